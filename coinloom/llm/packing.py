"""Packing by power-of-two decomposition: every piece of a document has a binary length and fills a sequence of that length."""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, ordered_rank

PIECE = "start long, length long, ids binary, doc_tokens long"


@functools.lru_cache(maxsize=2)
def _encoder(json_path: str, ranks_path: str, pattern: str):
    """text -> ids. The byte ranks of the same vocabulary encode ordinary text several times faster than the json's
    library, with the same ids; texts that hold a special string go to that library itself."""
    import base64
    import json

    import tiktoken
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    with open(json_path) as f:
        special = [t["content"] for t in json.load(f)["added_tokens"]]
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
    fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    whole = Tokenizer.from_file(json_path)
    return lambda text: whole.encode(text, add_special_tokens=False).ids if any(s in text for s in special) else fast.encode_ordinary(text)


def binary_lengths(n: int, longest: int) -> list[int]:
    """n as pieces of `longest`, a power of two, and the binary digits of the rest, longest first."""
    return [longest] * (n // longest) + [1 << k for k in range(longest.bit_length() - 1, -1, -1) if n % longest >> k & 1]


def pieces(docs: DataFrame, json_path: str, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, longest: int = 2048) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens): the pieces of every document, ids as little-endian 32-bit words.

    A document's ids end with end_id, so null and empty texts give one piece of one id. Whole texts are encoded where
    they are read; nothing is shuffled.
    """
    bounded_batches(docs.sparkSession)

    def cut(batches):
        encode = _encoder(json_path, ranks_path, pattern)
        for batch in batches:
            row, start, length, ids, total = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = np.array([*encode(text or ""), end_id], "<u4")
                at = 0
                for n in binary_lengths(len(words), longest):
                    row.append(i), start.append(at), length.append(n), ids.append(words[at : at + n].tobytes()), total.append(len(words))
                    at += n
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int32())), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array(total, pa.int64())], ["doc_id", "start", "length", "ids", "doc_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, f"doc_id {kind}, {PIECE}")


def pack(cut: DataFrame) -> DataFrame:
    """Pieces -> with sequence_id and offset. Pieces of equal length lie in one bucket with adjacent sequence ids, in the order
    of document and place, so a batch of adjacent sequences has one length and nothing is padded; no sequence crosses documents.
    Repeated rows and rows with a null id (first in their bucket) are pieces of their own; no pieces give an empty table.
    """
    order = [F.col("length"), F.col("doc_id").asc_nulls_first(), F.col("start")]
    return ordered_rank(cut, order, "sequence_id").withColumn("offset", F.lit(0).cast("long"))


def packed(docs: DataFrame, json_path: str, ranks_path: str, pattern: str, **how) -> DataFrame:
    """The packing of docs with the checksum of each piece's ids in place of the ids. Null and empty texts have one id, hence
    one piece; repeated rows are packed as often as they come; other columns aren't read; an empty table gives an empty one."""
    cut = pieces(docs, json_path, ranks_path, pattern, **how)
    cut = materialize(cut.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"), "pieces")
    return pack(cut).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
