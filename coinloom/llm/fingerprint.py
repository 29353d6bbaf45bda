"""Document fingerprints: quartile bucket digests of hashed byte triplets, and their bounded difference score."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, portions, utf8

BUCKETS = 256
TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))  # places of the second and third byte after the first
LENGTH_WEIGHT = 12
#: The largest difference: three steps in each bucket, and the length's share.
WORST = 3 * BUCKETS + LENGTH_WEIGHT * 16
HEX = 2 + BUCKETS // 2


def bucket_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """texts x BUCKETS: how many triplets of each text fall in each bucket. Triplets never cross texts."""
    n = len(offsets) - 1
    counts = np.zeros((n, BUCKETS), np.int64)
    wide = data.astype(np.uint32)
    owner = np.repeat(np.arange(n, dtype=np.int64) * BUCKETS, np.diff(offsets))
    for kind, (second, third) in enumerate(TRIPLETS, 1):
        if len(data) <= third:
            continue
        h = (wide[:-third] * np.uint32(0x9E3779B1) + wide[second : len(wide) - third + second] * np.uint32(0x85EBCA77)) ^ (wide[third:] * np.uint32(0xC2B2AE3D) + np.uint32(kind * 0x27D4EB2F))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        inside = owner[:-third] == owner[third:]
        where = owner[:-third] + (h >> np.uint32(24))
        counts += np.bincount(where[inside], minlength=n * BUCKETS).reshape(n, BUCKETS)
    return counts


def codes(counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """texts x (1 + BUCKETS): the length on a scale of 8 steps a doubling, and each bucket's quartile from 0 to 3."""
    ordered = np.sort(counts, axis=1)
    q = [ordered[:, BUCKETS * i // 4 - 1][:, None] for i in (1, 2, 3)]
    quartile = sum((counts > x).astype(np.int16) for x in q)
    scale = np.minimum(np.round(8 * np.log2(lengths + 1.0)), 255).astype(np.int16)
    return np.concatenate([scale[:, None], quartile.astype(np.int16)], axis=1)


def text_of(code: np.ndarray) -> list[str]:
    four = code[:, 1:].reshape(len(code), -1, 4)
    packed = (four * np.array([64, 16, 4, 1], np.int16)).sum(2).astype(np.uint8)
    return [bytes([int(a), *row]).hex() for a, row in zip(code[:, 0], packed.tolist(), strict=True)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 - difference / WORST of codes, row by row: 1 for equal digests, never below 0. The difference counts a bucket's
    steps between quartiles (two apart weigh 2, opposite ones 3) and the lengths' steps, at most 16."""
    steps = np.abs(a[:, 1:] - b[:, 1:]).sum(1)
    length = np.minimum(np.abs(a[:, 0] - b[:, 0]), 16) * LENGTH_WEIGHT
    return 1.0 - (steps + length) / WORST


def digests(texts: list[str]) -> np.ndarray:
    """Codes of texts; an empty text has quartiles 0 and length 0."""
    parts = []
    data, offsets = utf8(pa.array(texts, pa.string()))
    for i, j in portions(offsets):
        own = offsets[i : j + 1] - offsets[i]
        parts.append(codes(bucket_counts(data[offsets[i] : offsets[j]], own), np.diff(own)))
    return np.concatenate([np.zeros((0, 1 + BUCKETS), np.int16), *parts])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of each row, as hex: where it is read, without a shuffle. Null text counts as empty; repeated rows
    get equal fingerprints; an empty table gives an empty one."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(text_of(digests([t or "" for t in batch.column(1).to_pylist()])), pa.string())], ["doc_id", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"doc_id {kind}, fingerprint string")


def edited(text: str, other: str) -> str:
    """text with its last quarter of code points replaced by the first as many, or all, of other."""
    n = len(text) // 4
    return text[: len(text) - n] + other[:n]


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """For each row its fingerprint, that of its edited text, and the likeness to that and to the next row's fingerprint.

    Rows are in ascending order of id, nulls first and ties by a hash of the text; the row after the last is the first. One shuffle deals
    whole texts into ranges of ids; each range also gets a copy of the next range's first row, so it streams in
    order with one row held back. Nothing but the ranges' bounds reaches the driver. An id that fills several
    ranges, and null ids, are dealt by the hash that orders them. An empty table gives an empty one; a single
    row is its own next.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = rows.where("doc_id is not null").stat.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 1 / (4 * parts)) if parts > 1 else []
    often = Counter(int(b) for b in bounds)
    hot, bounds = [b for b, n in often.items() if n > 1], sorted(often)  # a bound that comes twice is an id with rows for a range and more
    # as many ranges as partitions; a hot id comes first in its range, and like null ids has 64, by the leading bits of its hashes
    by_hash = F.shiftright(F.xxhash64("text"), 58).cast("int") + 32
    placed = rows.withColumn("part", F.when(F.col("doc_id").isNull(), by_hash).otherwise((bucket_of(bounds) + 1) * 128 + F.when(F.col("doc_id").isin(hot), by_hash).otherwise(64)))
    order = F.struct("doc_id", F.xxhash64("text").alias("h"))
    firsts = placed.groupBy("part").agg(F.min(order).alias("first")).collect()
    heads = sorted(firsts, key=lambda r: r["part"])
    if not heads:
        return spark.createDataFrame([], RESULT)
    copies = [(heads[(i + 1) % len(heads)]["first"]["doc_id"], heads[(i + 1) % len(heads)]["first"]["h"], r["part"]) for i, r in enumerate(heads)]
    wanted = spark.createDataFrame(copies, "id long, h long, to int")
    # one row for each range: as small as the number of partitions
    guests = rows.join(F.broadcast(wanted), F.expr("doc_id <=> id and xxhash64(text) = h")).select("doc_id", "text", F.col("to").alias("part"), F.lit(True).alias("guest")).dropDuplicates(["part"])
    every = placed.select("doc_id", "text", "part", F.lit(False).alias("guest")).union(guests)
    dealt = every.repartition("part").sortWithinPartitions("part", "guest", "doc_id", F.xxhash64("text"))
    return dealt.select("doc_id", "text", "part", "guest").mapInArrow(stream, RESULT)


def bucket_of(bounds: list[int]):
    """How many bounds are at or below doc_id, by halving: a balanced tree of comparisons."""

    def tree(lo: int, hi: int):
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col("doc_id") < bounds[mid], tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(bounds)).cast("int")


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def stream(batches):
    """Rows of a range in order, its guest last: each waits for the row after it."""
    held = None  # (id, text, part, code)
    for batch in batches:
        ids, parts, guests = batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
        texts = batch.column(1).to_pylist()
        code = digests(texts)
        out = []  # (id, text, code, next text, next code)
        for i in range(len(ids)):
            if held is not None and held[2] == parts[i]:
                out.append((*held[:2], held[3], texts[i], code[i]))
            held = None if guests[i] else (ids[i], texts[i], parts[i], code[i])
        if not out:
            continue
        changed = [edited(t, n) for _, t, _, n, _ in out]
        own, new, after = np.array([x[2] for x in out]), digests(changed), np.array([x[4] for x in out])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in out], pa.int64()),
                pa.array([len(x[1]) for x in out], pa.int64()),
                pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in changed], pa.string()),
                pa.array(text_of(own), pa.string()),
                pa.array(text_of(new), pa.string()),
                pa.array(likeness(own, new)),
                pa.array(likeness(own, after)),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )
