"""Substring dedup by content-defined chunking: a gear rolling hash cuts texts where their content says so.

The hash at a byte depends on the 16 bytes that end there, and a chunk ends where it is the least within REACH
bytes on both sides. Cuts therefore move with the content: after an insertion they fall in the same places again.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize, mix64, portions, unused, utf8

REACH = 24
#: The shortest run of repeated chunks, in bytes, that is cut out.
MIN_RUN = 100
LONGEST = 2048
_GEAR = (mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The gear hash of the 16 bytes that end at each byte, h = (h << 1) + G[byte], by doubling of windows."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8):
        wide = h.copy()
        wide[width:] += h[:-width] << np.uint32(width)
        h = wide
    return h


def least_within(x: np.ndarray, reach: int) -> np.ndarray:
    """The least value within `reach` places on both sides."""
    n, width = len(x), 2 * reach + 1
    y = np.full(n + 2 * reach, np.iinfo(x.dtype).max, x.dtype)
    y[reach : reach + n] = x
    done = 1
    while done < width:
        step = min(done, width - done)
        y = np.minimum(y[:-step], y[step:])
        done += step
    return y


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one text, the last one len(data). Chunks don't split characters; where content repeats so
    that no least hash stands out, a chunk ends after LONGEST bytes."""
    n = len(data)
    if n <= REACH:
        return np.array([n][: n > 0], np.int64)
    h = mix64(gear(data).astype(np.uint64))
    near = least_within(h, REACH)
    spots = (h == near) & (np.arange(n) >= 15)
    spots[1:] &= h[1:] != h[:-1]
    ends = np.flatnonzero(spots) + 1
    ends = ends[ends < n]
    inside = (data[ends] & 0xC0) == 0x80  # the cut would fall into a character: move to its end
    while inside.any():
        ends[inside] += 1
        ends = ends[ends < n]
        inside = (data[ends] & 0xC0) == 0x80
    ends = np.unique(np.append(ends, n))
    if np.diff(ends, prepend=0).max() <= LONGEST:
        return ends
    out, at = [], 0
    for e in ends.tolist():
        while e - at > LONGEST:
            step = at + LONGEST
            while step > at + 1 and data[step] & 0xC0 == 0x80:
                step -= 1
            out.append(step)
            at = step
        out.append(e)
        at = e
    return np.array(out, np.int64)


#: What tells a document: its id, or a second hash of the text where it has none, and a hash of the text. Rows that share an id
#: stay apart unless their texts are equal too.
OWN = ("known", "id", "code")
CHUNK = "known boolean, id long, code long, start int, size int, hi long, lo long, again boolean"


def owner(id_col: str, text_col: str) -> dict[str, Column]:
    own = F.col(id_col).cast("long")
    text = F.coalesce(F.col(text_col), F.lit(""))
    return {"known": own.isNotNull(), "id": F.coalesce(own, F.xxhash64(F.lit(1), text)), "code": F.xxhash64(text)}


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(known, id, code, start, size, hi, lo, again): the chunks of each text, by bytes, with a 128-bit digest in two halves; again:
    the same chunk came earlier in this text."""
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(3))
            for i, j in portions(offsets):
                row, start, size, again, keys = [], [], [], [], []
                for r in range(i, j):
                    text = data[offsets[r] : offsets[r + 1]]
                    raw, seen, at = text.tobytes(), set(), 0
                    for end in cuts(text).tolist():
                        key = hashlib.blake2b(raw[at:end], digest_size=16).digest()
                        row.append(r), start.append(at), size.append(end - at), keys.append(key), again.append(key in seen)
                        seen.add(key)
                        at = end
                halves = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
                row = pa.array(row, pa.int32())
                own = [batch.column(k).take(row) for k in range(3)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(start, pa.int32()), pa.array(size, pa.int32()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(again, pa.bool_())], [*OWN, "start", "size", "hi", "lo", "again"])

    return docs.select(*(c.alias(n) for n, c in owner(id_col, text_col).items()), F.col(text_col)).mapInArrow(run, CHUNK)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(known, id, code, spans): for each document the chunks that came before, in a document of smaller id (null being the
    smallest) or earlier in itself."""
    every = materialize(chunks(docs, id_col, text_col), "chunks")
    once = every.where("not again")
    number = F.when(F.col("known"), F.col("id"))
    first = once.groupBy("hi", "lo").agg(F.min("known").alias("all_known"), F.min(number).alias("first"), F.max(number).alias("last"))
    first = first.where("if(all_known, first < last, last is not null)")
    first = materialize(first.select("hi", "lo", F.when(F.col("all_known"), F.col("first")).alias("first")), "repeats")
    # both sides of this join are dealt by digest, and what is hot among the chunks is split at run time
    later = once.join(first, ["hi", "lo"]).where("known and (first is null or id > first)").select(*OWN, "start", "size")
    spans = later.union(every.where("again").select(*OWN, "start", "size")).groupBy(*OWN)
    return materialize(spans.agg(F.sort_array(F.collect_set(F.struct("start", "size"))).alias("spans")), "spans")


def runs(spans: list[dict], min_run: int) -> list[tuple[int, int]]:
    """Adjacent chunks joined to (start, end), of which those of min_run bytes or more stay."""
    out: list[list[int]] = []
    for s in spans or []:
        if out and s["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s["start"] + s["size"])
        else:
            out.append([s["start"], s["start"] + s["size"]])
    return [(a, b) for a, b in out if b - a >= min_run]


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN, removed_col: str = "_removed") -> DataFrame:
    """docs with repeated passages cut out of text_col, and removed_col (a name that docs doesn't have): the cut (start, end)
    byte spans of the old text.

    The first occurrence, by id and then place, stays whole; each later run of at least min_run bytes of repeated chunks goes.
    Each row is a document of its own, whose passages are cut by what it repeats itself; null ids are the smallest, and of
    rows with equal ids, or with none, neither is earlier, so they keep what they share. Repeated rows get equal results.
    Null text stays null. A text that is a whole copy becomes empty. An empty table gives an empty one.
    """
    *own, found = unused(docs, *(f"span_{c}" for c in OWN), "spans")
    spans = repeated_spans(docs, id_col, text_col).toDF(*own, found)
    same = functools.reduce(lambda a, b: a & b, (c == F.col(n) for c, n in zip(owner(id_col, text_col).values(), own, strict=True)))
    joined = docs.join(spans, same, "left")
    names = docs.columns
    at, texts = len(names), names.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{removed_col}` array<struct<start:int,end:int>>"

    def run(batches):
        for batch in batches:
            new, gone = [], []
            for text, spans in zip(batch.column(texts).to_pylist(), batch.column(at).to_pylist(), strict=True):
                cut = runs(spans, min_run) if text else []
                if cut:
                    raw = text.encode()
                    ends = [0, *(b for _, b in cut)]
                    text = b"".join(raw[a:b] for a, b in zip(ends, [*(a for a, _ in cut), len(raw)], strict=True)).decode()
                new.append(text), gone.append([{"start": a, "end": b} for a, b in cut])
            columns = [pa.array(new, pa.string()) if i == texts else batch.column(i) for i in range(at)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(gone, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], [*names, removed_col])

    return joined.select(*names, found).mapInArrow(run, schema)
