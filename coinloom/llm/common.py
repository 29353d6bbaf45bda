"""Small helpers shared by the operators: Arrow text access and word hashing; shared storage and global ranks come from ..shared."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..shared import materialize, ordered_rank, shared_dir  # noqa: F401

#: What separates words: these six ASCII characters and no others.
WORD = r"[^\x20\x09-\x0D]+"


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that go to Python, by rows and by bytes, so that long texts don't add up. The same bounds for
    every operator; they stay set in the session, as plans read them when they run."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")


def unused(df: DataFrame, *names: str) -> list[str]:
    """names as columns that df doesn't have, by underscores before them; Spark's columns don't tell case apart."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column in one array, and n + 1 offsets; null counts as empty."""
    a = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(a):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, what = a.buffers()
    offsets = np.frombuffer(where, np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(what, np.uint8) if what is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def portions(offsets: np.ndarray, most: int = 1 << 20):
    """Runs (first, after) of rows that hold about `most` bytes together; a longer row comes alone, whole."""
    first, n = 0, len(offsets) - 1
    while first < n:
        after = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, min(after, n)
        first = min(after, n)


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (two xor-multiply rounds): spreads each input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(max(n, 1 << 20), base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


class Words:
    """Where the words of some texts are, and 64-bit hashes of whole words or of their first bytes.

    starts, ends: byte positions; rows: n + 1 offsets into them, a text's words being rows[i]:rows[i + 1].
    Lower-cases A-Z only.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = _LOWER[data]
        n = len(data)
        filled = ~_SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.ones(n, bool)
        before[1:] = ~filled[:-1]
        after = np.ones(n, bool)
        after[:-1] = ~filled[1:]
        self.starts = np.flatnonzero(filled & (before | edge[:n]))
        self.ends = np.flatnonzero(filled & (after | edge[1:])) + 1
        self.rows = np.searchsorted(self.starts, offsets)
        power, self._inverse = _powers(n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=self._sums[1:])

    def hashes(self, first: int | None = None) -> np.ndarray:
        ends = self.ends if first is None else np.minimum(self.ends, self.starts + first)
        return mix64((self._sums[ends] - self._sums[self.starts]) * self._inverse[self.starts])
