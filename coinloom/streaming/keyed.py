"""Keyed state with timers: balances and the mean age of coins from rows that may come out of order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AGES = "address_id long, nano long, mean_age_timestamp long"


def share(total: int, of: int) -> int:
    """A quotient cut towards zero."""
    return abs(total) // abs(of) * (1 if (total < 0) == (of < 0) else -1)


#: The store that keeps state on disk; Spark's own choice holds all of it in memory.
STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

ROW = ["address_id", "height", "tx_idx", "nano", "timestamp"]

#: Hash parts of addresses, a key of the state each.
PARTS = 4096

#: Rows that become Python's integers at once.
SLICE = 100_000


def _table(held: bytes, width: int) -> np.ndarray:
    return np.frombuffer(held, np.int64).reshape(-1, width)


def _fold(due: np.ndarray, known: dict[int, tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """Balance and mean of each address after its rows, which are sorted."""
    at, nano, mean, out = None, 0, 0, {}
    for i in range(0, len(due), SLICE):
        for address, _, _, n, t in due[i : i + SLICE].tolist():
            if address != at:
                if at is not None:
                    out[at] = nano, mean
                at, (nano, mean) = address, known.get(address, (0, 0))
            if n > 0:
                mean = share(mean * nano + t * n, nano + n) if nano + n else 0
            nano += n
            mean = mean if nano else 0
    return out if at is None else out | {at: (nano, mean)}


def _age(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """The balances and means of a part's addresses, and the rows that wait: those that the watermark hasn't passed, before which
    others may come. A timer at the first of them folds what the watermark has passed, in order, so only rows within the
    lateness are ever sorted. An address that holds nothing leaves the state, and so does a part without addresses and rows."""
    passed = state.getCurrentWatermarkMs()
    held, waiting = state.get if state.exists else (b"", b"")
    held, rows = _table(held, 3), [_table(waiting, len(ROW))]
    if not state.hasTimedOut:
        rows += [frame[ROW].to_numpy() for frame in frames]
    rows = np.concatenate(rows)
    if rows.dtype != np.int64:
        raise ValueError("rows hold nulls")
    over = rows[:, -1] < passed
    due, later = rows[over], rows[~over]
    if len(due):
        due = due[np.lexsort(due.T[::-1])]
        touched = np.isin(held[:, 0], due[:, 0])
        now = _fold(due, {a: (n, m) for a, n, m in held[touched].tolist()})
        told = np.array([(a, n, m) for a, (n, m) in now.items()], np.int64)
        held = np.concatenate([held[~touched], told[told[:, 1] != 0]])
        yield pd.DataFrame(told, columns=["address_id", "nano", "mean_age_timestamp"])
    if len(later):
        state.setTimeoutTimestamp(int(later[:, -1].min()))
    if len(held) or len(later):
        state.update((held.tobytes(), later.tobytes()))
    elif state.exists:
        state.remove()


def ages(diffs: DataFrame, lateness: str = "40 minutes", parts: int = PARTS) -> DataFrame:
    """A stream of diffs (address_id, height, tx_idx, nano, timestamp) -> (address_id, nano, mean_age_timestamp) of an address whenever the
    watermark passes rows of it: equal to mean_age of the rows that it has passed, zeros included. Rows that come later than
    the lateness are left out. Addresses share a key of the state by hash parts, whose number stays as it is for a checkpoint's
    life: Python is called once for each part that a batch or a timer touches, not for each address. Use it with STORE."""
    dealt = diffs.withColumns({"part": F.pmod(F.xxhash64("address_id"), F.lit(parts)), "at": F.timestamp_millis("timestamp")})
    return dealt.withWatermark("at", lateness).groupBy("part").applyInPandasWithState(_age, AGES, "held binary, waiting binary", "update", "EventTimeTimeout")
