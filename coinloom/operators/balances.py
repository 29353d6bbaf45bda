"""Balances, their history, block-level changes, and the mean age of coins."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import materialize


def erg_balances(diffs: DataFrame, at_height: int | None = None) -> DataFrame:
    """(address_id, nano) above zero, now or after a height."""
    some = diffs if at_height is None else diffs.where(F.col("height") <= at_height)
    return some.groupBy("address_id").agg(F.sum("nano").alias("nano")).where("nano > 0")


def token_balances(diffs: DataFrame, at_height: int | None = None) -> DataFrame:
    some = diffs if at_height is None else diffs.where(F.col("height") <= at_height)
    return some.groupBy("address_id", "asset_id").agg(F.sum("value").alias("value")).where("value <> 0")


def balances_at_timestamp(diffs: DataFrame, headers: DataFrame, t: int, value: str = "nano") -> DataFrame:
    """Sums of the diffs in blocks up to a time: the heights are filtered first, so only they join."""
    return diffs.join(headers.where(F.col("timestamp") <= t).select("height"), "height").groupBy("address_id").agg(F.sum(value).alias(value))


def aggregate_diff_series(diffs: DataFrame, addresses: DataFrame, max_height: int | None = None) -> DataFrame:
    some = diffs if max_height is None else diffs.where(F.col("height") <= max_height)
    return some.join(addresses.select("address_id"), "address_id", "left_semi").groupBy("height").agg(F.sum("nano").alias("nano"))


def first_tx_height(diffs: DataFrame) -> DataFrame:
    return diffs.groupBy("address_id").agg(F.min("height").alias("height"))


def by_block(diffs: DataFrame, value: str = "nano", keys: tuple = ("address_id",)) -> DataFrame:
    return diffs.groupBy(*keys, "height").agg(F.sum(value).alias(value))


def balance_history(diffs: DataFrame, value: str = "nano", keys: tuple = ("address_id",), by_blocks: bool = True) -> DataFrame:
    """diffs with balance: the sum up to and including the block, the same for each of an address's rows in a block.

    Sums by block come first, so a window holds a row a block at most, however busy an address is. Where hardly any of the keys
    has two rows in a block, these sums are as many as the rows: without by_blocks a window runs over the rows, dealt out once.
    It holds a key's rows beside it on disk where they are many.
    """
    w = Window.partitionBy(*keys).orderBy("height")  # to the end of the block
    if not by_blocks:
        return diffs.select(*keys, *(c for c in diffs.columns if c not in keys), F.sum(value).over(w).alias("balance"))
    run = by_block(diffs, value, keys).withColumn("balance", F.sum(value).over(w))
    return diffs.join(run.select(*keys, "height", "balance"), [*keys, "height"])


def balance_changes(diffs: DataFrame, value: str = "nano", keys: tuple = ("address_id",)) -> DataFrame:
    """(keys, height, old, new, kind): new, spent or modified balances by block. What starts and ends a block at zero is left
    out; what is unchanged over a block counts as modified, as its diffs touched it."""
    w = Window.partitionBy(*keys).orderBy("height")
    run = by_block(diffs, value, keys).withColumn("new", F.sum(value).over(w)).withColumn("old", F.col("new") - F.col(value))
    kind = F.when(F.col("old") == 0, "new").when(F.col("new") == 0, "spent").otherwise("modified")
    return run.where("old <> 0 or new <> 0").select(*keys, "height", "old", "new", kind.alias("kind"))


def live_steps(diffs: DataFrame, headers: DataFrame, span: int = 1000) -> DataFrame:
    """(address_id, step, credit, timestamp, debit): an address's credits after its last zero balance, in order, each with the sum
    of the debits that follow it. Debits before the first credit are a step without one.

    Balances and counts of credits are sums over spans of heights and running windows within an address's span, so a busy
    address is dealt out like the others.
    """
    key = ["address_id", "span"]
    rows = diffs.join(headers.select("height", "timestamp"), "height").select("address_id", F.floor(F.col("height") / span).alias("span"), "height", "tx_idx", "nano", "timestamp", (F.col("nano") > 0).cast("long").alias("credits"))
    rows = materialize(rows, "dated")
    before = Window.partitionBy("address_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*key).agg(F.sum("nano").alias("n"), F.sum("credits").alias("c")).select(*key, *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("n", "c")))
    so_far = Window.partitionBy(*key).orderBy("height", "tx_idx").rowsBetween(Window.unboundedPreceding, 0)
    run = rows.join(starts, key).select("address_id", "height", "tx_idx", "nano", "timestamp", (F.sum("nano").over(so_far) + F.col("n")).alias("balance"), (F.sum("credits").over(so_far) + F.col("c")).alias("step"))
    run = materialize(run, "balances")
    at = F.struct("height", "tx_idx")
    zeros = run.where("balance = 0").groupBy("address_id").agg(F.max(at).alias("zero"))
    live = run.join(zeros, "address_id", "left").where(F.col("zero").isNull() | (at > F.col("zero")))
    is_credit = F.col("nano") > 0
    return live.groupBy("address_id", "step").agg(
        F.sum(F.when(is_credit, F.col("nano")).otherwise(0)).alias("credit"), F.max(F.when(is_credit, F.col("timestamp"))).alias("timestamp"), F.sum(F.when(~is_credit, F.col("nano")).otherwise(0)).alias("debit")
    )


def folded(rows: DataFrame, state: DataFrame | None = None, log_from: int | None = None) -> DataFrame:
    """(address_id, height, nano, mean_age_timestamp) of the addresses of rows (address_id, height, tx_idx, nano, timestamp), from state
    (address_id, nano, mean_age_timestamp) or from nothing: with a null height what an address has in the end, zeros included, and, from
    the height log_from on, what it had before each block that touches it (null: nothing).

    Rows are dealt by address, sorted, and stream through with one address's state at a time.
    """
    none = F.lit(None).cast("long")
    stream = rows.select("address_id", "height", "tx_idx", "nano", "timestamp")
    if state is not None:
        stream = stream.unionByName(state.select("address_id", none.alias("height"), none.alias("tx_idx"), "nano", F.col("mean_age_timestamp").alias("timestamp")))
    stream = stream.select("address_id", F.coalesce("height", F.lit(-(2**62))).alias("height"), F.coalesce("tx_idx", F.lit(0)).cast("long").alias("tx_idx"), "nano", "timestamp")
    least = 2**62 if log_from is None else log_from

    def share(total: int, of: int) -> int:
        """A quotient cut towards zero."""
        return abs(total) // abs(of) * (1 if (total < 0) == (of < 0) else -1)

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, block, balance, mean, out = None, None, 0, 0, []
        frame = lambda rows: pd.DataFrame(rows, columns=["address_id", "height", "nano", "mean_age_timestamp"]).astype({"address_id": "int64", "height": "Int64", "nano": "Int64", "mean_age_timestamp": "Int64"})
        for f in frames:
            for a, h, n, t in zip(f["address_id"].tolist(), f["height"].tolist(), f["nano"].tolist(), f["timestamp"].tolist(), strict=True):
                if a != current:
                    if current is not None:
                        out.append((current, None, balance, mean))
                    current, block, balance, mean = a, None, 0, 0
                    if h == -(2**62):
                        balance, mean = n, t
                        continue
                if h != block and h >= least:
                    out.append((a, h, balance or None, mean if balance else None))
                block = h
                if n > 0:  # a debt paid off exactly leaves nothing whose age could be told
                    mean = share(mean * balance + t * n, balance + n) if balance + n else 0
                balance += n
                mean = mean if balance else 0
            yield frame(out)
            out = []
        if current is not None:
            yield frame([(current, None, balance, mean)])

    dealt = stream.repartition("address_id").sortWithinPartitions("address_id", "height", "tx_idx")
    return dealt.mapInPandas(fold, "address_id long, height long, nano long, mean_age_timestamp long")


#: Diffs of an address from which on mean_age cuts what lies before its last zero balance, and sums debits, before it folds.
HOT = 100_000


def mean_age(diffs: DataFrame, headers: DataFrame) -> DataFrame:
    """(address_id, nano, mean_age_timestamp): the value-weighted mean time at which an address's coins came.

    A credit moves the mean to trunc((mean * balance + time * amount) / new balance); a debit leaves it; at zero it is
    forgotten. The truncation makes that an ordered fold: an address's rows stream sorted through one task, with its state
    alone in memory. Of addresses with HOT rows only the steps that can matter are folded. streaming.state keeps states, so
    that a further run folds what has come since.
    """
    rows = materialize(diffs.join(headers.select("height", "timestamp"), "height").select("address_id", "height", "tx_idx", "nano", "timestamp"), "dated")
    hot = materialize(rows.groupBy("address_id").agg(F.count("*").alias("n")).where(F.col("n") >= HOT).select("address_id"), "hot")
    finals = lambda df: folded(df).where("height is null and nano > 0").drop("height")
    if hot.isEmpty():
        return finals(rows)
    return finals(rows.join(hot, "address_id", "left_anti")).unionByName(mean_of_steps(live_steps(rows.join(hot, "address_id", "left_semi").drop("timestamp"), headers)))


def mean_of_steps(steps: DataFrame) -> DataFrame:
    """mean_age from live_steps, which are dealt by address, sorted, and stream through."""

    def share(total: int, of: int) -> int:
        """A quotient cut towards zero."""
        return abs(total) // abs(of) * (1 if (total < 0) == (of < 0) else -1)

    def fold(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, balance, mean = None, 0, 0
        for frame in frames:
            out = []
            for a, credit, t, debit in zip(frame["address_id"].tolist(), frame["credit"].tolist(), frame["timestamp"].tolist(), frame["debit"].tolist(), strict=True):
                if a != current:
                    if current is not None and balance > 0:
                        out.append((current, balance, mean))
                    current, balance, mean = a, 0, 0
                if credit > 0:  # a debt paid off exactly leaves nothing whose age could be told
                    mean = share(mean * balance + t * credit, balance + credit) if balance + credit else 0
                balance += credit + debit
            yield pd.DataFrame(out, columns=["address_id", "nano", "mean_age_timestamp"])
        if current is not None and balance > 0:
            yield pd.DataFrame([(current, balance, mean)], columns=["address_id", "nano", "mean_age_timestamp"])

    steps = steps.withColumn("timestamp", F.coalesce("timestamp", F.lit(0)))  # else pandas makes floats of them
    dealt = steps.repartition("address_id").sortWithinPartitions("address_id", "step")
    return dealt.mapInPandas(fold, "address_id long, nano long, mean_age_timestamp long")
