"""Structured Streaming: blocks to diffs and balances with replays and rollbacks, windows, late prices, keyed state.

chain: facts that follow the best branch; state: balances, means and statistics kept by batches, with a log to undo blocks;
detection: exchange deposits by batches; keyed: state with timers; tables: what these write.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ROLLBACK_HORIZON
from ..operators.prices import interpolated
from ..shared import materialize, shared_dir
from ..sources import upserted
from .chain import DIFFS, HEADERS, Chain, Ledger, best_branch, branches, broken_links  # noqa: F401
from .tables import table_or_empty


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Feed all that is there to handle, batch by batch, and stop; the checkpoint remembers what was read."""
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


class BlockPrices:
    """Prices of blocks under a folder, as price points arrive in order. Once two points enclose a block its price is final and is
    written once; a batch is a folder, so a replayed one takes its own place. A point that comes before the last one changes
    nothing, as all until then is final: a batch reads the blocks after it, and no others."""

    def __init__(self, spark: SparkSession, path: str, blocks: DataFrame, genesis_heights: int = 3):
        self.spark, self.path, self.blocks, self.genesis_heights = spark, path, blocks, genesis_heights

    def _last(self, before: int | None = None) -> tuple | None:
        """(batch, timestamp, price) of the last point, as of all batches or of those before a number. The last two batches have a row."""
        rows = table_or_empty(self.spark, f"{self.path}/last", "batch long, timestamp long, price double").collect()
        return max(((r["batch"], r["timestamp"], r["price"]) for r in rows if r["timestamp"] is not None and (before is None or r["batch"] < before)), default=None)

    def take(self, batch: DataFrame, number: int) -> None:
        """Points (timestamp, price) of a batch; for foreachBatch."""
        last = self._last(number)
        points = batch.select("timestamp", F.col("price").cast("double").alias("price")).dropDuplicates(["timestamp"])
        if last is not None:
            points = points.where(F.col("timestamp") > last[1]).unionByName(self.spark.createDataFrame([last[1:]], "timestamp long, price double"))
        points = materialize(points, "points")
        latest = points.agg(F.max("timestamp"), F.max_by("price", "timestamp")).first()
        if latest[0] is not None:
            above = F.col("height") > self.genesis_heights
            pending = self.blocks.where(F.col("timestamp") > last[1]).where(above) if last else self.blocks
            pending = pending.where(~above | (F.col("timestamp") <= latest[0])).select("height", "timestamp")
            priced = interpolated(pending, points, self.genesis_heights).where("not provisional").select("height", "price")
            priced.write.mode("overwrite").parquet(f"{self.path}/final/batch={number}")
        row = self.spark.createDataFrame([(number, *latest)], "batch long, timestamp long, price double")
        row.write.mode("overwrite").parquet(f"{self.path}/last/slot={number % 2}")

    def prices(self) -> DataFrame:
        """(height, price, provisional): final prices, and the last point's for blocks after it."""
        last = self._last()
        done = table_or_empty(self.spark, f"{self.path}/final", "height long, price double").select("height", "price").withColumn("provisional", F.lit(False))
        if last is None:
            return done
        later = self.blocks.where((F.col("height") > self.genesis_heights) & (F.col("timestamp") > last[1]))
        return done.unionByName(later.select("height", F.lit(last[2]).alias("price"), F.lit(True).alias("provisional")))


def main_chain(headers: DataFrame, horizon: int = ROLLBACK_HORIZON) -> DataFrame:
    """headers with main_chain: the chain that ends at the best tip (of equal heights the smaller id). Only the last `horizon` heights
    can hold forks; the walk down from the tip joins once for each of them, on those few rows."""
    top = headers.agg(F.max("height")).first()[0]
    recent = headers.where(F.col("height") > (top or 0) - horizon)
    step = recent.where(F.col("height") == top).orderBy("header_id").limit(1)
    chain = step.select("header_id")
    for _ in range(horizon - 1):
        step = recent.join(step.select(F.col("parent_id").alias("_up")), F.col("header_id") == F.col("_up")).drop("_up")
        chain = chain.union(step.select("header_id"))
    main = F.broadcast(chain.withColumn("_main", F.lit(True)))  # at most `horizon` ids
    flagged = headers.join(main, "header_id", "left")
    return flagged.select("height", "timestamp", "header_id", "parent_id", ((F.col("height") <= (top or 0) - horizon) | F.coalesce("_main", F.lit(False))).alias("main_chain"))


def state_log(before: DataFrame, diffs: DataFrame, height: int) -> DataFrame:
    """What a batch of diffs touches, to undo it: (height, address_id, old) with null for new keys. Only touched keys are logged,
    and before is read for them alone."""
    touched = diffs.select("address_id").distinct()
    old = before.join(touched, "address_id", "left_semi").withColumnRenamed("nano", "old")
    return touched.join(old, "address_id", "left").select(F.lit(height).alias("height"), "address_id", "old")


def restored(balances: DataFrame, log: DataFrame, height: int) -> DataFrame:
    """Balances as they were before `height`: of each key the oldest logged state from there on."""
    undo = log.where(F.col("height") >= height).groupBy("address_id").agg(F.min_by(F.struct("old"), "height").alias("r")).select("address_id", F.col("r.old").alias("nano"))
    return upserted(balances, undo, ["address_id"]).where("nano is not null")


def hourly_totals(events: DataFrame, time: str, lateness: str = "40 minutes", width: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Counts and sums of value by tumbling or sliding windows; rows later than the watermark are left out."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return events.withWatermark(time, lateness).groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding_difficulty(headers: DataFrame, lateness: str = "40 minutes", width: str = "24 hours", slide: str = "1 hour") -> DataFrame:
    """A stream of headers (time, timestamp, difficulty) -> (start, n, difficulty_24h, hash_rate_24h) of each sliding window, once the watermark
    has passed its end: the mean rounds half to even, the rate truncates over at least 120 seconds between the first and the
    last block. Headers that come later than the lateness are left out."""
    w = F.window("time", width, slide)
    sums = headers.withWatermark("time", lateness).groupBy(w.alias("w")).agg(F.count("*").alias("n"), F.sum(F.col("difficulty").cast("decimal(38,0)")).alias("s"), F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    mean = F.expr("bround(s / cast(n as decimal(20,0)), 0)").cast("long").alias("difficulty_24h")
    rate = F.expr("s div cast(greatest((b - a) div 1000, 120) as decimal(20,0))").cast("long").alias("hash_rate_24h")
    return sums.select(F.col("w.start").alias("start"), "n", mean, rate)


def running_balances(diffs: DataFrame) -> DataFrame:
    """A stream of diffs (address_id, height, tx_idx, nano, timestamp) -> (address_id, nano, mean_age_timestamp) whenever a batch touches an
    address; its state is a balance and a mean. A key's rows of a batch are sorted in memory and folded in order, so the source's
    limit of files a trigger bounds them."""

    def fold(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        balance, mean = state.get if state.exists else (0, 0)
        for r in pd.concat(list(frames)).sort_values(["height", "tx_idx"]).itertuples():
            if r.nano > 0 and balance + r.nano:
                mean = (int(mean) * int(balance) + int(r.timestamp) * int(r.nano)) // (int(balance) + int(r.nano))
            balance += int(r.nano)
            mean = mean if balance else 0
        state.update((balance, mean))
        yield pd.DataFrame({"address_id": [key[0]], "nano": [balance], "mean_age_timestamp": [mean]})

    return diffs.groupBy("address_id").applyInPandasWithState(fold, "address_id long, nano long, mean_age_timestamp long", "nano long, mean long", "update", "NoTimeout")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parque[t]")


def to_table(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there into a table under path, and read it."""
    stream.writeStream.outputMode(mode).format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder that driver and executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
