"""Prices of blocks: interpolation between known points, as-of lookups, and provisional values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import DAY_MS, GENESIS_PRICE, HOUR_MS
from .helpers import interval_join, with_next


#: Points whose neighbours one task finds: those of thirty days.
BUCKET_MS = 30 * DAY_MS


def intervals(prices: DataFrame) -> DataFrame:
    """(t0, p0, t1, p1, first): neighbouring points. Each bucket of days orders its own points, and looks its successor's first one
    up among one row a bucket."""
    rows = with_next(prices.select("timestamp", "price"), "timestamp", ["timestamp", "price"], BUCKET_MS)
    least = prices.agg(F.min("timestamp").alias("_least"))
    both = rows.crossJoin(F.broadcast(least))  # one row
    return both.select(F.col("timestamp").alias("t0"), F.col("price").alias("p0"), F.col("next_timestamp").alias("t1"), F.col("next_price").alias("p1"), (F.col("timestamp") == F.col("_least")).alias("first"))


def interpolated(blocks: DataFrame, prices: DataFrame, genesis_heights: int = 3, single: bool = False) -> DataFrame:
    """(height, price, provisional): linear between the points around a block's time; blocks up to genesis_heights have a fixed price;
    beyond the last point its value holds, as provisional. Blocks before the first point have no row. single: prices are of single
    precision, and so is each step between them, as in ledgers that keep 32-bit prices; the price is then a float."""
    between = intervals(prices).where("t1 is not null")
    inside = ((F.col("timestamp") > F.col("t0")) | (F.col("first") & (F.col("timestamp") == F.col("t0")))) & (F.col("timestamp") <= F.col("t1"))
    later = blocks.where(F.col("height") > genesis_heights)
    kind = "float" if single else "double"
    p0, p1, passed, length = (c.cast(kind) for c in (F.col("p0"), F.col("p1"), F.col("timestamp") - F.col("t0"), F.col("t1") - F.col("t0")))
    # a quotient of two floats by way of doubles is the float next to it
    price = p0 + (p1 - p0) * (passed / length).cast(kind) if single else p0 + (p1 - p0) * passed / length
    found = interval_join(later, "timestamp", between, "t0", "t1", HOUR_MS, inside).select("height", price.alias("price"), F.lit(False).alias("provisional"))
    last = prices.agg(F.max("timestamp").alias("t"), F.max_by("price", "timestamp").cast(kind).alias("p"))
    beyond = later.crossJoin(F.broadcast(last)).where(F.col("timestamp") > F.col("t")).select("height", F.col("p").alias("price"), F.lit(True).alias("provisional"))  # one row
    genesis = blocks.where(F.col("height") <= genesis_heights).select("height", F.lit(GENESIS_PRICE).cast(kind).alias("price"), F.lit(False).alias("provisional"))
    return found.unionByName(beyond).unionByName(genesis)


def last_prior(points: DataFrame, prices: DataFrame) -> DataFrame:
    """points (key, timestamp) with the last price at or before, if any."""
    spans = intervals(prices)
    end = F.coalesce("t1", F.lit(2**62))
    bounded = spans.withColumn("until", F.coalesce("t1", "t0"))
    inside = (F.col("timestamp") >= F.col("t0")) & (F.col("timestamp") < end)
    found = interval_join(points, "timestamp", bounded.where("t1 is not null"), "t0", "until", HOUR_MS, inside).select(*points.columns, F.col("p0").alias("price"))
    last = spans.where("t1 is null").select("t0", "p0")
    tail = points.crossJoin(F.broadcast(last)).where("timestamp >= t0").select(*points.columns, F.col("p0").alias("price"))  # one row
    return found.unionByName(tail)


def refreshed(block_prices: DataFrame, blocks: DataFrame, prices: DataFrame) -> DataFrame:
    """Block prices after more points came: provisional ones alone are made anew."""
    again = interpolated(blocks.join(block_prices.where("provisional").select("height"), "height", "left_semi"), prices, -1)
    return block_prices.where("not provisional").unionByName(again)
