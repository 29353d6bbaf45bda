"""Ordered work that no single task does alone: prefix sums, forward fill, dense ids, interval joins, gap fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..shared import ordered_rank


def prefix_sum(df: DataFrame, order: str, values: Sequence[str], by: Sequence[str] = (), bucket: int = 10_000) -> DataFrame:
    """df with each value replaced by its sum up to and including the row's `order`, within `by`.

    df has one row for each (by, order). Buckets of `order` are summed and cumulated, one row each; within a bucket a
    window runs over at most `bucket` rows. `by` columns hold no nulls.
    """
    keyed = df.withColumn("_bucket", F.floor(F.col(order) / bucket).cast("long"))
    sums = keyed.groupBy(*by, "_bucket").agg(*(F.sum(v).alias(f"_{v}") for v in values))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*by, "_bucket", *(F.coalesce(F.sum(f"_{v}").over(before), F.lit(0)).alias(f"_{v}") for v in values))
    own = Window.partitionBy(*by, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = keyed.join(starts, [*by, "_bucket"])
    return joined.select(*(((F.sum(c).over(own) + F.col(f"_{c}")).cast("long").alias(c) if c in values else F.col(c)) for c in df.columns))


def forward_fill(df: DataFrame, order: str, values: Sequence[str], bucket: int = 10_000) -> DataFrame:
    """df with nulls of each value replaced by the last one before in `order`, which is unique."""
    keyed = df.withColumn("_bucket", F.floor(F.col(order) / bucket).cast("long"))
    last = keyed.groupBy("_bucket").agg(*(F.max_by(v, F.when(F.col(v).isNotNull(), F.col(order))).alias(f"_{v}") for v in values))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("_bucket", *(F.last(f"_{v}", ignorenulls=True).over(before).alias(f"_{v}") for v in values))
    own = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = keyed.join(carried, "_bucket")
    return joined.select(*((F.coalesce(F.last(c, ignorenulls=True).over(own), f"_{c}").alias(c) if c in values else F.col(c)) for c in df.columns))


def dense_ids(df: DataFrame, order: Sequence[str], name: str, start: int = 0) -> DataFrame:
    """df with consecutive numbers from `start` in a global order. The order must be total for reruns to agree."""
    return ordered_rank(df, list(order), name).withColumn(name, F.col(name) + start)


def spine(lo: int, hi: int, spark) -> DataFrame:
    return spark.range(lo, hi + 1).select(F.col("id").cast("long").alias("height"))


def height_spine(df: DataFrame) -> DataFrame:
    """Every height from the least to the greatest of df, which the driver asks for."""
    lo, hi = df.agg(F.min("height"), F.max("height")).first()
    return spine(lo if lo is not None else 0, hi if hi is not None else -1, df.sparkSession)


def with_next(df: DataFrame, order: str, columns: Sequence[str], bucket: int = 10_000) -> DataFrame:
    """df with next_<c>: the columns of the row after, in a unique integer order. Buckets look up their successor's first row."""
    keyed = df.withColumn("_bucket", F.floor(F.col(order) / bucket).cast("long"))
    row = F.struct(F.col(order).alias("_at"), *columns)
    firsts = keyed.groupBy("_bucket").agg(F.min(row).alias("_first"))
    after = firsts.select("_bucket", F.lead("_first").over(Window.orderBy("_bucket")).alias("_after"))
    own = Window.partitionBy("_bucket").orderBy(order)
    joined = keyed.join(after, "_bucket").withColumn("_next", F.coalesce(F.lead(row).over(own), "_after"))
    return joined.select(*df.columns, *(F.col(f"_next.{c}").alias(f"next_{c}") for c in columns))


def interval_join(points: DataFrame, at: str, intervals: DataFrame, lo: str, hi: str, width: int, inside: Column) -> DataFrame:
    """points x intervals that hold them: both fall in buckets of `width`, which make the join an equi-join; `inside`
    decides. A long interval takes part in each bucket that it touches."""
    touched = F.explode(F.sequence(F.floor(F.col(lo) / width), F.floor(F.coalesce(F.col(hi), F.col(lo)) / width)))
    return points.withColumn("_b", F.floor(F.col(at) / width)).join(intervals.withColumn("_b", touched), "_b").where(inside).drop("_b")
