"""Heights at calendar boundaries, and lookups between time and height."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import DAY_MS, HOUR_MS, WEEK_MS
from ..functions import ceil_to
from .helpers import with_next

STEP = {"hourly": HOUR_MS, "daily": DAY_MS, "weekly": WEEK_MS}


def calendar_heights(headers: DataFrame, unit: str) -> DataFrame:
    """(height, timestamp): for each boundary of the unit the last block at or before it, the genesis row, and the last block as
    live row.

    A block leaves rows from its own boundary (itself where it lies on one) up to, not including, the next block's time; its
    first boundary counts even where the next block lies on it. Weeks start on Monday throughout.
    """
    step = STEP[unit]
    rows = with_next(headers.select("height", "timestamp"), "height", ["timestamp"])
    first, after = ceil_to(F.col("timestamp"), step), F.col("next_timestamp")
    every = F.filter(F.sequence(first, after, F.lit(step).cast("long")), lambda b: (b == first) | (b < after))
    live = F.array(F.col("timestamp"))
    bounds = F.when(after.isNull() | (F.col("height") == 0), live).when(first <= after, every).otherwise(F.array().cast("array<bigint>"))
    return rows.select("height", F.explode(bounds).alias("timestamp"))


def timestamp_to_height(headers: DataFrame, t: int) -> DataFrame:
    return headers.where(F.col("timestamp") <= t).agg(F.max_by("height", "timestamp").alias("height"))


def height_to_timestamp(headers: DataFrame, height: int) -> DataFrame:
    """One row, null where no block has that height."""
    return headers.where(F.col("height") == height).agg(F.max("timestamp").alias("timestamp"))


def sync_height(headers: DataFrame) -> DataFrame:
    return headers.agg(F.max("height").alias("height"))


def gap_filled(periods: DataFrame, date_col: str, unit: str, flat: dict[str, str]) -> DataFrame:
    """periods with one row a period between its rows: `flat` gives each column's value there, from the row before.

    The table has a row for each calendar period, so it is ordered as a whole.
    """
    from pyspark.sql import Window

    step = {"day": "interval 1 day", "week": "interval 7 days", "month": "interval 1 month"}[unit]
    after = F.lead(date_col).over(Window.orderBy(date_col))
    last = F.coalesce(F.expr(f"_after - {step}").cast("date"), F.col(date_col))
    dates = periods.withColumn("_after", after).withColumn("_d", F.explode(F.sequence(F.col(date_col), last, F.expr(step))))
    own = F.col("_d") == F.col(date_col)
    return dates.select(F.col("_d").alias(date_col), *(F.when(own, F.col(c)).otherwise(F.col(flat.get(c, c))).alias(c) for c in periods.columns if c != date_col))
