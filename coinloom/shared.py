"""Shared storage and global ranks, for ledger and corpus operators alike."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """This application's folder in the one that driver and executors share, spark.checkpoint.dir; it can go when the
    application has ended. Where that is unset, a local master (tests) gets a temporary folder; a cluster gets an error, as its
    executors would write where nobody else can read."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if found:
        return f"{found.rstrip('/')}/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = tempfile.mkdtemp(prefix="spark-")
    return _OWN_DIRS[app]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it back: lineage ends there, and any executor can be lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ordered_rank(df: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """Add the 0-based position of each row in a global order.

    Range partitions are sorted each by itself and get the count of the rows before them as offset. Only
    a count for each partition, never the rows, meets in one task. Rows that tie in `order` get adjacent positions.
    """
    placed = materialize(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "ordered")
    counts = placed.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    # one row for each partition of the sort: as small as the number of partitions
    return placed.withColumn("_part", F.shiftright("_at", 33)).join(F.broadcast(before), "_part").withColumn(name, (F.col("_before") + local).cast("long")).drop("_part", "_before", "_at")
