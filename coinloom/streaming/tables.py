"""Tables that batches advance: what a batch writes counts from the moment that one small file tells so."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PROGRESS = "seq long, batch long, height long, journal string"


class Told(NamedTuple):
    """What was told last: its number, the batch, the height, and the tables whose parts are still to be put in place from the journal."""

    seq: int = -1
    batch: int = -1
    height: int = -1
    journal: str = ""


def table_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A Parquet table that the first batch makes; without rows before that."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def progress(spark: SparkSession, path: str) -> Told:
    """What was told last under path; -1 each before the first."""
    rows = table_or_empty(spark, f"{path}/progress", PROGRESS).collect()  # two at most
    return max((Told(r["seq"], r["batch"], r["height"], r["journal"]) for r in rows), default=Told())


def tell(spark: SparkSession, path: str, last: Told, batch: int, height: int, journal: str = "") -> Told:
    """Tell a batch and a height after what was told last, in a file of one row. It takes the place of the one before the last: whoever
    dies meanwhile leaves the last one."""
    now = Told(last.seq + 1, batch, height, journal)
    row = spark.range(1).select(*(F.lit(v).cast("string" if k == "journal" else "long").alias(k) for k, v in now._asdict().items()))
    row.write.mode("overwrite").parquet(f"{path}/progress/slot={now.seq % 2}")
    return now


def hash_part(keys: list[str], parts: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")


def replace_parts(rows: DataFrame, path: str) -> None:
    """Put rows, which have a column part, in the place of those parts of a table that they name; other parts keep their files."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)


def with_markers(rows: DataFrame, parts: list[int]) -> DataFrame:
    """rows and, for each part, a row of nulls, so that a part that loses its last row is replaced too."""
    one = rows.sparkSession.range(1)
    marks = one.select(F.explode(F.array(*map(F.lit, parts))).alias("part")) if parts else one.where("false").select(F.col("id").alias("part"))
    kind = rows.schema["part"].dataType if "part" in rows.columns else "int"
    return rows.unionByName(marks.withColumn("part", F.col("part").cast(kind)), allowMissingColumns=True)


def recover(spark: SparkSession, path: str, last: Told | None = None) -> Told:
    """What was told last, after putting it in place from the journal where that is still to be done."""
    last = last or progress(spark, path)
    if not last.journal:
        return last
    for name in last.journal.split(","):
        replace_parts(spark.read.parquet(f"{path}/journal/{name}"), f"{path}/{name}")
    return tell(spark, path, last, last.batch, last.height)


def once(spark: SparkSession, path: str, last: Told, batch: int, height: int, make: Callable[[], dict[str, DataFrame]]) -> None:
    """Replace parts of tables under path as batch number `batch`, to the end and not twice; last is what recover returned.

    What make returns, tables by name with a column part, is first written under path/journal and told; then it takes the parts'
    place. A batch that died between is put in place from the journal before anything else is done; one that comes again
    changes nothing. Batches come in order, as foreachBatch numbers them.
    """
    if batch <= last.batch:
        return
    made = make()
    for name, rows in made.items():
        rows.hint("rebalance", "part").write.mode("overwrite").parquet(f"{path}/journal/{name}")
    recover(spark, path, tell(spark, path, last, batch, height, ",".join(made)))
