"""Seeds from files: exchanges, their main addresses, addresses to ignore, known miners. Rows are checked against each other and
against the address dictionary; what can't be used is told with a reason, and nothing is dropped in silence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import valid
from ..operators.diffs import merged
from ..schemas import SEEDS

#: What tells a seed's rows apart.
KEYS = {"exchanges": "cex_id", "main_addresses": "address", "ignored": "address", "miners": "address"}


def read_seed(spark: SparkSession, path: str, kind: str, form: str = "json") -> DataFrame:
    """Rows of a kind of SEEDS from files of JSON lines or of CSV with a header line, typed by its schema."""
    reader = spark.read.schema(SEEDS[kind])
    return reader.option("header", True).csv(path) if form == "csv" else reader.json(path)


def checked_seed(rows: DataFrame, kind: str, exchanges: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, rejected with reason). Each row has one reason, the first that holds of:

    `no key`: the key is null (as of lines that can't be parsed); `no address`: the address isn't one; `no exchange`: exchanges
    (checked ones) don't hold its cex_id, or it is null; `contradiction`: usable rows of one key differ, none of which is taken. Equal rows are
    taken once. Empty seeds give empty tables.
    """
    key, columns = KEYS[kind], SEEDS[kind].fieldNames()
    rows = rows.select(*columns)
    reason = F.when(F.col(key).isNull(), "no key")
    if key == "address":
        reason = reason.when(~valid(F.col("address"), "address"), "no address")
    if exchanges is not None:
        rows = rows.join(exchanges.select("cex_id", F.lit(True).alias("_known")).distinct(), "cex_id", "left")
        reason = reason.when(F.col("_known").isNull(), "no exchange")
    told = rows.withColumn("reason", reason).select(*columns, "reason")
    usable = told.where("reason is null").drop("reason")
    # of a key as much as tells whether its rows are one: two hashes of contents, however often they are repeated
    content = F.xxhash64(*columns)
    by_key = usable.groupBy(key).agg(*(F.min_by(c, content).alias(f"_{c}") for c in columns if c != key), F.min(content).alias("_lo"), F.max(content).alias("_hi"))
    one = by_key.where("_lo = _hi").select(*(F.col(key) if c == key else F.col(f"_{c}").alias(c) for c in columns))
    torn = usable.join(by_key.where("_lo <> _hi").select(key), key, "left_semi").select(*columns, F.lit("contradiction").alias("reason"))
    return one, told.where("reason is not null").unionByName(torn)


def resolved(rows: DataFrame, addresses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with address_id, rows whose address the dictionary (id, address) doesn't hold yet). The latter are to be resolved again when
    it has grown; the former keep their ids, as the dictionary never changes one."""
    found = rows.join(merged(addresses.select("address", F.col("id").alias("address_id"))), "address", "left").select(*rows.columns, "address_id")
    return found.where("address_id is not null"), found.where("address_id is null").drop("address_id")
