"""Blocks and prices from files (seeds: see there), and tables with upserts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BLOCK, PRICES


def read_blocks(spark: SparkSession, path: str | list[str], stream: bool = False) -> DataFrame:
    """Blocks as JSON lines, with an explicit schema: nothing is inferred. A slice of a chain is a file of such lines; as a stream,
    files are taken as they come into a folder."""
    return (spark.readStream if stream else spark.read).schema(BLOCK).json(path)


def checked_blocks(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): blocks that can be flattened, each header id once however many slices of a chain hold it, and
    (height, header_id, reason) of the others: `no header` (its id, height or time is missing, as in lines that can't be parsed),
    `no transactions`, or `broken transaction` (one without an id or outputs, or an output without an id or a value)."""
    header, txs = F.col("header"), F.col("blockTransactions.transactions")
    box = lambda b: b["boxId"].isNull() | b["value"].isNull()
    broken = F.exists(txs, lambda t: t.isNull() | t["id"].isNull() | t["outputs"].isNull() | F.coalesce(F.exists(t["outputs"], box), F.lit(False)))
    reason = F.when(header["id"].isNull() | header["height"].isNull() | header["timestamp"].isNull(), "no header").when(txs.isNull() | (F.size(txs) == 0), "no transactions").when(broken, "broken transaction")
    told = blocks.withColumn("_reason", reason)
    rejected = told.where("_reason is not null").select("header.height", F.col("header.id").alias("header_id"), F.col("_reason").alias("reason"))
    good = told.where("_reason is null").withColumn("_id", F.col("header.id")).dropDuplicates(["_id"])
    return good.drop("_reason", "_id"), rejected


def flatten_blocks(blocks: DataFrame) -> dict[str, DataFrame]:
    """headers, txs, inputs, data_inputs, outputs and extension_fields; positions in the block are kept. No shuffle."""
    headers = blocks.select("header.height", "header.timestamp", F.col("header.id").alias("header_id"), F.col("header.parentId").alias("parent_id"), F.col("header.difficulty").cast("decimal(38,0)").alias("difficulty"), "header.votes")
    txs = blocks.select(F.col("header.height").alias("height"), F.posexplode("blockTransactions.transactions").alias("tx_idx", "tx"))
    reads = lambda kind: txs.select("height", "tx_idx", F.posexplode(f"tx.{kind}").alias("pos", "b")).select("height", "tx_idx", "pos", F.col("b.boxId").alias("box_id"))
    out = txs.select("height", "tx_idx", F.posexplode("tx.outputs").alias("out_idx", "b"))
    outputs = out.select("height", "tx_idx", "out_idx", F.col("b.boxId").alias("box_id"), F.col("b.ergoTree").alias("address"), "b.value", F.transform("b.assets", lambda a: F.struct(a["tokenId"].alias("token_id"), a["amount"].alias("amount"))).alias("assets"), F.to_json("b.additionalRegisters").alias("registers"), F.col("b.creationHeight").alias("creation_height"))
    fields = blocks.select(F.col("header.height").alias("height"), F.posexplode("extension.fields").alias("pos", "f")).select("height", "pos", F.col("f")[0].alias("key"), F.col("f")[1].alias("value"))
    return {"headers": headers, "txs": txs.select("height", "tx_idx", F.col("tx.id").alias("tx_id")), "inputs": reads("inputs"), "data_inputs": reads("dataInputs"), "outputs": outputs, "extension_fields": fields}


def genesis_outputs(boxes: DataFrame) -> DataFrame:
    """Genesis boxes as outputs of the one transaction of height 0, in the order of their box_id."""
    from ..operators.helpers import dense_ids

    return dense_ids(boxes, ["box_id"], "out_idx").withColumn("height", F.lit(0)).withColumn("tx_idx", F.lit(0))


def read_price_series(spark: SparkSession, path: str, since: int = -1) -> DataFrame:
    """(timestamp, price) of {prices: [[ms, value], ...]} after a time; repeated points once."""
    rows = spark.read.schema(PRICES).json(path).select(F.explode("prices").alias("p"))
    return rows.select(F.col("p")[0].cast("long").alias("timestamp"), F.col("p")[1].alias("price")).where(F.col("timestamp") > since).dropDuplicates(["timestamp"])


def upserted(target: DataFrame, updates: DataFrame, key: list[str]) -> DataFrame:
    """target with rows of equal key replaced by those of updates. Keys are not null; updates hold each key once."""
    return target.join(updates.select(*key), key, "left_anti").unionByName(updates)


def added(target: DataFrame, updates: DataFrame, key: str = "service") -> DataFrame:
    """Service statistics with further ones added: counts, fees and volumes sum, times widen. Null keys are one group."""
    both = target.unionByName(updates)
    sums = both.groupBy(F.coalesce(key, F.lit(0)).alias(key)).agg(F.sum("tx_count").alias("tx_count"), F.min("first_tx").alias("first_tx"), F.max("last_tx").alias("last_tx"), F.sum("fees").alias("fees"), F.sum("volume").alias("volume"))
    return sums


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Write df under path as table `name`, in buckets by key, each sorted by it, and read it. Tables in equally many buckets of
    their keys join on them without an exchange, however often they are read."""
    df.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def write_version(df: DataFrame, path: str) -> str:
    """Write a table as a further version beside the older ones; its path is the pointer to store. Readers of older versions are
    not disturbed, and a job that dies leaves none behind."""
    out = f"{path}/v-{uuid.uuid4().hex}"
    df.write.parquet(out)
    return out


def write_by_height(df: DataFrame, path: str, span: int = 100_000) -> None:
    """Facts under path, partitioned by height div span: a rollback rewrites the last partitions only."""
    df.withColumn("height_part", F.floor(F.col("height") / span)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("height_part").parquet(path)
