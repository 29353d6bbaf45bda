"""Exchange deposit addresses: candidates, conflicts, and the supply that exchanges hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import FEES
from .balances import first_tx_height
from .helpers import height_spine, prefix_sum


def deposit_candidates(diffs: DataFrame, main: DataFrame, ignored: DataFrame | None = None) -> DataFrame:
    """(height, tx_idx, address_id, cex_ids): who pays in a transaction that credits a main exchange address, and which exchanges
    it pays. main (address_id, cex_id) and ignored (address_id) join by shuffle unless Spark finds them small."""
    to = diffs.where("nano > 0").join(main.select("address_id", "cex_id"), "address_id")
    to = to.groupBy("height", "tx_idx").agg(F.sort_array(F.collect_set("cex_id")).alias("cex_ids"))
    payers = diffs.where((F.col("nano") < 0) & (F.col("address_id") != FEES)).join(main.select("address_id"), "address_id", "left_anti")
    if ignored is not None:
        payers = payers.join(ignored.select("address_id"), "address_id", "left_anti")
    return payers.join(to, ["height", "tx_idx"]).select("height", "tx_idx", "address_id", "cex_ids")


def classified(candidates: DataFrame) -> DataFrame:
    """(address_id, cex_id, spot_height, conflict, first_cex_id, conflict_spot_height): an address that ever paid one exchange is
    its deposit address. A second exchange in the block of the first is an intra conflict, without a first exchange; in a
    later block it is an inter conflict. Sums by block come first: a window holds a row for each block of an address."""
    each = candidates.select("address_id", "height", F.array_min("cex_ids").alias("lo"), F.array_max("cex_ids").alias("hi"))
    block = each.groupBy("address_id", "height").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    w = Window.partitionBy("address_id").orderBy("height")
    run = block.withColumn("lo_now", F.min("lo").over(w)).withColumn("hi_now", F.max("hi").over(w))
    clash = F.when(F.col("lo_now") != F.col("hi_now"), F.col("height"))
    out = run.groupBy("address_id").agg(F.min("height").alias("spot_height"), F.min(clash).alias("conflict_spot_height"), F.min_by("lo", "height").alias("first"))
    kind = F.when(F.col("conflict_spot_height").isNull(), "none").when(F.col("conflict_spot_height") == F.col("spot_height"), "intra").otherwise("inter")
    out = out.withColumn("conflict", kind)
    return out.select("address_id", F.when(kind == "none", F.col("first")).alias("cex_id"), "spot_height", "conflict", F.when(kind == "inter", F.col("first")).alias("first_cex_id"), "conflict_spot_height")


def deposit_addresses(candidates: DataFrame) -> DataFrame:
    return classified(candidates).where("conflict = 'none'").select("address_id", "cex_id", "spot_height")


def deposit_conflicts(candidates: DataFrame) -> DataFrame:
    return classified(candidates).where("conflict <> 'none'").select("address_id", "first_cex_id", F.col("spot_height").alias("deposit_spot_height"), "conflict_spot_height")


def exchange_supply(diffs: DataFrame, main: DataFrame, deposits: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """(height, main, deposits): what main and deposit addresses hold at each height. The final deposit set counts from the start,
    so history needs no patches. One join and one aggregate for both groups, which have no address in common; headers, where
    given, tell the heights without a pass over diffs."""
    keys = main.select("address_id", F.lit(True).alias("is_main")).distinct().unionByName(deposits.select("address_id", F.lit(False).alias("is_main")))
    part = lambda own, name: F.sum(F.when(own, F.col("nano")).otherwise(0)).alias(name)
    sums = diffs.join(keys, "address_id").groupBy("height").agg(part(F.col("is_main"), "main"), part(~F.col("is_main"), "deposits"))
    both = height_spine(diffs if headers is None else headers).join(sums, "height", "left")
    return prefix_sum(both.na.fill(0), "height", ["main", "deposits"])


def supply_patch(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """(height, nano): what newly found deposit addresses add at each height, less what conflicts take away."""
    return positive.select("height", "nano").unionByName(negative.select("height", (-F.col("nano")).alias("nano"))).groupBy("height").agg(F.sum("nano").alias("nano"))


def patched_supply(series: DataFrame, patch: DataFrame) -> DataFrame:
    """A supply series after a patch, whose changes hold from their height on."""
    joined = series.join(patch.withColumnRenamed("nano", "_patch"), "height", "left").na.fill(0, ["_patch"])
    run = prefix_sum(joined, "height", ["_patch"])
    return run.select("height", "main", (F.col("deposits") + F.col("_patch")).alias("deposits"))


def register_main(diffs: DataFrame, main: DataFrame, deposits: DataFrame, address_id: int, cex_id: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A further main address: (main, deposits without it, height from which series are to be made anew)."""
    new = diffs.sparkSession.createDataFrame([(address_id, cex_id)], "address_id long, cex_id int")
    return main.unionByName(new), deposits.where(F.col("address_id") != address_id), first_tx_height(diffs.where(F.col("address_id") == address_id))
