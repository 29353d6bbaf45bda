"""Mining, fees, votes, parameters and difficulty."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import DAY_MS, EMISSION, FEES, PARAMETERS, REEMISSION, VOTING_EPOCH_LENGTH
from ..functions import decode_extension, type_of_id
from .diffs import erg_diffs


def block_tx_counts(txs: DataFrame, inputs: DataFrame) -> DataFrame:
    """(height, transactions, user_transactions): those without an input from the fee and emission contracts are users'."""
    system = inputs.where(F.col("address_id").isin(FEES, EMISSION, REEMISSION)).select("height", "tx_idx").distinct().withColumn("system", F.lit(1))
    joined = txs.select("height", "tx_idx").join(system, ["height", "tx_idx"], "left")
    return joined.groupBy("height").agg(F.count("*").alias("transactions"), F.count_if(F.col("system").isNull()).alias("user_transactions"))


def block_fees(outputs: DataFrame) -> DataFrame:
    return outputs.groupBy("height").agg(F.coalesce(F.sum(F.when(F.col("address_id") == FEES, F.col("value"))), F.lit(0)).cast("long").alias("fees"))


def block_miner_reward(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """(height, miner, reward): the reward transaction spends an emission box and pays a miner, who nets the reward; without one the
    miner is who collects the fees, and the reward is 0. Only transactions of those kinds are summed."""
    kinds = inputs.where(F.col("address_id").isin(EMISSION, REEMISSION, FEES)).groupBy("height", "tx_idx").agg(F.max(F.col("address_id").isin(EMISSION, REEMISSION).cast("int")).alias("emission"))
    key = ["height", "tx_idx"]
    paid = outputs.join(kinds, key).where(type_of_id(F.col("address_id")) == 2).groupBy(*key, "emission").agg(F.min("address_id").alias("miner"))
    chosen = paid.groupBy("height").agg(F.max_by(F.struct("tx_idx", "emission", "miner"), F.struct(F.col("emission"), -F.col("tx_idx"))).alias("r")).select("height", "r.*")
    net = erg_diffs(inputs.join(kinds, key, "left_semi"), outputs.join(kinds, key, "left_semi")).withColumnRenamed("address_id", "miner")
    out = chosen.join(net, ["height", "tx_idx", "miner"], "left")
    return out.select("height", "miner", F.when((F.col("emission") == 1) & (F.col("nano") > 0), F.col("nano")).otherwise(0).cast("long").alias("reward"))


def network_parameters(fields: DataFrame) -> DataFrame:
    """fields (height, pos, key, value) -> a row for each height with a parameter; missing ones are 0, of repeated ones the last counts."""
    e = fields.select("height", "pos", decode_extension(F.col("key"), F.col("value")).alias("e")).where("e.kind = 'parameter'")
    pick = lambda i: F.coalesce(F.max_by("e.number", F.when(F.col("e.id") == i, F.col("pos"))), F.lit(0))
    return e.groupBy("height").agg(*(pick(i).alias(name) for i, name in PARAMETERS.items()))


def unhandled_extensions(fields: DataFrame) -> DataFrame:
    e = fields.select("height", "value", decode_extension(F.col("key"), F.col("value")).alias("e"))
    return e.where("e.kind = 'unknown'").select("height", F.col("e.key16").alias("key"), "value")


def proposals(votes: DataFrame, epoch_length: int = VOTING_EPOCH_LENGTH) -> DataFrame:
    """votes (height, v1, v2, v3) -> (epoch, height, v1..v3, tally_1..3): a proposal is the first block of an epoch with a vote; later
    blocks of the epoch count where they repeat a slot's vote. Epochs have at most epoch_length rows."""
    own = votes.withColumn("epoch", F.floor(F.col("height") / epoch_length).cast("long"))
    first = own.where((F.col("height") % epoch_length == 0) & ((F.col("v1") != 0) | (F.col("v2") != 0) | (F.col("v3") != 0)))
    later = own.where(F.col("height") % epoch_length != 0).select("epoch", *(F.col(f"v{i}").alias(f"w{i}") for i in (1, 2, 3)))
    match = lambda i: F.sum(F.when((F.col(f"v{i}") != 0) & (F.col(f"w{i}") == F.col(f"v{i}")), 1).otherwise(0)).alias(f"tally_{i}")
    return first.join(later, "epoch", "left").groupBy("epoch", "height", "v1", "v2", "v3").agg(*map(match, (1, 2, 3)))


def difficulty_24h(headers: DataFrame) -> DataFrame:
    """(height, difficulty_24h, hash_rate_24h) over the trailing day, both ends included: the mean rounds half to even, the rate
    truncates over at least 120 seconds.

    Each row also sends a probe to the time a day before. Rows and probes are dealt by day, rows to the next day as well, and
    running sums up to the row and up to its probe differ by the trailing day's: linear in rows, however many a day has. The first
    time within the day is the last one that a running window in descending order meets before the probe. Heights are unique.
    """
    day = lambda t: F.floor(t / DAY_MS)
    rows = headers.select("height", "timestamp", F.col("difficulty").cast("decimal(38,0)").alias("difficulty"))
    seen = rows.select(F.explode(F.array(day(F.col("timestamp")), day(F.col("timestamp")) + 1)).alias("day"), F.col("timestamp").alias("t"), F.lit(1).alias("kind"), "height", "difficulty", F.col("timestamp").alias("time"))
    probes = rows.select(day(F.col("timestamp")).alias("day"), (F.col("timestamp") - DAY_MS).alias("t"), F.lit(0).alias("kind"), "height", F.lit(None).cast("decimal(38,0)").alias("difficulty"), F.lit(None).cast("long").alias("time"))
    up = Window.partitionBy("day").orderBy("t", "kind").rangeBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("day").orderBy(F.desc("t"), F.desc("kind")).rangeBetween(Window.unboundedPreceding, 0)
    run = seen.union(probes).withColumns({"s": F.coalesce(F.sum("difficulty").over(up), F.lit(0)).cast("decimal(38,0)"), "n": F.count("time").over(up), "from": F.last("time", ignorenulls=True).over(down)})
    own, probe = (F.col("kind") == 1) & (day(F.col("t")) == F.col("day")), F.col("kind") == 0
    pick = lambda c, when: F.max(F.when(when, F.col(c)))
    out = run.groupBy("day", "height").agg((pick("s", own) - pick("s", probe)).cast("decimal(38,0)").alias("s"), (pick("n", own) - pick("n", probe)).alias("n"), (pick("t", own) - pick("from", probe)).alias("span")).where("n is not null")
    rate = F.expr("s div cast(greatest(span div 1000, 120) as decimal(20,0))")
    return out.select("height", F.expr("bround(s / cast(n as decimal(20,0)), 0)").cast("long").alias("difficulty_24h"), rate.cast("long").alias("hash_rate_24h"))


def miner_labels(mining: DataFrame, known: DataFrame) -> DataFrame:
    """mining with the names of known miners, null for others; Spark broadcasts the names only where their size allows."""
    return mining.join(known.select(F.col("address_id").alias("miner"), "name"), "miner", "left")
