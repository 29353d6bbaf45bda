"""State by key in a fixed number of hash parts, kept by batches: balances with the mean age of coins and a log to undo blocks,
statistics that add up. A batch reads and rewrites the parts in which its keys fall, however long the history is."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ROLLBACK_HORIZON
from ..operators.balances import folded
from ..shared import materialize
from ..sources import added
from .chain import Chain
from .tables import hash_part, once, progress, recover, replace_parts, table_or_empty, with_markers

BALANCES = "address_id long, nano long, mean_age_timestamp long, part int"
LOG = "height long, header_id string, address_id long, nano long, mean_age_timestamp long, part int"
STATS = "service long, tx_count long, first_tx long, last_tx long, fees long, volume long, batch long, part int"


def touched_parts(keys: DataFrame, parts: int) -> list[int]:
    """The parts in which keys fall: at most `parts` numbers reach the driver."""
    return sorted(r[0] for r in keys.select(hash_part(keys.columns, parts).alias("part")).distinct().collect())


def balances(spark: SparkSession, path: str) -> DataFrame:
    """(address_id, nano, mean_age_timestamp) above zero, as of the last batch or rollback."""
    return table_or_empty(spark, f"{path}/balances", BALANCES).where("nano > 0").drop("part")


def state_log(spark: SparkSession, path: str) -> DataFrame:
    """(height, address_id, nano, mean_age_timestamp): what a block's addresses held before it, null for new ones; for the last
    ROLLBACK_HORIZON blocks."""
    low = progress(spark, path).height - ROLLBACK_HORIZON
    return table_or_empty(spark, f"{path}/log", LOG).where(F.col("address_id").isNotNull() & (F.col("height") > low)).drop("part", "header_id")


def applied(spark: SparkSession, path: str) -> DataFrame:
    """(height, header_id) of the last ROLLBACK_HORIZON blocks that the state has taken in."""
    head = progress(spark, path).height
    rows = table_or_empty(spark, f"{path}/log", LOG).where(F.col("address_id").isNull())
    return rows.where((F.col("height") <= head) & (F.col("height") > head - ROLLBACK_HORIZON)).select("height", "header_id")


def advance(spark: SparkSession, path: str, batch: int, diffs: DataFrame, headers: DataFrame, parts: int = 64) -> None:
    """Bring the balances under path forward by the diffs (address_id, height, tx_idx, nano) of further blocks, headers (height,
    timestamp and, where there is one, header_id). Blocks at or below the head are known and change nothing; so does a batch
    that comes again.

    Old states of the touched addresses are read from their parts alone and folded on with the batch's rows. Of the last
    ROLLBACK_HORIZON blocks the log keeps what each address held before them, a part for each height modulo the horizon: a
    block's log takes the place of the one that is too old to undo.
    """
    last = recover(spark, path)
    head = last.height
    top = headers.agg(F.max("height")).first()[0]
    if batch <= last.batch or top is None or top <= head:
        return

    def make() -> dict[str, DataFrame]:
        new = materialize(diffs.where(F.col("height") > head).join(headers.select("height", "timestamp"), "height").select("address_id", "height", "tx_idx", "nano", "timestamp"), "batch-diffs")
        at = touched_parts(new.select("address_id"), parts)
        before = table_or_empty(spark, f"{path}/balances", BALANCES).where(F.col("part").isin(at) & F.col("address_id").isNotNull())
        keys = materialize(new.select("address_id").distinct(), "batch-keys")
        since = max(head, top - ROLLBACK_HORIZON) + 1
        steps = materialize(folded(new, before.join(keys, "address_id", "left_semi").drop("part"), since), "batch-steps")
        now = steps.where("height is null and nano <> 0").select("address_id", "nano", "mean_age_timestamp", hash_part(["address_id"], parts).alias("part"))
        same = before.join(keys, "address_id", "left_anti").select(*now.columns)
        slot = (F.col("height") % ROLLBACK_HORIZON).cast("int").alias("part")
        log = steps.where("height is not null").select("height", "address_id", "nano", "mean_age_timestamp", slot)
        ids = headers.where(F.col("height") >= since).select("height", *(["header_id"] if "header_id" in headers.columns else []), slot)
        log = with_markers(log, [h % ROLLBACK_HORIZON for h in range(since, top + 1)]).unionByName(ids, allowMissingColumns=True)
        return {"balances": with_markers(now.unionByName(same), at), "log": log}

    once(spark, path, last, batch, top, make)


def revert(spark: SparkSession, path: str, batch: int, height: int, parts: int = 64) -> None:
    """Undo the blocks from a height on, as batch number `batch`: each address that they touched gets the oldest state that the log
    has of it from there on, by upsert, or by delete where it had none."""
    last = recover(spark, path)
    head = last.height
    if batch <= last.batch or height > head:
        return
    if height <= head - ROLLBACK_HORIZON:
        raise ValueError("a rollback goes further back than the horizon")

    def make() -> dict[str, DataFrame]:
        undone = state_log(spark, path).where(F.col("height") >= height)
        old = undone.groupBy("address_id").agg(F.min_by(F.struct("nano", "mean_age_timestamp"), "height").alias("r"))
        old = materialize(old.select("address_id", "r.*", hash_part(["address_id"], parts).alias("part")), "undo")
        at = [r[0] for r in old.select("part").distinct().collect()]
        now = table_or_empty(spark, f"{path}/balances", BALANCES).where(F.col("part").isin(at) & F.col("address_id").isNotNull())
        kept = now.join(old.select("address_id"), "address_id", "left_anti").unionByName(old.where("nano is not null"))
        none = spark.createDataFrame([], LOG)
        return {"balances": with_markers(kept, at), "log": with_markers(none, [h % ROLLBACK_HORIZON for h in range(height, head + 1)])}

    once(spark, path, last, batch, height - 1, make)


def follow(spark: SparkSession, path: str, number: int, chain: Chain, facts: str = "nano", times: str = "times", parts: int = 64) -> None:
    """Bring the state under path to the end of a chain, as batch `number` of a stream: blocks that have left the chain are undone by the
    log, those that have come are folded in. chain has tables of diffs and of (height, timestamp). What the state has taken in is told by
    its own log, so it doesn't matter who died when: the next call finds where the two part.
    """
    head, fork = recover(spark, path).height, -1
    if head >= 0:
        both = applied(spark, path).join(chain.headers.since(head - ROLLBACK_HORIZON), ["height", "header_id"], "left_semi")
        fork = both.agg(F.max("height")).first()[0]
        if fork is None:
            raise ValueError("the chain has parted from the state before the horizon")
        if fork < head:
            revert(spark, path, 2 * number, fork + 1, parts)
    heads = chain.headers.since(fork + 1).join(chain.tables[times].since(fork + 1), "height").select("height", "timestamp", "header_id")
    advance(spark, path, 2 * number + 1, chain.tables[facts].since(fork + 1), heads, parts)


def mean_age_at(spark: SparkSession, path: str, diffs: DataFrame, headers: DataFrame, height: int, span: int = 10_000) -> DataFrame:
    """mean_age as of a height, folding only the blocks after the last whole span of heights.

    States at the ends of the last two spans lie under path; a run stores those of a span that has become whole, made from
    the one before it, and a rollback takes the older one. Without a stored state, or for a height before both, the fold
    begins at nothing.
    """
    whole = (height + 1) // span
    rows = diffs.join(headers.select("height", "timestamp"), "height")
    stored = table_or_empty(spark, f"{path}/spans", "spans long, part int").select("spans").where("spans is not null").distinct().collect()  # two at most
    have = max((r[0] for r in stored if r[0] <= whole), default=0)
    state = "address_id long, nano long, mean_age_timestamp long"
    at = lambda k: table_or_empty(spark, f"{path}/states", f"{state}, part int").where((F.col("part") == k % 2) & F.col("address_id").isNotNull()).drop("part") if k else None
    between = lambda lo, hi: rows.where((F.col("height") >= lo) & (F.col("height") < hi))
    for k in range(max(have, whole - 2) + 1, whole + 1):
        made = folded(between(have * span, k * span), at(have)).where("height is null and nano <> 0").drop("height").withColumn("part", F.lit(k % 2))
        # the span's number goes before its states do and comes after them
        replace_parts(with_markers(spark.createDataFrame([], "spans long, part int"), [k % 2]), f"{path}/spans")
        replace_parts(with_markers(materialize(made, "span-states"), [k % 2]), f"{path}/states")
        replace_parts(spark.createDataFrame([(k, k % 2)], "spans long, part int"), f"{path}/spans")
        have = k
    return folded(between(have * span, height + 1), at(have)).where("height is null and nano > 0").drop("height")


def add_stats(spark: SparkSession, path: str, batch: int, stats: DataFrame, parts: int = 16) -> None:
    """Add statistics by service to those under path, once: each part remembers the last batch that it took in, the journal puts a
    batch that died in place again, and one that was taken in adds nothing."""

    def make() -> dict[str, DataFrame]:
        new = materialize(stats.withColumn("service", F.coalesce("service", F.lit(0)).cast("long")), "batch-stats")
        at = touched_parts(new.select("service"), parts)
        before = table_or_empty(spark, f"{path}/stats", STATS).where(F.col("part").isin(at))
        both = added(before.drop("batch", "part"), new.select(*(c for c in before.columns if c not in ("batch", "part"))))
        return {"stats": both.select("*", F.lit(batch).cast("long").alias("batch"), hash_part(["service"], parts).alias("part"))}

    once(spark, path, recover(spark, path), batch, -1, make)


def stats(spark: SparkSession, path: str) -> DataFrame:
    return table_or_empty(spark, f"{path}/stats", STATS).drop("batch", "part")
