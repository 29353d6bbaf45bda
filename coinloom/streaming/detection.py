"""Exchange deposits found batch by batch: what each payer has paid so far, and the patches of the supply that follow from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.exchanges import deposit_candidates
from ..operators.helpers import height_spine, prefix_sum
from ..shared import materialize
from .tables import hash_part, once, recover, replace_parts, table_or_empty, with_markers

PAYERS = "address_id long, lo int, hi int, spot_height long, first int, conflict_spot_height long, part int"
DELTAS = "height long, main long, deposits long, part long"
SERIES = "height long, main long, deposits long, part long"


def payers(spark: SparkSession, path: str) -> DataFrame:
    """(address_id, lo, hi, spot_height, first, conflict_spot_height): the least and the greatest exchange that an address ever paid, the
    block in which it was first seen and the exchange then, and the block from which on it had paid two."""
    return table_or_empty(spark, f"{path}/payers", PAYERS).where("address_id is not null").drop("part")


def deposits(spark: SparkSession, path: str) -> DataFrame:
    return payers(spark, path).where("conflict_spot_height is null").select("address_id", F.col("first").alias("cex_id"), "spot_height")


def conflicts(spark: SparkSession, path: str) -> DataFrame:
    later = F.col("conflict_spot_height") > F.col("spot_height")
    return payers(spark, path).where("conflict_spot_height is not null").select("address_id", F.when(later, F.col("first")).alias("first_cex_id"), F.col("spot_height").alias("deposit_spot_height"), "conflict_spot_height")


def paid_on(before: DataFrame, candidates: DataFrame) -> DataFrame:
    """The payers of candidates with their state after these, was (what they were before: null, deposit or conflict) beside it. A window
    holds a row for each block of a payer in the batch."""
    block = candidates.groupBy("address_id", "height").agg(F.min(F.array_min("cex_ids")).alias("l"), F.max(F.array_max("cex_ids")).alias("h"))
    w = Window.partitionBy("address_id").orderBy("height")
    run = block.join(before, "address_id", "left").withColumns({"l_now": F.least(F.min("l").over(w), "lo"), "h_now": F.greatest(F.max("h").over(w), "hi")})
    clash = F.when(F.col("l_now") != F.col("h_now"), F.col("height"))
    was = F.when(F.col("conflict_spot_height").isNotNull(), "conflict").when(F.col("spot_height").isNotNull(), "deposit")
    return run.groupBy("address_id").agg(
        F.min("l_now").alias("lo"), F.max("h_now").alias("hi"), F.coalesce(F.min("spot_height"), F.min("height")).alias("spot_height"), F.coalesce(F.min("first"), F.min_by("l", "height")).alias("first"),
        F.coalesce(F.min("conflict_spot_height"), F.min(clash)).alias("conflict_spot_height"), F.min(was).alias("was"),
    )


def detect(spark: SparkSession, path: str, batch: int, diffs: DataFrame, history: DataFrame, main: DataFrame, ignored: DataFrame | None = None, parts: int = 64, span: int = 1000) -> None:
    """Take in the diffs (address_id, height, tx_idx, nano) of further blocks: payers' state, and what the supply of main (address_id,
    cex_id) and deposit addresses changes by, at each height. history: all diffs up to these, in which new deposit addresses and those
    that turn out to be none are looked up.

    The batch itself counts what it moves on main addresses and on deposit addresses known before. An address that is found
    adds its whole history, a positive patch; one that pays a second exchange takes its whole history away, a negative
    one; one that does both within the batch does neither. Conflicts are final. A batch that comes again changes nothing.
    """
    last = recover(spark, path)
    head = last.height
    top = diffs.agg(F.max("height")).first()[0]
    if batch <= last.batch or top is None or top <= head:
        return

    def make() -> dict[str, DataFrame]:
        moved = materialize(diffs.where(F.col("height") > head), "batch-diffs")
        at = sorted(r[0] for r in moved.select(hash_part(["address_id"], parts).alias("part")).distinct().collect())  # `parts` numbers at most
        state = table_or_empty(spark, f"{path}/payers", PAYERS).where(F.col("part").isin(at) & F.col("address_id").isNotNull()).drop("part")
        new = materialize(paid_on(state, deposit_candidates(moved, main, ignored)), "batch-payers")
        kept = state.join(new.select("address_id"), "address_id", "left_anti")
        now = kept.unionByName(new.drop("was")).withColumn("part", hash_part(["address_id"], parts))

        past = history.where(F.col("height") <= top)
        zero = F.lit(0).cast("long")
        by = lambda rows, keys, name, sign=1: rows.join(keys.select("address_id"), "address_id", "left_semi").groupBy("height").agg(F.sum(F.col("nano") * sign).alias(name))
        deltas = by(moved, main, "main").withColumn("deposits", zero)
        found, lost = (new.where(F.col("conflict_spot_height").isNull() & F.col("was").isNull()), new.where(F.col("conflict_spot_height").isNotNull() & (F.col("was") == "deposit")))
        for rows, keys, sign in ((moved, state.where("conflict_spot_height is null"), 1), (past, found, 1), (past, lost, -1)):
            deltas = deltas.unionByName(by(rows, keys, "deposits", sign).withColumn("main", zero))
        deltas = materialize(deltas.groupBy("height").agg(F.sum("main").alias("main"), F.sum("deposits").alias("deposits")).withColumn("part", F.floor(F.col("height") / span).cast("long")), "deltas")
        spans = [r[0] for r in deltas.select("part").distinct().collect()]  # spans of heights that the batch's addresses were ever seen in
        old = table_or_empty(spark, f"{path}/deltas", DELTAS).where(F.col("part").isin(spans))
        summed = old.unionByName(deltas).groupBy("height", "part").agg(F.sum("main").alias("main"), F.sum("deposits").alias("deposits"))
        return {"payers": with_markers(now, at), "deltas": summed}

    once(spark, path, last, batch, top, make)


def supply(spark: SparkSession, path: str, headers: DataFrame) -> DataFrame:
    """(height, main, deposits) at each height, as the batches so far tell it."""
    changes = table_or_empty(spark, f"{path}/deltas", DELTAS).drop("part")
    return prefix_sum(height_spine(headers).join(changes, "height", "left").na.fill(0), "height", ["main", "deposits"])


def write_series(series: DataFrame, path: str, span: int = 1000) -> None:
    """A supply series in parts by spans of heights."""
    replace_parts(materialize(series.select("height", "main", "deposits", F.floor(F.col("height") / span).cast("long").alias("part")), "series"), path)


def read_series(spark: SparkSession, path: str) -> DataFrame:
    return table_or_empty(spark, path, SERIES).drop("part")


def rewrite_tail(spark: SparkSession, path: str, diffs: DataFrame, headers: DataFrame, before: tuple[DataFrame, DataFrame], after: tuple[DataFrame, DataFrame], span: int = 1000) -> int | None:
    """Bring a series under path from one pair of main and deposit addresses to another: the height from which it was made anew.

    Nothing changes before the first height of an address that came, went or changed sides. The parts from there on are
    written anew, from the sums that the part before them ends with; parts before keep their files.
    """
    sides = lambda pair: pair[0].select("address_id", F.lit("main").alias("side")).unionByName(pair[1].select("address_id", F.lit("deposit").alias("side"))).distinct()
    old, new = sides(before), materialize(sides(after), "sides")
    changed = old.exceptAll(new).unionByName(new.exceptAll(old)).select("address_id").distinct()
    first = diffs.join(changed, "address_id", "left_semi").agg(F.min("height")).first()[0]
    if first is None:
        return None
    start = first // span * span
    base = table_or_empty(spark, path, SERIES).where(F.col("part") == start // span - 1).agg(F.max_by("main", "height"), F.max_by("deposits", "height")).first()
    part = lambda side: F.sum(F.when(F.col("side") == side, F.col("nano")).otherwise(0))
    sums = diffs.where(F.col("height") >= start).join(new, "address_id").groupBy("height").agg(part("main").alias("main"), part("deposit").alias("deposits"))
    every = height_spine(headers).where(F.col("height") >= start).join(sums, "height", "left").na.fill(0)
    tail = prefix_sum(every, "height", ["main", "deposits"])
    write_series(tail.select("height", *((F.col(c) + F.lit(b or 0)).alias(c) for c, b in zip(("main", "deposits"), base, strict=True))), path, span)
    return start
