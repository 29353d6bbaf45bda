"""Mixing sources to target weights: capped water-filling and seeded whole and fractional repetitions. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, ordered_rank


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, max_epochs: float = 3.0) -> DataFrame:
    """sources (source, size, weight) -> with target: shares of all sizes by weight, none above max_epochs times its size.

    A source whose share would be above its cap is clamped there; what it leaves is shared out again by weight, until
    none is above. Each pass is one aggregate over the sources, of which the driver sees three sums.
    A source of size 0 has target 0; so has every source where nothing has a size.
    """
    cap = F.col("size") * F.lit(float(max_epochs))
    total = sources.agg(F.sum("size")).first()[0] or 0
    level, clamped = 0.0, -1
    while total:
        over = cap / F.col("weight") < F.lit(level)
        n, capped, weight = sources.agg(F.count_if(over), F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)), F.sum(F.when(~over, F.col("weight")))).first()
        if n == clamped or not weight:
            break
        clamped, level = n, (total - capped) / weight
    return sources.withColumn("target", F.least(cap, F.lit(float(level)) * F.col("weight")))


def mix_plan(sized: DataFrame, weights: tuple = (1, 2, 3), max_epochs: float = 3.0) -> DataFrame:
    """sized (source, size, key) -> per source: source_size, target, whole, cut_key, cut_words.

    A source takes each of its documents `whole` times. Documents with key < cut_key, a seeded order, come once more,
    and cut_words more words come from the one at cut_key (cut_words / count each, where several rows share the key):
    its taken words are its target to the word. cut_key is null where no fraction is left.
    The cut is found by digits of the key: sums for each source and digit, then only the rows of the digit that the cut
    falls in; so no source is ever ordered as a whole, however many rows it has.
    """
    by_source = materialize(sized.groupBy("source").agg(F.sum("size").alias("size")), "sources")
    ranked = ordered_rank(by_source, [F.col("source").asc_nulls_last()], "rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("double")
    filled = water_fill(materialize(ranked.select("source", "size", weight.alias("weight")), "weighted"), max_epochs)
    whole = F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(F.lit(0)).cast("long")
    plan = filled.withColumn("whole", whole)
    left = F.floor(F.col("target") - F.col("whole") * F.col("size") + F.lit(0.5)).cast("long")
    plan = materialize(plan.select("source", F.col("size").alias("source_size"), "target", "whole", left.alias("left")), "plan")

    rows, cuts = sized.where("size > 0"), plan.where("left > 0").select("source", "left", F.lit("").alias("prefix"))
    for _ in range(2):
        near = rows.alias("r").join(cuts.alias("c"), F.expr("r.source <=> c.source and startswith(r.key, c.prefix)"))
        sums = near.groupBy(F.expr("r.source").alias("source"), F.expr("c.left").alias("left"), F.expr("substring(r.key, 1, length(c.prefix) + 2)").alias("prefix")).agg(F.sum(F.expr("r.size")).alias("sum"))
        run = F.sum("sum").over(Window.partitionBy("source").orderBy("prefix"))
        cuts = sums.withColumn("run", run).where("run >= left and run - sum < left")
        cuts = materialize(cuts.select("source", (F.expr("left - (run - sum)")).alias("left"), "prefix"), "cuts")
    last = rows.alias("r").join(cuts.alias("c"), F.expr("r.source <=> c.source and startswith(r.key, c.prefix)"))
    last = last.groupBy(F.expr("r.source").alias("source"), F.expr("c.left").alias("left"), F.expr("r.key").alias("key")).agg(F.sum(F.expr("r.size")).alias("sum"), F.count("*").alias("n"))
    last = last.withColumn("run", F.sum("sum").over(Window.partitionBy("source").orderBy("key"))).where("run >= left and run - sum < left")
    last = last.select(F.col("source").alias("s"), F.col("key").alias("cut_key"), F.expr("(left - (run - sum)) div n").alias("cut_words"))
    return materialize(plan.join(last, F.expr("source <=> s"), "left").drop("s", "left"), "mix-plan")


TOLD = ("size", "source_size", "target", "whole", "extra")


def prefix(docs: DataFrame) -> str:
    """What stands before the names that mix adds: an underscore, or as many as no column of docs begins with."""
    p = "_"
    while any(c.startswith(p) for c in docs.columns):
        p += "_"
    return p


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = (1, 2, 3), max_epochs: float = 3.0, seed: int = 17) -> DataFrame:
    """docs with size, source_size, target, whole (copies) and extra (words of one more, fractional repetition), named after
    prefix(docs): _size and so on, where no column of docs begins with an underscore.

    Sources by code point, null last, weigh `weights` in turn. Null text has size 0. A null source is a source. Repeated
    rows share a key and take equal parts. Null ids share a key too. An empty table gives an empty table.
    The texts are read twice (sizes, then the result) and never shuffled: the plan has one row for each source.
    """
    p = prefix(docs)
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).cast("binary"))
    sized = materialize(docs.select(F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size"), key.alias("key")), "sized")
    plan = mix_plan(sized, weights, max_epochs).select(*(F.col(c).alias(f"{p}{c}") for c in ("source", "source_size", "target", "whole", "cut_key", "cut_words")))
    # Spark broadcasts the plan where its measured size allows, and joins by sorting, with hot sources split, where not.
    size, own, cut = f"{p}size", F.col(f"{p}key"), F.col(f"{p}cut_key")
    out = docs.withColumn(size, n_words(F.col(text_col))).withColumn(f"{p}key", key).join(plan, F.col(source_col).eqNullSafe(F.col(f"{p}source")), "left")
    extra = F.when(own < cut, F.col(size)).when(own == cut, F.least(size, f"{p}cut_words")).otherwise(F.lit(0).cast("long"))
    return out.withColumn(f"{p}extra", extra).select(*docs.columns, *(f"{p}{c}" for c in TOLD))


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: each document's row as often as it is taken; the one fractional repetition of a source counts
    where it covers half of its document. Columns are those of docs. Documents of size 0 come as often as their source's
    whole copies, and not at all where nothing has a size."""
    p = prefix(docs)
    taken = mix(docs, **how)
    copies = F.col(f"{p}whole") + (F.col(f"{p}extra") * 2 >= F.greatest(F.col(f"{p}size"), F.lit(1))).cast("long")
    return taken.withColumn(f"{p}n", copies).where(F.col(f"{p}n") > 0).withColumn(f"{p}copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{p}n")))).select(*docs.columns)
