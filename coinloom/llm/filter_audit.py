"""Filter interaction audit: which documents each filter takes, alone, before and after the others, in every order.

An existential self-join marks exact copies of smaller ids; their ids join those of the other failures, and a count of each
combination of failures, by part, tells all orders of the filters.
"""

from __future__ import annotations

import itertools
import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

FILTERS = "ABCDE"
#: Thresholds: words of a document, percent of distinct words, percent of capitals.
FEW_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 50, 65, 5
MARKS = "[#$%&*|]"
COPY = 1 << FILTERS.index("E")


def own_failures(text) -> F.Column:
    """The bits of the filters A to D that a text fails; each reads the whole text."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, string.ascii_uppercase, ""))
    failed = [n < FEW_WORDS, 100 * distinct < DISTINCT_PERCENT * n, 100 * capitals > CAPITAL_PERCENT * F.length(text), text.rlike(MARKS)]
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(failed[1:], 1)), F.when(failed[0], F.lit(1)).otherwise(F.lit(0)))


def copies(docs: DataFrame, hashed: DataFrame) -> DataFrame:
    """(doc, h1, h2, part) of the rows with the text of a smaller id. docs: doc, part, text, h1, h2; hashed: the same without text.

    Only texts whose hash comes twice are compared. A text's smallest id comes from partial sums, so thousands of copies meet one
    row; the self-join is a left-semi join on hash, text and smaller id, whose hot hashes Spark splits. Null ids are neither
    copies nor originals.
    """
    twice = hashed.where("doc is not null").groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    some = materialize(docs.where("doc is not null").join(materialize(twice, "hashes-twice"), ["h1", "h2"], "left_semi"), "texts-twice")
    first = materialize(some.groupBy("h1", "h2", "text").agg(F.min("doc").alias("first")), "texts-first")
    a, b = some.alias("a"), first.alias("b")
    return a.join(b, F.expr("a.h1 = b.h1 and a.h2 = b.h2 and a.text = b.text and b.first < a.doc"), "left_semi").select("doc", "h1", "h2", "part")


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc, h1, h2, part, mask, n): the filters that a document fails, as bits, and how many rows of docs it is: rows that are equal
    in id, text and part."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.select("*", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    own = materialize(rows.select("doc", "h1", "h2", "part", own_failures(F.col("text")).alias("mask"), F.lit(1).cast("long").alias("n")), "failures")
    found = copies(rows, own).select("doc", "h1", "h2", "part", F.lit(COPY).alias("mask"), F.lit(0).cast("long").alias("n"))
    return own.unionByName(found).groupBy("doc", "h1", "h2", "part").agg(F.bit_or("mask").alias("mask"), F.sum("n").alias("n"))


def combinations(failed: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(part, n, good, toxic): of each combination of failures, at the place of its bits, how many documents, how many of quality 1 and how
    many toxic ones. Labels that repeat an id say 1 where one of them does."""
    known = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    both = failed.join(known, "doc", "left")
    of = lambda c: F.sum(F.when(F.coalesce(c, F.lit(False)), F.col("n")).otherwise(0)).alias(c)
    counts = both.groupBy("part", "mask").agg(F.sum("n").alias("n"), of("good"), of("toxic"))
    seen = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("mask", F.struct("n", "good", "toxic")))).alias("seen"))  # 32 at most
    at = lambda c: F.transform(F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1)), lambda m: F.coalesce(F.element_at("seen", m)[c], F.lit(0).cast("long"))).alias(c)
    return seen.select("part", at("n"), at("good"), at("toxic"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley): a row for each part, each order of the
    filters and each of its steps, zeros included.

    In each order the first filter that a document fails removes it, so a combination of k failures gives each of its filters
    120 / k of all orders: shapley. Null texts are empty, null parts the empty part. Rows that repeat an id are documents of
    their own; a smaller id alone makes a copy, so equal rows are none of each other, and rows with a null id are neither
    copies nor originals. Labels of unknown documents are not read. An empty table gives an empty one.
    """
    parts = materialize(combinations(failures(docs, id_col, text_col, part_col), labels, id_col), "combinations")
    orders = F.array(*(F.lit("".join(p)) for p in itertools.permutations(FILTERS)))
    steps = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    place = {x: F.instr("filter_order", x) for x in FILTERS}
    pick = lambda keep: sum((F.when(keep(place[x]), F.lit(1 << i)).otherwise(F.lit(0)) for i, x in enumerate(FILTERS)), F.lit(0))
    steps = steps.withColumns({"f": pick(lambda at: at == F.col("step")), "prior": pick(lambda at: at < F.col("step"))})
    told = "aggregate(sequence(0, 31), 0L, (s, m) -> s + if({}, {}[m], 0L))"
    now, before = "(m & f) <> 0 and (m & prior) = 0", "(m & f) <> 0 and (m & prior) <> 0"
    columns = {"kept": ("(m & (f | prior)) = 0", "n"), "removed": (now, "n"), "redundant": (before, "n"), "unique_fails": ("m = f", "n"), "good_lost": (now, "good"), "toxic_lost": (now, "toxic")}
    share = "aggregate(sequence(0, 31), 0L, (s, m) -> s + if((m & f) <> 0, n[m] * (120 div bit_count(m)), 0L)) as shapley"
    return steps.selectExpr("part", "filter_order", "step", *(f"{told.format(when, c)} as {name}" for name, (when, c) in columns.items()), share)
