"""Facts by height that follow a chain of headers, through replays, rollbacks and forks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ROLLBACK_HORIZON
from ..operators.balances import erg_balances
from ..shared import materialize
from .tables import Told, progress, replace_parts, table_or_empty, tell, with_markers

DIFFS = "address_id long, height long, tx_idx long, nano long"
HEADERS = "height long, header_id string, parent_id string"
#: Runs of spans that a batch of many heights is written in.
GROUPS = 32


def columns_of(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


class Ledger:
    """Diffs (or other facts of a schema with height) under a folder, with balances of them. append skips heights that are there, so
    replays change nothing; roll_back drops heights. A block's rows come in one batch.

    A part of the table holds a span of heights, or a run of spans, and has the number of the last of them. A batch makes GROUPS parts
    and some at most: the spans that a rollback can reach, and as many runs of those below. What lies above the head doesn't count: a
    rollback lowers the head, by one small file, and the next append replaces the parts from there on, so whoever dies in between
    leaves no gap.
    """

    def __init__(self, spark: SparkSession, path: str, span: int = 1000, schema: str = DIFFS):
        self.spark, self.path, self.span, self.schema = spark, path, span, schema
        self.columns = columns_of(schema)

    def _table(self, head: int | None = None) -> DataFrame:
        return table_or_empty(self.spark, f"{self.path}/diffs", f"{self.schema}, part long").where(F.col("height") <= (self.head() if head is None else head))

    def diffs(self) -> DataFrame:
        return self._table().select(*self.columns)

    def since(self, height: int, head: int | None = None) -> DataFrame:
        """The rows from a height on, read from its part and those after it; head where it is known."""
        return self._table(head).where((F.col("part") >= height // self.span) & (F.col("height") >= height)).select(*self.columns)

    def head(self) -> int:
        return progress(self.spark, self.path).height

    def append(self, batch: DataFrame, _: int = 0) -> None:
        last = progress(self.spark, self.path)
        head = last.height
        new = materialize(batch.where(F.col("height") > head).select(*self.columns), "new-facts")
        top = new.agg(F.max("height")).first()[0]
        if top is None:
            return
        first, highest = (head + 1) // self.span, top // self.span
        # rows that stay keep their part; parts that hold none of them, as a rollback leaves, are replaced too, with or without new rows
        there = table_or_empty(self.spark, f"{self.path}/diffs", f"{self.schema}, part long").where(F.col("part") >= first).groupBy("part").agg(F.min("height").alias("low")).collect()
        staying = [r["part"] for r in there if r["low"] is not None and r["low"] <= head]  # one at most
        going, recent = max(staying, default=first), (top - ROLLBACK_HORIZON) // self.span
        run = max(1, -(-(recent - going - 1) // GROUPS))
        at = F.floor(F.col("height") / self.span).cast("long")
        end_of_run = F.least(going + F.floor((at - going - 1) / run) * run + run, F.lit(recent - 1))
        rows = new.select("*", F.when(at <= going, going).when(at >= recent, at).otherwise(end_of_run).cast("long").alias("part"))
        if staying:
            rows = rows.unionByName(materialize(self._table(head).where(F.col("part") >= first).select(*self.columns, "part"), "kept-facts"))
        marks = sorted({r["part"] for r in there} | {highest})
        replace_parts(with_markers(rows, marks).hint("rebalance", "part"), f"{self.path}/diffs")
        tell(self.spark, self.path, last, 0, top)

    def roll_back(self, height: int) -> None:
        """Forget the blocks from a height on, as when the chain turns to another branch."""
        if self.head() - height >= ROLLBACK_HORIZON:
            raise ValueError("a rollback goes further back than the horizon")
        self.drop_from(height)

    def drop_from(self, height: int) -> None:
        last = progress(self.spark, self.path)
        if last.height >= height:
            tell(self.spark, self.path, last, 0, height - 1)

    def balances(self) -> DataFrame:
        return erg_balances(self.diffs())


def branches(headers: DataFrame) -> DataFrame:
    """(tip, tip_height, height, header_id, parent_id, main): for each header that isn't on the main chain its parents, one after another, down
    to the first that is. headers: height, header_id, parent_id, main; of the last blocks, so the walk is short."""
    spark = headers.sparkSession
    headers.createOrReplaceTempView("_recent_headers")
    return spark.sql("""
        WITH RECURSIVE up (tip, tip_height, height, header_id, parent_id, main) AS (
          SELECT header_id, height, height, header_id, parent_id, main FROM _recent_headers WHERE NOT main
          UNION ALL
          SELECT up.tip, up.tip_height, h.height, h.header_id, h.parent_id, h.main FROM up JOIN _recent_headers h ON h.header_id = up.parent_id AND h.height = up.height - 1 WHERE NOT up.main)
        SELECT * FROM up""")


def best_branch(walked: DataFrame, head: int) -> tuple[int, DataFrame] | None:
    """(fork, headers): the last height that the best tip shares with the main chain, and the branch above it. Only a tip above the
    head is better; of equal ones the smaller id is."""
    joined = walked.where("main").select("tip", F.col("height").alias("fork"))
    best = walked.where((F.col("tip_height") > head) & ~F.col("main")).join(joined, "tip").orderBy(F.desc("tip_height"), "tip").select("tip", "fork").first()
    if best is None:
        return None
    return best["fork"], walked.where((F.col("tip") == best["tip"]) & ~F.col("main")).select("height", "header_id", "parent_id")


class Chain:
    """Tables of facts by height that follow the best chain of headers. Headers that aren't on it, and their facts, are kept for
    ROLLBACK_HORIZON heights: they may come to be on it when further blocks make theirs the better branch.

    Headers are written last and dropped first, so rows beyond the last header are of a batch that died, and go.
    """

    def __init__(self, spark: SparkSession, path: str, tables: dict[str, str], span: int = 1000):
        self.spark, self.path = spark, path
        self.headers = Ledger(spark, f"{path}/headers", span, HEADERS)
        self.tables = {name: Ledger(spark, f"{path}/{name}", span, schema) for name, schema in tables.items()}
        self.schemas = {"headers": HEADERS} | {name: f"{schema}, header_id string" for name, schema in tables.items()}

    def roll_back(self, height: int) -> None:
        self.headers.roll_back(height)
        self._drop_rows(height)

    def _drop_rows(self, height: int) -> None:
        for book in self.tables.values():
            book.drop_from(height)

    def _aside(self, name: str, version: int) -> DataFrame:
        """What is kept of headers, or of a table's facts, that may be of other branches. The last two versions are there."""
        rows = table_or_empty(self.spark, f"{self.path}/aside/{name}", f"{self.schemas[name]}, part int")
        return rows.where((F.col("part") == version % 2) & F.col("header_id").isNotNull()).drop("part")

    def _keep_aside(self, kept: dict[str, DataFrame], last: Told) -> Told:
        version = last.batch + 1
        for name, rows in kept.items():  # the other version is read while this one is written
            replace_parts(with_markers(rows.withColumn("part", F.lit(version % 2)), [version % 2]), f"{self.path}/aside/{name}")
        return tell(self.spark, f"{self.path}/aside", last, version, -1)

    def follow(self, headers: DataFrame, facts: dict[str, DataFrame]) -> int | None:
        """Take in a batch of blocks, one a height, and go over to another branch where that has come to end higher. Known headers
        are skipped. Returns the first height that is new on the chain, None where the chain stays as it is.

        A batch that joins neither the chain nor what is kept aside is refused; what is at or below the horizon is final.
        """
        head = self.headers.head()
        self._drop_rows(head + 1)
        low = head - ROLLBACK_HORIZON
        version = progress(self.spark, f"{self.path}/aside")
        aside = {name: self._aside(name, version.batch).where(F.col("height") > low) for name in self.schemas}
        chain = self.headers.since(low, head).withColumn("main", F.lit(True))
        others = aside["headers"].join(chain.select("header_id"), "header_id", "left_anti").withColumn("main", F.lit(False))
        known = materialize(chain.unionByName(others), "known-headers")
        new = headers.select(*columns_of(HEADERS)).where(F.col("height") > low).join(known.select("header_id"), "header_id", "left_anti")
        new = materialize(new.select(*columns_of(HEADERS)), "new-headers")
        first = new.agg(F.min("height")).first()[0]
        tagged = {name: rows.join(new.select("height", "header_id"), "height").select(*columns_of(self.schemas[name])) for name, rows in facts.items()}
        if first is not None:
            parent = known.join(new.where(F.col("height") == first).select((F.col("height") - 1).alias("height"), F.col("parent_id").alias("header_id")), ["height", "header_id"], "left_semi").select("main").first()
            wrong = broken_links(new).agg(F.min("height")).first()[0]
            if wrong is None and head >= 0 and parent is None:
                wrong = first
            if wrong is not None:
                raise ValueError(f"the block of height {wrong} doesn't follow the one before")
            if head < 0 or (parent["main"] and first == head + 1):  # the chain goes on
                return self._go(new, tagged)
        every = materialize(known.unionByName(new.withColumn("main", F.lit(False))), "branches")
        found = None if every.where("not main").isEmpty() else best_branch(materialize(branches(every), "branches"), head)
        if found is None:
            if first is not None:
                self._keep_aside({"headers": aside["headers"].unionByName(new), **{name: aside[name].unionByName(rows) for name, rows in tagged.items()}}, version)
            return None
        fork, branch = found
        # what leaves the chain, and the branch's own blocks, are kept aside before anything is dropped
        left = known.where(F.col("main") & (F.col("height") > fork)).select(*columns_of(HEADERS))
        kept = {"headers": aside["headers"].unionByName(new).unionByName(left).dropDuplicates(["header_id"])}
        for name, book in self.tables.items():
            gone = book.since(fork + 1).join(left.select("height", "header_id"), "height").join(aside[name].select("header_id").distinct(), "header_id", "left_anti")
            rows = aside[name].unionByName(gone.select(*columns_of(self.schemas[name])))
            kept[name] = rows.unionByName(tagged[name]) if name in tagged else rows
        version = self._keep_aside(kept, version)
        rows = {name: self._aside(name, version.batch).join(branch.select("header_id"), "header_id", "left_semi") for name in self.tables}
        self.headers.drop_from(fork + 1)
        self._drop_rows(fork + 1)
        return self._go(branch, rows)

    def _go(self, headers: DataFrame, facts: dict[str, DataFrame]) -> int:
        for name, rows in facts.items():
            self.tables[name].append(rows)
        first = headers.agg(F.min("height")).first()[0]
        self.headers.append(headers)
        return first


def broken_links(headers: DataFrame) -> DataFrame:
    """Headers (height, header_id, parent_id) that don't follow the one before: its id isn't their parent, or it is missing. The
    first height needs none. To be empty before a batch is appended; the lowest broken height is where to roll back to."""
    before = headers.select((F.col("height") + 1).alias("height"), F.col("header_id").alias("_before"))
    first = headers.agg(F.min("height").alias("_first"))
    out = headers.join(before, "height", "left").crossJoin(F.broadcast(first))  # one row
    return out.where((F.col("height") > F.col("_first")) & ~F.col("parent_id").eqNullSafe(F.col("_before"))).select("height", "header_id", "parent_id")
