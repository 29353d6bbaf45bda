"""Line dedup by keep bitmaps. DataFrame functions only.

Hashes of lines are dealt out by ranges and sorted by document and position within; first occurrences stream by, and what
comes after them in another document is told to its document as a bit. Only hashes, ids and bits move until a document's
text meets its bitmap.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, unused

#: The shortest key, in code points, whose repetitions go.
MIN_CHARS = 10
#: Lines of the sample that tells which hashes are hot, and the lines in it that make one so: at most 2,000 hashes or so are.
SAMPLE, HOT = 200_000, 100
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case. Spark's lower is the same for lines of one-byte characters."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, string.ascii_uppercase, string.ascii_lowercase))


def two_hashes(text: Column) -> tuple[Column, Column]:
    """128 bits of hash in two columns."""
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def lines_of(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(doc, t1, t2, pos, h1, h2): each line with a key of at least min_chars, its document (id and hashes of the text, so that
    rows that share an id stay apart unless they are equal), its position, and the key's hashes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    each = docs.select(F.col(id_col).alias("doc"), *(h.alias(n) for h, n in zip(two_hashes(text), ("t1", "t2"), strict=True)), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    keyed = each.select("doc", "t1", "t2", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keyed.select("doc", "t1", "t2", "pos", *(h.alias(n) for h, n in zip(two_hashes(F.col("key")), ("h1", "h2"), strict=True)))


def later_lines(lines: DataFrame) -> DataFrame:
    """(doc, t1, t2, pos): the lines whose hash a document of smaller id holds. Null ids come last.

    A hash with many lines would fill one range: a bounded sample finds such hashes, their smallest ids come from partial
    sums, and their lines are compared with these where they lie. All others are dealt out by ranges of hashes. The sample
    decides by which way a hash goes and never what comes of it.
    """
    every = max(1, lines.count() // SAMPLE)
    seen = lines.where(F.pmod(F.xxhash64("h1", "doc", "t1", "pos"), F.lit(every)) == 0)
    hot = materialize(seen.groupBy("h1", "h2").agg(F.count("*").alias("n")).where(F.col("n") >= HOT).select("h1", "h2"), "hot-lines")
    some = F.broadcast(hot)  # about SAMPLE / HOT hashes at most
    least = materialize(lines.join(some, ["h1", "h2"], "left_semi").groupBy("h1", "h2").agg(F.min("doc").alias("first")), "hot-firsts")
    after = F.col("first").isNotNull() & ~F.col("doc").eqNullSafe(F.col("first"))
    those = lines.join(F.broadcast(least), ["h1", "h2"]).where(after).select("doc", "t1", "t2", "pos")
    order = [F.col("doc").asc_nulls_last(), F.col("pos")]
    dealt = lines.join(some, ["h1", "h2"], "left_anti").repartitionByRange("h1", "h2").sortWithinPartitions("h1", "h2", *order)
    passing = Window.partitionBy("h1", "h2").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return those.unionByName(dealt.withColumn("first", F.first("doc").over(passing)).where(after).select("doc", "t1", "t2", "pos"))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc, t1, t2, n_dropped, keep) for each document that loses lines: keep is a bitmap in words of 64 lines, a set bit for a
    line that stays; words after the last line that goes are left out, as all their lines stay."""
    gone = later_lines(materialize(lines_of(docs, id_col, text_col, min_chars), "lines"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("pos") % 64).cast("int"))
    words = gone.groupBy("doc", "t1", "t2", F.floor(F.col("pos") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("bits"))
    by_doc = words.groupBy("doc", "t1", "t2").agg(F.sum(F.bit_count("bits")).cast("long").alias("n_dropped"), F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("m"))
    keep = F.transform(F.sequence(F.lit(0), F.array_max(F.map_keys("m"))), lambda w: F.bitwise_not(F.coalesce(F.element_at("m", w), F.lit(0).cast("long"))))
    return materialize(by_doc.select("doc", "t1", "t2", "n_dropped", keep.alias("keep")), "bitmaps")


def kept_lines(text: Column, keep: Column) -> Column:
    """The text's lines whose bit is set, joined. keep must be a column as read, not an expression: each line looks into it."""
    stays = lambda line, i: F.coalesce(F.getbit(F.get(keep, F.floor(i / 64).cast("int")), (i % 64).cast("int")), F.lit(1).cast("tinyint")) == 1
    return F.array_join(F.filter(F.split(text, "\n"), stays), "\n")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, lines_col: str = "_lines", dropped_col: str = "_dropped") -> DataFrame:
    """docs without repeated lines, with lines_col and dropped_col (names that docs doesn't have): how many lines there were and
    how many go.

    Of a key that at least two documents hold the lines stay in the document of the smallest id, all of them, and go
    elsewhere. Rows that share an id are one document: they keep what the others of that id hold. Null ids come last and
    are one document. A null text counts as an empty line and becomes the empty text. Other columns stay as they are; an
    empty table gives an empty one.
    """
    doc, t1, t2, n, keep, h1, h2 = unused(docs, "doc", "t1", "t2", "n_dropped", "keep", "h1", "h2")
    bitmaps = keep_bitmaps(docs, id_col, text_col, min_chars).toDF(doc, t1, t2, n, keep)
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.withColumns({text_col: text}).withColumns(dict(zip((h1, h2), two_hashes(F.col(text_col)), strict=True)))
    out = own.join(bitmaps, F.col(id_col).eqNullSafe(F.col(doc)) & (F.col(h1) == F.col(t1)) & (F.col(h2) == F.col(t2)), "left")
    new = F.when(F.col(keep).isNull(), F.col(text_col)).otherwise(kept_lines(F.col(text_col), F.col(keep)))
    told = [(F.regexp_count(text_col, F.lit("\n")) + 1).cast("long").alias(lines_col), F.coalesce(n, F.lit(0)).cast("long").alias(dropped_col)]
    return out.select(*(new.alias(c) if c == text_col else F.col(c) for c in docs.columns), *told)
