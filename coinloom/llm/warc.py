"""WARC as a content-addressed archive: payload bytes once for each digest, exact record headers beside them, records by joins."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_dir

#: Payloads shorter than this are never revisits.
REVISIT_BYTES = 100
CRLF = "\r\n"
#: Spark's setting by which an execution removes its shuffle files when it ends, and not when the driver collects garbage.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df: DataFrame, path: str) -> None:
    """Write df, after which nothing else reads its shuffles: payloads that were dealt out leave the disks at once, before they
    are dealt out again for reading. The session's setting stays as it was."""
    conf = df.sparkSession.conf
    before = conf.get(CLEAN_UP, "false")
    conf.set(CLEAN_UP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(CLEAN_UP, before)


def record_id(page: Column, row: Column) -> Column:
    """Pages may repeat, so the row's number is part of it."""
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), row.cast("string"), F.lit(">"))


def header(kind: Column, own: Column, url: Column, digest: Column, size: Column, refers_to: Column, date: str) -> Column:
    """A record's header block, with the empty line that ends it. A null url gives an empty value; line ends in a url become
    %0D and %0A, as a header line can't hold them. own and refers_to are record ids."""
    clean = F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = F.when(kind == "revisit", F.concat(F.lit(f"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest{CRLF}WARC-Refers-To: "), refers_to, F.lit(CRLF))).otherwise(F.lit(""))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "), kind, F.lit(f"{CRLF}WARC-Record-ID: "), own, F.lit(f"{CRLF}WARC-Date: {date}{CRLF}WARC-Target-URI: "), clean,
        F.lit(f"{CRLF}WARC-Payload-Digest: sha256:"), digest, F.lit(CRLF), revisit, F.lit(f"Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.when(kind == "revisit", F.lit("0")).otherwise(size.cast("string")), F.lit(f"{CRLF}X-Payload-Length: "), size.cast("string"), F.lit(CRLF * 2),
    )


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", date: str | None = None) -> None:
    """Write path/headers (page_id, digest, header) and path/payloads (digest, payload), a row of payloads for each digest.

    Null payloads count as empty. Of equal payloads of at least REVISIT_BYTES the record of the smallest page_id is the
    response and others revisit it; rows that repeat that page_id are responses too; null page_ids come last, and are
    responses where no page has an id. Two payloads of one digest that differ in length or in a second hash stop the
    job. Every record has an id of its own, and date (UTC; now where it is None) as WARC-Date. An empty table gives
    an empty archive; other columns aren't kept.
    """
    spark = pages.sparkSession
    date = date or datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    body = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), body.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    # payloads are hashed once; what follows moves narrow rows, numbered as written
    write_table(rows.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("size"), F.xxhash64("payload").alias("check"), F.monotonically_increasing_id().alias("row")), f"{path}/seen")
    seen = spark.read.parquet(f"{path}/seen")
    order = F.struct(F.col("page_id").isNull(), "page_id", "row")
    first = seen.groupBy("digest").agg(F.min(order).alias("f"), F.min("size").alias("a"), F.max("size").alias("b"), F.min("check").alias("c"), F.max("check").alias("d"))
    sound = F.when((F.col("a") == F.col("b")) & (F.col("c") == F.col("d")), F.col("f.row")).otherwise(F.raise_error(F.lit("different payloads have one digest")).cast("long"))
    write_table(first.select("digest", F.col("f.page_id").alias("first"), sound.alias("first_row")), f"{path}/firsts")
    first = spark.read.parquet(f"{path}/firsts")
    other = (F.col("size") >= REVISIT_BYTES) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    kind = F.when(other, F.lit("revisit")).otherwise(F.lit("response"))
    told = header(kind, record_id(F.col("page_id"), F.col("row")), F.col("url"), F.col("digest"), F.col("size"), record_id(F.col("first"), F.col("first_row")), date)
    write_table(seen.join(first, "digest").select("page_id", "digest", told.alias("header")), f"{path}/headers")
    # Only rows of a payload's first page bring its bytes on. Dealt by digest and page, so that copies of a common payload
    # spread; only rows that repeat page and payload meet, and of these one stays without a further shuffle.
    page = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    first = first.select("digest", page(F.col("first")).alias("page"))
    owners = rows.select(page(F.col("page_id")).alias("page"), "digest", "payload").join(first, ["digest", "page"], "left_semi")
    write_table(owners.dropDuplicates(["digest", "page"]).select("digest", "payload"), f"{path}/payloads")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, header, payload): every record with its own header and, through the digest, its full payload, verified."""
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    sound = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(F.raise_error(F.lit("a payload doesn't match its digest")).cast("binary"))
    return headers.join(payloads.select("digest", sound.alias("payload")), "digest").select("page_id", "header", "payload")


def record_bytes(records: DataFrame) -> DataFrame:
    """With record: the bytes of the WARC record, header, block and two line ends; a revisit's block is empty."""
    block = F.when(field("header", "WARC-Type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    return records.withColumn("record", F.concat(F.encode("header", "UTF-8"), block, F.lit(CRLF * 2).cast("binary")))


def parsed(records: DataFrame) -> DataFrame:
    """records (record, and others) with head, the header block read from the record's bytes, and block, the bytes that its
    Content-Length tells. A record that doesn't end two line ends after its block stops the job."""
    head = F.substring_index(F.decode("record", "UTF-8"), CRLF * 2, 1)
    out = records.withColumn("head", head).withColumns({"_at": F.octet_length("head") + 4, "_n": field("head", "Content-Length").cast("int")})
    whole = F.octet_length("record") == F.col("_at") + F.col("_n") + 4
    block = F.when(whole, F.expr("substring(record, _at + 1, _n)")).otherwise(F.raise_error(F.lit("a record of another length than it tells")).cast("binary"))
    return out.withColumn("block", block).drop("_at", "_n")


def field(column: str, name: str) -> Column:
    """A header field's value. Only CRLF begins a line, as a url may hold other characters that end one."""
    return F.regexp_extract(column, rf"\r\n{name}: ([^\r\n]*)", 1)


def archived(pages: DataFrame, **columns) -> DataFrame:
    """Write pages to an archive in the shared folder, rebuild its records, and tell what each says as read from its bytes:
    (page_id, payload_bytes, payload_digest, record_type, refers_to). A response's length and digest are those of its
    block; a revisit's those of the payload that its digest leads to."""
    spark = pages.sparkSession
    path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(pages, path, **columns)
    records = parsed(record_bytes(read_records(spark, path)))
    payload = F.when(field("head", "WARC-Type") == "revisit", F.col("payload")).otherwise(F.col("block"))
    target = F.regexp_extract(field("head", "WARC-Refers-To"), r"<urn:page:(-?\d+):", 1)
    return records.select(
        "page_id", F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest"),
        field("head", "WARC-Type").alias("record_type"), F.when(target != "", target).cast("long").alias("refers_to"),
    )
