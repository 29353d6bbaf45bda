"""The registered queries of the thirteen operators, each over its whole table, and DuckDB SQL where SQL can tell the result."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunk_dedup, cover_tree, filter_audit, fingerprint, flat_graph, line_dedup, mixing, packing, quality, setsketch, token_count, toxicity, warc
from .common import materialize


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_bpe() -> dict:
    import public_tokenizers

    return {"json_path": tokenizer("byte_bpe_50k.json"), "ranks_path": tokenizer("byte_bpe_50k.tiktoken"), "pattern": public_tokenizers.PATTERN}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents' posterior quality; source is the host, source and language the path."""
    docs = table(spark, sf_dir, "documents")
    return quality.quality(docs, table(spark, sf_dir, "labels"), F.col("source"), F.concat_ws("/", "source", "lang"))


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compared(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without repeated passages: the spans cut out, by bytes, and what is left."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = chunk_dedup.deduplicated(docs)
    cut = F.aggregate("_removed", F.lit(0), lambda n, s: n + s["end"] - s["start"]).cast("long")
    return out.select("doc_id", F.size("_removed").cast("long").alias("n_spans"), cut.alias("removed_bytes"), F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"), F.col("_removed").alias("removed"), "text")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_graph.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of documents by a model that saw no held-out label; thresholds by language stand beside the fixed one."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    known = labels.where(F.coalesce(~held, F.lit(False)))
    model = toxicity.train(docs.select("doc_id", "text"), known)
    out = toxicity.scored(docs.select("doc_id", "lang", "text"), model)
    out = materialize(out.select("doc_id", "lang", F.coalesce(held, F.lit(False)).alias("held_out"), F.col("_score").alias("score")), "scores")
    cut = toxicity.thresholds(out, known)
    out = out.join(cut, F.expr("lang <=> _lang"), "left").withColumn("threshold", F.coalesce("_threshold", F.lit(toxicity.THRESHOLD)))
    return out.select("doc_id", "held_out", "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), F.col("threshold").alias("language_threshold"), (F.col("score") >= F.col("threshold")).alias("above_language_threshold"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.mix(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_size") * F.col("_whole") + F.col("_extra")).alias("taken"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), **byte_bpe())


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, books = cover_tree.compressed(table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(cover_tree.digest(books)).alias("codebooks_sha256"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"), F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_quality, op2_fingerprint, op3_substring_dedup, op4_near_dedup, op5_embedding_dedup, op6_toxicity, op7_warc, op8_token_counts, op9_mixing, op10_packing, op11_vector_codes, op12_line_dedup, op13_filter_audit, pipeline)}

_SIZE = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"



def _lloyd() -> str:
    """The rounds one after another, in integers; a floored quotient, as // cuts towards zero."""
    nearest = "arg_min(entry, (dist, entry)) AS entry, min(dist) AS dist FROM (SELECT i, part, entry, sum((p.x - c.x) * (p.x - c.x)) AS dist FROM p JOIN c{} c USING (part, pos) GROUP BY ALL) GROUP BY i, part"
    steps = []
    for k in range(cover_tree.ROUNDS):
        steps.append(f"a{k} AS MATERIALIZED (SELECT i, part, {nearest.format(k)})")
        steps.append(f"m{k} AS (SELECT part, entry, pos, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS x FROM a{k} JOIN p USING (i, part) GROUP BY ALL)")
        steps.append(f"c{k + 1} AS MATERIALIZED (SELECT part, entry, pos, CAST(coalesce(m.x, c.x) AS BIGINT) AS x FROM c{k} c LEFT JOIN m{k} m USING (part, entry, pos))")
    last = cover_tree.ROUNDS
    return f"""
        WITH v AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS i, vec_id, label, embedding AS e FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        f AS (SELECT i, unnest(range(len(e))) AS j, unnest(e) AS x, len(e) // 8 AS w FROM v),
        p AS MATERIALIZED (SELECT i, j // w AS part, j % w AS pos, CAST(floor(4096 * x::DOUBLE) AS BIGINT) AS x FROM f),
        c0 AS (SELECT part, i AS entry, pos, x FROM p WHERE i < 16),
        {", ".join(steps)},
        z AS (SELECT i, part, {nearest.format(last)}),
        o AS (SELECT i, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(dist) AS BIGINT) AS error FROM z GROUP BY i)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM c{last}) AS codebooks_sha256 FROM v JOIN o USING (i)"""


_ORDERS = ", ".join(f"('{''.join(p)}')" for p in itertools.permutations("ABCDE"))
_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE = {
    "op4_near_dedup": r"""
        WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d),
        e AS (SELECT doc_id, unnest(g) AS h FROM s),
        o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM e a JOIN e b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (SELECT x, y FROM o JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y WHERE 100 * n >= 85 * (len(a.g) + len(b.g) - n)),
        r AS (SELECT doc_id AS node, doc_id AS seen FROM s UNION SELECT r.node, l.y FROM r JOIN l ON l.x = r.seen)
        SELECT s.doc_id, CAST(any_value(len(s.g)) AS BIGINT) AS n_shingles, min(r.seen) AS component_id, s.doc_id = min(r.seen) AS kept FROM s JOIN r ON r.node = s.doc_id GROUP BY s.doc_id""",
    "op5_embedding_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
        r AS (SELECT vec_id AS node, vec_id AS seen FROM v UNION SELECT r.node, l.y FROM r JOIN l ON l.x = r.seen),
        n AS (SELECT x, count(*) AS c FROM l GROUP BY x)
        SELECT v.vec_id, CAST(coalesce(any_value(c), 0) AS BIGINT) AS n_links, min(seen) AS component_id, v.vec_id = min(seen) AS kept FROM v JOIN r ON r.node = v.vec_id LEFT JOIN n ON n.x = v.vec_id GROUP BY v.vec_id""",
    "op7_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
        f AS (SELECT d, min(page_id) AS first FROM p GROUP BY d)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest, CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to FROM p JOIN f ON p.d = f.d""",
    "op9_mixing": rf"""
        WITH d AS (SELECT doc_id, source, CAST({_SIZE} AS BIGINT) AS size, md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
        g AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM d GROUP BY source),
        w AS (SELECT source, s, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w, s * 3.0::DOUBLE AS cap FROM g),
        o AS (SELECT *, cap / w AS r, coalesce(sum(cap) OVER b, 0) AS capped, coalesce(sum(w) OVER b, 0) AS gone FROM w WINDOW b AS (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        t AS (SELECT sum(s) AS total, sum(w) AS ws FROM w),
        l AS (SELECT (total - capped) / (ws - gone) AS level FROM o, t WHERE (total - capped) / (ws - gone) <= r ORDER BY r, source LIMIT 1),
        p AS (SELECT source, s, least(cap, level * w) AS target, CASE WHEN s > 0 THEN CAST(floor(least(cap, level * w) / s) AS BIGINT) ELSE 0 END AS whole FROM w, l),
        q AS (SELECT d.*, s, target, whole, CAST(floor(target - whole * s + 0.5::DOUBLE) AS BIGINT) AS spare, sum(size) OVER (PARTITION BY d.source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
        SELECT doc_id, size, CAST(s AS BIGINT) AS source_size, CAST(target AS DOUBLE) AS target, CAST(size * whole + greatest(0, least(size, spare - before)) AS BIGINT) AS taken FROM q""",
    "op11_vector_codes": _lloyd(),
    "op12_line_dedup": rf"""
        WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
        k AS (SELECT *, translate(trim(line, {_BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
        d AS (SELECT k.*, coalesce(doc_id <> first, FALSE) AS gone FROM k LEFT JOIN f ON k.key = f.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM d GROUP BY doc_id""",
    "op13_filter_audit": rf"""
        WITH w AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        k AS (SELECT doc_id, part, (CASE WHEN len(w) < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END) + (CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 5 * length(t) THEN 4 ELSE 0 END)
          + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END) AS mask FROM w),
        g AS (SELECT part, mask, count(*) AS n, count(*) FILTER (quality = 1) AS good, count(*) FILTER (toxic = 1) AS toxic FROM k LEFT JOIN labels USING (doc_id) GROUP BY ALL),
        o AS (SELECT part, filter_order, unnest(range(1, 6)) AS step FROM (SELECT DISTINCT part FROM w), (VALUES {_ORDERS}) AS v(filter_order)),
        b AS (SELECT *, 1 << CAST(instr('ABCDE', filter_order[step]) - 1 AS INT) AS f, CAST(list_sum(list_transform(range(1, step), lambda i: 1 << CAST(instr('ABCDE', filter_order[i]) - 1 AS INT))) AS INT) AS before FROM o)
        SELECT b.part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(sum(n) FILTER (mask & (f | coalesce(before, 0)) = 0), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (mask & f <> 0 AND mask & coalesce(before, 0) = 0), 0) AS BIGINT) AS removed,
          CAST(coalesce(sum(n) FILTER (mask & f <> 0 AND mask & coalesce(before, 0) <> 0), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (mask = f), 0) AS BIGINT) AS unique_fails, CAST(coalesce(sum(good) FILTER (mask & f <> 0 AND mask & coalesce(before, 0) = 0), 0) AS BIGINT) AS good_lost,
          CAST(coalesce(sum(toxic) FILTER (mask & f <> 0 AND mask & coalesce(before, 0) = 0), 0) AS BIGINT) AS toxic_lost, CAST(coalesce(sum(n * (120 // greatest(bit_count(mask), 1))) FILTER (mask & f <> 0), 0) AS BIGINT) AS shapley
        FROM b JOIN g USING (part) GROUP BY b.part, filter_order, step""",
}
