"""A corpus pipeline of five stages over the documents table: toxicity, near-dedup, substring dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. What
a stage returns is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinloom.llm import chunk_dedup, mixing, packing, setsketch, toxicity
from coinloom.llm.common import materialize, unused
from coinloom.llm.queries import byte_bpe, table


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic, by a threshold for their language.

    Each text is read for its score once; thresholds come from (doc_id, lang, score) and labels, so no text is dealt out. Null
    and empty texts score as texts of no words; rows with a null doc_id or lang are scored like others; repeated rows
    go or stay together; other columns stay as they are, whatever their names; an empty table gives an empty one.
    """
    labels = table(spark, sf_dir, "labels")
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    (score,) = unused(docs, "score")
    scored = materialize(toxicity.scored(docs, model, score_col=score), "scored")
    cut = toxicity.thresholds(scored.select("doc_id", "lang", F.col(score).alias("score")), labels)
    lang, threshold = unused(scored, "lang_of_cut", "cut")
    cut = cut.select(F.col("_lang").alias(lang), F.col("_threshold").alias(threshold))
    kept = scored.join(cut, F.col("lang").eqNullSafe(F.col(lang)), "left")
    return kept.where(F.col(score) < F.coalesce(threshold, F.lit(toxicity.THRESHOLD))).select(*docs.columns)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest doc_id: five-word shingles, a similarity of 0.8.

    Null, empty and wordless texts have no copies and stay, as do rows with a null doc_id; of rows equal in doc_id and text one
    stays; other columns stay as they are; an empty table gives an empty one.
    """
    return setsketch.deduplicated(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document holds; n_chars follows the text. Texts that were repeats throughout go.

    Null and empty texts stay. Earlier is by doc_id, nulls first; of rows with equal or no doc_id neither is earlier, and they
    keep what they share; other columns stay as they are; an empty table gives an empty one.
    """
    (removed,) = unused(docs, "removed")
    out = chunk_dedup.deduplicated(docs, removed_col=removed).where((F.size(removed) == 0) | (F.trim("text") != ""))
    return out.withColumn("n_chars", F.when(F.size(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: sources weigh 1, 2, 3 in turn and come three times at most.

    A null source is a source, the last one; a null text has no words. Ties don't arise: documents come in the order of a seeded
    hash of doc_id, and rows that repeat one share their part. Other columns stay; an empty table gives an empty one.
    """
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of binary lengths, each a sequence.

    Null and empty texts give a piece of one id; a document that comes twice is packed twice, as pieces of equal start and
    different sequence_id; rows with a null doc_id come first; an empty table gives an empty one.
    """
    return packing.packed(docs, **byte_bpe())


STAGES = [("toxicity", without_toxic), ("near-dedup", without_near_copies), ("substring-dedup", without_repeats), ("mixing", mixed), ("packing", packed)]
#: Trained scores, sketches and digests are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
