"""Quality by hierarchical empirical Bayes: a document's own evidence over the posterior rate of its path, host and the world."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize

#: Labelled documents that the evidence model is fitted on, at most; those with the smallest seeded hash.
TRAINING_ROWS = 6000
NAMES = ("words", "word_length", "long_words", "distinct", "repeat_run", "upper", "symbols", "digits", "ends", "bars", "lines", "repeated_lines", "sentence", "vowels", "exclaim", "top_word")
_TOKENS = re.compile(r"\S+")


def features(text: str) -> list[float]:
    """What a text looks like, as numbers of about unit size; whole text, no language needed. Empty texts give zeros."""
    words = _TOKENS.findall(text)
    n, chars = len(words), max(len(text), 1)
    if not n:
        return [0.0] * len(NAMES)
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    letters = sum(map(len, words))
    stripped = re.sub(r"[\W\d_]+", "", text)
    upper = sum(1 for w in words if len(w) > 2 and w.isupper()) / n
    symbols = 1 - len(stripped) / max(letters, 1)
    return [
        np.log1p(n) / 8, letters / n / 10, sum(len(w) > 20 for w in words) / n, len(counts) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n, upper, symbols, len(re.findall(r"\d", text)) / chars * 5,
        sum(w[-1] in ".?!…" for w in words) / n, text.count("|") / n, len(lines) / n * 5, 1 - len(set(lines)) / max(len(lines), 1),
        len(re.findall(r"[.?!](?:\s|$)", text)) / n * 5, len(re.findall(r"[aeiouyàâäáéèêëíîïóôöúùûü]", text.lower())) / max(letters, 1), text.count("!") / n, counts.most_common(1)[0][1] / n,
    ]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Weights and intercept by Newton steps; features are standardized within, weights are for the raw ones."""
    mean, sd = x.mean(0), x.std(0) + 1e-6
    z = np.concatenate([(x - mean) / sd, np.ones((len(x), 1))], axis=1)
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p) + 1e-6)[:, None]).T @ z / len(z) + ridge * np.eye(len(w)), z.T @ (p - y) / len(z) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1] / sd, float(w[-1] - (w[:-1] * mean / sd).sum())


def train(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> tuple[np.ndarray, float, float]:
    """(weights, intercept, prior log odds) of the evidence model. With one class or no labels: zeros, so only sites count."""
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_y"))
    chosen = materialize(known.orderBy(F.xxhash64(F.lit(11), "_id"), "_id").limit(TRAINING_ROWS), "quality-sample")
    # at most TRAINING_ROWS rows
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = texts.join(F.broadcast(chosen), "_id").select("_text", "_y").mapInArrow(_features_of, "y double, f array<double>").collect()
    y = np.array([r["y"] for r in rows])
    if not len(y) or y.min() == y.max():
        return np.zeros(len(NAMES)), 0.0, 0.0
    w, b = fit_logistic(np.array([r["f"] for r in rows]), y)
    return w, b, float(np.log(y.mean() / (1 - y.mean())))


def _features_of(batches):
    for batch in batches:
        f = [features(t or "") for t in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(1).cast(pa.float64()), pa.array(f, pa.list_(pa.float64()))], ["y", "f"])


def evidence(docs: DataFrame, host: Column, path: Column, model: tuple, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, host, path, ratio): the log likelihood ratio of good against bad that the text alone gives."""
    weights, intercept, prior = model
    bounded_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            x = np.array([features(t or "") for t in batch.column(3).to_pylist()]).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.clip(x @ weights + intercept - prior, -30, 30))], ["doc_id", "host", "path", "ratio"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), host.alias("host"), path.alias("path"), F.col(text_col)).mapInArrow(run, f"doc_id {kind}, host string, path string, ratio double")


def shrunk(n: Column, good: Column, rate: Column, strength: Column) -> Column:
    return (good + rate * strength) / (n + strength)


def strength_of(groups: DataFrame, n: str, good: str, rate: str) -> float:
    """How many documents the prior weighs, from how much the groups' rates differ beyond chance (moments); between 2 and 1000."""
    p = F.col(good) / F.col(n)
    spread, chance = groups.where(F.col(n) > 0).agg(F.sum(F.col(n) * (p - F.col(rate)) ** 2), F.sum(F.col(rate) * (1 - F.col(rate)))).first()
    total, k, mean = groups.agg(F.sum(n), F.count("*"), F.avg(rate)).first()
    if not k or not total or spread is None:
        return 1000.0
    between = max((spread - chance) / total, 1e-9)
    return float(min(max(mean * (1 - mean) / between, 2.0), 1000.0))


def posteriors(scored: DataFrame, prior: float) -> tuple[DataFrame, float, float]:
    """Sums over all documents, and how many documents each prior weighs: (host, path, n, good, host_n, host_good, all_n,
    all_good), the strength of the world's rate over hosts, and of a host's over its paths.

    Every document counts with its own probability. Paths are summed first and hosts from paths, so one pass of partial
    aggregates does it, whatever the size of a host.
    """
    good = 1 / (1 + F.exp(-(F.col("ratio") + F.lit(prior))))
    paths = materialize(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(good).alias("good")), "paths")
    total, all_good = paths.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0.0))).first()
    hosts = materialize(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good")), "hosts")
    world = F.lit((all_good + 1.0) / (total + 2.0))
    by_host = strength_of(hosts.withColumn("world", world), "host_n", "host_good", "world")
    joined = paths.join(hosts.withColumnRenamed("host", "_host"), F.expr("host <=> _host")).drop("_host")
    joined = materialize(joined.withColumns({"all_n": F.lit(total), "all_good": F.lit(all_good)}), "sums")
    rated = joined.withColumn("host_rate", shrunk(F.col("host_n"), F.col("host_good"), world, F.lit(by_host)))
    return joined, by_host, strength_of(rated, "n", "good", "host_rate")


def quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.5) -> DataFrame:
    """(doc_id, host, path, evidence, host_rate, path_rate, score, kept) for each row of docs.

    score is the posterior probability of good: the text's evidence over the odds of its path. A path's rate shrinks toward
    its host's and a host's toward the world's; all three are those of the other documents, so that no evidence counts twice.
    Texts are read once; what follows moves four narrow columns. Null and empty texts count as a text of no words; null
    hosts and paths are a host and a path; repeated rows each count. Without usable labels the score is the path's rate. An
    empty table gives an empty one; columns other than those named aren't read.
    """
    model = train(docs, labels, id_col, text_col, label_col)
    scored = materialize(evidence(docs, host, path, model, id_col, text_col), "evidence")
    sums, by_host, by_path = posteriors(scored, model[2])
    sums = sums.withColumnRenamed("host", "_host").withColumnRenamed("path", "_path")
    out = scored.join(sums, F.expr("host <=> _host and path <=> _path"), "left").drop("_host", "_path")
    own = 1 / (1 + F.exp(-(F.col("ratio") + F.lit(model[2]))))
    others = lambda n, good, rate, strength: shrunk(F.col(n) - 1, F.greatest(F.col(good) - own, F.lit(0.0)), rate, F.lit(strength))
    world = (F.greatest(F.col("all_good") - own, F.lit(0.0)) + 1.0) / (F.col("all_n") + 1.0)
    out = out.withColumn("host_rate", others("host_n", "host_good", world, by_host)).withColumn("path_rate", others("n", "good", F.col("host_rate"), by_path))
    odds = F.col("ratio") + F.log(F.col("path_rate") / (1 - F.col("path_rate")))
    score = 1 / (1 + F.exp(-odds))
    return out.select("doc_id", "host", "path", F.col("ratio").alias("evidence"), "host_rate", "path_rate", score.alias("score"), (score >= threshold).alias("kept"))
