"""Toxicity by a convolutional text classifier: hashed word embeddings, filters of several widths, max pooling; numpy trains it."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, bounded_batches, materialize, portions, utf8

#: Labelled documents of each class that training reads, at most; those with the smallest seeded hash.
TRAINING_ROWS = 2500
#: Bytes of text of each class that training reads, at most (a first text that is longer comes alone).
TRAINING_BYTES = 64 << 20
#: One labelled document in so many is held back from the weights: it scales probabilities and calibrates thresholds.
HELD_BACK = 5
SLOTS, DIM = 1 << 15, 6
#: A word's vector joins those of three hashes: the whole word, and its first four and five bytes.
VIEWS = (None, 4, 5)
WIDTHS, FILTERS = (1, 2, 3), 12
THRESHOLD = 0.3


def slots(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words x views, row offsets): the embedding slot of each word under each view."""
    words = Words(data, offsets)
    return np.stack([(words.hashes(v) >> np.uint64(64 - 15)).astype(np.int32) + i * SLOTS for i, v in enumerate(VIEWS)], axis=1), words.rows


class Model:
    """Embeddings (views * SLOTS, DIM), a filter bank for each width, a linear layer, and a scale for probabilities."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        e = len(VIEWS) * DIM
        self.table = (r.normal(size=(len(VIEWS) * SLOTS, DIM)) * 0.02).astype(np.float32)
        self.banks = [(r.normal(size=(w * e, FILTERS)) / np.sqrt(w * e)).astype(np.float32) for w in WIDTHS]
        self.shifts = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.out = (r.normal(size=len(WIDTHS) * FILTERS) * 0.3).astype(np.float32)
        self.bias, self.scale, self.offset = np.float32(0), 1.0, 0.0

    def start(self, texts: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
        """Begin the first dimension of each slot at how much more often than by chance toxic texts hold it, shrunk by four
        texts' weight. Slots that fewer than two texts hold begin at zero and stay there: they can't tell anything
        but which text it is. Returns which slots two texts hold."""
        held = np.zeros((2, len(self.table)), np.int32)
        for ids, y in zip(texts, labels, strict=True):
            held[int(y), np.unique(ids)] += 1
        rate = labels.mean()
        common = held.sum(0) >= 2
        self.table[:, 0] += np.log((held[1] + 4 * rate) / ((held.sum(0) + 4) * rate)).astype(np.float32) * 0.5
        self.table[~common] = 0
        for k, w in enumerate(WIDTHS):  # half of the filters begin as detectors of such words
            for j in range(w):
                self.banks[k][[j * len(VIEWS) * DIM + i * DIM for i in range(len(VIEWS))], : FILTERS // 2] = 0.7 / w
        self.out[:] = np.abs(self.out) * np.tile([*[1.0] * (FILTERS // 2), *[0.3] * (FILTERS - FILTERS // 2)], len(WIDTHS)).astype(np.float32)
        return common

    def pooled(self, ids: np.ndarray, rows: np.ndarray, where: bool = False):
        """The largest answer of each filter over each text's words (0 without words), and on request where it is."""
        n, widest = len(rows) - 1, max(WIDTHS)
        # widest - 1 empty words follow each text, so that no window reaches into the next one
        place = np.arange(len(ids)) + np.repeat(np.arange(n) * (widest - 1), np.diff(rows))
        x = np.zeros((len(ids) + n * (widest - 1) + widest, len(VIEWS) * DIM), np.float32)
        x[place] = self.table[ids].reshape(len(ids), len(VIEWS) * DIM)
        first = rows[:-1] + np.arange(n) * (widest - 1)
        top = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        at = np.zeros(top.shape, np.int64)
        full = np.flatnonzero(np.diff(rows) > 0)
        length = len(x) - widest
        for k, w in enumerate(WIDTHS):
            e = x.shape[1]
            y = x[:length] @ self.banks[k][:e]
            for j in range(1, w):
                y += x[j : length + j] @ self.banks[k][j * e : (j + 1) * e]
            y += self.shifts[k]
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            if len(full):
                edges = np.stack([first[full], first[full] + np.diff(rows)[full]], 1)
                if where:
                    for i, (a, b) in zip(full, edges):
                        at[i, cols] = a + y[a:b].argmax(0)
                        top[i, cols] = y[at[i, cols], np.arange(FILTERS)]
                else:
                    top[full, cols] = np.maximum.reduceat(y, edges.ravel()[: 2 * len(full)], axis=0)[::2]
        return (np.maximum(top, 0), top, at, x, place) if where else np.maximum(top, 0)

    def logits(self, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return self.pooled(ids, rows) @ self.out + self.bias

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        raw = self.scale * self.logits(*slots(data, offsets)).astype(np.float64) + self.offset
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def fit(texts: list[str], labels: np.ndarray, odds: float, back: np.ndarray | None = None, seed: int = 5, epochs: int = 6, least_steps: int = 900) -> Model:
    """Train on whole texts with Adam; those marked in `back` (a random fifth where it is None) turn logits into probabilities.
    odds: log of the toxic rate of all labelled documents over the sample's. With one class only, the rate itself is the score."""
    model, r = Model(seed), np.random.default_rng(seed)
    if not len(labels) or labels.min() == labels.max():
        model.out[:] = 0
        model.offset = -30.0 if not len(labels) or labels.max() == 0 else 30.0
        return model
    data = [slots(*utf8(pa.array([t]))) for t in texts]
    order = r.permutation(len(texts))
    back = np.arange(len(order)) < len(order) // HELD_BACK if back is None else back[order]
    held, own = order[back], order[~back]
    if min(map(len, (np.unique(labels[held]), np.unique(labels[own])))) < 2:  # too few to hold any back
        held = own = order
    common = model.start([data[i][0] for i in own], labels[own])
    dense = [*model.banks, *model.shifts, model.out]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in dense]
    m_table, v_table = np.zeros_like(model.table), np.zeros_like(model.table)
    m_bias = v_bias = 0.0
    e, step = len(VIEWS) * DIM, 0
    best = None
    epochs = max(epochs, -(-least_steps // -(-max(len(own), 1) // 32)))
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.001
        own = r.permutation(own)
        for at in range(0, len(own), 32):
            step += 1
            some = own[at : at + 32]
            ids = np.concatenate([data[i][0] for i in some])
            rows = np.concatenate([[0], np.cumsum([len(data[i][0]) for i in some])])
            keep = r.random(len(ids)) > 0.1  # some words are left out, so that no single one carries a label
            kept_rows = np.concatenate([[0], np.cumsum(keep)])[rows]
            ids, rows = ids[keep], kept_rows
            hidden, top, where, x, place = model.pooled(ids, rows, True)
            g = (1 / (1 + np.exp(-np.clip(hidden @ model.out + model.bias, -30, 30))) - labels[some]).astype(np.float32) / len(some)
            g_out, g_bias = hidden.T @ g, float(g.sum())
            g_top = g[:, None] * model.out * (top > 0)
            back = np.full(len(x), -1, np.int64)
            back[place] = np.arange(len(ids))
            g_banks, g_shifts = [], []
            g_table = {}
            touched, pushed = [], []
            for k, w in enumerate(WIDTHS):
                cols = slice(k * FILTERS, (k + 1) * FILTERS)
                gk, pk = g_top[:, cols], where[:, cols]
                bank = np.zeros_like(model.banks[k])
                for j in range(w):
                    part = x[pk + j]
                    bank[j * e : (j + 1) * e] = np.einsum("nf,nfe->ef", gk, part)
                    touched.append(back[pk + j].ravel())
                    pushed.append((gk[:, :, None] * model.banks[k][j * e : (j + 1) * e].T[None]).reshape(-1, e))
                g_banks.append(bank + 1e-5 * model.banks[k]), g_shifts.append(gk.sum(0))
            touched, pushed = np.concatenate(touched), np.concatenate(pushed)
            real = (touched >= 0) & (np.abs(pushed).sum(1) > 0)
            used = ids[touched[real]].ravel()
            slot, inverse = np.unique(used, return_inverse=True)
            g_table = np.zeros((len(slot), DIM), np.float32)
            np.add.at(g_table, inverse.ravel(), pushed[real].reshape(-1, DIM))
            for p, gp, (m, v) in zip(dense, [*g_banks, *g_shifts, g_out], moments, strict=True):
                m += 0.1 * (gp - m)
                v += 0.001 * (gp * gp - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            m_bias += 0.1 * (g_bias - m_bias)
            v_bias += 0.001 * (g_bias**2 - v_bias)
            model.bias -= np.float32(rate * m_bias / (1 - 0.9**step) / (np.sqrt(v_bias / (1 - 0.999**step)) + 1e-8))
            g_table[~common[slot]] = 0
            m_table[slot] += 0.1 * (g_table - m_table[slot])
            v_table[slot] += 0.01 * (g_table**2 - v_table[slot])
            model.table[slot] -= rate * m_table[slot] / (np.sqrt(v_table[slot]) + 1e-6)
        z = np.array([model.logits(*data[i])[0] for i in held], np.float64)
        loss = float(np.logaddexp(0, np.where(labels[held] > 0, -z, z)).mean())
        if best is None or loss < best[0]:
            best = (loss, z, model.table.copy(), [p.copy() for p in dense], model.bias)
        elif loss > 3 * best[0] + 0.1:
            break
    _, z, model.table, kept, model.bias = best
    model.banks, model.shifts, model.out = kept[: len(WIDTHS)], kept[len(WIDTHS) : 2 * len(WIDTHS)], kept[-1]
    y = labels[held].astype(np.float64)
    a, b = 1.0, 0.0
    for _ in range(200):  # the scale and offset of the probabilities, by damped Newton steps toward 1 and 0
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g = np.array([((p - y) * z).mean() + 0.02 * (a - 1), (p - y).mean() + 0.005 * b])
        s = p * (1 - p) + 1e-3
        h = np.array([[(s * z * z).mean() + 0.02, (s * z).mean()], [(s * z).mean(), s.mean() + 0.005]])
        d = np.linalg.solve(h, g)
        a, b = a - 0.5 * d[0], b - 0.5 * d[1]
    model.scale, model.offset = float(min(max(a, 0.05), 5.0)), float(b + odds)
    return model


def known_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", seed: int = 5) -> DataFrame:
    """(_id, _y, _back) of usable labels: null ids and labels other than 0 and 1 are left out, the largest of repeated ones counts.
    _back: the document is held back from the weights, by a seeded hash of its id."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_y"))
    return known.withColumn("_back", F.pmod(F.xxhash64(F.lit(seed), F.lit("back"), "_id"), F.lit(HELD_BACK)) == 0)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", seed: int = 5) -> Model:
    """Fit on up to TRAINING_ROWS documents of each class, of up to TRAINING_BYTES. How frequent each class is comes from all
    labels. Of rows that repeat an id the least text counts; null texts are left out; without usable labels all score 0."""
    known = materialize(known_labels(labels, id_col, label_col, seed), "toxic-labels")
    n, toxic = known.agg(F.count("*"), F.coalesce(F.sum("_y"), F.lit(0))).first()
    order = F.xxhash64(F.lit(seed), "_id")
    few = lambda y: known.where(F.col("_y") == y).orderBy(order, "_id").limit(TRAINING_ROWS)
    chosen = materialize(few(0).union(few(1)), "toxic-sample")
    # at most 2 * TRAINING_ROWS ids; the texts found for them are written before their bytes are counted
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    texts = materialize(texts.groupBy("_id", "_y", "_back").agg(F.min("_text").alias("_text")), "toxic-texts")
    so_far = F.sum(F.octet_length("_text")).over(Window.partitionBy("_y").orderBy(order, "_id"))
    fits = texts.withColumn("_sum", so_far).where((F.col("_sum") <= TRAINING_BYTES) | (F.col("_sum") == F.octet_length("_text")))
    rows = sorted(fits.select("_id", "_text", "_y", "_back").collect(), key=lambda r: str(r["_id"]))
    y = np.array([r["_y"] for r in rows], np.float32)
    own = min(max(float(y.mean()) if len(y) else 0.5, 1e-6), 1 - 1e-6)
    rate = min(max(toxic / n if n else 0.5, 1e-6), 1 - 1e-6)
    back = np.array([r["_back"] for r in rows], bool)
    return fit([r["_text"] for r in rows], y, float(np.log(rate / (1 - rate)) - np.log(own / (1 - own))), back, seed)


def scored(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "_score") -> DataFrame:
    """docs with score_col (a name that docs doesn't have), from the whole text alone, where it is read.

    Null and empty texts score as a text of no words, repeated rows alike; an empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    # the model's size is fixed: SLOTS, DIM and FILTERS bound it
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    at = names.index(text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + f", `{score_col}` double"

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            out = [shared.value.scores(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in portions(offsets, 1 << 19)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate([np.zeros(0), *out]))], [*names, score_col])

    return docs.mapInArrow(run, schema)


def thresholds(scores: DataFrame, labels: DataFrame, label_col: str = "toxic", seed: int = 5) -> DataFrame:
    """scores (doc_id, lang, score), labels -> (_lang, _threshold), calibrated on the labelled documents held back from the
    weights. Only these narrow columns are joined and dealt out. Languages without such documents have no row."""
    back = known_labels(labels, "doc_id", label_col, seed).where("_back")
    seen = scores.join(back, F.col("doc_id") == F.col("_id")).select("lang", "score", F.col("_y").alias("toxic"))
    return materialize(language_thresholds(seen), "thresholds").select(F.col("lang").alias("_lang"), F.col("threshold").alias("_threshold"))


def language_thresholds(scores: DataFrame, start: float = THRESHOLD, prior: float = 20.0) -> DataFrame:
    """scores (lang, score, toxic) of labelled documents -> (lang, threshold): for each language the cut with the best F1 on a
    grid, drawn toward `start` where a language has few labels. Sums over (language, step of the grid), so as many rows
    as languages times steps ever meet."""
    step = F.least(F.floor(F.col("score") * 50), F.lit(49)).cast("int")
    grid = scores.groupBy("lang", step.alias("step")).agg(F.sum("toxic").alias("pos"), F.count("*").alias("n"))
    steps = F.explode(F.sequence(F.lit(1), F.lit(49))).alias("cut")
    by_cut = grid.select("*", steps).groupBy("lang", "cut").agg(F.sum(F.when(F.col("step") >= F.col("cut"), F.col("pos")).otherwise(0)).alias("tp"), F.sum(F.when(F.col("step") >= F.col("cut"), F.col("n")).otherwise(0)).alias("called"), F.sum("pos").alias("pos"))
    f1 = 2 * F.col("tp") / F.greatest(F.col("called") + F.col("pos"), F.lit(1))
    near = -F.abs(F.col("cut") / 50.0 - F.lit(start))
    best = by_cut.groupBy("lang").agg(F.max(F.struct(f1.alias("f1"), near.alias("near"), F.col("cut"), F.col("pos"))).alias("b"))
    return best.select("lang", ((F.col("b.cut") / 50.0 * F.col("b.pos") + F.lit(start * prior)) / (F.col("b.pos") + prior)).alias("threshold"))
