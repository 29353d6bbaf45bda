"""MinHash near-dedup with SetSketch registers over word shingles.

A register holds the truncated exponent of the smallest of a set's exponentially distributed hash values, so sketches of
unions are register-wise maxima, and equal registers are as likely as the sets are alike. Bands of registers give
candidates, the likelihood of how two sketches compare estimates their similarity, and full sets confirm each link.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Words, bounded_batches, materialize, mix64, portions, unused, utf8
from .components import connected_components

BANDS, ROWS = 30, 6
BASE, RATE, TOP = 1.08, 20.0, 255  # registers lie on a scale of powers of BASE, from 0 to TOP
#: How far below the threshold an estimate may lie: over five standard errors of this many registers.
SLACK = 0.16
#: Bands in which rows also meet a second hub, drawn anew for each bucket.
EXTRA = (0, 8, 15, 23)
#: Rows of a bucket whose sketches one task compares with as many others, and bytes of full sets likewise.
BLOCK, BLOCK_BYTES = 1024, 16 << 20
_SEEDS = mix64(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int):
    """For each text: (its words' hashes, its sorted distinct shingle hashes). Fewer than k words make one shingle."""
    words = Words(data, offsets)
    h = words.hashes()
    for a, b in zip(words.rows[:-1].tolist(), words.rows[1:].tolist(), strict=True):
        w = h[a:b]
        if not len(w):
            yield w, w
        elif len(w) < k:
            yield w, mix64(np.array([hash_sequence(w)], np.uint64))
        else:
            s = np.zeros(len(w) - k + 1, np.uint64)
            for i in range(k):
                s = mix64(s + w[i : len(w) - k + 1 + i] + np.uint64(i + 1))
            yield w, np.unique(s)


def node_of(w: np.ndarray) -> bytes:
    """The digest of a word sequence, by its words' hashes."""
    return hashlib.blake2b(w.tobytes(), digest_size=16).digest()


def hash_sequence(w: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(w.tobytes(), digest_size=8).digest(), "little")


def registers(shingles: np.ndarray) -> np.ndarray:
    """The sketch of a non-empty set of 64-bit hashes, a byte a register."""
    m = BANDS * ROWS
    least = np.full(m, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 256):
        each = shingles[at : at + 256, None] * (_SEEDS[:m] | np.uint64(1)) + _SEEDS[m:]
        np.minimum(least, each.min(axis=0), out=least)
    x = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(np.maximum(x, 1e-300)) / np.log(BASE)), 0, TOP).astype(np.uint8)


def likely_jaccard(u: np.ndarray, v: np.ndarray, n_u: np.ndarray, n_v: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of pairs from how many registers of u are above, below and equal to those of v,
    given the sizes of the sets. u, v: pairs x registers."""
    up, down = (u > v).sum(1), (u < v).sum(1)
    same = u.shape[1] - up - down
    a, b = n_u / (n_u + n_v), n_v / (n_u + n_v)
    best, found = np.full(len(u), -np.inf), np.zeros(len(u))
    above = lambda x: np.clip(-np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE), 1e-12, 1)
    for j in np.linspace(0, 1, 101):
        fit = j <= np.minimum(a / b, b / a) + 1e-9
        p, q = above(np.clip(a - b * j, 0, 1)), above(np.clip(b - a * j, 0, 1))
        likely = np.where(fit, up * np.log(p) + down * np.log(q) + same * np.log(np.clip(1 - p - q, 1e-12, 1)), -np.inf)
        found, best = np.where(likely > best, j, found), np.maximum(likely, best)
    return found


def bytes_of(bands) -> np.ndarray:
    """The registers, rows x (BANDS * ROWS), from a column of bands."""
    wide = bands.flatten().to_numpy(zero_copy_only=False).reshape(len(bands), BANDS, 1)
    return (wide >> (8 * np.arange(ROWS)) & 255).astype(np.uint8).reshape(len(bands), -1)


def sketched(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(doc_id, node, n_shingles, bands): node is a 128-bit digest of the word sequence, null where there are no words;
    bands are the sketch's registers, ROWS to a long under the band's number."""

    def sketch(batches):
        for batch in batches:
            node, size, bands = [], [], []
            data, offsets = utf8(batch.column(1))
            for i, j in portions(offsets):
                for w, s in shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k):
                    size.append(len(s))
                    node.append(node_of(w) if len(w) else None)
                    bands.append((registers(s).reshape(BANDS, ROWS).astype(np.int64) @ (256 ** np.arange(ROWS)) + (np.arange(BANDS) << 8 * ROWS)).tolist() if len(w) else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(node, pa.binary()), pa.array(size, pa.int64()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "node", "n_shingles", "bands"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(sketch, f"doc_id {kind}, node binary, n_shingles long, bands array<long>")


def shingles_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(node, shingles): full sets of the wanted nodes (node, doc_id), from one text each.

    Texts are dealt out by id whatever the number of nodes: one plan for all sizes.
    """

    def sets(batches):
        for batch in batches:
            keep, out = [], []
            data, offsets = utf8(batch.column(1))
            asked = batch.column(0).to_pylist()
            for i, j in portions(offsets):
                for r, (w, s) in enumerate(shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], k), i):
                    if node_of(w) == asked[r]:
                        keep.append(asked[r]), out.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(keep, pa.binary()), pa.array(out, pa.binary())], ["node", "shingles"])

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(wanted.select("doc_id", "node").hint("merge"), "doc_id").select("node", "text")
    found = materialize(texts.mapInArrow(sets, "node binary, shingles binary"), "sets")
    # only repeated rows give a node twice; the check reads digests alone, and sets are dealt out anew only where it finds some
    return found if found.groupBy("node").count().where("count > 1").isEmpty() else materialize(found.dropDuplicates(["node"]), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) with 100 * intersection >= percent * union on full sets."""

    def compare(batches):
        for batch in batches:
            ok = []
            for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    one = lambda c: sets.select(F.col("node").alias(c), F.col("shingles").alias(f"{c}_set"))
    both = pairs.join(one("v"), "v").join(one("u"), "u").select("u", "v", "u_set", "v_set")
    return both.mapInArrow(compare, "u binary, v binary")


def likely(pairs: DataFrame, nodes: DataFrame, percent: int, slack: float = SLACK) -> DataFrame:
    """The pairs whose sizes allow the similarity and whose sketches make it likely; SLACK is over five standard errors."""

    def estimate(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            u, v = (bytes_of(batch.column(c)) for c in (2, 3))
            n_u, n_v = (batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in (4, 5))
            yield batch.select([0, 1]).filter(pa.array(likely_jaccard(u, v, n_u, n_v) >= percent / 100 - slack))

    one = lambda c: nodes.select(F.col("node").alias(c), F.col("bands").alias(f"{c}_bands"), F.col("n_shingles").alias(f"{c}_n"))
    both = pairs.join(one("v"), "v").join(one("u"), "u").where(F.least("u_n", "v_n") * 100 >= F.greatest("u_n", "v_n") * percent)
    return both.select("u", "v", "u_bands", "v_bands", "u_n", "v_n").mapInArrow(estimate, "u binary, v binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs.

    Links join texts whose sets of distinct k-word shingles have 100 * intersection >= percent * union. Equal word
    sequences are one node, so groups of copies cost one sketch row in the joins. In a bucket of equal bands every
    node meets the node of the smallest digest, and in a few bands a second hub; after components of those links,
    buckets that still hold several are settled (see settled), so no link between components is left out and no group is
    expanded into all pairs.

    Null and empty texts, and those without words: n_shingles 0, linked with nothing. Rows with a null id get a null
    component_id and kept true, and link nothing. Repeated rows get equal results. An empty table gives an empty one.
    """
    bounded_batches(docs.sparkSession)
    rows = materialize(sketched(docs, id_col, text_col, k), "sketches")
    filled = rows.where("node is not null and doc_id is not null")
    nodes = materialize(filled.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands")), "nodes")
    banded = nodes.select("node", F.explode("bands").alias("band"))
    hubs = banded.groupBy("band").agg(F.min("node").alias("u"), F.min_by("node", F.xxhash64("node", "band")).alias("w"), F.count("*").alias("n")).where("n > 1")
    extra = F.shiftright("band", 8 * ROWS).isin(*EXTRA)
    hubs = materialize(hubs.select("band", "u", F.when(extra, F.col("w")).alias("w")), "hubs")
    shared = materialize(banded.join(hubs, "band").select("band", "node", "u", "w"), "shared")
    wanted = materialize(nodes.select("node", "doc_id").join(shared.select("node").distinct(), "node"), "wanted")
    sets = shingles_of(docs, wanted, id_col, text_col, k)

    to_first = shared.where("node <> u").select("u", F.col("node").alias("v"))
    links = materialize(confirmed(materialize(likely(to_first.distinct(), nodes, percent), "likely"), sets, percent), "confirmed")
    labels = nodes.select("node").join(connected_components(links), "node", "left")
    labels = materialize(labels.select("node", F.coalesce("root", "node").alias("root")), "labels")
    to_second = shared.where("w is not null and w <> u and w <> node and node <> u").select("w", "node").distinct()
    root = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    apart = to_second.withColumnsRenamed({"w": "u", "node": "v"}).join(root("u"), "u").join(root("v"), "v").where("u_root <> v_root").select("u", "v")
    links = materialize(confirmed(materialize(likely(apart, nodes, percent), "likely"), sets, percent), "confirmed")
    labels = united(labels, links)
    links = materialize(settled(shared.select("band", "node"), labels, nodes, sets, percent), "settled")
    labels = united(labels, links)

    reach = nodes.select("node", "doc_id").join(labels, "node")
    lowest = materialize(reach.groupBy("root").agg(F.min("doc_id").alias("component_id")), "lowest")
    by_node = materialize(reach.join(lowest, "root").select("node", "component_id"), "by-node")
    out = rows.select("doc_id", "node", "n_shingles").join(by_node, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def united(labels: DataFrame, links: DataFrame) -> DataFrame:
    """labels (node, root) after links (u, v): components of the roots that they join, and the labels renamed."""
    if links.isEmpty():
        return labels
    root = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
    between = links.join(root("u"), "u").join(root("v"), "v").select("u_root", "v_root")
    moved = connected_components(between, "u_root", "v_root").select(F.col("node").alias("root"), F.col("root").alias("to"))
    return materialize(labels.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "labels")


def dealt(rows: DataFrame, weight: Column, most: int) -> DataFrame:
    """rows (band, node, minor) -> with own, a, b: every pair of blocks (a, b) of a bucket that holds a minor row meets once.

    Minor rows are those outside a bucket's largest component. Blocks weigh about `most`, minor ones before the others; rows of
    the largest component go to each minor block once, and none of its own rows meet each other.
    """
    sums = rows.groupBy("band").agg(*(F.ceil(F.sum(F.when(F.col("minor") == m, weight).otherwise(0)) / most).cast("int").alias(c) for c, m in (("minors", True), ("majors", False))))
    blocks = F.when(F.col("minor"), F.col("minors")).otherwise(F.col("majors"))
    own = (F.pmod(F.xxhash64("node"), blocks) + F.when(F.col("minor"), 0).otherwise(F.col("minors"))).cast("int")
    last = F.col("minors") + F.when(F.col("minor"), F.col("majors")).otherwise(0) - 1
    each = rows.join(sums, "band").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    return each.withColumns({"a": F.least("own", "other"), "b": F.greatest("own", "other")}).drop("other", "minors", "majors")


def settled(shared: DataFrame, labels: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that connect what is still apart in buckets of several components: shared (band, node).

    Only pairs with a row outside the bucket's largest component can add anything, so that component's rows are dealt out
    once for each block of the others, which are few where hubs have linked most. Within a task rows meet by their
    registers, each pair in the first bucket that it shares; rows likely to link with none drop out before full sets are dealt
    out, in blocks of bounded bytes; those decide, for pairs not connected yet. No pair leaves a task but as a link.
    """
    above = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    want = percent / 100

    placed = materialize(shared.join(labels, "node").select("band", "node", "root"), "placed")
    parts = placed.groupBy("band", "root").agg(F.count("*").alias("n"))
    # a bucket of two nodes has its one pair decided: either is the other's hub
    mixed = parts.groupBy("band").agg(F.max_by("root", F.struct("n", "root")).alias("largest"), F.count("*").alias("parts"), F.sum("n").alias("n")).where("parts > 1 and n > 2")
    mixed = materialize(mixed.select("band", "largest"), "mixed")
    rest = placed.join(mixed, "band").select("band", "node", "root", (F.col("root") != F.col("largest")).alias("minor"))
    rest = materialize(rest.join(nodes.select("node", "bands", "n_shingles"), "node"), "rest")

    def partners(table: pa.Table):
        """The rows of block a, and for each of them: those of block b, of other components, that may link with it,
        the likeliest first."""
        band, a, b = (table.column(c)[0].as_py() for c in ("band", "a", "b"))
        column = table.column("bands").combine_chunks()
        regs, bands = bytes_of(column), column.flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)
        own, size = table.column("own").to_numpy(), table.column("n_shingles").to_numpy().astype(float)
        at = int(band) >> 8 * ROWS
        index: dict[bytes, int] = {}
        group = np.array([index.setdefault(r, len(index)) for r in table.column("root").to_pylist()])
        there = np.flatnonzero(own == b)

        def of(i: int) -> np.ndarray:
            j = there if a != b else there[there > i]
            j = j[(group[j] != group[i]) & (np.minimum(size[j], size[i]) >= want * np.maximum(size[j], size[i]) - 1e-9)]
            j = j[~(bands[j, :at] == bands[i, :at]).any(1)] if len(j) else j
            if not len(j):
                return j
            x, y = size[i] / (size[i] + size[j]), size[j] / (size[i] + size[j])
            least = 1 - above(x - y * want) - above(y - x * want) - SLACK
            same = (regs[j] == regs[i]).mean(1)
            j, same = j[same >= least], same[same >= least]
            return j[np.argsort(-same, kind="stable")]

        return np.flatnonzero(own == a).tolist(), group, of

    def hopeful(table: pa.Table) -> pa.Table:
        here, _, of = partners(table)
        hit = np.zeros(table.num_rows, bool)
        for i in here:
            j = of(i)
            hit[j] = True
            hit[i] |= len(j) > 0
        return table.select(["band", "node", "root", "minor"]).filter(pa.array(hit))

    def settle(table: pa.Table) -> pa.Table:
        table = table.sort_by("node").combine_chunks()
        names, full = table.column("node").to_pylist(), table.column("shingles")
        here, group, of = partners(table)
        u, v = [], []
        for i in here:
            mine = None
            for o in of(i).tolist():
                if group[o] != group[i]:
                    mine = np.frombuffer(full[i].as_buffer(), np.uint64) if mine is None else mine
                    other = np.frombuffer(full[o].as_buffer(), np.uint64)
                    both = len(np.intersect1d(mine, other, assume_unique=True))
                    if 100 * both >= percent * (len(mine) + len(other) - both):
                        u.append(names[i]), v.append(names[o])
                        group[group == group[o]] = group[i]
        return pa.table({"u": pa.array(u, pa.binary()), "v": pa.array(v, pa.binary())})

    near = dealt(rest, F.lit(1), BLOCK).groupBy("band", "a", "b").applyInArrow(hopeful, "band long, node binary, root binary, minor boolean")
    near = materialize(near.distinct(), "hopeful")
    full = nodes.select("node", "bands", "n_shingles").join(sets, "node")
    met = dealt(near.join(nodes.select("node", "n_shingles"), "node"), F.col("n_shingles") * 8, BLOCK_BYTES).drop("n_shingles")
    return met.join(full, "node").groupBy("band", "a", "b").applyInArrow(settle, "u binary, v binary")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """docs without all but one document of each group: that of the smallest id stays.

    Rows without words or without an id stay; of rows with equal id and text one stays, null counting as a text of its own.
    An empty table gives an empty one. Texts are dealt out once, by id, at every size.
    """
    found = near_duplicates(docs, id_col, text_col, k, percent).where("doc_id is not null")
    key, kept, n = unused(docs, "id", "kept", "n")
    by_id = found.groupBy(F.col("doc_id").alias(key)).agg(F.max("kept").alias(kept), F.count("*").alias(n))
    by_id = materialize(by_id, "by-id")
    named = docs.where(F.col(id_col).isNotNull())
    marked = named.join(by_id.where(f"not {kept} or {n} > 1").hint("merge"), F.col(id_col) == F.col(key), "left").where(F.coalesce(kept, F.lit(True)))
    if by_id.where(f"{n} > 1").isEmpty():
        stay = marked.select(*docs.columns)
    else:
        marked = materialize(marked, "marked")
        stay = marked.where(f"{n} is null").union(marked.where(f"{n} > 1").dropDuplicates([id_col, text_col])).select(*docs.columns)
    return stay.union(docs.where(F.col(id_col).isNull()))
