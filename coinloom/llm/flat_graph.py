"""Embedding near-dedup by exact comparison of all vectors that can be in range.

Each vector has a home: a block of the vectors whose nearest centre is the same, or one of a few. It visits the other blocks
in which a vector within range of it can live, by a bound that no pair escapes, and is compared there with each vector by
matrix products; double-precision cosines decide what is close to the threshold. No neighbours are capped and no pair is left
to chance; where the bound excludes nothing (directions without clusters), that is each pair of the table once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize
from .components import connected_components

#: Vectors a centre, and centres at most; these are a bounded sample of the rows, by seeded hash.
SHARD, MAX_CENTRES = 800, 4096
#: Vectors in a block, about: centres with more are dealt into several blocks, those with fewer share one.
BLOCK = 6000
#: Rows that meet a block at a time, and the width around the threshold in which single precision doesn't decide.
PORTION, DOUBT = 1024, 1e-4
#: Queries in a block of the audit.
QUERIES = 6000


def unit(flat: np.ndarray, n: int) -> np.ndarray:
    """Unit vectors in double precision; the largest component comes to one first, so that no square over- or underflows."""
    x = flat.reshape(n, -1).astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def blocks_of(sizes: dict[int, int], dims: dict[int, int]) -> dict[int, tuple[int, int]]:
    """The blocks of each centre as (first, number), from its vectors and their length. A block holds vectors of one length."""
    out, block, room, last = {}, -1, 0, None
    for c in sorted(sizes, key=lambda c: (dims[c], c)):
        many = -(-sizes[c] // BLOCK)
        if many > 1 or sizes[c] > room or dims[c] != last:
            out[c] = (block + 1, many)
            block, room = block + many, (BLOCK - sizes[c] if many == 1 else 0)
        else:
            out[c], room = (block, 1), room - sizes[c]
        last = dims[c]
    return out


def placed(nodes: DataFrame, shard: int, threshold: float) -> tuple[DataFrame, int]:
    """((block, visits, node, weight, vec), number of blocks): each vector at home (visits = 0) and where it visits (1).

    Let v have the nearest centre c, and u the nearest centre d. If their cosine is at least threshold, |v - u| is at most
    r = sqrt(2 - 2 threshold), and u (c - d) <= 0, so v (c - d) <= r |c - d|: v visits where that holds, and misses nothing. Of
    two blocks one visits the other, by turns, so each pair meets in one block and all get equally many visits.
    """
    spark = nodes.sparkSession
    n, kind = nodes.count(), nodes.schema["vec"].dataType.simpleString()
    sample = nodes.orderBy(F.xxhash64(F.lit(3), "node")).limit(min(MAX_CENTRES, max(1, -(-n // shard)))).select("vec").collect()
    by_size: dict[int, list] = {}
    for i, r in enumerate(sample):  # at most MAX_CENTRES vectors
        by_size.setdefault(len(r["vec"]), []).append((i, r["vec"]))
    centres = spark.sparkContext.broadcast({d: (np.array([i for i, _ in c]), unit(np.array([v for _, v in c], np.float64).ravel(), len(c))) for d, c in by_size.items()})

    def portions(batch: pa.RecordBatch, columns: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray | None, np.ndarray | None, np.ndarray]]:
        """Rows of one length, ids and vectors of its centres (none: the length has none), and unit vectors."""
        length = batch.column(columns - 1).value_lengths().to_numpy()
        for d in np.unique(length).tolist():
            some = np.flatnonzero(length == d)
            for i in range(0, len(some), PORTION):
                part = batch.take(pa.array(some[i : i + PORTION]))
                yield part, *centres.value.get(d, (None, None)), matrix(part, columns - 1)

    def assign(batches):
        for batch in batches:
            for part, ids, c, x in portions(batch, 3):
                cell = np.full(len(x), -x.shape[1]) if c is None else ids[(x @ c.T).argmax(1)]
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array(np.full(len(x), x.shape[1]), pa.int64()), *part.columns], ["cell", "dim", "node", "weight", "vec"])

    assigned = materialize(nodes.select("node", "weight", "vec").mapInArrow(assign, f"cell long, dim long, node long, weight long, vec {kind}"), "assigned")
    counted = assigned.groupBy("cell").agg(F.count("*").alias("n"), F.first("dim").alias("dim")).collect()  # a row for each centre
    blocks = blocks_of({r["cell"]: r["n"] for r in counted}, {r["cell"]: r["dim"] for r in counted})
    total = max((first + many for first, many in blocks.values()), default=1)
    where = spark.sparkContext.broadcast(blocks)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))

    def visit(batches):
        for batch in batches:
            for part, ids, c, x in portions(batch, 4):
                cell, node = part.column(0).to_numpy(), part.column(1).to_numpy()
                first, many = np.array([where.value[k] for k in cell.tolist()]).T
                home = first + node % many
                near = np.zeros((len(x), total), bool)
                if c is None:
                    cells, can = cell[:1], np.ones((len(x), 1), bool)
                else:
                    filled = np.array([k for k in range(len(ids)) if int(ids[k]) in where.value])
                    own, c = c[np.searchsorted(ids, cell)], c[filled]
                    cells, score = ids[filled], x @ c.T
                    apart = np.sqrt(np.maximum(2 - 2 * own @ c.T, 0))
                    can = np.einsum("ij,ij->i", x, own)[:, None] - score <= reach * apart + 1e-6
                for k, cell_id in enumerate(cells.tolist()):
                    at, count = where.value[cell_id]
                    near[:, at : at + count] |= can[:, k, None]
                turn = (home[:, None] - np.arange(total)) % total
                near &= (turn > 0) & ((2 * turn < total) | ((2 * turn == total) & (home[:, None] > np.arange(total))))
                near[np.arange(len(x)), home] = True
                out = [np.flatnonzero(r) for r in near]
                yield pa.RecordBatch.from_arrays([pa.array([o.tolist() for o in out], pa.list_(pa.int32())), pa.array(home, pa.int32()), *part.columns[1:]], ["blocks", "home", "node", "weight", "vec"])

    each = assigned.select("cell", "node", "weight", "vec").mapInArrow(visit, f"blocks array<int>, home int, node long, weight long, vec {kind}")
    each = each.select(F.explode("blocks").alias("block"), "home", "node", "weight", "vec")
    return each.select("block", (F.col("block") != F.col("home")).cast("int").alias("visits"), "node", "weight", "vec"), total


def matrix(table: pa.Table | pa.RecordBatch, name: str | int = "vec") -> np.ndarray:
    return unit(table.column(name).flatten().to_numpy(zero_copy_only=False), table.num_rows)


class Block:
    """Vectors at home in a block: what they link with so far, and the smallest position that links reach (label)."""

    def __init__(self, parts: list[pa.RecordBatch], threshold: float):
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        self.node, self.weight = (rows.column(c).to_numpy() for c in ("node", "weight"))
        self.x, self.threshold = matrix(rows), threshold
        self.f = self.x.astype(np.float32)
        self.label = np.arange(len(self.x))
        self.links = np.zeros(len(self.x))
        for i in range(0, len(self.x), PORTION):
            own = np.arange(i, min(i + PORTION, len(self.x)))
            hits = self.hits(self.x[own])
            hits[own - i, own] = True
            self.unite(hits)
            hits[own - i, own] = False
            self.links[own] += hits @ self.weight.astype(np.float64)

    def hits(self, x: np.ndarray) -> np.ndarray:
        """Which rows of x reach which vectors of the block: by single precision, in doubt by double."""
        s = x.astype(np.float32) @ self.f.T
        hits = s >= self.threshold + DOUBT
        row, col = np.nonzero((s >= self.threshold - DOUBT) & ~hits)
        for i in range(0, len(row), 65536):
            r, c = row[i : i + 65536], col[i : i + 65536]
            hits[r, c] = np.einsum("ij,ij->i", x[r], self.x[c]) >= self.threshold
        return hits

    def unite(self, hits: np.ndarray) -> None:
        """Join the vectors that a row reaches, by repeated minima."""
        col, none = np.flatnonzero(hits.any(0)), len(self.label)
        hits = hits[hits.any(1)][:, col]
        while len(col):
            old, label = self.label, self.label.copy()
            low = np.where(hits, label[col], none).min(1)
            low = np.where(hits, low[:, None], none).min(0)
            np.minimum.at(label, old[col], low)
            np.minimum.at(label, col, low)
            while (label[label] != label).any():
                label = label[label]
            self.label = label
            if (old == label).all():
                break

    def meet(self, rows: pa.RecordBatch) -> pa.RecordBatch:
        """(node, links, root) of the visiting rows that reach a vector; those of the block are kept for the end."""
        node, weight = (rows.column(c).to_numpy() for c in ("node", "weight"))
        x = matrix(rows)
        out = []
        for i in range(0, len(x), PORTION):
            hits = self.hits(x[i : i + PORTION])
            self.unite(hits)
            some = np.flatnonzero(hits.any(1))
            hits = hits[some]
            self.links += weight[i + some].astype(np.float64) @ hits
            out.append((node[i + some], hits @ self.weight.astype(np.float64), self.node[self.label[hits.argmax(1)]] if len(some) else node[:0]))
        return found_rows(*(np.concatenate(c) for c in zip(*out, strict=True)))

    def own(self) -> pa.RecordBatch:
        some = self.links > 0
        return found_rows(self.node[some], self.links[some], self.node[self.label[some]])


def found_rows(node: np.ndarray, links: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(np.round(links).astype(np.int64)), pa.array(root, pa.int64())], ["node", "links", "root"])


def searched(rows: DataFrame, blocks: int, threshold: float) -> DataFrame:
    """(node, links, root) for each block: what each vector links with there, and a vector of its local component.

    Blocks stream sorted, those at home first: a task holds one block and a batch of visitors, however many come.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, block = None, [], None
        for batch in batches:
            at, visits = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            turns = np.flatnonzero((np.diff(at) != 0) | (np.diff(visits) != 0)) + 1
            for lo, hi in zip([0, *turns.tolist()], [*turns.tolist(), len(at)], strict=True):
                if lo == hi:
                    continue
                if at[lo] != current:
                    if parts:
                        yield (block or Block(parts, threshold)).own()
                    current, parts, block = at[lo], [], None
                if not visits[lo]:
                    parts.append(batch.slice(lo, hi - lo))
                elif parts:
                    block = block or Block(parts, threshold)
                    yield block.meet(batch.slice(lo, hi - lo))
        if parts:
            yield (block or Block(parts, threshold)).own()

    dealt = rows.repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "visits")
    return dealt.mapInArrow(run, "node long, links long, root long")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9, shard: int = SHARD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row.

    Vectors link at a cosine of at least threshold, in double precision of the components as they are. Null, empty and zero vectors, and those with null or non-finite
    components, link with nothing and are their own component. Equal vectors are one node with a weight: each counts
    the others, and a group of copies costs one row in a block. Rows with a null id take part in links; their kept is
    true. Repeated rows are further vectors. Other columns aren't read; an empty table gives an empty one.
    """
    bounded_batches(vectors.sparkSession)
    usable = F.coalesce((F.size(vec_col) > 0) & F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec_col, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.when(usable, F.col(vec_col)).alias("vec"))
    nodes = rows.where("vec is not null").groupBy("vec").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("weight"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = materialize(searched(*placed(nodes, shard, threshold), threshold), "found")
    reach = connected_components(found.select("node", "root"), "root", "node")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    by_node = nodes.join(links, "node", "left").join(reach, "node", "left").select("node", "vec", "vec_id", "weight", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    by_node = materialize(by_node, "linked")
    lowest = materialize(by_node.groupBy("root").agg(F.min("vec_id").alias("component_id")), "lowest")
    by_vec = by_node.join(lowest, "root").select(F.col("vec").alias("_vec"), (F.col("links") + F.col("weight") - 1).alias("_links"), "component_id")
    out = rows.join(materialize(by_vec, "by-vector"), F.col("vec") == F.col("_vec"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def audit_recall(vectors: DataFrame, result: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9, every: int = 20) -> DataFrame:
    """(links, found, recall) over the rows whose id is divisible by `every`, each compared with all rows by brute force.

    The stated queries are dealt by a hash into blocks of about QUERIES, and each row goes to each block, by its number: rows x
    blocks, which every task counts for itself. A block has several tasks where blocks are few, and none passes the driver.
    Ids are unique and not null.
    """
    bounded_batches(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    rows = rows.where((F.size("vec") > 0) & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0))
    asked = rows.where(F.pmod("id", F.lit(every)) == 0)
    blocks = max(1, -(-asked.count() // QUERIES))
    home = asked.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("visits"), "id", "vec")
    visits = rows.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("visits"), "id", "vec")
    parts = max(1, -(-4 * vectors.sparkSession.sparkContext.defaultParallelism // blocks))  # a block's rows go to so many tasks

    # each task has a copy of its block, so a few blocks keep all cores busy
    copies = home.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
    dealt = copies.unionByName(visits.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(parts)).cast("int")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, queries, found = None, [], {}

        def done() -> pa.RecordBatch:
            ids, n = [i for i, _, _ in found.values()], [n for _, _, n in found.values()]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids), pa.int64()), pa.array(np.concatenate(n), pa.int64())], ["q", "n"])

        for batch in batches:
            at, kind, length = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3).value_lengths().to_numpy()
            turns = np.flatnonzero((np.diff(at) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip([0, *turns.tolist()], [*turns.tolist(), len(at)], strict=True):
                if lo == hi:
                    continue
                if at[lo] != current:
                    if found:
                        yield done()
                    current, queries, found = at[lo], [], {}
                if not kind[lo]:
                    queries.append(batch.slice(lo, hi - lo))
                    continue
                if queries and not found:
                    all_q = pa.Table.from_batches(queries).combine_chunks().to_batches()[0]
                    sizes = all_q.column(3).value_lengths().to_numpy()
                    for d in np.unique(sizes).tolist():
                        q = all_q.take(pa.array(np.flatnonzero(sizes == d)))
                        found[d] = (q.column(2).to_numpy(), matrix(q), np.zeros(q.num_rows, np.int64))
                for d, (ids, q, n) in found.items():
                    at_d = lo + np.flatnonzero(length[lo:hi] == d)
                    for i in range(0, len(at_d), PORTION):
                        some = batch.take(pa.array(at_d[i : i + PORTION]))
                        hit = matrix(some) @ q.T >= threshold
                        n += (hit & (some.column(2).to_numpy()[:, None] != ids[None, :])).sum(0)
        if found:
            yield done()

    dealt = dealt.select((F.col("block") * parts + F.col("part")).alias("at"), "visits", "id", "vec").repartitionById(blocks * parts, F.col("at")).sortWithinPartitions("at", "visits")
    true = dealt.mapInArrow(count, "q long, n long").groupBy("q").agg(F.sum("n").alias("n"))
    both = true.join(result.select(F.col("vec_id").alias("q"), "n_links"), "q")
    sums = both.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("links"), F.coalesce(F.sum(F.least("n", "n_links")), F.lit(0)).alias("found"))
    return sums.withColumn("recall", F.when(F.col("links") > 0, F.col("found") / F.col("links")).otherwise(1.0))
