"""Vector code compression: product codebooks by Lloyd's rounds in exact integers over partition-local cover trees.

A tree covers one part of the vectors of a block: balls within balls of twice the radius or more, their points side by
side, with cumulative sums along them. A round walks each tree with the codebook's entries. An entry that is farther from
all of a ball than another is dropped for all that lies below; a ball with one entry left is assigned whole, by two
cumulative sums; only the points of the smallest balls that stay ambiguous are compared one by one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Components are held within this many units on both sides, so that squared distances fit in a long.
MOST = 1 << 27
#: Vectors of a block, and components of all of them, at most; points of a ball that isn't divided further.
BLOCK, BLOCK_SIZE, LEAF = 4096, 1 << 20, 24
#: By how much rounding may shift a bound, relative to it: bounds are doubles, comparisons of points are integers.
SLACK = 1e-9

ARRAYS = ("points", "row", "start", "end", "radius", "first", "count")
TREE = "struct<points:array<int>,row:array<int>,start:array<int>,end:array<int>,radius:array<double>,first:array<int>,count:array<int>>"


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a - b) ** 2).sum(-1))


class CoverTree:
    """Balls over rows of integers. Ball i holds points[start[i]:end[i]], all within radius[i] of the first of them, its centre;
    its children, count[i] balls from first[i] on, divide that range, and the first of them has its centre. row tells which
    row each point was."""

    def __init__(self, points, row, start, end, radius, first, count):
        self.points, self.row, self.start, self.end, self.radius, self.first, self.count = points, row, start, end, radius, first, count
        self.f = points.astype(np.float64)
        self.sums = np.zeros((len(points) + 1, points.shape[1]), np.int64)
        np.cumsum(points, axis=0, out=self.sums[1:])

    @classmethod
    def build(cls, x: np.ndarray) -> CoverTree:
        """Level by level, for all balls of a level at a time: the first point that is left becomes the centre of what lies within
        half the ball's radius of it, until none is left."""
        f, row = x.astype(np.float64), np.arange(len(x))
        start, end, radius = np.array([0]), np.array([len(x)]), np.array([distances(f, f[0]).max()])
        first, count = np.zeros(1, np.int64), np.zeros(1, np.int64)
        level = np.array([0])
        while True:
            level = level[(end[level] - start[level] > LEAF) & (radius[level] > 0)]
            if not len(level):
                return cls(x[row], row, start, end, radius, first, count)
            size = end[level] - start[level]
            ball = np.repeat(np.arange(len(level)), size)
            at = np.arange(size.sum()) + np.repeat(start[level] - (np.cumsum(size) - size), size)
            rows, reach = row[at], radius[level] / 2
            child, far = np.zeros(len(at), np.int64), np.zeros(len(at))
            left, made = np.arange(len(at)), 0
            while len(left):
                some, lead = np.unique(ball[left], return_index=True)
                which = np.searchsorted(some, ball[left])
                d = distances(f[rows[left]], f[rows[left[lead]]][which])
                near = d <= reach[ball[left]]
                child[left[near]], far[left[near]] = made + which[near], d[near]
                left, made = left[~near], made + len(some)
            turn = np.lexsort((child, ball))
            row[at] = rows[turn]
            child, far, ball = child[turn], far[turn], ball[turn]
            begin = np.flatnonzero(np.concatenate([[True], child[1:] != child[:-1]]))
            many = np.bincount(ball[begin], minlength=len(level))
            first[level], count[level] = len(start) + np.cumsum(many) - many, many
            level = len(start) + np.arange(len(begin))
            start = np.concatenate([start, at[begin]])
            end = np.concatenate([end, at[begin] + np.diff(np.append(begin, len(at)))])
            radius = np.concatenate([radius, np.maximum.reduceat(far, begin)])
            first, count = (np.concatenate([a, np.zeros(len(begin), np.int64)]) for a in (first, count))

    def assign(self, book: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(start, end, entry) of ranges of points with their nearest entry, of ties the first: whole balls, then single points."""
        f = book.astype(np.float64)
        ball = np.array([0])
        alive = np.array([[not (book[:i] == e).all(1).any() for i, e in enumerate(book)]])  # an entry's copies never win
        while len(ball):
            d = np.where(alive, distances(self.f[self.start[ball]][:, None], f[None]), np.inf)
            bound = (d.min(1) + 2 * self.radius[ball])[:, None]
            alive = alive & (d <= bound + SLACK * (1 + bound))
            lone = alive.sum(1) == 1
            yield self.start[ball[lone]], self.end[ball[lone]], alive[lone].argmax(1)
            last = ~lone & (self.count[ball] == 0)
            size = (self.end - self.start)[ball[last]]
            at = np.arange(size.sum()) + np.repeat(self.start[ball[last]] - (np.cumsum(size) - size), size)
            nearest = np.zeros(len(at), np.int64)
            for i in range(0, len(at), 1024):
                p = self.points[at[i : i + 1024], None].astype(np.int64) - book[None]
                nearest[i : i + 1024] = (p * p).sum(2).argmin(1)
            yield at, at + 1, nearest
            more = ~lone & (self.count[ball] > 0)
            many = self.count[ball[more]]
            alive = np.repeat(alive[more], many, 0)
            ball = np.arange(many.sum()) + np.repeat(self.first[ball[more]] - (np.cumsum(many) - many), many)

    def moved(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each entry how many points are nearest to it, and their sums."""
        n, total = np.zeros(len(book), np.int64), np.zeros(book.shape, np.int64)
        for start, end, entry in self.assign(book):
            np.add.at(n, entry, end - start)
            np.add.at(total, entry, self.sums[end] - self.sums[start])
        return n, total

    def codes(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's entry and its squared distance."""
        mark = np.zeros(len(self.points) + 1, np.int64)
        entry = np.zeros(len(self.points), np.int64)
        for start, end, e in self.assign(book):
            mark[start] = e  # ranges divide the points, so each begins where its entry is written
            long = end - start > 1
            for a, b, k in zip(start[long].tolist(), end[long].tolist(), e[long].tolist(), strict=True):
                mark[a:b] = k
        entry[self.row] = mark[:-1]
        error = np.zeros(len(entry), np.int64)
        gap = self.points.astype(np.int64) - book[mark[:-1]]
        error[self.row] = (gap * gap).sum(1)
        return entry, error


def units(flat: np.ndarray, n: int) -> np.ndarray:
    """Components as integers, a row for each vector."""
    return np.clip(np.floor(flat.astype(np.float64) * SCALE), -MOST, MOST).astype(np.int64).reshape(n, -1)


def forest(rows: DataFrame, dim: int) -> DataFrame:
    """(ids, labels, trees) by block: vectors of a task, in the order in which they come, with a tree for each part. rows: id, label, vec."""
    schema = rows.schema
    most = max(LEAF, min(BLOCK, BLOCK_SIZE // dim))

    def build(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        x = units(t.column(2).combine_chunks().flatten().to_numpy(zero_copy_only=False), t.num_rows)
        trees = [CoverTree.build(np.ascontiguousarray(p)) for p in np.split(x, PARTS, axis=1)]
        told = [{c: (getattr(t, c) if c == "radius" else getattr(t, c).astype(np.int32)).ravel() for c in ARRAYS} for t in trees]
        kinds = pa.list_(pa.struct([(c, pa.list_(pa.float64() if c == "radius" else pa.int32())) for c in ARRAYS]))
        lists = [pa.ListArray.from_arrays(pa.array([0, t.num_rows], pa.int32()), t.column(i).combine_chunks()) for i in (0, 1)]
        return pa.RecordBatch.from_arrays([*lists, pa.array([told], kinds)], ["ids", "labels", "trees"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                take = min(batch.num_rows, most - n)
                held.append(batch.slice(0, take))
                batch, n = batch.slice(take), n + take
                if n == most:
                    yield build(held)
                    held, n = [], 0
        if held:
            yield build(held)

    of = lambda i: schema[i].dataType.simpleString()
    return rows.mapInArrow(run, f"ids array<{of(0)}>, labels array<{of(1)}>, trees array<{TREE}>")


def trees_of(batch: pa.RecordBatch) -> Iterator[tuple[int, list[CoverTree]]]:
    """(place in the batch, trees) of each block."""
    column = batch.column(batch.num_columns - 1)
    for i in range(batch.num_rows):
        own = column[i].values
        arrays = [{c: own.field(c)[k].values.to_numpy() for c in ARRAYS} for k in range(PARTS)]
        yield i, [CoverTree(a["points"].reshape(len(a["row"]), -1), *(a[c] for c in ARRAYS[1:])) for a in arrays]


def moved(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round: entries go to the floor of the mean of what is nearest to them, and stay where nothing is.
    What reaches the driver is a row for each part, entry and position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(books.shape[:2], np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            for _, own in trees_of(batch):
                for k, t in enumerate(own):
                    a, b = t.moved(books[k])
                    n[k] += a
                    total[k] += b
        part, entry = np.nonzero(n)
        width = books.shape[2]
        at = [np.repeat(part, width), np.repeat(entry, width), np.tile(np.arange(width), len(part))]
        yield pa.RecordBatch.from_arrays([*(pa.array(a, pa.int32()) for a in at), pa.array(total[part, entry].ravel()), pa.array(np.repeat(n[part, entry], width))], ["part", "entry", "pos", "total", "n"])

    told = trees.select("trees").mapInArrow(run, "part int, entry int, pos int, total long, n long")
    sums = told.groupBy("part", "entry", "pos").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    new = books.copy()
    for r in sums.collect():
        new[r["part"], r["entry"], r["pos"]] = int(r["total"]) // r["n"]
    return new


def coded(trees: DataFrame, books: np.ndarray, id_type: str, label_type: str) -> DataFrame:
    """(id, label, code, error) of each vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, own in trees_of(batch):
                found = [t.codes(books[k]) for k, t in enumerate(own)]
                code = np.stack([c for c, _ in found], 1).astype(np.uint8).tobytes().hex()
                step = 2 * PARTS
                yield pa.RecordBatch.from_arrays([batch.column(0)[i].values, batch.column(1)[i].values, pa.array([code[j : j + step] for j in range(0, len(code), step)], pa.string()), pa.array(sum(e for _, e in found))], ["id", "label", "code", "error"])

    return trees.mapInArrow(run, f"id {id_type}, label {label_type}, code string, error long")


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """((id, label, code, error, label_error), codebooks): each vector's entry of each part in hex, its squared distance to what the code says,
    that summed over its label's vectors, and the codebooks as [part, entry, position].

    Vectors that are null or hold null or non-finite components have no row. Codebooks start from the ENTRIES smallest ids, rows
    of equal id by their vectors, null ids last; fewer rows make fewer entries. A vector's length is that of the smallest
    id whose length PARTS divides; vectors of other lengths have a row with null code and error. Components beyond MOST
    units count as MOST. Repeated rows are vectors of their own; null labels are one label; a sum beyond a long is null.
    Other columns aren't read. An empty table gives an empty one.

    Trees are built once, in the tasks that read the vectors, and written; a round reads them and shuffles a row for each
    component of the codebooks and task.
    """
    bounded_batches(vectors.sparkSession)
    fine = F.coalesce(F.forall(vec_col, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))), F.lit(False))
    rows = vectors.where(fine).select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
    order = [F.col("id").asc_nulls_last(), F.col("vec")]
    one = rows.where((F.size("vec") > 0) & (F.size("vec") % PARTS == 0)).orderBy(*order).select(F.size("vec").alias("n")).first()
    dim = one["n"] if one else PARTS
    own = rows.where(F.size("vec") == dim)
    start = own.orderBy(*order).limit(ENTRIES).select("vec").collect()  # ENTRIES vectors at most
    books = np.stack(np.split(units(np.array([r["vec"] for r in start], np.float64).ravel(), max(1, len(start))), PARTS, axis=1)) if start else np.zeros((PARTS, 0, dim // PARTS), np.int64)
    trees = materialize(forest(own, dim), "cover-trees")
    for _ in range(ROUNDS if start else 0):
        books = moved(trees, books)
    kinds = [rows.schema[i].dataType.simpleString() for i in (0, 1)]
    other = rows.where(F.size("vec") != dim).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    done = materialize(coded(trees, books, *kinds).unionByName(other), "codes")
    sums = done.groupBy(F.col("label").alias("_label")).agg(F.try_sum("error").alias("label_error"))
    return done.join(materialize(sums, "label-errors"), F.col("label").eqNullSafe(F.col("_label"))).drop("_label"), books
