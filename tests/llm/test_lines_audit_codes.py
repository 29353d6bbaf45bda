"""Line dedup, filter audit and vector codes against brute force in plain Python, odd rows included."""

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from coinloom.llm import cover_tree, filter_audit, line_dedup, queries
from conftest import SF, canonical

CLASHES = ("doc", "keep", "n_dropped", "h1", "h2", "t1", "t2", "_dropped2", "pos", "first", "part", "mask", "n", "id", "label_error")


def clashing(df):
    return df.withColumns({c: F.lit(i) for i, c in enumerate(CLASHES)})


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_line_dedup", "op13_filter_audit"])
def test_query_matches_sql(spark, oracle, name):
    rows = queries.QUERIES[name](spark, SF)
    got = canonical(rows.toPandas())
    assert got[0] and got == oracle(queries.ORACLE[name])


# line dedup


def plain_key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def plain_line_dedup(rows):
    """(id, text) -> sorted (id, lines, dropped, kept text); null ids last."""
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = plain_key(line)
            if len(key) >= 10:
                first[key] = min(first.get(key, order(i)), order(i))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if first.get(plain_key(x), order(i)) == order(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def line_rows():
    r = random.Random(3)
    common = [f"Shared line number {i}" for i in range(12)]
    rows = [(i, "\n".join(r.choice([r.choice(common), r.choice(common).upper() + " \t", f"own {r.random()}", "short", "", "\r", "ÄÖÜ äöü Zeile É" + "x" * r.randint(0, 2)]) for _ in range(r.randint(1, 30)))) for i in range(60)]
    rows += [(3, "Shared line number 1\nsomething else of its own"), (3, rows[3][1]), (None, "Shared line number 2\nonly nulls hold this"), (None, "only nulls hold this\nonly nulls hold this"), (None, None), (99, None), (98, ""), (97, "\n"), (96, "  \x0b Shared line number 3\x0c\n\n")]
    rows += [(200 + i, "\n".join(["a very common line"] * 3 + [f"line {i} {k}" for k in range(200)] + ["Shared line number 4", "tail " * 3])) for i in range(30)]
    return rows + [(95, "ſhared line number 1"), (94, "x" * 100_000 + "\nShared line number 5")]


@pytest.mark.parametrize("hot", [10**9, 3])
def test_lines_match_brute_force(spark, monkeypatch, hot):
    """Both ways that a hash can go give the same: through ranges, and, for hot ones, by their smallest id."""
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rows = line_rows()
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    out = line_dedup.deduplicated(df)
    assert out.columns == [*df.columns, "_lines", "_dropped"]
    got = sorted(((r["doc_id"], r["_lines"], r["_dropped"], r["text"]) for r in out.collect()), key=str)
    assert got == plain_line_dedup(rows) and sum(g[2] for g in got) > 100
    assert line_dedup.deduplicated(df.limit(0)).count() == 0


def test_bitmaps_hold_what_goes(spark):
    text = "\n".join(f"line of text {i}" for i in range(200))
    df = spark.createDataFrame([(1, "line of text 3\nline of text 130"), (2, text)], "doc_id long, text string")
    (row,) = line_dedup.keep_bitmaps(df).collect()
    bits = [(row["keep"][i // 64] >> (i % 64)) & 1 for i in range(64 * len(row["keep"]))]
    assert row["doc"] == 2 and row["n_dropped"] == 2 and len(row["keep"]) == 3 and [i for i, b in enumerate(bits) if not b] == [3, 130]


def test_ranges_are_dealt_once(spark):
    """Lines are dealt out by ranges, and the window needs no other exchange of them."""
    lines = spark.createDataFrame([(1, 1, 1, 0, 1, 1)], "doc long, t1 long, t2 long, pos int, h1 long, h2 long")
    plan = line_dedup.later_lines(lines)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Window") :]
    assert "rangepartitioning(h1" in below and "hashpartitioning" not in below.split("rangepartitioning")[0]


# filter audit


def plain_audit(rows, labels):
    words = lambda t: [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
    docs = [(i, s or "", t or "") for i, s, t in rows]
    least = {}
    for i, _, t in docs:
        if i is not None:
            least[t] = min(least.get(t, i), i)
    fails = []
    for i, s, t in docs:
        w = words(t)
        checks = [len(w) < 50, 100 * len(set(w)) < 65 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t), any(c in "#$%&*|" for c in t), i is not None and least[t] < i]
        fails.append((s, {f for f, c in zip("ABCDE", checks, strict=True) if c}, any(d == i and q == 1 for d, q, _ in labels if d is not None), any(d == i and x == 1 for d, _, x in labels if d is not None)))
    out, shapley = [], {}
    orders = ["".join(p) for p in itertools.permutations("ABCDE")]
    for part in {s for s, *_ in fails}:
        own, done = [f for f in fails if f[0] == part], []
        for order in orders:
            for k, f in enumerate(order):
                before = set(order[:k])
                gone = [x for x in own if f in x[1] and not x[1] & before]
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                done.append((part, order, k + 1, sum(not x[1] & (before | {f}) for x in own), len(gone), sum(f in x[1] and bool(x[1] & before) for x in own), sum(x[1] == {f} for x in own), sum(x[2] for x in gone), sum(x[3] for x in gone)))
        out += done
    return sorted((*x, shapley[x[0], x[1][x[2] - 1]]) for x in out)


def test_audit_matches_brute_force(spark):
    r = random.Random(5)
    word = lambda n: " ".join(r.choice(["alpha", "Beta", "GAMMA", "ä", "x$", f"w{r.randint(0, 400)}"]) if r.random() < 0.4 else f"v{r.randint(0, 10**6)}" for _ in range(n))
    texts = [word(r.choice([5, 49, 50, 60, 200])) for _ in range(25)] + ["", None, "  \n", "a" * 5, " ".join(["same"] * 100), "clean " + " ".join(f"w{i}" for i in range(60)), "É" * 50]
    rows = [(i, r.choice(["s", "t", "", None]), r.choice(texts)) for i in range(150)]
    rows += [(7, "s", texts[0]), (7, "t", texts[0]), (7, "s", texts[0]), (None, "s", texts[0]), (None, None, None), (1000, "u", "w" * 200_000)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1])) for i in range(0, 150, 2)] + [(8, 1, 1), (None, 1, 1), (5000, 1, 1)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, source string, text string"))
    got = filter_audit.audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    want = plain_audit(rows, labels)
    assert sorted(tuple(x) for x in got.collect()) == want
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert filter_audit.audit(df.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


# vector codes


def plain_codes(rows):
    """Lloyd's rounds in Python's integers."""
    own = [(i, lab, [int(np.floor(4096 * float(np.float32(c)))) for c in v]) for i, lab, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    first = sorted((o for o in own if o[2] and len(o[2]) % 8 == 0), key=lambda o: (o[0] is None, o[0] or 0, o[2]))
    d = len(first[0][2])
    fit, first = [o for o in own if len(o[2]) == d], [o for o in first if len(o[2]) == d]
    w = d // 8
    part = lambda v, k: v[k * w : (k + 1) * w]
    books = [[list(part(o[2], k)) for o in first[:16]] for k in range(8)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda p, book: min(range(len(book)), key=lambda e: (dist(p, book[e]), e))
    for _ in range(6):
        for k in range(8):
            groups = {}
            for o in fit:
                groups.setdefault(nearest(part(o[2], k), books[k]), []).append(part(o[2], k))
            for e, g in groups.items():
                books[k][e] = [sum(c) // len(g) for c in zip(*g, strict=True)]
    out = []
    for i, lab, v in own:
        if len(v) == d:
            code = [nearest(part(v, k), books[k]) for k in range(8)]
            out.append((i, lab, "".join(f"{c:02x}" for c in code), sum(dist(part(v, k), books[k][c]) for k, c in enumerate(code))))
        else:
            out.append((i, lab, None, None))
    sums = {}
    for _, lab, _, e in out:
        sums[lab] = None if e is None and sums.get(lab) is None else (sums.get(lab) or 0) + (e or 0)
    return sorted(((*o, sums[o[1]]) for o in out), key=str), hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


VEC = "vec_id long, label int, embedding array<float>"


def vector_rows(n, d=16):
    r = np.random.default_rng(n)
    base = r.normal(size=(6, d))
    x = [(int(i), int(r.integers(3)) if i % 5 else None, [float(c) for c in np.float32(base[r.integers(6)] + r.normal(size=d) * 0.2)]) for i in r.permutation(n)]
    one = x[0][2]
    x += [(n, 1, one), (n, 1, one), (n + 1, 2, [-c for c in one]), (None, 1, one), (None, None, [0.0] * d), (n + 2, 0, None), (n + 3, 0, [None] + one[1:]), (n + 4, 0, [float("nan")] + one[1:]), (n + 5, 0, [float("inf")] + one[1:]), (n + 6, 7, [1.0, 2.0]), (n + 7, 7, []), (n + 8, 1, one)]
    return x + [(n + 9 + i, 3, [0.25] * d) for i in range(70)]  # a ball without radius


@pytest.mark.parametrize("n, block, leaf", [(300, 64, 4), (300, 4096, 24), (5, 4096, 1)])
def test_codes_match_brute_force(spark, monkeypatch, n, block, leaf):
    monkeypatch.setattr(cover_tree, "BLOCK", block)
    monkeypatch.setattr(cover_tree, "LEAF", leaf)
    rows = vector_rows(n)
    df = spark.createDataFrame(rows, VEC).withColumns({c: F.lit(0) for c in ("id", "vec", "code", "error", "ids", "trees")})
    out, books = cover_tree.compressed(df)
    want, digest = plain_codes(rows)
    got = sorted(((r["id"], r["label"], r["code"], r["error"], r["label_error"]) for r in out.collect()), key=str)
    assert got == want and cover_tree.digest(books) == digest


def test_no_vectors_and_few(spark):
    rows = [(1, 0, [0.5] * 8), (2, None, [0.75] * 8), (3, 0, [3e38] * 8)]
    df = spark.createDataFrame(rows, VEC)
    out, books = cover_tree.compressed(df.limit(0))
    assert out.count() == 0 and books.shape[1] == 0
    out, books = cover_tree.compressed(df)
    assert sorted((r["id"], r["code"], r["error"]) for r in out.collect()) == [(1, "00" * 8, 0), (2, "01" * 8, 0), (3, "02" * 8, 0)] and books.max() == cover_tree.MOST
    assert cover_tree.compressed(spark.createDataFrame([(4, 1, None)], VEC))[0].count() == 0


def test_balls_cover_and_prune():
    """Every point lies within its ball's radius of the centre, children divide the ball, radii halve; clustered points are
    assigned by whole balls, and every point once."""
    r = np.random.default_rng(0)
    middles = r.normal(size=(8, 8)) * 4000
    x = (middles[r.integers(8, size=3000)] + r.normal(size=(3000, 8)) * 40).astype(np.int64)
    t = cover_tree.CoverTree.build(x)
    assert sorted(t.row.tolist()) == list(range(3000)) and (t.points == x[t.row]).all()
    for i in range(len(t.start)):
        a, b = t.start[i], t.end[i]
        assert cover_tree.distances(t.f[a:b], t.f[a]).max() <= t.radius[i] + 1e-9
        if t.count[i]:
            own = range(t.first[i], t.first[i] + t.count[i])
            assert [t.start[k] for k in own] == [a, *(t.end[k] for k in own)][:-1] and t.end[own[-1]] == b and all(t.radius[k] <= t.radius[i] / 2 for k in own)
    for book, most in ((middles.astype(np.int64), 100), (x[:16], 3000)):  # an entry a cluster; several in some
        ranges = [(s, e) for start, end, _ in t.assign(book) for s, e in zip(start.tolist(), end.tolist(), strict=True)]
        assert sum(e - s for s, e in ranges) == 3000 and len(ranges) < most
        entry, error = t.codes(book)
        d = ((x[:, None] - book[None]) ** 2).sum(2)
        assert (entry == d.argmin(1)).all() and (error == d.min(1)).all()
