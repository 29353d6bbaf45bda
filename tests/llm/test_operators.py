import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from coinloom.llm import chunk_dedup, fingerprint, flat_graph, mixing, packing, quality, queries, setsketch, token_count, toxicity, warc
from conftest import SF, canonical

DOC = "doc_id long, text string, lang string, source string, n_chars long"
R = random.Random(7)
SYLLABLES = "ra po ti len sho ká bu mer ni".split()


def prose(n, r=R):
    return " ".join("".join(r.choice(SYLLABLES) for _ in range(r.randint(1, 4))) for _ in range(n))


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{i % 3}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)], DOC)


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty and blank texts, a long one, ties, a repeated row, a null id, and columns with clashing names."""
    base = prose(80)
    texts = [None, "", "  \n", "a", "a b", base, base, prose(20_000), "don't <|endoftext|> we'll", "é" * 300]
    df = docs(spark, texts)
    df = df.union(df.where("doc_id = 5")).union(spark.createDataFrame([(None, base, None, None, None)], DOC))
    return df.withColumn("score", F.lit(1)).withColumn("size", F.lit("x")).withColumn("node", F.lit(2)).withColumn("source_size", F.lit(0))


CLASHES = ("score", "size", "node", "source_size", "_source", "_size", "threshold", "_score", "_threshold", "_lang", "_removed", "removed", "_spans", "kept", "band", "vec", "id")


def clashing(df):
    return df.withColumns({c: F.lit(i) for i, c in enumerate(CLASHES)})


def test_odd_rows_have_defined_results(spark, odd):
    """Null, empty, blank, short, equal and very long texts, a repeated row, a null id, clashing columns."""
    odd = clashing(odd)
    labels = spark.createDataFrame([(5, 1, 0), (7, 0, 1)], "doc_id long, quality int, toxic int")
    texts = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    words = [len((t or "").encode().split()) for _, t in texts]

    got = quality.quality(odd, labels, F.col("source"), F.col("lang")).collect()
    assert len(got) == 12 and all(0 < r["score"] < 1 and r["kept"] == (r["score"] >= 0.5) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (5, 6) and r["host"] is None}) <= 1

    prints = sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["fingerprint"]) for r in fingerprint.fingerprints(odd).collect())
    assert prints == sorted(((d is None, d or 0), fingerprint.text_of(fingerprint.digests([t or ""]))[0]) for d, t in texts)
    assert sorted(r["n_chars"] for r in fingerprint.compared(odd).collect()) == sorted(len(t or "") for _, t in texts)

    cut = chunk_dedup.deduplicated(odd.drop("_removed")).collect()
    whole = [r["text"] for r in cut if r["doc_id"] is None or r["doc_id"] in (0, 1, 2, 3, 4, 7, 8)]
    assert sorted(map(str, whole)) == sorted(str(t) for d, t in texts if d is None or d in (0, 1, 2, 3, 4, 7, 8))
    assert [r["text"] for r in cut if r["doc_id"] in (5, 6)] == ["", "", ""]  # the null id comes first

    near = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in setsketch.near_duplicates(odd, k=3, percent=85).collect())
    assert [r[2] for r in near] == [None, 0, 1, 2, 3, 4, 5, 5, 5, 7, 8, 9] and [r[3] for r in near] == [True] * 8 + [False] + [True] * 3
    assert [r[1] for r in near][1:6] == [0, 0, 0, 1, 1]

    own = toxicity.scored(odd.drop("_score"), toxicity.train(odd, labels)).collect()
    assert len(own) == 12 and len({r["_score"] for r in own if not (r["text"] or "").split()}) == 1 and all(0 <= r["_score"] <= 1 for r in own)

    counts = sorted(tuple(r)[1:] for r in token_count.token_counts(odd, queries.tokenizer("word_bpe_49k.json")).collect())
    library = token_count_library()
    assert counts == sorted((len((t or "").encode()), n, n > 2048) for _, t in texts for n in [len(library.encode(t or "", add_special_tokens=False).ids)])

    p = mixing.prefix(odd)
    taken = mixing.mix(odd).collect()
    assert p == "__" and sorted(r[f"{p}size"] for r in taken) == sorted(words)
    assert set(mixing.mixed_documents(odd).columns) == set(odd.columns)

    packed = packing.packed(odd, **queries.byte_bpe()).collect()
    assert sum(r["start"] == 0 for r in packed) == 12 and [r["doc_tokens"] for r in packed if r["doc_id"] in (0, 1)] == [1, 1]


def token_count_library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer("word_bpe_49k.json"))


def test_empty_tables_give_empty_tables(spark, odd):
    labels = spark.createDataFrame([(5, 1, 0), (7, 0, 1)], "doc_id long, quality int, toxic int")
    runs = [
        lambda d: quality.quality(d, labels, F.col("source"), F.col("lang")),
        lambda d: fingerprint.compared(d),
        lambda d: chunk_dedup.deduplicated(d),
        lambda d: setsketch.near_duplicates(d, k=3, percent=85),
        lambda d: toxicity.scored(d, toxicity.train(d, labels)),
        lambda d: token_count.token_counts(d, queries.tokenizer("word_bpe_49k.json")),
        lambda d: mixing.mix(d),
        lambda d: packing.packed(d, **queries.byte_bpe()),
    ]
    for run in runs:
        assert run(odd.limit(0)).count() == 0
    assert flat_graph.near_vectors(vectors(spark, [[1.0]]).limit(0)).count() == 0


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_odd_rows(spark, odd, stage):
    """Every stage alone, with clashing columns: what must stay stays, once, and nothing else comes; empty tables stay empty."""
    import corpus_pipeline as p

    name, run = p.STAGES[stage]
    docs = clashing(odd)
    out = run(spark, docs, SF)
    if name == "packing":
        assert out.where("start = 0").count() == 12
    else:
        assert out.columns == docs.columns
        rows = [(r["doc_id"], r["text"]) for r in out.collect()]
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        if name == "toxicity":
            assert sorted(map(str, rows)) == sorted(map(str, before))
        if name == "near-dedup":
            assert sorted(str(d) for d, _ in rows) == sorted(map(str, [None, 0, 1, 2, 3, 4, 5, 7, 8, 9]))
        if name == "substring-dedup":
            assert sorted(str(d) for d, _ in rows) == sorted(map(str, [None, 0, 1, 2, 3, 4, 7, 8, 9]))
        if name == "mixing":
            assert set(rows) <= set(before)
    assert run(spark, docs.limit(0), SF).count() == 0


def test_fingerprints_follow_the_next_document(spark):
    texts = [prose(60) for _ in range(30)] + ["", None]
    got = {r["doc_id"]: r for r in fingerprint.compared(docs(spark, texts)).collect()}
    own = fingerprint.digests([t or "" for t in texts])
    for i, t in enumerate(texts):
        t, other = t or "", texts[(i + 1) % len(texts)] or ""
        new = fingerprint.edited(t, other)
        assert got[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest() and got[i]["n_chars"] == len(t)
        assert got[i]["near_next"] == fingerprint.likeness(own[i : i + 1], own[[(i + 1) % len(texts)]])[0]
        assert 0 <= got[i]["near_edited"] <= 1
    assert np.mean([got[i]["near_edited"] for i in range(30)]) > np.mean([got[i]["near_next"] for i in range(29)]) + 0.1


def test_fingerprints_of_an_id_with_many_rows(spark):
    texts = [(i if i < 60 else 7 if i < 260 else None, prose(12)) for i in range(300)] + [(7, "again")] * 3
    df = spark.createDataFrame(texts, "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions would share a task
    try:
        got = fingerprint.compared(df, parts=8).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = [tuple(r) for r in df.orderBy(F.asc_nulls_first("doc_id"), F.xxhash64("text")).collect()]
    want = []
    for i, (d, t) in enumerate(rows):
        new = fingerprint.edited(t, rows[(i + 1) % len(rows)][1])
        want.append((d, len(t), hashlib.sha256(new.encode()).hexdigest(), *fingerprint.text_of(fingerprint.digests([t, new]))))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    assert len({r["task"] for r in got if r["doc_id"] == 7}) > 2


def plain_code(text):
    """A text's digest in plain Python: triplets, buckets, quartiles, length."""
    data, counts, mask = text.encode(), [0] * fingerprint.BUCKETS, 0xFFFFFFFF
    for kind, (second, third) in enumerate(fingerprint.TRIPLETS, 1):
        for i in range(len(data) - third):
            a, b, c = data[i], data[i + second], data[i + third]
            h = ((a * 0x9E3779B1 + b * 0x85EBCA77) & mask) ^ ((c * 0xC2B2AE3D + kind * 0x27D4EB2F) & mask)
            h = ((h ^ (h >> 15)) * 0x2C1B3C6D) & mask
            counts[h >> 24] += 1
    ordered = sorted(counts)
    q = [ordered[fingerprint.BUCKETS * i // 4 - 1] for i in (1, 2, 3)]
    return [min(round(8 * np.log2(len(data) + 1)), 255), *(sum(n > x for x in q) for n in counts)]


def test_digests_in_plain_python(spark):
    texts = [prose(60), prose(300), "", "ab", "abc", "abcd", "é" * 50, prose(20) * 3]
    codes = [plain_code(t) for t in texts]
    hexes = [bytes([c[0], *(64 * c[i] + 16 * c[i + 1] + 4 * c[i + 2] + c[i + 3] for i in range(1, len(c), 4))]).hex() for c in codes]
    assert fingerprint.digests(texts).tolist() == codes and fingerprint.text_of(fingerprint.digests(texts)) == hexes

    def plain_likeness(a, b):
        return 1 - (sum(abs(x - y) for x, y in zip(a[1:], b[1:], strict=True)) + 12 * min(abs(a[0] - b[0]), 16)) / (3 * 256 + 12 * 16)

    for r in fingerprint.compared(docs(spark, texts)).collect():
        i, after = r["doc_id"], texts[(r["doc_id"] + 1) % len(texts)]
        n = len(texts[i]) // 4
        new = plain_code(texts[i][: len(texts[i]) - n] + after[:n])
        assert r["fingerprint"] == hexes[i] and abs(r["near_edited"] - plain_likeness(codes[i], new)) < 1e-12
        assert r["edited_fingerprint"][:2] == f"{new[0]:02x}" and abs(r["near_next"] - plain_likeness(codes[i], plain_code(after))) < 1e-12


def plain_chunks(data):
    """Ends of a text's chunks in plain Python: a gear hash of 16 bytes, cut where it is the least within REACH on both sides."""
    n, mask = len(data), 0xFFFFFFFF
    if n <= chunk_dedup.REACH:
        return [n] if n else []
    h = []
    for i in range(n):
        x = 0
        for b in data[max(0, i - 15) : i + 1]:
            x = (x * 2 + int(chunk_dedup._GEAR[b])) & mask
        h.append(int(chunk_dedup.mix64(np.array([x], np.uint64))[0]))
    ends = set()
    for i in range(15, n):
        if h[i] == min(h[max(0, i - chunk_dedup.REACH) : i + chunk_dedup.REACH + 1]) and h[i] != h[i - 1] and i + 1 < n:
            e = i + 1
            while e < n and data[e] & 0xC0 == 0x80:
                e += 1
            if e < n:
                ends.add(e)
    return sorted(ends | {n})


def test_chunks_and_spans_in_plain_python(spark):
    r = random.Random(8)
    passages = [prose(40, r) for _ in range(4)]
    texts = [" ".join(x for _ in range(3) for x in (prose(r.randint(5, 40), r), r.choice(passages))) for _ in range(25)] + [None, "", "short"]
    seen, want = set(), {}
    for i, t in enumerate(texts):
        data, spans, own, at = (t or "").encode(), [], set(), 0
        for e in plain_chunks(data):
            if data[at:e] in seen or data[at:e] in own:
                if spans and spans[-1][1] == at:
                    spans[-1][1] = e
                else:
                    spans.append([at, e])
            own.add(data[at:e])
            at = e
        seen |= own
        want[i] = [tuple(s) for s in spans if s[1] - s[0] >= chunk_dedup.MIN_RUN]
    got = {q["doc_id"]: q for q in chunk_dedup.deduplicated(docs(spark, texts)).collect()}
    assert sum(map(len, want.values())) > 20
    for i, t in enumerate(texts):
        assert [(s["start"], s["end"]) for s in got[i]["_removed"]] == want[i]
        data = (t or "").encode()
        assert (got[i]["text"] or "").encode() == b"".join(data[a:b] for a, b in zip([0, *(e for _, e in want[i])], [*(s for s, _ in want[i]), len(data)], strict=True))


@pytest.mark.parametrize("stage", [False, True])
def test_spans_belong_to_rows(spark, stage):
    """Several rows without an id, and one id with several texts: each row loses what it repeats itself, and nothing else."""
    import corpus_pipeline as p

    r = random.Random(12)
    shared, inner = prose(60, r), prose(50, r)
    rows = [(None, f"{inner} {prose(20, r)} {inner}"), (None, prose(120, r)), (None, f"{prose(30, r)} {shared}"), (None, None), (5, f"{inner} {prose(70, r)}"), (5, f"{prose(90, r)}"), (5, f"{prose(40, r)} {shared} {shared}"), (5, None), (5, ""), (7, f"{shared} {prose(30, r)}")]
    rows += [rows[5], (8, rows[5][1])]
    earlier = lambda a, b: a != b and (a is None or (b is not None and a < b))
    pieces = [[(t or "").encode()[i:j] for i, j in zip([0, *ends], ends, strict=False)] for _, t in rows for ends in [plain_chunks((t or "").encode())]]
    want = []
    for (i, t), own in zip(rows, pieces, strict=True):
        spans, at, seen = [], 0, set()
        for c in own:
            if c in seen or any(earlier(k, i) and c in other for (k, _), other in zip(rows, pieces, strict=True)):
                if spans and spans[-1][1] == at:
                    spans[-1][1] += len(c)
                else:
                    spans.append([at, at + len(c)])
            seen.add(c)
            at += len(c)
        spans = [s for s in spans if s[1] - s[0] >= chunk_dedup.MIN_RUN]
        data = (t or "").encode()
        left = b"".join(data[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(data)], strict=True))
        if not (stage and spans and not left.strip()):  # the stage drops texts that repeat throughout
            want.append((i, None if t is None else left.decode()))
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOC)
    out = p.without_repeats(spark, df, SF) if stage else chunk_dedup.deduplicated(df)
    got = sorted(((q["doc_id"], q["text"]) for q in out.collect()), key=str)
    assert got == sorted(want, key=str)
    assert (None, rows[1][1]) in got and got.count((5, rows[5][1])) == 2 and sum(a != b for a, b in zip(sorted(map(str, rows)), sorted(map(str, got)), strict=False)) > 2


def test_repeated_passages_go_and_clean_ones_stay(spark):
    shared = prose(60)
    texts = [prose(100) for _ in range(6)]
    with_it = [f"{prose(30)} {shared} {prose(30)}" for _ in range(3)]
    out = {r["doc_id"]: r["text"] for r in chunk_dedup.deduplicated(docs(spark, texts + with_it)).collect()}
    assert all(out[i] == t for i, t in enumerate(texts)) and shared in out[6]
    middle = shared[len(shared) // 3 : 2 * len(shared) // 3]
    for i in (7, 8):
        assert middle not in out[i] and with_it[i - 6][:60] == out[i][:60]


def test_chunks_cover_texts_and_resist_insertion():
    text = np.frombuffer(prose(3000).encode(), np.uint8)
    moved = np.concatenate([np.frombuffer(b"something new", np.uint8), text])
    a, b = ([bytes(t[i:j]) for i, j in zip([0, *c[:-1]], c)] for t, c in ((t, chunk_dedup.cuts(t).tolist()) for t in (text, moved)))
    assert b"".join(a) == text.tobytes() and len(set(a) - set(b)) <= 2
    assert np.diff(chunk_dedup.cuts(np.zeros(9000, np.uint8)), prepend=0).max() <= chunk_dedup.LONGEST


def brute_components(texts, k, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                x, y = root[i], root[j]
                root = [min(x, y) if r in (x, y) else r for r in root]
    return [(i, len(s), root[i], root[i] == i) for i, s in enumerate(sets)]


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_near_duplicates_match_brute_force(spark, k, percent):
    r = random.Random(k)
    texts = [None, "", "one", "one two", "One TWO", "ONE"]
    for _ in range(6):
        words = prose(120, r).split()
        for _ in range(12):  # a chain of edits: links within, not all of them to the first
            texts.append(" ".join(words))
            words[r.randrange(len(words))] = "edit%d" % r.randrange(999)
            words[r.randrange(len(words))] = "edit%d" % r.randrange(999)
    got = sorted(tuple(x) for x in setsketch.near_duplicates(docs(spark, texts), k=k, percent=percent).collect())
    assert got == brute_components(texts, k, percent)


def test_buckets_of_several_components_are_settled_in_blocks(spark, monkeypatch):
    """Versions of one text at all distances from it: buckets hold many components, in many blocks of rows and of bytes."""
    monkeypatch.setattr(setsketch, "BLOCK", 16)
    monkeypatch.setattr(setsketch, "BLOCK_BYTES", 16 * 800)
    r = random.Random(9)
    base, texts = prose(100, r).split(), []
    for i in range(260):
        words = list(base if i % 2 else texts[r.randrange(len(texts))].split() if texts else base)
        for _ in range(i % 7):
            words[r.randrange(len(words))] = f"edit{r.randrange(99)}"
        texts.append(" ".join(words))
    want = brute_components(texts, 3, 85)
    assert 20 < len({c for _, _, c, _ in want}) < 200
    assert sorted(tuple(x) for x in setsketch.near_duplicates(docs(spark, texts), k=3, percent=85).collect()) == want


def test_deduplication_keeps_one_of_repeated_rows(spark):
    """Clashing names, null ids and texts, a group of copies, rows repeated whole, and one id with two texts."""
    base = prose(40)
    rows = [(1, base), (1, base), (2, base), (3, None), (3, None), (4, ""), (None, base), (5, prose(40)), (5, "other words")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit(1), "KEPT": F.lit(False), "n": F.lit(7), "_id": F.lit(0)})
    out = setsketch.deduplicated(df)
    assert out.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "-") for r in out.collect()) == sorted([(0, base), (1, base), (3, "-"), (4, "-"), (5, rows[7][1]), (5, "other words")])
    assert setsketch.deduplicated(df.limit(0)).count() == 0


def test_sketches_merge_and_estimate():
    r = np.random.default_rng(0)
    pool = r.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = pool[:2000], pool[500:2500]
    u, v = setsketch.registers(a), setsketch.registers(b)
    assert (np.maximum(u, v) == setsketch.registers(np.union1d(a, b))).all()
    assert abs(setsketch.likely_jaccard(u[None], v[None], np.array([2000.0]), np.array([2000.0]))[0] - 0.6) < 0.12


def vectors(spark, x):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 0) for i, v in enumerate(x)], "vec_id long, embedding array<float>, label int")


def test_embedding_links_match_brute_force(spark):
    r = np.random.default_rng(1)
    base = r.normal(size=(300, 24))
    x = [*base, *(base[:60] + r.normal(size=(60, 24)) * 0.25), *(base[:1] + r.normal(size=(150, 24)) * 0.1), base[5], base[5]]
    df = vectors(spark, [*x, None, [0.0] * 24, [float("nan")] * 24, [None] * 24, [1.0, 2.0], []])
    got = {q["vec_id"]: q for q in flat_graph.near_vectors(df, shard=100).collect()}
    f = np.array(x, np.float32).astype(float)
    f /= np.linalg.norm(f, axis=1, keepdims=True)
    hit = f @ f.T >= 0.9
    np.fill_diagonal(hit, False)
    found = np.array([got[i]["n_links"] for i in range(len(x))])
    assert (found <= hit.sum(1)).all() and found.sum() >= 0.9 * hit.sum() and len(got) == len(x) + 6
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] and got[i]["component_id"] == i for i in range(len(x), len(x) + 6))
    good = df.where(f"vec_id < {len(x)}")
    audit = flat_graph.audit_recall(good, flat_graph.near_vectors(good, shard=100)).first()
    assert audit["recall"] >= 0.9


def test_blocks_count_as_one_shard(spark, monkeypatch):
    r = np.random.default_rng(2)
    x = r.normal(size=(1, 16)) + r.normal(size=(90, 16)) * 0.1
    monkeypatch.setattr(flat_graph, "BLOCK", 40)
    got = flat_graph.near_vectors(vectors(spark, x), shard=1000).collect()
    f = x.astype(np.float32).astype(float)
    f /= np.linalg.norm(f, axis=1, keepdims=True)
    assert sorted(q["n_links"] for q in got) == sorted(((f @ f.T >= 0.9).sum(1) - 1).tolist()) and {q["component_id"] for q in got} == {0}


def links_by_brute_force(x):
    f = np.asarray(x, np.float32).astype(float)
    f /= np.linalg.norm(f, axis=1, keepdims=True)
    hit = f @ f.T >= 0.9
    label = np.arange(len(f))
    while True:
        low = np.where(hit, label[None, :], len(f)).min(1)
        if (low == label).all():
            return (hit.sum(1) - 1).tolist(), label.tolist()
        label = low


def links_found(spark, x, **options):
    got = sorted(flat_graph.near_vectors(vectors(spark, x), **options).collect(), key=lambda q: q["vec_id"])
    return [q["n_links"] for q in got], [q["component_id"] for q in got]


def at_cosine(r, x, c):
    """A vector at cosine c to each unit row of x, in a random direction."""
    w = r.normal(size=x.shape)
    w -= (w * x).sum(1, keepdims=True) * x
    return c * x + np.sqrt(1 - c * c) * w / np.linalg.norm(w, axis=1, keepdims=True)


def directions(r, n, d):
    x = r.normal(size=(n, d))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


@pytest.mark.parametrize("d", [3, 64])
def test_pairs_are_found_however_many_centres(spark, monkeypatch, d):
    """Many centres, as in large tables; a hot group of near copies has its share of them. In three dimensions the bound prunes."""
    r = np.random.default_rng(d)
    x = directions(r, 1200, d)
    x = np.concatenate([x, at_cosine(r, x, 0.901), at_cosine(r, np.repeat(x[:1], 600, 0), 0.96)])
    monkeypatch.setattr(flat_graph, "BLOCK", 200)
    assert links_found(spark, x, shard=8) == links_by_brute_force(x)


def test_tight_clusters_in_range_of_each_other_link(spark):
    """Two clusters of 100 near copies at cosine 0.92 to each other, and a larger one elsewhere, which holds the middle."""
    r = np.random.default_rng(4)
    a, m = directions(r, 2, 64)[:, None]
    b = at_cosine(r, a, 0.92)
    x = np.concatenate([at_cosine(r, np.repeat(c, k, 0), 0.998) for c, k in ((m, 300), (a, 100), (b, 100))])
    want = links_by_brute_force(x)
    assert len(set(want[1])) == 2 and links_found(spark, x) == want


def test_links_and_components_agree(spark):
    """Groups that many centres divide: each pair of a component is counted, once."""
    r = np.random.default_rng(3)
    x = directions(r, 120, 6)
    x = np.concatenate([x, *(at_cosine(r, x[i : i + 1].repeat(70, 0), 0.96) for i in range(6))])
    assert links_found(spark, x, shard=25) == links_by_brute_force(x)


def test_vectors_with_odd_ids(spark):
    """A repeated row, a null id, clashing columns, an unusable vector without an id."""
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [2.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.1]), (None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(7) for c in ("vec", "node", "weight", "label", "root", "_vec")})
    got = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"] or 0, r["kept"]) for r in flat_graph.near_vectors(df).collect())
    assert got == [(0, 0, 0, True), (0, 3, 1, True), (1, 3, 1, True), (1, 3, 1, True), (2, 0, 2, True), (3, 3, 1, False)]


def test_components_keep_their_precision(spark):
    """Doubles that single precision would overflow, lose or take for equal."""
    c = 0.9
    rows = [(0, [1e300, 1.0]), (1, [1.0, 0.0]), (2, [1e-60, 0.0]), (3, [-1e-300, 0.0]), (4, [c, (1 - c * c) ** 0.5 * (1 - 1e-12)]), (5, [c, (1 - c * c) ** 0.5 * (1 + 1e-9)]), (6, [5e-324, 0.0])]
    got = sorted(tuple(r)[:3] for r in flat_graph.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(0, 4, 0), (1, 4, 0), (2, 4, 0), (3, 0, 3), (4, 5, 0), (5, 1, 0), (6, 4, 0)]


def test_audit_counts_what_a_result_lacks(spark, monkeypatch):
    """Several blocks of queries, vectors of two lengths and unusable ones; a result with half of the links has half the recall."""
    r = np.random.default_rng(6)
    x = directions(r, 700, 3)
    monkeypatch.setattr(flat_graph, "QUERIES", 60, raising=False)
    df = vectors(spark, [*x, [1.0, 2.0], [1.0, 2.1], None, [0.0] * 3, [float("nan")] * 3])
    want = sum(links_by_brute_force(x)[0]) + 2
    result = flat_graph.near_vectors(df)
    assert tuple(flat_graph.audit_recall(df, result, every=1).first()) == (want, want, 1.0)
    none = result.withColumn("n_links", F.when(F.col("vec_id") % 2 == 0, F.col("n_links")).otherwise(0))
    assert 0.4 < flat_graph.audit_recall(df, none, every=1).first()["recall"] < 0.6


def test_toxicity_on_held_out_texts():
    r = random.Random(3)
    texts = [prose(150, r) + (" vile" + r.choice(SYLLABLES) + " nasty " if i % 4 == 0 else " ") + prose(50, r) for i in range(400)]
    y = np.array([float(i % 4 == 0) for i in range(400)], np.float32)
    model = toxicity.fit(texts[:300], y[:300], 0.0)
    score = model.scores(*toxicity.utf8(pa.array(texts[300:] + [""])))
    assert ((score[:100] >= 0.3) == (y[300:] > 0)).mean() >= 0.95 and 0 <= score[100] <= 1

    # the forward pass in plain loops: views of a word, filters at each place, the largest answer, a linear layer
    for text, s in [(texts[300], score[0]), (texts[301], score[1]), ("", score[100]), ("one", None)]:
        ids, _ = toxicity.slots(*toxicity.utf8(pa.array([text])))
        x = [[float(v) for i in word for v in model.table[i]] for word in ids.tolist()]
        total, at = float(model.bias), 0
        for width, bank, shift in zip(toxicity.WIDTHS, model.banks, model.shifts, strict=True):
            for f in range(toxicity.FILTERS):
                best = 0.0
                for i in range(len(x)):
                    window = [v for w in (x[i : i + width] + [[0.0] * len(bank)] * width)[:width] for v in w][: len(bank)]
                    best = max(best, float(shift[f]) + sum(a * float(b) for a, b in zip(window, bank[:, f], strict=True)))
                total += best * float(model.out[at])
                at += 1
        want = 1 / (1 + np.exp(-np.clip(model.scale * total + model.offset, -30, 30)))
        assert abs(want - (model.scores(*toxicity.utf8(pa.array([text])))[0] if s is None else s)) < 1e-4


def test_thresholds_see_held_back_labels_only(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    back = {r["_id"] for r in toxicity.known_labels(labels).where("_back").collect()}
    assert 40 < len(back) < 130
    # documents held back say 0.6, all others would say 0.1
    scores = spark.createDataFrame([(i, "en", (0.65 if i in back else 0.15) if i % 2 else 0.02) for i in range(400)], "doc_id long, lang string, score double")
    cut = toxicity.thresholds(scores, labels).first()
    assert cut["_lang"] == "en" and 0.3 <= cut["_threshold"] <= 0.65


def test_training_texts_are_bounded_by_bytes(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "TRAINING_BYTES", 5000)
    monkeypatch.setattr(toxicity, "fit", lambda texts, *_: seen.extend(texts))
    texts = [prose(60) for _ in range(60)] + [prose(3000)]
    toxicity.train(docs(spark, texts), spark.createDataFrame([(i, i % 2) for i in range(61)], "doc_id long, toxic int"))
    assert 4 < len(seen) < 60 and sum(len(t.encode()) for t in seen if len(t) < 5000) <= 10_000


def test_quality_is_shrunk_by_hand(spark):
    """The posterior arithmetic in plain Python, each document left out of its own sites' rates."""
    r = random.Random(1)
    rows = [(i, f"h{i % 3}" if i % 7 else None, f"p{i % 5}", r.uniform(-4, 4)) for i in range(200)] + [(900, "lone", "lone", 1.0)]
    model = (np.zeros(len(quality.NAMES)), 0.0, 0.4)
    scored = spark.createDataFrame(rows, "doc_id long, host string, path string, ratio double")
    sums, by_host, by_path = quality.posteriors(scored, model[2])
    own = {d: 1 / (1 + np.exp(-(x + 0.4))) for d, _, _, x in rows}
    of = lambda keep: (sum(1 for q in rows if keep(q)), sum(own[q[0]] for q in rows if keep(q)))
    n, good = of(lambda q: True)
    hosts = {h: of(lambda q: q[1] == h) for h in {q[1] for q in rows}}
    paths = {(h, p): of(lambda q: (q[1], q[2]) == (h, p)) for _, h, p, _ in rows}

    def strength(groups):  # (n, good, rate)
        spread = sum(k * (g / k - m) ** 2 for k, g, m in groups)
        chance, total = sum(m * (1 - m) for *_, m in groups), sum(k for k, *_ in groups)
        mean = sum(m for *_, m in groups) / len(groups)
        return min(max(mean * (1 - mean) / max((spread - chance) / total, 1e-9), 2.0), 1000.0)

    world = (good + 1) / (n + 2)
    a = strength([(*v, world) for v in hosts.values()])
    rate = {h: (g + world * a) / (k + a) for h, (k, g) in hosts.items()}
    b = strength([(*v, rate[h]) for (h, _), v in paths.items()])
    assert abs(by_host / a - 1) < 1e-6 and abs(by_path / b - 1) < 1e-6 and sums.count() == len(paths)

    texts = docs(spark, [prose(30) for _ in range(40)] + [None, ""])
    labels = spark.createDataFrame([(i, i % 2) for i in range(0)], "doc_id long, quality int")
    for q in quality.quality(texts, labels, F.col("source"), F.col("lang")).collect():  # no labels: evidence 0, a rate of a half
        assert q["evidence"] == 0 and abs(q["score"] - 0.5) < 1e-9 and abs(q["path_rate"] - 0.5) < 1e-9


def test_archive_round_trip(spark):
    big, small = "<p>é\r\n\r\n</p>" * 20, "tiny"
    rows = [(1, "http://a\r\nx: y", big), (2, "http://b", big), (3, None, small), (4, "u", small), (5, "u", None), (2, "http://b", big), (None, "n", big), (None, "m", "lone" * 40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit(0), "row": F.lit(1), "payload": F.lit("x"), "page": F.lit(2)})
    path = f"{warc.shared_dir(spark)}/test-{random.random()}"
    warc.write_archive(df, path)
    back = warc.parsed(warc.record_bytes(warc.read_records(spark, path))).collect()
    assert sorted(b["payload"].decode() for b in back) == sorted(h or "" for _, _, h in rows)
    ids, refers = [], []
    for b in back:
        head, body = bytes(b["record"]).split(b"\r\n\r\n", 1)
        told = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        n = int(told["Content-Length"])
        assert head.startswith(b"WARC/1.1\r\n") and {"WARC-Type", "WARC-Record-ID", "WARC-Date"} <= set(told) and "x" not in told
        assert body[n:] == b"\r\n\r\n" and body[:n] == (b"" if told["WARC-Type"] == "revisit" else bytes(b["payload"])) == bytes(b["block"])
        assert told["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(bytes(b["payload"])).hexdigest() and b["head"].encode() == head
        ids.append(told["WARC-Record-ID"]), refers.append(told.get("WARC-Refers-To"))
    assert len(set(ids)) == len(ids) and {x for x in refers if x} <= set(ids)
    got = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0) for r in warc.archived(df).collect())
    assert got == [(0, "response", 0), (0, "revisit", 1), (1, "response", 0), (2, "revisit", 1), (2, "revisit", 1), (3, "response", 0), (4, "response", 0), (5, "response", 0)]
    assert warc.archived(df.limit(0)).count() == 0
    assert spark.conf.get(warc.CLEAN_UP) == "false"


def test_thousands_of_equal_payloads(spark):
    pages = spark.range(10, 5010).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 == 0, F.lit("common " * 50)).when(F.col("id") % 3 == 1, F.lit("short")).otherwise(F.concat(F.lit("x" * 120), F.col("id").cast("string"))).alias("html"))
    got = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.archived(pages).collect()}
    for i in range(10, 5010):
        want = {0: ("response", None, 350) if i == 12 else ("revisit", 12, 350), 1: ("response", None, 5), 2: ("response", None, 120 + len(str(i)))}
        assert got[i] == want[i % 3]


def test_urls_that_look_like_header_lines(spark):
    lines = [f"http://a{end}{line}" for end in "\x85\u2028\u2029\x0b\x0c" for line in ("Content-Length: 3", "WARC-Refers-To: <urn:page:77:0>", "WARC-Type: revisit")]
    rows = [(i, url, f"{text} " * 40) for i, (url, text) in enumerate([(u, t) for t in ("same", "own") for u in lines])]
    rows = [(i, u, h if h.startswith("same") else h + str(i)) for i, u, h in rows]
    got = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"]) for r in warc.archived(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: ("revisit", 0, 200) if 0 < i < len(lines) else ("response", None, len(h)) for i, _, h in rows}


def test_records_that_tell_another_length_stop_the_job(spark):
    short = spark.createDataFrame([(bytearray(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"),)], "record binary")
    with pytest.raises(Exception, match="another length"):
        warc.parsed(short).collect()


def test_token_counts_equal_the_library(spark, monkeypatch):
    path, library = queries.tokenizer("word_bpe_49k.json"), token_count_library()
    r = random.Random(5)
    texts = ["don't we're 'll 'rs ''s !'s've '' d'r'e", "", "<|endoftext|>a<|startoftext|> <|x|>", "é İ ΑΣ ﬁ ½ Ⅷ 漢字 한글 😀 a\x85b\x1cc", "x" * 3000, "'r", prose(900), "aaaa" * 50, "ha" * 77, "😁" * 40, "=-" * 99]
    texts += ["".join(r.choice("'sretvmld aB1 .!é́<|>\n") for _ in range(r.randint(0, 60))) for _ in range(500)]
    texts += ["".join(r.choice("inthearosl") for _ in range(r.randint(1, 90))) for _ in range(500)]
    texts += [t["text"] for t in queries.table(spark, SF, "documents").where("text is not null").collect()]
    want = [len(library.encode(t, add_special_tokens=False)) for t in texts]
    assert token_count.Counter(path).counts(texts).tolist() == want
    monkeypatch.setattr(token_count, "STATES", 50)
    monkeypatch.setattr(token_count, "LEXICON", 50)
    assert token_count.Counter(path).counts(texts[:300]).tolist() == want[:300]


def test_transitions_emit_what_prefixes_gain():
    """After each byte the emitted sum is the count of the prefix, and every entry of the vocabulary is one token."""
    library = token_count_library()
    machine = token_count.Counter(queries.tokenizer("word_bpe_49k.json")).machine
    model = machine.entry
    assert sum(i >= 0 for i in model) == 49406 and max(machine.depth) == 32
    for word in ("inthethere", "understanding", "straßenbahn", "aaaaaaaaaaaaa"):
        data = word.encode()
        for n in range(1, len(data) + 1):
            try:
                text = data[:n].decode()
            except UnicodeDecodeError:
                continue
            assert machine.count(data[:n]) == len(library.encode(text, add_special_tokens=False))


def test_prefix_scan_equals_one_pass():
    c = np.random.default_rng(0).integers(0, 10, 5000).astype(np.uint8)
    assert (token_count.starts_by_scan(c, 37) == token_count.starts_by_scan(c, 5000)).all()


def test_mix_meets_targets(spark):
    texts = [prose(R.randint(1, 60)) for _ in range(200)]
    got = mixing.mix(docs(spark, texts)).select("doc_id", "source", *(F.col(c).alias(c[1:]) for c in ("_size", "_source_size", "_target", "_whole", "_extra"))).toPandas()
    got["taken"] = got["size"] * got["whole"] + got["extra"]
    by = got.groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"), cap=("source_size", "first"))
    assert (abs(by["taken"] - by["target"]) <= 1).all() and abs(by["target"].sum() - by["size"].sum()) < 1e-6 * by["size"].sum()
    assert (got["taken"] <= 3 * got["size"]).all() and (by["size"] == by["cap"]).all()
    out = mixing.mixed_documents(docs(spark, texts))
    assert out.columns == docs(spark, texts).columns and out.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3




def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    how = queries.byte_bpe()
    texts = [prose(R.randint(0, 1500)) for _ in range(20)] + [None, "", "a<|endoftext|>b 漢字"]
    library = Tokenizer.from_file(how["json_path"])
    ids = [[*library.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]
    rows = packing.packed(docs(spark, texts), **how).orderBy("doc_id", "start").collect()
    at = dict.fromkeys(range(len(texts)), 0)
    for r in rows:
        d, n = r["doc_id"], r["length"]
        assert r["start"] == at[d] and n & n - 1 == 0 and n <= 2048 and r["offset"] == 0 and r["doc_tokens"] == len(ids[d])
        assert r["ids_crc32"] == zlib.crc32(np.array(ids[d][at[d] : at[d] + n], "<u4").tobytes())
        at[d] += n
    assert all(at[d] == len(ids[d]) for d in at) and sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    assert [r["length"] for r in sorted(rows, key=lambda r: r["sequence_id"])] == sorted(r["length"] for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, oracle, name):
    assert canonical(queries.QUERIES[name](spark, SF).toPandas()) == oracle(queries.ORACLE[name])


def test_quality_of_documents_not_used_in_the_fit(spark):
    where = SF.replace("0.001", "0.01")
    docs, labels = queries.table(spark, where, "documents"), queries.table(spark, where, "labels")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    out = quality.quality(docs, labels.where(~rest), F.col("source"), F.concat_ws("/", "source", "lang")).join(labels.where(rest), "doc_id").toPandas()
    assert len(out) > 40 and ((out["quality"] == 1) == out["kept"]).mean() > 0.9


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline as p

    start = queries.table(spark, SF, "documents")
    frames = [start]
    for name, stage in p.STAGES:
        frames.append(p.materialize(stage(spark, frames[-1], SF), f"test-{name}"))
        if name != "packing":
            assert frames[-1].columns == start.columns
    ids = [set(r[0] for r in f.select("doc_id").distinct().collect()) for f in frames]
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    texts = {r["doc_id"]: r["text"] for r in frames[1].collect()}
    kept = brute_components([texts[i] for i in sorted(texts)], 5, 80)
    assert ids[2] == {sorted(texts)[i] for i, _, _, k in kept if k}
    assert frames[5].groupBy("doc_id").agg(F.sum("length")).count() == len(ids[4])
