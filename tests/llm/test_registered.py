"""The registered functions as they are called: op1's score by hand, op6's held-out rule, the others' digests, and the pipeline."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from coinloom.llm import chunk_dedup, fingerprint, quality, queries, toxicity
from conftest import SF


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_scores_of_quality_by_hand(spark, documents):
    """Evidence from the fitted weights, rates of the other documents, shrunk from world to host to path, and the odds of both."""
    docs, labels = (queries.table(spark, SF, n) for n in ("documents", "labels"))
    weights, intercept, prior = quality.train(docs, labels, "doc_id", "text", "quality")
    ratio = {i: float(np.clip(np.array(quality.features(d["text"] or "")) @ weights + intercept - prior, -30, 30)) for i, d in documents.items()}
    own = {i: 1 / (1 + np.exp(-(x + prior))) for i, x in ratio.items()}
    host = {i: d["source"] for i, d in documents.items()}
    path = {i: "/".join(x for x in (d["source"], d["lang"]) if x is not None) for i, d in documents.items()}
    scored = spark.createDataFrame([(i, host[i], path[i], ratio[i]) for i in documents], "doc_id long, host string, path string, ratio double")
    _, by_host, by_path = quality.posteriors(scored, prior)
    members = lambda keep: [i for i in documents if keep(i)]

    def rest(i, group):  # count and good of a group without i
        return len(group) - 1, max(sum(own[k] for k in group) - own[i], 0.0)

    got = {r["doc_id"]: r for r in queries.op1_quality(spark, SF).collect()}
    assert set(got) == set(documents) and np.std([r["score"] for r in got.values()]) > 0.1
    for i in list(documents)[:60]:
        n, good = rest(i, list(documents))
        world = (good + 1) / (n + 2)
        n, good = rest(i, members(lambda k: host[k] == host[i]))
        at_host = (good + world * by_host) / (n + by_host)
        n, good = rest(i, members(lambda k: (host[k], path[k]) == (host[i], path[i])))
        at_path = (good + at_host * by_path) / (n + by_path)
        score = 1 / (1 + np.exp(-(ratio[i] + np.log(at_path / (1 - at_path)))))
        r = got[i]
        assert np.allclose((r["evidence"], r["host_rate"], r["path_rate"], r["score"]), (ratio[i], at_host, at_path, score), rtol=1e-6) and r["kept"] == (r["score"] >= 0.5)


def test_features_of_texts():
    f = dict(zip(quality.NAMES, quality.features("Aa bb bb! CCC 12 | aa.\nAa bb\nAa bb\n"), strict=True))
    assert quality.features("") == quality.features(" \n") == [0.0] * len(quality.NAMES)
    assert f["words"] == np.log1p(11) / 8 and f["distinct"] == 7 / 11 and f["repeat_run"] == 0 and f["upper"] == 1 / 11 and f["bars"] == 1 / 11
    assert f["lines"] == 3 / 11 * 5 and f["repeated_lines"] == 1 - 2 / 3 and f["ends"] == 2 / 11 and f["exclaim"] == 1 / 11 and f["top_word"] == 3 / 11


def test_held_out_labels_are_not_learned(spark, monkeypatch, documents):
    """Turning every held-out label round changes no score and no threshold."""
    held = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in documents}
    seen, train = [], toxicity.train

    def noted(docs, labels, **how):
        seen.append({r["doc_id"] for r in labels.collect()})
        return train(docs, labels, **how)

    monkeypatch.setattr(toxicity, "train", noted)
    first = {r["doc_id"]: r for r in queries.op6_toxicity(spark, SF).collect()}
    read = queries.table

    def turned(s, d, name):
        t = read(s, d, name)
        out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
        return t.withColumn("toxic", F.when(out, 1 - F.col("toxic")).otherwise(F.col("toxic"))) if name == "labels" else t

    monkeypatch.setattr(queries, "table", turned)
    second = {r["doc_id"]: r for r in queries.op6_toxicity(spark, SF).collect()}
    assert first == second and seen[0] and not any(held[i] for s in seen for i in s)
    for i, r in first.items():
        assert r["held_out"] == held[i] and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_digests_of_texts(spark, documents):
    ids = sorted(documents)
    got = {r["doc_id"]: r for r in queries.op2_fingerprint(spark, SF).collect()}
    for k, i in enumerate(ids):
        text, after = documents[i]["text"] or "", documents[ids[(k + 1) % len(ids)]]["text"] or ""
        n = len(text) // 4
        new = text[: len(text) - n] + after[:n]
        assert got[i]["n_chars"] == len(text) and got[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert [got[i]["fingerprint"], got[i]["edited_fingerprint"]] == fingerprint.text_of(fingerprint.digests([text, new]))
    for r in queries.op3_substring_dedup(spark, SF).collect():
        raw, spans = (documents[r["doc_id"]]["text"] or "").encode(), [(s["start"], s["end"]) for s in r["removed"]]
        left = b"".join(raw[a:b] for a, b in zip([0, *(e for _, e in spans)], [*(s for s, _ in spans), len(raw)], strict=True))
        assert r["kept_sha256"] == hashlib.sha256(left).hexdigest() and r["n_spans"] == len(spans) and r["removed_bytes"] == sum(e - s for s, e in spans) and all(e - s >= chunk_dedup.MIN_RUN for s, e in spans)


def test_tokens_of_texts(spark, documents):
    from tokenizers import Tokenizer

    words, pieces = Tokenizer.from_file(queries.tokenizer("word_bpe_49k.json")), Tokenizer.from_file(queries.tokenizer("byte_bpe_50k.json"))
    for r in queries.op8_token_counts(spark, SF).collect():
        text = documents[r["doc_id"]]["text"] or ""
        n = len(words.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 2048)
    packed = {}
    for r in queries.op10_packing(spark, SF).collect():
        packed.setdefault(r["doc_id"], []).append(r)
    assert set(packed) == set(documents)
    for i, rows in packed.items():
        ids = [*pieces.encode(documents[i]["text"] or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(rows, key=lambda r: r["start"]):
            own = ids[at : at + r["length"]]
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["length"] & (r["length"] - 1) == 0 and r["ids_crc32"] == zlib.crc32(np.array(own, "<u4").tobytes())
            at += r["length"]
        assert at == len(ids)


def test_the_pipeline_runs_its_stages(spark, monkeypatch, documents):
    """Each stage works on what the one before kept, with the columns of documents; what is packed is what mixing took."""
    import corpus_pipeline as p

    seen, write = {}, p.materialize
    monkeypatch.setattr(p, "materialize", lambda df, name: seen.setdefault(name, write(df, name)))
    got = sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in queries.pipeline(spark, SF).collect())
    stages = [seen[f"stage-{name}"] for name, _ in p.STAGES]
    kept = [df.count() for df in stages[:-1]]
    assert all(df.columns == queries.table(spark, SF, "documents").columns for df in stages[:-1])
    assert len(documents) > kept[0] > kept[1] >= kept[2] > 0 and {r["doc_id"] for r in stages[1].collect()} <= {r["doc_id"] for r in stages[0].collect()}
    assert got == sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in p.packed(spark, stages[3], SF).collect()) and {g[0] for g in got} <= set(documents)
