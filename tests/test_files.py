"""Sources: blocks that can't be flattened, seeds that contradict each other, prices of single precision, valid input."""

import json
import os

import numpy as np
from pyspark.sql import functions as F

from coinloom import functions as fn
from coinloom import sources
from coinloom.operators import diffs, exchanges, prices
from coinloom.plans import files
from coinloom.plans.queries import ORACLE
from coinloom.schemas import SEEDS
from coinloom.shared import materialize
from coinloom.sources import seeds
from coinloom.streaming.blocks import BlockFiles
from conftest import SF, canonical

ADDRESSES = "id long, address string"


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def block(height, ident=None, txs=(), **header):
    return {"header": {"id": ident or f"h{height}", "parentId": f"h{height - 1}", "height": height, "timestamp": height, "difficulty": "1", "votes": "000000"} | header, "blockTransactions": {"transactions": list(txs)}, "extension": {"fields": []}}


def tx(ident="t", outputs=({"boxId": "b", "value": 1},)):
    return {"id": ident, "inputs": [], "dataInputs": [], "outputs": None if outputs is None else list(outputs)}


def test_blocks_are_checked(spark, tmp_path):
    lines = [block(1, txs=[tx()]), block(1, txs=[tx()]), block(2), block(3, txs=[tx(None)]), block(4, txs=[tx(outputs=None)]), block(5, txs=[tx(), tx(outputs=[{"boxId": "c"}])]), block(6, txs=[tx()], timestamp=None), block(7, txs=[tx(outputs=[])]), {"header": None}]
    text = [json.dumps(b) for b in lines]
    (tmp_path / "low.json").write_text("\n".join([*text, text[0][:40], "", "[1]", "no json"]) + "\n")
    (tmp_path / "high.json").write_text("\n".join([text[0], json.dumps(block(8, txs=[tx()]))]))
    good, bad = sources.checked_blocks(sources.read_blocks(spark, str(tmp_path)))
    assert rows(good, "header.height") == [(1,), (7,), (8,)]
    told = rows(bad, "height", "reason")
    assert [r for r in told if r[0] is not None and r[1] != "no header"] == [(2, "no transactions"), (3, "broken transaction"), (4, "broken transaction"), (5, "broken transaction")]
    assert sum(r[1] == "no header" for r in told) == 5  # no time, a null header, a line cut off, a list, no json
    assert good.columns == sources.read_blocks(spark, str(tmp_path)).columns
    flat = sources.flatten_blocks(good)
    assert rows(flat["outputs"], "height", "box_id") == [(1, "b"), (8, "b")]
    none = sources.checked_blocks(good.limit(0))
    assert none[0].count() == none[1].count() == 0


def test_blocks_with_equal_heights_stay(spark, tmp_path):
    (tmp_path / "b.json").write_text("\n".join(json.dumps(block(1, i, [tx()])) for i in ("x", "y", "x")))
    good, bad = sources.checked_blocks(sources.read_blocks(spark, str(tmp_path)))
    assert rows(good, "header.id") == [("x",), ("y",)] and bad.isEmpty()


def test_block_files_are_followed(spark, tmp_path):
    def one(branch, height, spends, parent=None):
        t = {"id": f"t{height}", "inputs": [{"boxId": spends}], "dataInputs": [], "outputs": [{"boxId": f"{branch}{height}", "value": height, "ergoTree": "x"}]}
        return json.dumps(block(height, f"{branch}{height}", [t], parentId=f"{parent or branch}{height - 1}"))

    source, book = tmp_path / "in", BlockFiles(spark, str(tmp_path / "book"), 2)
    source.mkdir()
    (source / "1.json").write_text("\n".join([one("a", 1, "g"), one("a", 2, "a1"), "{cut", one("a", 3, "a2"), one("a", 3, "a2")]))
    book.follow(str(source))
    assert rows(book.unspent(), "box_id", "value") == [("a3", 3)] and rows(book.spent(), "height", "box_id", "value") == [(2, "a1", 1), (3, "a2", 2)]
    (source / "2.json").write_text("\n".join([one("a", 3, "a2"), one("a", 4, "a3")]))
    book.follow(str(source))
    (source / "3.json").write_text("{}\n[")
    book.follow(str(source))
    assert rows(book.unspent(), "box_id") == [("a4",)] and rows(book.outputs(), "height") == [(1,), (2,), (3,), (4,)]
    (source / "4.json").write_text("\n".join([one("b", 3, "a2", "a"), one("b", 4, "b3"), one("b", 5, "b4")]))
    book.follow(str(source))
    assert rows(book.unspent(), "box_id") == [("b5",)] and rows(book.outputs(), "box_id") == [("a1",), ("a2",), ("b3",), ("b4",), ("b5",)]
    assert rows(book.rejected(), "reason", "batch") == [("no header", 0), ("no header", 2), ("no header", 2)]


def test_seeds_are_checked(spark, tmp_path):
    names = spark.createDataFrame([(1, "a", "A"), (1, "a", "A"), (2, "b", None), (3, "c", "C"), (3, "c", "D"), (None, "d", "D")], "cex_id int, text_id string, name string")
    good, bad = seeds.checked_seed(names.withColumn("reason", F.lit("a column of this name")), "exchanges")
    assert rows(good) == [(1, "a", "A"), (2, "b", None)]
    assert rows(bad) == sorted([(3, "c", "C", "contradiction"), (3, "c", "D", "contradiction"), (None, "d", "D", "no key")], key=str)
    main = spark.createDataFrame([(1, "x1"), (2, "x1"), (2, "x2"), (2, "x2"), (3, "x3"), (None, "x4"), (1, None), (1, ""), (1, "x 5"), (1, "x6\n")], "cex_id int, address string")
    found, rejected = seeds.checked_seed(main, "main_addresses", good)
    assert rows(found, "cex_id", "address") == [(2, "x2")]
    told = {(r["cex_id"], r["address"]): r["reason"] for r in rejected.collect()}
    assert told == {(1, "x1"): "contradiction", (2, "x1"): "contradiction", (3, "x3"): "no exchange", (None, "x4"): "no exchange", (1, None): "no key", (1, ""): "no address", (1, "x 5"): "no address", (1, "x6\n"): "no address"}
    for kind in SEEDS:
        empty = seeds.read_seed(spark, str(empty_folder(tmp_path, kind)), kind)
        assert all(df.isEmpty() for df in seeds.checked_seed(empty, kind, good if kind == "main_addresses" else None))


def empty_folder(path, name):
    (path / name).mkdir()
    (path / name / "none.json").write_text("")
    return path / name


def test_seeds_from_csv_and_json_are_alike(spark, tmp_path):
    (tmp_path / "m.csv").write_text("address,label,mining_pool\nx1,one,\nx2,,p\n")
    (tmp_path / "m.json").write_text('{"address": "x1", "label": "one"}\n{"address": "x2", "mining_pool": "p", "more": 1}\n')
    one, two = (seeds.read_seed(spark, str(tmp_path / f"m.{form}"), "miners", form) for form in ("csv", "json"))
    assert rows(one) == rows(two) == [("x1", "one", None), ("x2", None, "p")]


def test_seeds_wait_for_the_dictionary(spark):
    main = spark.createDataFrame([(1, "x1"), (2, "x2")], "cex_id int, address string")
    early = spark.createDataFrame([(11, "x1")], ADDRESSES)
    found, pending = seeds.resolved(main, early)
    assert rows(found, "address_id", "cex_id") == [(11, 1)] and rows(pending) == rows(main.where("cex_id = 2"))
    again, pending = seeds.resolved(pending, early.union(spark.createDataFrame([(21, "x2")], ADDRESSES)))
    assert rows(again, "address_id", "cex_id") == [(21, 2)] and pending.isEmpty()
    # what is ignored pays no exchange
    moved = spark.createDataFrame([(1, 0, 31, -5), (1, 0, 11, 5), (2, 0, 41, -5), (2, 0, 11, 5)], "height long, tx_idx long, address_id long, nano long")
    told = exchanges.deposit_addresses(exchanges.deposit_candidates(moved, found, spark.createDataFrame([(41,)], "address_id long")))
    assert rows(told) == [(31, 1, 1)]


def test_prices_of_single_precision(spark):
    r = np.random.default_rng(5)
    times = np.cumsum(r.integers(1_000_000, 4_000_000, 40)) + 1_563_159_993_440
    values = r.random(40) * 10
    asked = np.sort(r.integers(times[0], times[-1], 200))
    blocks = spark.createDataFrame([(int(h), int(t)) for h, t in enumerate([0, *asked, times[-1] + 5])], "height long, timestamp long")
    points = spark.createDataFrame([(int(t), float(v)) for t, v in zip(times, values, strict=True)], "timestamp long, price double")
    got = {h: (p, late) for h, p, late in rows(prices.interpolated(blocks, points, 0, single=True))}
    f = np.float32
    at = np.searchsorted(times, asked, "left") - 1
    at = np.maximum(at, 0)
    want = f(values)[at] + (f(values)[at + 1] - f(values)[at]) * (f(asked - times[at]) / f(times[at + 1] - times[at]))
    assert [got[i + 1] for i in range(200)] == [(float(p), False) for p in want]
    assert got[0] == (float(f(5.581469768257971)), False) and got[201] == (float(f(values[-1])), True)
    assert dict(prices.interpolated(blocks, points, 0).dtypes)["price"] == "double"


def test_valid_input(spark):
    texts = ["a0", "", None, "a\n", "é", "A-", "9" + "0" * 50, "9" + "0" * 49, "8" + "0" * 50, "f" * 64, "f" * 65, "f" * 64 + "\n"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    told = [[r[k] for r in df.orderBy("i").select(*(fn.valid(F.col("t"), k).alias(k) for k in fn.PATTERNS)).collect()] for k in fn.PATTERNS]
    assert [[i for i, ok in enumerate(t) if ok] for t in told] == [[0, 6, 7, 8, 9, 10], [9], [6]]


def test_addresses_are_base58(spark):
    texts = ["a1", "9xyz", "a0", "O", "I", "l", "", None, "a\n", "é"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in df.where(fn.base58(F.col("t"))).select("i").orderBy("i").collect()] == [0, 1]


def test_slices_are_written_compressed(spark):
    folders = files.slices(spark, SF)
    stored = [os.path.join(f, n) for f in folders for n in os.listdir(f) if n.startswith("part-")]
    assert stored and all(n.endswith(".gz") for n in stored)
    text = sum(len(r[0]) for r in spark.read.text(folders).collect())
    assert sum(map(os.path.getsize, stored)) < text / 3


def broadcasts(df):
    """The joins of a plan that broadcast a side, but for those on the rows that ordered_rank has for each partition."""
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    return [line for line in plan if "Broadcast" in line and "Join" in line and "_part#" not in line]


def test_diffs_of_files_broadcast_no_dictionary_and_no_boxes(spark, oracle):
    got = files.file_diffs(spark, SF)
    assert not broadcasts(got)
    assert canonical(got.toPandas()) == oracle(ORACLE["file_diffs"])


def test_what_grows_with_the_chain_is_not_broadcast(spark):
    df = lambda rows, schema: materialize(spark.createDataFrame(rows, schema), "table")
    boxes = df([(1, 0, 0, "b1", "x", 5), (1, 0, 1, "b2", "y", 6)], "height int, tx_idx int, out_idx int, box_id string, address string, value long")
    reads = df([(2, 0, "b1"), (2, 1, "b9")], "height int, tx_idx int, box_id string")
    tokens = df([(1, 0, 0, [("k",)]), (1, 0, 1, [("m",)])], "height int, tx_idx int, out_idx int, assets array<struct<token_id: string>>")
    known, ids = df([(13, 1, "x")], "id long, spot_height int, address string"), df([(13, "x")], ADDRESSES)
    minted = df([(1, 1, "k")], "asset_id long, spot_height int, token_id string")
    found, pending = seeds.resolved(df([(1, "x"), (2, "z")], "cex_id int, address string"), ids)
    told = {
        "expand_inputs": (diffs.expand_inputs(reads, boxes).select("height", "tx_idx", "box_id", "output_height", "value"), [(2, 0, "b1", 1, 5)]),
        "expand_data_inputs": (diffs.expand_data_inputs(reads, boxes).select("box_id", "value"), [("b1", 5), ("b9", None)]),
        "unspent_boxes": (diffs.unspent_boxes(boxes, reads).select("box_id"), [("b2",)]),
        "lookup": (diffs.lookup(boxes, ids, "address", "id").select("address", "id"), [("x", 13), ("y", None)]),
        "index_addresses": (diffs.index_addresses(boxes, known), [(13, 1, "x"), (23, 1, "y")]),
        "index_tokens": (diffs.index_tokens(tokens, minted), [(1, 1, "k"), (2, 1, "m")]),
        "found": (found, [(1, "x", 13)]),
        "pending": (pending, [(2, "z")]),
    }
    for name, (got, want) in told.items():
        assert not broadcasts(got), name
        assert rows(got) == want, name
