"""State kept by batches: equal to one pass over everything, rewriting no more than it must, whoever dies in between."""

import datetime
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from coinloom import streaming
from coinloom.operators import balances as bal
from coinloom.operators import exchanges, metrics, prices
from coinloom.plans import incremental
from coinloom.streaming import detection, keyed, state, tables
from conftest import SF

A, B, C = 1001, 1002, 1003
DIFF = "address_id long, height long, tx_idx long, nano long"
TS = 1563159993440


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def files(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def plain_ages(moved, upto):
    """Balances and means in plain Python, from diffs in order."""
    held = {}
    for a, h, _, n in sorted(moved, key=lambda r: (r[1], r[2])):
        if h <= upto:
            b, m = held.get(a, (0, 0))
            if n > 0:
                q, of = m * b + (TS + h) * n, b + n
                m = abs(q) // abs(of) * (1 if (q < 0) == (of < 0) else -1) if of else 0
            b += n
            held[a] = (b, m if b else 0)
    return sorted((a, b, m) for a, (b, m) in held.items() if b > 0)


def some_diffs(n=60, addresses=25, seed=1):
    r = random.Random(seed)
    moved = [(1000 + r.randrange(addresses), h, tx, r.choice([r.randint(1, 10**9), -r.randint(1, 10**9)])) for h in range(n) for tx in range(r.randint(0, 6))]
    totals = {}
    for i, (a, h, tx, v) in enumerate(moved):  # some balances end at zero
        if i % 17 == 0 and totals.get(a):
            moved[i] = (a, h, tx, -totals[a])
        totals[a] = totals.get(a, 0) + moved[i][3]
    return moved


@pytest.fixture
def chain_of(spark):
    def make(moved, lo, hi):
        some = [m for m in moved if lo <= m[1] <= hi]
        return spark.createDataFrame(some, DIFF), spark.createDataFrame([(h, TS + h) for h in range(lo, hi + 1)], "height long, timestamp long")

    return make


def test_batches_of_state_equal_one_pass(spark, tmp_path, chain_of):
    moved, path = some_diffs(), str(tmp_path / "s")
    for number, (lo, hi) in enumerate([(0, 29), (30, 30), (31, 44), (45, 59)]):
        state.advance(spark, path, number, *chain_of(moved, lo, hi), parts=8)
        assert rows(state.balances(spark, path)) == plain_ages(moved, hi)
    state.advance(spark, path, 4, *chain_of(moved, 20, 59), parts=8)  # known blocks under another number
    state.advance(spark, path, 3, *chain_of(moved, 45, 59), parts=8)  # the last batch once more
    state.advance(spark, path, 1, *chain_of(moved, 30, 30), parts=8)  # an old one
    assert rows(state.balances(spark, path)) == plain_ages(moved, 59)
    assert {r[0] for r in rows(state.state_log(spark, path), "height")} == {h for _, h, _, _ in moved if h > 39}
    assert rows(state.balances(spark, path)) == rows(bal.mean_age(*chain_of(moved, 0, 59)))


def test_a_batch_rewrites_the_parts_of_its_keys(spark, tmp_path, chain_of):
    moved, path = [(a, 0, a, 5) for a in range(200)], str(tmp_path / "s")
    state.advance(spark, path, 0, *chain_of(moved, 0, 0), parts=16)
    before = files(f"{path}/balances")
    state.advance(spark, path, 1, *chain_of([(7, 1, 0, 1), (8, 1, 1, -5)], 1, 1), parts=16)
    touched = {f"part={r[0]}" for r in spark.createDataFrame([(7,), (8,)], "address_id long").select(tables.hash_part(["address_id"], 16)).collect()}
    assert {f.split("/")[0] for f in before ^ files(f"{path}/balances")} == touched
    assert state.balances(spark, path).count() == 199


def test_blocks_are_undone_by_the_log(spark, tmp_path, chain_of):
    moved, other, path = some_diffs(), some_diffs(seed=2), str(tmp_path / "s")
    state.advance(spark, path, 0, *chain_of(moved, 0, 49), parts=8)
    with pytest.raises(ValueError, match="horizon"):
        state.revert(spark, path, 1, 29, parts=8)
    for number in (1, 1):
        state.revert(spark, path, number, 40, parts=8)
        assert rows(state.balances(spark, path)) == plain_ages(moved, 39)
    mixed = [m for m in moved if m[1] < 40] + [m for m in other if m[1] >= 40 and m[1] not in (43, 44)]  # blocks without diffs
    state.advance(spark, path, 2, *chain_of(mixed, 40, 46), parts=8)
    assert rows(state.balances(spark, path)) == plain_ages(mixed, 46)
    state.revert(spark, path, 3, 43, parts=8)  # the old branch's log of these heights is gone
    assert rows(state.balances(spark, path)) == plain_ages(mixed, 42)
    state.revert(spark, path, 4, 31, parts=8)
    assert rows(state.balances(spark, path)) == plain_ages(moved, 30)


def test_a_batch_that_died_is_put_in_place_again(spark, tmp_path, chain_of, monkeypatch):
    moved, path = some_diffs(), str(tmp_path / "s")
    state.advance(spark, path, 0, *chain_of(moved, 0, 39), parts=8)
    put = tables.replace_parts

    def dies(rows, to):
        if to.endswith("/log"):
            raise RuntimeError("died")
        put(rows.where("part % 2 = 0"), to)  # half of the parts have been replaced

    monkeypatch.setattr(tables, "replace_parts", dies)
    with pytest.raises(RuntimeError):
        state.advance(spark, path, 1, *chain_of(moved, 40, 59), parts=8)
    monkeypatch.setattr(tables, "replace_parts", put)
    state.advance(spark, path, 1, *chain_of(moved, 40, 59), parts=8)
    assert rows(state.balances(spark, path)) == plain_ages(moved, 59)
    state.revert(spark, path, 2, 45, parts=8)
    assert rows(state.balances(spark, path)) == plain_ages(moved, 44)


def test_statistics_add_once(spark, tmp_path):
    path, schema = str(tmp_path / "s"), "service long, tx_count long, first_tx long, last_tx long, fees long, volume long"
    one = spark.createDataFrame([(None, 1, 5, 6, 7, 8), (3, 1, 1, 2, -3, 4)], schema)
    two = spark.createDataFrame([(3, 2, 0, 9, 1, 1), (4, 1, 1, 1, 1, 1)], schema)
    for number, part in ((0, one), (0, one), (1, two), (1, two), (0, one)):
        state.add_stats(spark, path, number, part)
    assert rows(state.stats(spark, path)) == [(0, 1, 5, 6, 7, 8), (3, 3, 0, 9, -2, 5), (4, 1, 1, 1, 1, 1)]


def test_ages_from_stored_spans(spark, tmp_path, chain_of):
    moved, path = some_diffs(), str(tmp_path / "s")
    diffs, headers = chain_of(moved, 0, 59)
    at = lambda h: rows(state.mean_age_at(spark, path, diffs, headers, h, 10))
    assert at(34) == plain_ages(moved, 34) and {r[0] for r in rows(spark.read.parquet(f"{path}/spans"), "spans") if r[0]} == {2, 3}
    late = diffs.where("height >= 30")  # what lies before the stored states isn't read
    assert rows(state.mean_age_at(spark, path, late, headers, 39, 10)) == plain_ages(moved, 39)
    assert at(25) == plain_ages(moved, 25) and at(59) == plain_ages(moved, 59) and at(3) == plain_ages(moved, 3)
    assert rows(bal.folded(diffs.join(headers, "height")).where("height is null and nano > 0").drop("height")) == plain_ages(moved, 59)


HEAD = "height long, header_id string, parent_id string"


def test_a_late_orphan_and_a_lower_branch(spark, tmp_path):
    chain = streaming.Chain(spark, str(tmp_path / "chain"), {"nano": streaming.DIFFS}, span=3)
    def feed(branch, lo, hi, n, parent="a", fork=0):
        heads = [(h, f"{branch}{h}", f"{parent if h - 1 < fork else branch}{h - 1}") for h in range(lo, hi + 1)]
        facts = [(A, h, 0, n) for h in range(lo, hi + 1) if h % 4]
        return chain.follow(spark.createDataFrame(heads, HEAD), {"nano": spark.createDataFrame(facts, streaming.DIFFS)})

    total = lambda: [r[1] for r in rows(chain.tables["nano"].balances())]
    assert feed("a", 1, 9, 1) == 1 and total() == [7]
    assert feed("b", 7, 9, 100, fork=7) is None and total() == [7]  # as high: it waits
    assert feed("b", 10, 12, 100, fork=7) == 7 and total() == [5 + 400]
    assert feed("a", 7, 12, 1) is None and total() == [405]  # late blocks of the old branch, and some more
    assert feed("a", 13, 13, 1) == 7 and total() == [5 + 5]  # and back, with the blocks that were kept
    assert rows(chain.headers.diffs(), "header_id") == sorted((f"a{h}",) for h in range(1, 14))
    with pytest.raises(ValueError, match="height 15"):
        feed("c", 15, 15, 1)
    # whoever dies after the chain was cut goes over when the batch comes again
    seen = chain._go
    chain._go = lambda *_: (_ for _ in ()).throw(RuntimeError("died"))
    with pytest.raises(RuntimeError):
        feed("b", 13, 14, 100, fork=7)
    chain._go = seen
    assert feed("b", 13, 14, 100, fork=7) == 7 and total() == [5 + 600]


def test_what_lies_above_the_head_does_not_come_back(spark, tmp_path):
    book = streaming.Ledger(spark, str(tmp_path / "b"), span=4)
    of = lambda *h: spark.createDataFrame([(A, i, 0, 1) for i in h], DIFF)
    book.append(of(*range(16)))
    kept = {f for f in files(f"{tmp_path}/b/diffs") if f.split("/")[0] in ("part=0",)}
    book.roll_back(6)
    assert book.head() == 5 and rows(book.balances()) == [(A, 6)]
    book.append(of(15))  # nothing at heights 6 to 14 on this branch
    assert rows(book.diffs(), "height") == [(h,) for h in (0, 1, 2, 3, 4, 5, 15)] and kept <= files(f"{tmp_path}/b/diffs")
    assert rows(book.since(5), "height") == [(5,), (15,)]


def test_a_long_batch_makes_few_parts(spark, tmp_path):
    book = streaming.Ledger(spark, str(tmp_path / "b"), span=5)
    some = lambda lo, hi, n=1: spark.range(lo, hi).select(F.lit(A).cast("long").alias("address_id"), F.col("id").alias("height"), F.lit(0).cast("long").alias("tx_idx"), F.lit(n).cast("long").alias("nano"))
    parts = lambda: {f.split("/")[0] for f in files(f"{tmp_path}/b/diffs")}
    book.append(some(0, 3001))
    assert len(parts()) <= 45 and len(files(f"{tmp_path}/b/diffs")) <= 2 * len(parts())
    assert [book.since(h).count() for h in (0, 77, 1500, 2994, 3000)] == [3001, 2924, 1501, 7, 1]
    before = files(f"{tmp_path}/b/diffs")
    book.append(some(2990, 3003))
    assert sum(f not in files(f"{tmp_path}/b/diffs") for f in before) <= 2  # a block more rewrites its own part alone
    book.drop_from(1234)  # into a run of spans, farther than a rollback goes
    book.append(some(1236, 1300, 2))
    assert rows(book.diffs(), "height", "nano") == [(h, 1) for h in range(1234)] + [(h, 2) for h in range(1236, 1300)]
    book.append(some(1300, 6000, 3))
    assert rows(book.balances()) == [(A, 1234 + 128 + 3 * 4700)] and book.since(1299).count() == 4701
    assert rows(book.since(5998), "height") == [(5998,), (5999,)]


BLOCKS = "height long, tx_idx long, address_id long, nano long"


def test_deposits_by_blocks(spark, tmp_path):
    """A pays two exchanges in different blocks: found, then lost, with its history; B pays one; C two in one block."""
    main = spark.createDataFrame([(11, 1), (12, 2)], "address_id long, cex_id int")
    all_rows = [(0, 0, C, 9), (1, 0, A, 20), (1, 1, B, 30), (1, 2, A, -5), (1, 2, 11, 5), (2, 0, A, -5), (2, 0, 12, 5), (2, 1, B, -1), (2, 1, 11, 1), (3, 0, C, -2), (3, 0, 11, 2), (3, 1, C, -2), (3, 1, 12, 2), (4, 0, A, -1), (4, 0, 11, 1), (5, 0, B, 7)]
    history, headers, path = spark.createDataFrame(all_rows, BLOCKS), spark.createDataFrame([(h,) for h in range(6)], "height long"), str(tmp_path / "d")
    for h in range(6):
        for _ in range(1 + (h == 2)):
            detection.detect(spark, path, h, history.where(F.col("height") == h), history, main, parts=4, span=2)
        if h not in (1, 2, 5):
            continue
        done = history.where(F.col("height") <= h)
        cand = exchanges.deposit_candidates(done, main)
        assert rows(detection.deposits(spark, path)) == rows(exchanges.deposit_addresses(cand))
        assert sorted(map(str, rows(detection.conflicts(spark, path)))) == sorted(map(str, rows(exchanges.deposit_conflicts(cand))))
        assert rows(detection.supply(spark, path, headers.where(F.col("height") <= h))) == rows(exchanges.exchange_supply(done, main, exchanges.deposit_addresses(cand), headers.where(F.col("height") <= h)))
        if h == 1:
            assert rows(detection.supply(spark, path, headers.where("height <= 1"))) == [(0, 0, 0), (1, 5, 15)]
    assert rows(detection.supply(spark, path, headers.where("height <= 2"))) == [(0, 0, 0), (1, 5, 30), (2, 11, 29)]


def test_only_the_tail_is_written_anew(spark, tmp_path):
    path, main = str(tmp_path / "s"), spark.createDataFrame([(11, 1)], "address_id long, cex_id int")
    moved = spark.createDataFrame([(0, 0, 11, 5), (3, 0, B, 4), (6, 0, C, 8), (9, 0, C, 1), (11, 0, B, -1)], BLOCKS)
    headers = spark.createDataFrame([(h,) for h in range(12)], "height long")
    none = spark.createDataFrame([], "address_id long, cex_id int, spot_height long")
    found = spark.createDataFrame([(B, 1, 3)], none.schema)
    detection.write_series(exchanges.exchange_supply(moved, main, found, headers), path, 3)
    before = files(path)
    then = main.unionByName(spark.createDataFrame([(C, 1)], main.schema))
    assert detection.rewrite_tail(spark, path, moved, headers, (main, found), (then, found), 3) == 6
    same = {f for f in before if f.split("/")[0] in ("part=0", "part=1")}
    assert same and before & files(path) == same
    assert rows(detection.read_series(spark, path)) == rows(exchanges.exchange_supply(moved, then, found, headers))
    assert detection.rewrite_tail(spark, path, moved, headers, (then, found), (then, found), 3) is None


def test_bucketed_tables_join_without_an_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = incremental.diffs.expand_inputs(*incremental.bucketed(spark, SF))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_prices_across_buckets(spark):
    r = random.Random(3)
    points = sorted(r.sample(range(0, 200 * 86_400_000, 3_600_000), 90))
    asked = [(i, r.randrange(-5, 210 * 86_400_000)) for i in range(300)] + [(400 + i, p) for i, p in enumerate(points)]
    value = {t: float(i) for i, t in enumerate(points)}
    known = spark.createDataFrame(list(value.items()), "timestamp long, price double")
    got = dict(rows(prices.last_prior(spark.createDataFrame(asked, "key long, timestamp long"), known), "key", "price"))
    assert got == {k: value[max(p for p in points if p <= t)] for k, t in asked if t >= points[0]}
    assert [r[1] for r in rows(prices.intervals(known), "t0", "t1")] == [*points[1:], None] and rows(prices.intervals(known).where("first"), "t0") == [(points[0],)]


def test_a_rich_list_has_a_bound(spark):
    with pytest.raises(ValueError, match="10000"):
        metrics.rich_list(spark.createDataFrame([(11, 5)], "address_id long, nano long"), 10_001)


def at(minutes):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minutes)


def fed(spark, tmp_path, batches, schema, start):
    """Files that a stream takes one after another."""
    source = str(tmp_path / "source")
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        start(spark.readStream.schema(schema).parquet(source))


def test_sliding_windows_and_late_blocks(spark, tmp_path):
    """A late row counts in the windows that the watermark hasn't closed, and not in those that it has."""
    schema = "time timestamp, timestamp long, difficulty long"
    block = lambda m, d: (at(m), m * 60_000, d)
    out = []

    def start(stream):
        days = streaming.sliding_difficulty(stream, "40 minutes", "2 hours", "1 hour")
        days.writeStream.outputMode("append").foreachBatch(lambda b, _: out.extend(map(tuple, b.collect()))).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()

    fed(spark, tmp_path, [[block(0, 10), block(59, 20), block(60, 40), block(150, 80)], [block(119, 1000), block(120, 5), block(109, 7), block(30, 5000)], [block(300, 1)]], schema, start)
    got = {r[0]: r[1:] for r in out}
    # the watermark after the first file is 110: the window up to 60 is closed and misses 30, the one up to 120 takes it and 109
    assert got[at(-60)] == (2, 15, 0) and len(out) == len(got)
    assert got[at(0)] == (6, round((10 + 20 + 40 + 1000 + 7 + 5000) / 6), 6077 // (119 * 60))
    assert got[at(60)] == (5, round((40 + 80 + 1000 + 7 + 5) / 5), 1132 // (90 * 60))


def test_keyed_state_waits_for_late_rows(spark, tmp_path):
    """Rows out of order within the lateness are folded in order; a key that comes to zero leaves; later rows are left out."""
    for k, v in keyed.STORE.items():
        spark.conf.set(k, v)
    schema, out = "address_id long, height long, tx_idx long, nano long, timestamp long", []
    row = lambda a, h, n: (a, h, 0, n, TS + h * 60_000)
    try:

        def start(stream):
            keyed.ages(stream, "40 minutes").writeStream.outputMode("update").foreachBatch(lambda b, n: out.extend((n, *r) for r in b.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()

        batches = [[row(A, 30, -40), row(A, 0, 100), row(B, 10, 50)], [row(A, 10, 60), row(B, 20, -50), row(C, 100, 1)], [row(A, 5, 1000), row(C, 300, 1)], [row(C, 400, 1)]]
        fed(spark, tmp_path, batches, schema, start)
    finally:
        for k in keyed.STORE:
            spark.conf.unset(k)
    last = {r[1]: r[2:] for r in sorted(out)}
    mean = ((TS * 100) + (TS + 600_000) * 60) // 160
    assert last[A] == (120, mean) and last[B] == (0, 0) and last[C][0] == 2


def test_many_addresses_share_few_keys_of_state(spark, tmp_path, monkeypatch):
    """400 addresses in batches, rows out of order: the state has a row for each part, not for each address."""
    for k, v in keyed.STORE.items():
        spark.conf.set(k, v)
    r, schema, out, kept = random.Random(4), "address_id long, height long, tx_idx long, nano long, timestamp long", [], []
    moved = [(2000 + r.randrange(400), h, 0, r.choice([1, -1]) * r.randint(1, 10**15)) for h in range(3000)]
    try:

        def start(stream):
            q = keyed.ages(stream, "1 second", parts=8).writeStream.outputMode("update").foreachBatch(lambda b, n: out.extend((n, *r) for r in b.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
            q.awaitTermination()
            kept.append(q.lastProgress["stateOperators"][0]["numRowsTotal"])

        batches = [r.sample(some, len(some)) for some in (moved[:1500], moved[1500:2000], moved[2000:])]
        fed(spark, tmp_path, [[(*m, TS + m[1]) for m in b] for b in batches], schema, start)
    finally:
        for k in keyed.STORE:
            spark.conf.unset(k)
    assert all(0 < n <= 8 for n in kept)
    last = {r[1]: r[2:] for r in sorted(out)}
    assert sorted((a, b, m) for a, (b, m) in last.items() if b > 0) == plain_ages(moved, 2999 - 1000 - 1)
    rows = np.array([(a, h, x, n, TS + h) for a, h, x, n in sorted(moved)])
    monkeypatch.setattr(keyed, "SLICE", 7)
    assert sorted((a, b, m) for a, (b, m) in keyed._fold(rows, {}).items() if b > 0) == plain_ages(moved, 2999)
    assert keyed._fold(rows[:0], {1: (2, 3)}) == {}


def test_the_state_follows_the_chain(spark, tmp_path, monkeypatch):
    """A fork, and a death between the two halves of going over: the next call finds where chain and state part."""
    chain = streaming.Chain(spark, str(tmp_path / "chain"), {"nano": streaming.DIFFS, "times": "height long, timestamp long"}, span=3)
    path, moved, other = str(tmp_path / "s"), some_diffs(14), some_diffs(14, seed=5)

    def feed(branch, lo, hi, rows):
        heads = [(h, f"{branch}{h}", f"{'a' if h - 1 < 6 else branch}{h - 1}") for h in range(lo, hi + 1)]
        facts = {"nano": spark.createDataFrame([m for m in rows if lo <= m[1] <= hi], DIFF), "times": spark.createDataFrame([(h, TS + h) for h in range(lo, hi + 1)], "height long, timestamp long")}
        chain.follow(spark.createDataFrame(heads, HEAD), facts)

    feed("a", 0, 8, moved)
    state.follow(spark, path, 0, chain, parts=4)
    assert rows(state.balances(spark, path)) == plain_ages(moved, 8)
    feed("b", 6, 10, other)
    put = tables.replace_parts
    monkeypatch.setattr(tables, "replace_parts", lambda *_: (_ for _ in ()).throw(RuntimeError("died")))
    with pytest.raises(RuntimeError):
        state.follow(spark, path, 1, chain, parts=4)  # told that blocks are undone, but nothing is
    monkeypatch.setattr(tables, "replace_parts", put)
    for _ in range(2):
        state.follow(spark, path, 1, chain, parts=4)
        assert rows(state.balances(spark, path)) == plain_ages([m for m in moved if m[1] < 6] + [m for m in other if m[1] >= 6], 10)
