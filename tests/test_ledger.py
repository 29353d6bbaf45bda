import json
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from coinloom import functions as fn
from coinloom import shared, sources, streaming
from coinloom.operators import balances as bal
from coinloom.operators import bank, calendar, diffs, exchanges, helpers, metrics, network, prices
from coinloom.plans import ledger as led
from coinloom.plans import queries

A, B, C = 1001, 1002, 1003
E9 = 10**9
TS = 1563159993440
DIFF = "height long, tx_idx long, address_id long, nano long"


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def chain(spark):
    """Block 1 mints A 105 and sends B 5; block 2: B to C 5, C to A 1."""
    leg = "height long, tx_idx long, address_id long, value long"
    ins = spark.createDataFrame([(1, 1, A, 105 * E9), (2, 0, B, 5 * E9), (2, 1, C, 5 * E9)], leg)
    outs = spark.createDataFrame([(1, 0, A, 105 * E9), (1, 1, A, 100 * E9), (1, 1, B, 5 * E9), (2, 0, C, 5 * E9), (2, 1, C, 4 * E9), (2, 1, A, E9)], leg)
    return ins, outs


def test_diffs_balances_and_mean_age(spark):
    d = diffs.erg_diffs(*chain(spark))
    assert d.count() == 7
    assert rows(bal.erg_balances(d), "address_id", "nano") == [(A, 101 * E9), (C, 4 * E9)]
    assert rows(bal.erg_balances(d, 1), "address_id", "nano") == [(A, 100 * E9), (B, 5 * E9)]
    heads = spark.createDataFrame([(1, TS), (2, TS + 120000)], "height long, timestamp long")
    assert rows(bal.mean_age(d, heads)) == [(A, 101 * E9, 1563159994628), (C, 4 * E9, TS + 120000)]


@pytest.mark.parametrize("hot", [100, 10**6])
def test_mean_age_folds_only_what_counts(spark, monkeypatch, hot):
    """A busy address with zero balances and runs of debits: few steps are left to fold, and the result is that of all rows."""
    monkeypatch.setattr(bal, "HOT", hot)
    r, d, want = random.Random(1), [], []
    for a, n in ((A, 3000), (B, 40), (C, 41)):
        balance = mean = 0
        for i in range(n):
            h, tx = i // 7, i % 7
            nano = -balance if balance and (i % 50 == 0 or (i == n - 1 and a == C)) else r.randint(1, 10**9) if balance < 10 or i % 5 == 0 else -r.randint(1, balance // 3)
            mean = mean if nano < 0 else (mean * balance + (TS + h * 977) * nano) // (balance + nano)
            balance += nano
            mean = mean if balance else 0
            d.append((h, tx, a, nano))
        want += [(a, balance, mean)] if balance else []
    df, heads = spark.createDataFrame(d, DIFF), spark.createDataFrame([(h, TS + h * 977) for h in range(500)], "height long, timestamp long")
    assert rows(bal.mean_age(df, heads)) == sorted(want) and {w[0] for w in want} == {A, B}
    assert bal.live_steps(df, heads).where(F.col("address_id") == A).count() <= 11


def test_rollback_and_replay(spark, tmp_path):
    d = diffs.erg_diffs(*chain(spark))
    book = streaming.Ledger(spark, str(tmp_path / "book"))
    book.append(d.select("address_id", "height", "tx_idx", "nano"))
    book.append(d.select("address_id", "height", "tx_idx", "nano"))
    assert book.diffs().count() == 7 and book.head() == 2
    book.roll_back(2)
    assert rows(book.balances()) == [(A, 100 * E9), (B, 5 * E9)]


def test_a_chain_follows_forks(spark, tmp_path):
    chain = streaming.Chain(spark, str(tmp_path / "chain"), {"nano": streaming.DIFFS}, span=3)
    heads = lambda *h: spark.createDataFrame(list(h), streaming.HEADERS)
    moved = lambda *r: {"nano": spark.createDataFrame([(A, h, 0, n) for h, n in r], streaming.DIFFS)}
    chain.follow(heads((1, "a1", ""), (2, "a2", "a1"), (3, "a3", "a2"), (4, "a4", "a3")), moved((1, 1), (2, 1), (4, 1)))
    book = chain.tables["nano"]
    assert rows(book.balances()) == [(A, 3)]
    with pytest.raises(ValueError, match="height 4"):
        chain.follow(heads((4, "b4", "b3")), moved((4, 9)))
    with pytest.raises(ValueError, match="height 6"):
        chain.follow(heads((6, "a6", "a5")), moved((6, 9)))
    fork = heads((3, "b3", "a2"), (4, "b4", "b3"), (5, "b5", "b4")), moved((3, 10), (5, 10))
    for _ in range(2):
        chain.follow(*fork)
        assert rows(book.balances()) == [(A, 22)] and rows(chain.headers.diffs(), "header_id") == [("a1",), ("a2",), ("b3",), ("b4",), ("b5",)]
    book.append(moved((6, 100))["nano"])  # of a batch that died before its headers were written
    chain.follow(heads((6, "b6", "b5")), moved((6, 1)))
    assert rows(book.balances()) == [(A, 23)]


def test_late_prices_become_final(spark, tmp_path):
    hour = 3_600_000
    blocks = spark.createDataFrame([(2, 5), (9, -1), (10, 0), (11, hour // 2), (12, hour), (13, hour * 2), (14, hour * 5)], "height long, timestamp long")
    points = lambda *p: spark.createDataFrame(list(p), "timestamp long, price double")
    book = streaming.BlockPrices(spark, str(tmp_path / "prices"), blocks)
    assert book.prices().isEmpty()
    book.take(points((0, 1.0), (hour, 3.0)), 0)
    early = [(2, 5.581469768257971, False), (10, 1.0, False), (11, 2.0, False), (12, 3.0, False)]
    assert rows(book.prices()) == [*early, (13, 3.0, True), (14, 3.0, True)]
    for _ in range(2):  # a replay
        book.take(points((hour, 99.0), (3 * hour, 5.0)), 1)
        assert rows(book.prices()) == [*early, (13, 4.0, False), (14, 5.0, True)]
    book.take(points(), 2)
    book.take(points((7 * hour, 9.0)), 3)
    assert rows(book.prices()) == [*early, (13, 4.0, False), (14, 7.0, False)]


def test_main_chain_takes_the_best_tip(spark):
    h = spark.createDataFrame([(1, 0, "a", ""), (2, 1, "b", "a"), (2, 1, "x", "a"), (3, 2, "y", "x")], "height long, timestamp long, header_id string, parent_id string")
    assert rows(streaming.main_chain(h).where("main_chain"), "header_id") == [("a",), ("x",), ("y",)]


def test_state_log_restores(spark):
    s = "address_id long, nano long"
    old, new = spark.createDataFrame([(1, 5), (2, 7)], s), spark.createDataFrame([(1, 6), (3, 1)], s)
    log = streaming.state_log(old, spark.createDataFrame([(1, 1), (2, -7), (3, 1), (3, 0)], s), 9)
    assert rows(log, "address_id", "old") == [(1, 5), (2, 7), (3, None)]
    assert rows(streaming.restored(new, log, 9)) == [(1, 5), (2, 7)]


def test_exchange_fixture(spark):
    """A pays two exchanges in different blocks, B one: B is a deposit address, A a conflict."""
    main = spark.createDataFrame([(11, 1), (12, 2)], "address_id long, cex_id int")
    d = spark.createDataFrame([(1, 0, A, 20), (1, 1, B, 30), (1, 2, A, -5), (1, 2, 11, 5), (2, 0, A, -5), (2, 0, 12, 5), (2, 1, B, -1), (2, 1, 11, 1)], DIFF)
    c = exchanges.deposit_candidates(d, main)
    deposits = exchanges.deposit_addresses(c)
    assert rows(deposits) == [(B, 1, 2)]
    assert rows(exchanges.deposit_conflicts(c)) == [(A, 1, 1, 2)]
    assert rows(exchanges.exchange_supply(d, main, deposits)) == [(1, 5, 30), (2, 11, 29)]


def test_intra_conflict(spark):
    main = spark.createDataFrame([(11, 1), (12, 2)], "address_id long, cex_id int")
    d = spark.createDataFrame([(2, 0, A, -3), (2, 0, 11, 2), (2, 0, 12, 1), (3, 0, A, -2), (3, 0, 11, 2)], DIFF)
    assert rows(exchanges.deposit_conflicts(exchanges.deposit_candidates(d, main))) == [(A, None, 2, 2)]


def test_tally_and_rates(spark):
    v = spark.createDataFrame([(1024, 4, 0, 0), (1025, 4, 0, 0)], "height long, v1 int, v2 int, v3 int")
    assert rows(network.proposals(v), "epoch", "tally_1", "tally_2", "tally_3") == [(1, 1, 0, 0)]
    h = spark.createDataFrame([(1, 0, 1165864577531904), (2, 3_600_000, 1129245686366208)], "height long, timestamp long, difficulty long")
    assert rows(network.difficulty_24h(h).where("height = 2"), "hash_rate_24h") == [(637530628860,)]
    outs = spark.createDataFrame([(1, 0, 2403, 123), (1, 1, 2403, 1000), (1, 1, 5, 7)], "height long, tx_idx long, address_id long, value long")
    assert rows(network.block_fees(outs)) == [(1, 1123)]


def test_trailing_day_matches_brute_force(spark):
    """Ties, both ends included, busy and empty days."""
    r, day = random.Random(4), 86_400_000
    times = sorted([r.randrange(0, 3 * day) for _ in range(300)] + [day, 2 * day, 2 * day, 2 * day + 5, day + 5, 9 * day])
    h = [(i, t, r.randint(1, 10**15)) for i, t in enumerate(times)]
    want = []
    for i, t, _ in h:
        own = [(u, x) for _, u, x in h if t - day <= u <= t]
        s, n = sum(x for _, x in own), len(own)
        low, rest = divmod(s, n)
        want.append((i, low + (2 * rest > n or (2 * rest == n and low % 2)), s // max((t - min(u for u, _ in own)) // 1000, 120)))
    assert rows(network.difficulty_24h(spark.createDataFrame(h, "height long, timestamp long, difficulty long"))) == want


def test_a_debt_paid_off_has_no_age(spark):
    d = spark.createDataFrame([(1, 0, A, -5), (2, 0, A, 5), (3, 0, A, 4), (1, 0, B, -5), (2, 0, B, 5)], DIFF)
    heads = spark.createDataFrame([(i, TS + i) for i in range(5)], "height long, timestamp long")
    assert rows(bal.mean_age(d, heads)) == [(A, 4, TS + 3)]


def test_broken_links_and_versions(spark, tmp_path):
    h = spark.createDataFrame([(1, "a", ""), (2, "b", "a"), (3, "c", "x"), (5, "e", "d")], "height long, header_id string, parent_id string")
    assert rows(streaming.broken_links(h), "height") == [(3,), (5,)]
    one, two = (sources.write_version(h.where(f"height <= {n}"), str(tmp_path / "v")) for n in (2, 5))
    assert spark.read.parquet(one).count() == 2 and spark.read.parquet(two).count() == 4
    sources.write_by_height(h, str(tmp_path / "f"), 2)
    sources.write_by_height(h.where("height = 5").withColumn("header_id", F.lit("z")), str(tmp_path / "f"), 2)
    assert rows(spark.read.parquet(str(tmp_path / "f")), "header_id") == [("a",), ("b",), ("c",), ("z",)]


def test_rollback_within_and_beyond_a_span(spark, tmp_path):
    d = spark.createDataFrame([(h, 0, A, 1) for h in range(30)], DIFF).select("address_id", "height", "tx_idx", "nano")
    book = streaming.Ledger(spark, str(tmp_path / "book"), span=8)
    book.append(d)
    book.roll_back(26)
    assert book.head() == 25 and book.diffs().count() == 26
    book.roll_back(16)
    assert book.head() == 15 and rows(book.balances()) == [(A, 16)]
    book.append(d)
    assert book.diffs().count() == 30


def test_calendar_fixture(spark):
    g = 1561978800000
    h = spark.createDataFrame([(0, g), (1, g + 120_000), (2, g + 120_000 + 86_400_000)], "height long, timestamp long")
    assert calendar.calendar_heights(h, "hourly").count() == 26
    assert rows(calendar.calendar_heights(h, "daily")) == [(0, g), (1, g + 46_800_000), (2, g + 120_000 + 86_400_000)]
    assert calendar.calendar_heights(h, "weekly").count() == 2


def test_prices(spark):
    one = spark.range(1).select(fn.rc_price(*(F.lit(x) for x in (847457627, 44837610, 2700966369, 1494997124719372))).alias("p"), fn.rc_price(*(F.lit(x) for x in (1, 1000, 0, 5))).alias("q"))
    assert rows(one) == [(412821, 1_000_000)]
    points = spark.createDataFrame([(0, 1.0), (3_600_000, 3.0), (36_000_000, 4.0)], "timestamp long, price double")
    blocks = spark.createDataFrame([(2, 0), (10, 0), (11, 1_800_000), (12, 3_600_000), (13, 40_000_000)], "height long, timestamp long")
    got = prices.interpolated(blocks, points)
    assert rows(got) == [(2, 5.581469768257971, False), (10, 1.0, False), (11, 2.0, False), (12, 3.0, False), (13, 4.0, True)]
    more = points.union(spark.createDataFrame([(43_600_000, 8.0)], points.schema))
    assert ("False" in str(rows(prices.refreshed(got, blocks, more).where("height = 13")))) and rows(prices.last_prior(blocks.where("height = 13"), points), "price") == [(4.0,)]


def test_ohlc_gap(spark):
    ticks = spark.createDataFrame([(1, 0, 1), (1, 1, 5), (1, 2, 3), (3, 0, 7)], "height long, seq int, price long")
    day = 86_400_000
    blocks = spark.createDataFrame([(1, 0), (2, 2 * day), (3, 2 * day + 5)], "height long, timestamp long")
    assert [tuple(map(str, r)) for r in bank.ohlc(ticks, blocks, "day").orderBy("date").collect()] == [("1970-01-01", "1", "5", "1", "3"), ("1970-01-02", "3", "3", "3", "3"), ("1970-01-03", "3", "7", "3", "7")]


def test_bank_events_and_fees(spark):
    box = "height long, tx_idx long, address_id long, value long, assets array<struct<asset_id: long, amount: long>>, registers string"
    bank_id, nft, sc, rc, oracle, user, service = 43, 1, 2, 3, 4, 501, 703
    ins = spark.createDataFrame([(1, 0, bank_id, 1000, [(nft, 1), (sc, 50)], None), (1, 0, user, 5000, None, None)], box)
    outs = spark.createDataFrame([(1, 0, bank_id, 1100, [(nft, 1), (sc, 30)], None), (1, 0, user, 4890, [(sc, 20)], None), (1, 0, service, 10, None, None), (2, 0, 9, 1, [(oracle, 1)], '{"R4": "0580897a", "R5": "04"}')], box)
    reads = spark.createDataFrame([(2, 0, "x")], "height long, tx_idx long, box_id string")
    ev = bank.bank_events(ins, outs, reads, bank_id, nft, sc, rc, oracle)
    assert rows(ev, "height", "kind", "reserves_diff", "circ_sc_diff", "oracle") == [(1, "bank", 100, 20, None), (2, "oracle", 0, 0, 1_000_000)]
    assert rows(bank.service_fees(ev, ins, outs, bank_id, sc, rc)) == [(1, 0, 10, service)]


def test_ranks(spark):
    b = spark.createDataFrame([(11, 5), (21, 4), (31, 4), (41, 3), (51, 2), (61, 2), (13, 9)], "address_id long, nano long")
    assert rows(metrics.rank_of(b, 11)) == [("target", 11, 5, 1), ("under", 21, 4, 2)]
    assert rows(metrics.rank_of(b, 41)) == [("above", 21, 4, 2), ("target", 41, 3, 4), ("under", 51, 2, 5)]
    assert rows(metrics.ranks(b), "address_id", "rank") == [(11, 1), (21, 2), (31, 2), (41, 4), (51, 5), (61, 5)]


def test_blocks_from_files(spark, tmp_path):
    out = lambda i, v, assets=(): {"boxId": i, "value": v, "ergoTree": "t" + i, "assets": list(assets), "creationHeight": 1, "additionalRegisters": {}, "transactionId": "x", "index": 0}
    block = {"header": {"id": "h1", "parentId": "h0", "height": 1, "timestamp": 5, "difficulty": "12", "votes": "0400fa"}, "blockTransactions": {"headerId": "h1", "transactions": [{"id": "t0", "inputs": [{"boxId": "g"}], "dataInputs": [], "outputs": [out("a", 1), out("b", 2, [{"tokenId": "k", "amount": 3}])]}]}, "extension": {"fields": [["0001", "0000000a"], ["0100", "ff"], ["f00d", "aa"]]}, "size": 10}
    (tmp_path / "b.json").write_text(json.dumps(block) + "\n")
    flat = sources.flatten_blocks(sources.read_blocks(spark, str(tmp_path / "b.json")))
    assert rows(flat["inputs"], "height", "tx_idx", "box_id") == [(1, 0, "g")] and flat["outputs"].count() == 2
    assert rows(network.network_parameters(flat["extension_fields"]), "height", "storage_fee_factor") == [(1, 10)]
    assert rows(network.unhandled_extensions(flat["extension_fields"])) == [(1, -4083, "aa")]
    assert rows(diffs.index_addresses(flat["outputs"])) == [(13, 1, "ta"), (23, 1, "tb")]
    assert rows(diffs.index_tokens(flat["outputs"])) == [(1, 1, "k")]
    assert rows(flat["headers"].select(fn.parse_votes(F.col("votes")).alias("v"))) == [([4, 0, -6],)]
    (tmp_path / "p.json").write_text('{"prices": [[1, 2.5], [2, 3.5]]}\n')
    assert rows(sources.read_price_series(spark, str(tmp_path / "p.json"), 1)) == [(2, 3.5)]
    genesis = sources.genesis_outputs(spark.createDataFrame([("z", 1), ("y", 2)], "box_id string, value long"))
    assert rows(genesis, "box_id", "out_idx", "height") == [("y", 0, 0), ("z", 1, 0)]


def test_helpers(spark):
    df = spark.range(50).select(F.col("id").alias("k"), F.when(F.col("id") % 7 == 0, F.col("id")).alias("v"), F.lit(1).alias("n"))
    assert rows(helpers.prefix_sum(df, "k", ["n"], bucket=8), "k", "n") == [(i, i + 1) for i in range(50)]
    assert rows(helpers.forward_fill(df, "k", ["v"], bucket=3), "k", "v") == [(i, i // 7 * 7) for i in range(50)]
    assert rows(helpers.with_next(df, "k", ["k"], bucket=4), "k", "next_k") == [(i, i + 1 if i < 49 else None) for i in range(50)]
    assert rows(helpers.dense_ids(df, ["k"], "i", 5), "k", "i") == [(i, i + 5) for i in range(50)]


def test_dense_ids_of_a_wide_table(spark):
    """The rows that are counted and those that are numbered are the same, though only one of the two needs the wide column."""
    n, before = 300_000, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        k = F.xxhash64("id")
        df = spark.range(n).select(k.alias("k"), F.pmod(k, F.lit(7)).alias("j"), F.concat(F.sha2(F.col("id").cast("string"), 512), F.repeat(F.lit("x"), 100)).alias("wide"))
        got = helpers.dense_ids(df, ["j", "k"], "i", 1)
        seen = got.agg(F.count("*"), F.countDistinct("i"), F.min("i"), F.max("i"), F.countDistinct("wide")).first()
        assert tuple(seen) == (n, n, 1, n, n)
        assert helpers.with_next(got, "i", ["j", "k"]).where("next_k is not null and struct(j, k) >= struct(next_j, next_k)").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_cluster_needs_a_shared_folder():
    unset = SimpleNamespace(get=lambda *_: None)
    context = SimpleNamespace(master="spark://host:7077", applicationId="app-1", getConf=lambda: unset)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(SimpleNamespace(conf=unset, sparkContext=context))
    context.master = "local[2]"
    assert shared.shared_dir(SimpleNamespace(conf=unset, sparkContext=context)) == shared.shared_dir(SimpleNamespace(conf=unset, sparkContext=context))
    named = SimpleNamespace(get=lambda *_: "/shared/")
    assert shared.shared_dir(SimpleNamespace(conf=named, sparkContext=context)) == "/shared/app-1"


def test_registers(spark):
    def serialized(n):
        z, out = (n << 1) ^ (n >> 63), []
        while z > 127:
            out.append(z & 127 | 128)
            z >>= 7
        return bytes([5, *out, z]).hex()

    numbers = [0, -1, 1, 63, -64, 64, 10**6, 2**62, -(2**62), 2**63 - 1, -(2**63)]
    bad = ["04", None, "05ff", "05", "0580", "", "05zz", "05" + "ff" * 9 + "02", "05" + "ff" * 10 + "00", "050"]
    df = spark.createDataFrame([(i, h) for i, h in enumerate([*map(serialized, numbers), *bad, "0580897A"])], "i int, h string")
    assert [r[1] for r in df.select("i", fn.decode_slong("h")).orderBy("i").collect()] == [*numbers, *[None] * len(bad), 1_000_000]


def test_keyed_state_matches_batch(spark, tmp_path):
    d = diffs.erg_diffs(*chain(spark)).join(spark.createDataFrame([(1, TS), (2, TS + 120000)], "height long, timestamp long"), "height")
    d.write.parquet(str(tmp_path / "d"))
    out = []
    stream = streaming.running_balances(spark.readStream.schema(d.schema).parquet(str(tmp_path / "d")))
    stream.writeStream.outputMode("update").foreachBatch(lambda b, i: out.extend(map(tuple, b.collect()))).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(x for x in out if x[1]) == [(A, 101 * E9, 1563159994628), (C, 4 * E9, TS + 120000)]


def test_token_moves_are_the_legs(spark, tmp_path):
    spark.createDataFrame([(0, 5, "1994-12-31"), (1, 5, "1995-01-01"), (2, 6, "1995-01-01")], "o_orderkey long, o_custkey long, o_orderdate string").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(0, 9, 7, 1.0), (0, 8, 7, 2.0), (1, 9, 7, 4.0), (1, 9, 7, 4.0), (2, 9, 3, 5.0), (9, 9, 3, 5.0)]  # the last one is of no order
    spark.createDataFrame([(k, s, p, 1.0, q) for k, s, p, q in lines], "l_orderkey long, l_suppkey long, l_partkey long, l_extendedprice double, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    want = diffs.token_diffs(*led.token_legs(spark, str(tmp_path)))
    got = queries.tokens(spark, str(tmp_path))
    cols = ["height", "tx_idx", "address_id", "asset_id", "value"]
    assert got.columns == want.columns == cols and rows(got, *cols) == rows(want, *cols)
    keys = ("address_id", "asset_id")
    once = bal.balance_history(want, "value", keys, by_blocks=False)
    assert rows(once, *cols, "balance") == rows(bal.balance_history(want, "value", keys), *cols, "balance")
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hash")
    assert exchanges(once) == exchanges(want) + 1
    # of the token's lines alone, by a filter that reaches the scan
    assert "EqualTo(l_partkey,7)" in got.where("asset_id = 7")._jdf.queryExecution().executedPlan().toString()


def test_supply_of_tokens_by_one_pass(spark):
    moved = spark.createDataFrame([(2, 0, 1001, 1, 5), (2, 0, 1003, 1, 7), (2, 1, 1001, 1, 100), (3, 0, 1003, 1, -2), (1, 0, 1002, 2, 4)], "height long, tx_idx long, address_id long, asset_id long, value long")
    told = metrics.token_supply(moved)
    assert rows(told, "asset_id", "emitted", "in_p2pks", "in_contracts", "burned") == [(1, 12, 105, 5, -98), (2, 4, 0, 4, 0)]
    assert told._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
