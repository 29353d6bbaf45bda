"""Registered queries that work by increments: state kept by batches, forks, patches, parts written anew. Each tells the rows of its
one-pass counterpart, and its SQL is that one's."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from .. import streaming
from ..operators import balances as bal
from ..operators import bank, diffs, exchanges
from ..shared import materialize
from ..sources import write_bucketed
from ..streaming import detection, keyed, state
from . import ledger as led
from .queries import _CLASS, _FOLD, _SUPPLY, DIFFS, EV, MAIN, ORACLE, addressed, erg, exchange_supply, fees, query, token_boxes


def in_parts(df, n: int = 3):
    """df by ranges of heights, about n of equal length."""
    lo, hi = df.agg(F.min("height"), F.max("height")).first()
    step = (hi - lo) // n + 1
    return [df.where((F.col("height") >= lo + i * step) & (F.col("height") < lo + (i + 1) * step)) for i in range(n)]


@query(ORACLE["mean_age"])
def stream_mean_age(s, d):
    """Balances and mean ages of a ledger whose diffs come by a stream, three files one after another: each batch reads and rewrites
    the parts of the state that its addresses fall in."""
    path, headers, moved = streaming.scratch(s, "ages"), materialize(led.headers(s, d), "headers"), materialize(erg(s, d), "diffs")

    def take(batch, number):
        heights = batch.select("height").distinct()
        state.advance(s, path, number, batch, headers.join(heights, "height", "left_semi"), parts=16)

    for part in in_parts(moved):
        part.write.mode("append").parquet(f"{path}/source")
        streaming.run_available(s.readStream.schema(moved.schema).parquet(f"{path}/source"), take, f"{path}/checkpoint")
    return state.balances(s, path)


_FORKED = f"{EV}, t AS (SELECT max(height // 100) - 4 AS fork FROM ev), x AS (SELECT height // 100 AS h, height AS tx, user_id * 10 + 1 AS address_id, CASE WHEN user_id % 3 = 0 THEN -1 ELSE 1 END * (amount + CASE WHEN height // 100 >= fork THEN 2 ELSE 1 END) AS nano FROM ev, t)"


@query(f"WITH {_FORKED}, o AS (SELECT address_id, list({{'b': CAST(nano AS HUGEINT), 'm': CAST(h * 120000 AS HUGEINT)}} ORDER BY h, tx) AS l FROM x GROUP BY 1), f AS (SELECT address_id, list_reduce(list_prepend({{'b': 0::HUGEINT, 'm': 0::HUGEINT}}, l), lambda a, x: {_FOLD}) AS r FROM o) SELECT address_id, CAST(r.b AS BIGINT) AS nano, CAST(r.m AS BIGINT) AS mean_age_timestamp FROM f WHERE r.b > 0")
def state_with_fork(s, d):
    """State that is undone by its log: the last five blocks are taken back and come anew on another branch, twice."""
    path = streaming.scratch(s, "undone")
    e = led.table(s, d, "events").select(F.floor(F.col("event_id") / 100).cast("long").alias("height"), F.col("event_id").cast("long").alias("tx_idx"), (F.col("user_id") * 10 + 1).alias("address_id"), F.round(F.col("value") * 100).cast("long").alias("amount"))
    e = materialize(e, "blocks")
    headers = e.select("height").distinct().withColumn("timestamp", F.col("height") * 120_000)
    sign = F.when(F.floor(F.col("address_id") / 10) % 3 == 0, -1).otherwise(1)
    moved = lambda more: e.select("address_id", "height", "tx_idx", (sign * (F.col("amount") + more)).cast("long").alias("nano"))
    fork = e.agg(F.max("height")).first()[0] - 4
    since = headers.where(F.col("height") >= fork)
    state.advance(s, path, 0, moved(1), headers, parts=16)
    state.revert(s, path, 1, fork, parts=16)
    state.advance(s, path, 2, moved(7).where(F.col("height") >= fork), since, parts=16)
    for number in (3, 3):
        state.revert(s, path, number, fork, parts=16)
    for number in (4, 4, 2):
        state.advance(s, path, number, moved(2).where(F.col("height") >= fork), since, parts=16)
    return state.balances(s, path)


@query(ORACLE["service_stats_added"])
def service_stats_replayed(s, d):
    """Statistics added batch by batch, of which each comes twice and an old one once more."""
    path = streaming.scratch(s, "stats")
    parts = [bank.service_stats(p) for p in in_parts(fees(s, d))]
    for number, part in [*enumerate(parts), (2, parts[2]), (1, parts[1])]:
        state.add_stats(s, path, number, part)
        state.add_stats(s, path, number, part)
    return state.stats(s, path)


@query(f"WITH {EV}, x AS (SELECT height // 100 AS h, user_id * 10 + 1 AS address_id, amount FROM ev), t AS (SELECT max(h) AS top FROM x) SELECT address_id, CAST(sum(amount + CASE WHEN h >= top - 8 THEN 2 ELSE 1 END) AS BIGINT) AS nano FROM x, t WHERE h < top GROUP BY 1")
def chain_with_late_orphan(s, d):
    """Balances on the best of two branches: b comes in two pieces, of which the first ends lower than a and waits; then blocks
    of a come once more, which changes nothing."""
    chain = streaming.Chain(s, streaming.scratch(s, "orphans"), {"nano": streaming.DIFFS}, span=50)
    e = led.table(s, d, "events")
    moved = materialize(e.select(F.floor(F.col("event_id") / 100).cast("long").alias("height"), F.col("event_id").cast("long").alias("tx_idx"), (F.col("user_id") * 10 + 1).alias("address_id"), F.round(F.col("value") * 100).cast("long").alias("amount")), "moved")
    heights = materialize(moved.select("height").distinct(), "heights")
    top = heights.agg(F.max("height")).first()[0]

    def batch(branch, first, last, more):
        inside = F.col("height").between(first, last)
        parent = F.concat(F.when(F.col("height") - 1 < top - 8, "a").otherwise(branch), F.col("height") - 1)
        return heights.where(inside).select("height", F.concat(F.lit(branch), "height").alias("header_id"), parent.alias("parent_id")), {"nano": moved.where(inside).withColumn("nano", F.col("amount") + more)}

    for one in (("a", 0, top - 3, 1), ("b", top - 8, top - 5, 2), ("b", top - 4, top - 1, 2), ("a", top - 6, top - 3, 1)):
        chain.follow(*batch(*one))
    return chain.tables["nano"].balances()


@query(f"WITH {_FORKED.replace('- 4 AS fork', '- 8 AS fork')}, o AS (SELECT address_id, list({{'b': CAST(nano AS HUGEINT), 'm': CAST(h * 120000 AS HUGEINT)}} ORDER BY h, tx) AS l FROM x WHERE h < (SELECT max(h) FROM x) GROUP BY 1), f AS (SELECT address_id, list_reduce(list_prepend({{'b': 0::HUGEINT, 'm': 0::HUGEINT}}, l), lambda a, x: {_FOLD}) AS r FROM o) SELECT address_id, CAST(r.b AS BIGINT) AS nano, CAST(r.m AS BIGINT) AS mean_age_timestamp FROM f WHERE r.b > 0")
def stream_state_with_forks(s, d):
    """A stream of blocks whose state follows the best branch: a, of b as much as ends lower, then the rest of b."""
    path = streaming.scratch(s, "forking")
    sign = F.when(F.col("user_id") % 3 == 0, -1).otherwise(1)
    e = led.table(s, d, "events").select(F.floor(F.col("event_id") / 100).cast("long").alias("height"), F.col("event_id").cast("long").alias("tx_idx"), (F.col("user_id") * 10 + 1).alias("address_id"), sign.cast("long").alias("sign"), F.round(F.col("value") * 100).cast("long").alias("amount"))
    e = materialize(e, "blocks")
    top = e.agg(F.max("height")).first()[0]
    chain = streaming.Chain(s, f"{path}/chain", {"nano": streaming.DIFFS, "times": "height long, timestamp long"}, span=10)

    def take(batch, number):
        # a branch's rows are blocks one a height: its name, and whose child each block is, come with them
        parent = F.concat(F.when((F.col("height") - 1 < top - 8) | (F.col("branch") == "a"), "a").otherwise("b"), F.col("height") - 1)
        headers = materialize(batch.select("height", "branch").distinct().select("height", F.concat("branch", "height").alias("header_id"), parent.alias("parent_id")), "stream-headers")
        times = headers.select("height", (F.col("height") * 120_000).alias("timestamp"))
        chain.follow(headers, {"nano": batch.select("address_id", "height", "tx_idx", "nano"), "times": times})
        state.follow(s, f"{path}/state", number, chain, parts=16)

    for branch, lo, hi, more in (("a", 0, top - 3, 1), ("b", top - 8, top - 5, 2), ("b", top - 4, top - 1, 2)):
        rows = e.where(F.col("height").between(lo, hi)).withColumns({"branch": F.lit(branch), "nano": F.col("sign") * (F.col("amount") + more)})
        rows.write.mode("append").parquet(f"{path}/source")
        streaming.run_available(s.readStream.schema(rows.schema).parquet(f"{path}/source"), take, f"{path}/checkpoint")
    return state.balances(s, f"{path}/state")


_DIFFICULTY = f"""{EV}, p AS (SELECT CAST(floor(timestamp / 3600000) AS BIGINT) - i AS k, timestamp, CAST(round(value * 1000000) AS HUGEINT) AS d FROM ev, (SELECT unnest(range(24)) AS i)),
    g AS (SELECT k, count(*) AS n, CAST(sum(d) AS HUGEINT) AS s, max(timestamp) - min(timestamp) AS span FROM p GROUP BY k HAVING (k + 24) * 3600000 <= (SELECT max(timestamp) - 2400000 FROM ev))"""


@query(f"WITH {_DIFFICULTY} SELECT make_timestamp(k * 3600000000) AS start, n, CAST(CASE WHEN 2 * (s % n) < n OR (2 * (s % n) = n AND (s // n) % 2 = 0) THEN s // n ELSE s // n + 1 END AS BIGINT) AS difficulty_24h, CAST(s // greatest(span // 1000, 120) AS BIGINT) AS hash_rate_24h FROM g")
def stream_difficulty(s, d):
    """Difficulty over sliding days by a stream of blocks, an hour apart; days that the watermark hasn't passed have no row."""
    time = F.col("ts").cast("timestamp")
    headers = streaming.events_stream(s, d).select(time.alias("time"), F.unix_millis(time).alias("timestamp"), F.round(F.col("value") * 1_000_000).cast("long").alias("difficulty"))
    out = streaming.to_table(streaming.sliding_difficulty(headers), streaming.scratch(s, "difficulty"))
    return out.withColumn("start", F.col("start").cast("timestamp_ntz"))


@query(f"WITH {EV}, x AS (SELECT height, timestamp, user_id * 10 + 1 AS address_id, CASE WHEN event_type = 'error' THEN -amount ELSE amount END AS nano FROM ev WHERE timestamp < (SELECT max(timestamp) - 2400000 FROM ev)), o AS (SELECT address_id, list({{'b': CAST(nano AS HUGEINT), 'm': CAST(timestamp AS HUGEINT)}} ORDER BY height) AS l FROM x GROUP BY 1), f AS (SELECT address_id, list_reduce(list_prepend({{'b': 0::HUGEINT, 'm': 0::HUGEINT}}, l), lambda a, x: {_FOLD}) AS r FROM o) SELECT address_id, CAST(r.b AS BIGINT) AS nano, CAST(r.m AS BIGINT) AS mean_age_timestamp FROM f WHERE r.b > 0")
def stream_keyed_age(s, d):
    """Mean ages by keyed state with timers, of all rows that the watermark has passed."""
    path, time = streaming.scratch(s, "keyed"), F.col("ts").cast("timestamp")
    amount = F.round(F.col("value") * 100).cast("long")
    moved = streaming.events_stream(s, d).select((F.col("user_id") * 10 + 1).alias("address_id"), F.col("event_id").alias("height"), F.lit(0).cast("long").alias("tx_idx"), F.when(F.col("event_type") == "error", -amount).otherwise(amount).alias("nano"), F.unix_millis(time).alias("timestamp"))
    before = {k: s.conf.get(k, None) for k in keyed.STORE}
    for k, v in keyed.STORE.items():
        s.conf.set(k, v)
    try:
        write = lambda batch, n: batch.withColumn("batch", F.lit(n)).write.mode("overwrite").parquet(f"{path}/out/batch={n}")
        keyed.ages(moved).writeStream.outputMode("update").foreachBatch(lambda batch, n: write(batch, n)).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            s.conf.unset(k) if v is None else s.conf.set(k, v)
    out = streaming.table_or_empty(s, f"{path}/out", f"{keyed.AGES}, batch int")
    last = out.groupBy("address_id").agg(F.max_by(F.struct("nano", "mean_age_timestamp"), "batch").alias("r"))
    return last.select("address_id", "r.*").where("nano > 0")


@query(ORACLE["mean_age"])
def mean_age_resumed(s, d):
    """Mean ages from states stored at the ends of spans: a run half-way stores them, one further on folds the rest, one goes back, and the
    last one folds what comes after the last span."""
    path, headers, moved = streaming.scratch(s, "spans"), materialize(led.headers(s, d), "headers"), materialize(erg(s, d), "diffs")
    top = headers.agg(F.max("height")).first()[0]
    for height in (top // 2, top - 100, top - 500):
        state.mean_age_at(s, path, moved, headers, height, 300).write.format("noop").mode("overwrite").save()
    return state.mean_age_at(s, path, moved, headers, top, 300)


def detected(s, d):
    """Exchange detection in three batches of heights."""
    path, main, moved = streaming.scratch(s, "detected"), materialize(led.main_addresses(s, d), "main"), materialize(erg(s, d), "diffs")
    for number, part in enumerate(in_parts(moved)):
        for _ in range(2):  # a batch that comes again changes nothing
            detection.detect(s, path, number, part, moved, main, parts=16)
    return path


@query(f"WITH {_SUPPLY} SELECT * FROM su")
def exchange_supply_by_batches(s, d):
    """The supply on exchanges from what each batch moves and from the patches of deposit addresses that are found or lost."""
    return detection.supply(s, detected(s, d), led.headers(s, d))


@query(f"WITH {_CLASS} SELECT address_id, CASE WHEN conflict_spot_height IS NULL THEN first END AS cex_id, spot_height, conflict_spot_height, CASE WHEN conflict_spot_height > spot_height THEN first END AS first_cex_id FROM cl")
def deposits_by_batches(s, d):
    path = detected(s, d)
    found = detection.deposits(s, path).select("address_id", "cex_id", "spot_height", F.lit(None).cast("long").alias("conflict_spot_height"), F.lit(None).cast("int").alias("first_cex_id"))
    lost = detection.conflicts(s, path).select("address_id", F.lit(None).cast("int").alias("cex_id"), F.col("deposit_spot_height").alias("spot_height"), "conflict_spot_height", "first_cex_id")
    return found.unionByName(lost)


def _renamed(sql: str, *names: str) -> str:
    return re.sub(rf"\b({'|'.join(names)})\b", r"\g<1>0", sql)


_ONCE = _CLASS[len(DIFFS) + 2 :]
_LEAST = "main AS (SELECT * FROM main0 UNION ALL SELECT min(address_id), 1 FROM cl0 WHERE conflict_spot_height IS NULL)"
_TWICE = f"{DIFFS}, {_renamed(_ONCE, 'main', 'rx', 'cand', 'bl', 'ru', 'cl')}, {_ONCE.replace(MAIN, _LEAST)}"


@query(f"WITH {_TWICE}, {_SUPPLY[len(_CLASS) + 2 :]} SELECT height, main, deposits FROM su")
def supply_with_tail_anew(s, d):
    """A stored supply series after the least deposit address turns out to be a main one: only the heights from the first that this
    changes are written anew."""
    path, moved, headers = streaming.scratch(s, "series"), materialize(erg(s, d), "diffs"), led.headers(s, d)
    main = materialize(led.main_addresses(s, d), "main")
    first = materialize(exchanges.deposit_addresses(exchanges.deposit_candidates(moved, main)), "deposits")
    detection.write_series(exchanges.exchange_supply(moved, main, first, headers), path, 100)
    least = first.agg(F.min("address_id")).first()[0]
    then, _, _ = exchanges.register_main(moved, main, first, least if least is not None else -1, 1)
    then = materialize(then, "main")
    found = materialize(exchanges.deposit_addresses(exchanges.deposit_candidates(moved, then)), "deposits")
    detection.rewrite_tail(s, path, moved, headers, (main, first), (then, found), 100)
    return detection.read_series(s, path)


@query(ORACLE["expanded_inputs"])
def expanded_inputs_bucketed(s, d):
    """Inputs with the boxes that they spend, both written once in buckets of box_id: the join needs no exchange."""
    return diffs.expand_inputs(*bucketed(s, d), led.headers(s, d))


def bucketed(s, d, buckets: int = 8):
    """(inputs, boxes) as tables in buckets of box_id."""
    path, (outputs, inputs) = streaming.scratch(s, "boxes"), led.boxes(s, d)
    name = path.rsplit("-", 1)[1]
    return tuple(write_bucketed(df, f"{kind}_{name}", f"{path}/{kind}", "box_id", buckets) for kind, df in (("inputs", inputs), ("boxes", outputs.drop("out_idx"))))


@query(ORACLE["address_index"])
def address_index_by_batches(s, d):
    """Ids given in two batches: the second keeps the first one's and goes on from them."""
    early, late = in_parts(addressed(s, d), 2)
    return diffs.index_addresses(late, materialize(diffs.index_addresses(early), "known"))


@query(ORACLE["token_index"])
def token_index_by_batches(s, d):
    early, late = in_parts(token_boxes(s, d), 2)
    return diffs.index_tokens(late, materialize(diffs.index_tokens(early), "known"))


@query(f"WITH {_SUPPLY}, pa AS (SELECT height, sum(CASE WHEN address_id % 10 = 2 THEN -nano ELSE nano END) AS p FROM diffs WHERE address_id % 10 = 2 OR (address_id // 10) % 11 = 5 GROUP BY 1) SELECT su.height, main, CAST(deposits + coalesce(sum(p) OVER (ORDER BY su.height), 0) AS BIGINT) AS deposits FROM su LEFT JOIN pa ON pa.height = su.height")
def patched_supply_both_ways(s, d):
    """The supply series after some addresses, say, had been found to be deposits and all miners not to be."""
    moved = materialize(erg(s, d), "diffs")
    yes = moved.where("address_id div 10 % 11 = 5 and address_id % 10 <> 2")
    return exchanges.patched_supply(exchange_supply(s, d), exchanges.supply_patch(yes, moved.where("address_id % 10 = 2")))


@query(f"WITH {DIFFS} SELECT address_id, CAST(sum(nano) AS BIGINT) AS nano, CAST(address_id // 10 AS BIGINT) AS position FROM diffs WHERE height <= 700 GROUP BY 1 HAVING sum(nano) <> 0")
def balances_with_debts(s, d):
    """States at a height with those below zero, and each address's position in the dictionary."""
    from ..functions import sequence_position

    rows = erg(s, d).where("height <= 700").join(led.headers(s, d), "height")
    return bal.folded(rows).where("height is null and nano <> 0").select("address_id", "nano", sequence_position(F.col("address_id")).alias("position"))
