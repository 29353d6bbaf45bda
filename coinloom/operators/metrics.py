"""Wealth metrics: counts by balance band, supply by kind of address, rich list and ranks, token supply."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import BANDS, EMISSION_CONTRACTS, P2PK, TREASURY, EMISSION
from ..functions import type_of_id
from ..shared import materialize
from .balances import balance_changes
from .helpers import height_spine, prefix_sum

#: Rows that a rich list can have.
MOST_RICH = 10_000


def address_count(balances: DataFrame, kind: str, value: str = "nano", at_least: int | None = None, below: int | None = None) -> DataFrame:
    """How many balances of wallets ("p2pk") or of all else ("contracts") lie in a half-open range."""
    own = type_of_id(F.col("address_id")) == P2PK
    some = balances.where(own if kind == "p2pk" else ~own)
    some = some if at_least is None else some.where(F.col(value) >= at_least)
    some = some if below is None else some.where(F.col(value) < below)
    return some.agg(F.count("*").alias("n"))


def contract_supply(balances: DataFrame, value: str = "nano") -> DataFrame:
    return balances.where((type_of_id(F.col("address_id")) != P2PK) & ~F.col("address_id").isin(EMISSION, TREASURY)).agg(F.coalesce(F.sum(value), F.lit(0)).cast("long").alias("supply"))


def token_supply(diffs: DataFrame) -> DataFrame:
    """(asset_id, emitted, in_p2pks, in_contracts, burned): emitted is what the token's first transaction made."""
    wallet = type_of_id(F.col("address_id")) == P2PK
    by_tx = diffs.groupBy("asset_id", "height", "tx_idx").agg(F.sum("value").alias("total"), F.sum(F.when(wallet, F.col("value")).otherwise(0)).alias("in_p2pks"))
    held = by_tx.groupBy("asset_id").agg(F.min_by("total", F.struct("height", "tx_idx")).alias("emitted"), F.sum("total").alias("total"), F.sum("in_p2pks").alias("in_p2pks"))
    return held.select("asset_id", "emitted", "in_p2pks", (F.col("total") - F.col("in_p2pks")).alias("in_contracts"), (F.col("emitted") - F.col("total")).alias("burned"))


def holder_buckets(balances: DataFrame) -> DataFrame:
    """By type of address, how many balances reach each band."""
    return balances.groupBy(type_of_id(F.col("address_id")).alias("type")).agg(*(F.count_if(F.col("nano") >= n).alias(k) for k, n in BANDS.items()))


def address_counts_series(diffs: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """(height, type, counts by band) for every height: each block-end change of a balance adds or takes away one where it
    crosses a band's edge, and prefix sums over heights turn changes into counts. headers, where given, tell the heights."""
    change = balance_changes(diffs)
    crossed = [((F.col("new") >= n).cast("int") - (F.col("old") >= n).cast("int")) for n in BANDS.values()]
    deltas = change.groupBy("height", type_of_id(F.col("address_id")).alias("type")).agg(*(F.sum(c).alias(k) for k, c in zip(BANDS, crossed, strict=True)))
    every = height_spine(diffs if headers is None else headers).crossJoin(F.broadcast(diffs.sparkSession.range(1, 4).select(F.col("id").cast("int").alias("type"))))  # three types
    full = every.join(deltas, ["height", "type"], "left").na.fill(0)
    return prefix_sum(full, "height", list(BANDS), ["type"])


def supply_composition(diffs: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """(height, p2pks, contracts, miners): what kinds of address hold, without the emission contracts, for every height.
    headers, where given, tell the heights without a pass over diffs."""
    kind = type_of_id(F.col("address_id"))
    part = lambda t: F.sum(F.when(kind == t, F.col("nano")).otherwise(0))
    deltas = diffs.where(~F.col("address_id").isin(*EMISSION_CONTRACTS)).groupBy("height").agg(part(1).alias("p2pks"), part(3).alias("contracts"), part(2).alias("miners"))
    return prefix_sum(height_spine(diffs if headers is None else headers).join(deltas, "height", "left").na.fill(0), "height", ["p2pks", "contracts", "miners"])


def rich_list(balances: DataFrame, limit: int, value: str = "nano", exclude: tuple = EMISSION_CONTRACTS, addresses: DataFrame | None = None) -> DataFrame:
    """The largest balances, MOST_RICH at most, ties by id. Each task keeps its own top rows; texts join after the cut."""
    if limit > MOST_RICH:
        raise ValueError(f"a rich list has {MOST_RICH} rows at most")
    top = balances.where(~F.col("address_id").isin(*exclude)).orderBy(F.desc(value), "address_id").limit(limit)
    return top if addresses is None else top.join(addresses.select(F.col("id").alias("address_id"), "address"), "address_id", "left")


def ranks(balances: DataFrame) -> DataFrame:
    """(address_id, nano, rank) of all wallets. Counts by distinct balance are summed in buckets of their logarithm and
    cumulated, so no task sorts all wallets."""
    own = balances.where(type_of_id(F.col("address_id")) == P2PK)
    counts = own.groupBy("nano").agg(F.count("*").alias("n")).withColumn("bucket", F.floor(F.log2("nano") * 64))
    sums = counts.groupBy("bucket").agg(F.sum("n").alias("n"))
    above = sums.select("bucket", (F.sum("n").over(Window.orderBy(F.desc("bucket"))) - F.col("n")).alias("above"))
    within = F.sum("n").over(Window.partitionBy("bucket").orderBy(F.desc("nano"))) - F.col("n")
    return own.join(counts.join(above, "bucket").select("nano", (within + F.col("above") + 1).alias("rank")), "nano").select("address_id", "nano", "rank")


def rank_of(balances: DataFrame, address_id: int) -> DataFrame:
    """(position, address_id, nano, rank) of a wallet and of its nearest neighbours: above and under it, of ties the lowest id.
    By counting: no order of all wallets is needed, and wallets that tie with the target are no neighbours."""
    own = materialize(balances.where(type_of_id(F.col("address_id")) == P2PK), "wallets")
    mine = own.where(F.col("address_id") == address_id).select(F.col("nano").alias("t"))
    both = own.crossJoin(F.broadcast(mine))  # one row at most
    found = both.agg(
        F.first("t").alias("t"), F.count_if(F.col("nano") > F.col("t")).alias("more"), F.min(F.when(F.col("nano") > F.col("t"), F.struct("nano", "address_id"))).alias("above"),
        F.max(F.when(F.col("nano") < F.col("t"), F.struct("nano", (-F.col("address_id")).alias("neg")))).alias("under"), F.count_if(F.col("nano") == F.col("t")).alias("ties"),
    )
    above_n = both.join(F.broadcast(found.select(F.col("above.nano").alias("level"))), F.col("nano") > F.col("level")).agg(F.count("*").alias("n"))
    one = lambda name, i, nano, rank: F.struct(F.lit(name).alias("position"), i.alias("address_id"), nano.alias("nano"), rank.cast("long").alias("rank"))
    rows = F.array(one("above", F.col("above.address_id"), F.col("above.nano"), F.col("n") + 1), one("target", F.lit(address_id).cast("long"), F.col("t"), F.col("more") + 1), one("under", -F.col("under.neg"), F.col("under.nano"), F.col("more") + F.col("ties") + 1))
    return found.crossJoin(F.broadcast(above_n)).select(F.inline(rows)).where("nano is not null")


def tracklist(main: DataFrame, exchanges: DataFrame, balances: DataFrame) -> DataFrame:
    """Main exchange addresses with their exchange and balance, zero where there is none. No side is broadcast unless Spark finds it small."""
    known = main.join(exchanges, "cex_id")
    return known.join(balances, "address_id", "left").select("text_id", "name", "address_id", F.coalesce("nano", F.lit(0)).cast("long").alias("nano"))


def latest(series: DataFrame, order: str = "height", columns: list[str] | None = None) -> DataFrame:
    """The last row of a series, by one aggregate."""
    row: Column = F.struct(*(columns or series.columns))
    return series.agg(F.max_by(row, order).alias("r")).select("r.*")
