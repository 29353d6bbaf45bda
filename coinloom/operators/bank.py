"""A stable-coin bank: events, service fees, history, prices of the reserve coin, and their OHLC series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import FEES
from ..functions import asset_amount, decode_slong, has_register, holds_asset, period_date, rc_price, utc_date
from .calendar import gap_filled
from .diffs import erg_diffs, token_diffs
from .helpers import dense_ids, forward_fill, prefix_sum

TX = ["height", "tx_idx"]


def bank_events(inputs: DataFrame, outputs: DataFrame, data_inputs: DataFrame, bank: int, bank_nft: int, sc: int, rc: int, oracle_nft: int) -> DataFrame:
    """(height, tx_idx, kind, reserves_diff, circ_sc_diff, circ_rc_diff, oracle): bank transactions, those that change nothing
    ("noop"), and oracle postings. Boxes are filtered by the two tokens first; only candidates' legs are summed."""
    banks = outputs.where((F.col("address_id") == bank) & holds_asset(F.col("assets"), bank_nft)).select(*TX).distinct()
    legs = lambda df: df.join(banks, TX, "left_semi").where(F.col("address_id") == bank)
    erg = erg_diffs(legs(inputs), legs(outputs)).groupBy(*TX).agg(F.sum("nano").alias("reserves_diff"))
    tok = token_diffs(legs(inputs), legs(outputs)).groupBy(*TX).agg(F.sum(F.when(F.col("asset_id") == sc, -F.col("value"))).alias("s"), F.sum(F.when(F.col("asset_id") == rc, -F.col("value"))).alias("r"))
    moved = banks.join(erg, TX, "left").join(tok, TX, "left").na.fill(0)
    events = moved.select(*TX, F.when(F.col("reserves_diff") == 0, "noop").otherwise("bank").alias("kind"), "reserves_diff", F.col("s").alias("circ_sc_diff"), F.col("r").alias("circ_rc_diff"), F.lit(None).cast("long").alias("oracle"))
    posting = outputs.where(holds_asset(F.col("assets"), oracle_nft) & has_register(F.col("registers"), "R4") & has_register(F.col("registers"), "R5") & ~has_register(F.col("registers"), "R6"))
    posting = posting.join(data_inputs.select(*TX).distinct(), TX, "left_semi").join(banks, TX, "left_anti")
    zero = F.lit(0).cast("long")
    posted = posting.select(*TX, F.lit("oracle").alias("kind"), zero.alias("reserves_diff"), zero.alias("circ_sc_diff"), zero.alias("circ_rc_diff"), decode_slong(F.get_json_object("registers", "$.R4")).alias("oracle"))
    return events.unionByName(posted)


def service_fees(events: DataFrame, inputs: DataFrame, outputs: DataFrame, bank: int, sc: int, rc: int) -> DataFrame:
    """(height, tx_idx, fee, service): on a mint, the one address that gains coins and moves no bank token; on a redeem with two
    receivers, the smaller gain if positive, else the larger. Fee 0 and no service in all other cases."""
    key = events.where("kind = 'bank'").select(*TX, "reserves_diff")
    ins, outs = inputs.join(key, TX, "left_semi"), outputs.join(key, TX, "left_semi")
    net = erg_diffs(ins, outs).where(~F.col("address_id").isin(bank, FEES))
    movers = token_diffs(ins, outs).where(F.col("asset_id").isin(sc, rc)).select(*TX, "address_id").distinct()
    gains = net.where("nano > 0").join(movers, [*TX, "address_id"], "left_anti").groupBy(*TX).agg(F.count("*").alias("n"), F.min("nano").alias("fee"), F.min("address_id").alias("who"))
    mint = gains.where("n = 1").select(*TX, F.col("fee").alias("mint_fee"), F.col("who").alias("mint_who"))
    to = outs.where(~F.col("address_id").isin(bank, FEES)).select(*TX, "address_id").distinct().join(net, [*TX, "address_id"], "left").na.fill(0, ["nano"])
    row = F.struct("nano", "address_id")
    pair = to.groupBy(*TX).agg(F.count("*").alias("n"), F.min(row).alias("lo"), F.max(row).alias("hi")).where("n = 2 and lo.nano <> hi.nano")
    pick = F.when(F.col("lo.nano") > 0, F.col("lo")).otherwise(F.col("hi"))
    redeem = pair.select(*TX, pick.alias("p")).select(*TX, F.col("p.nano").alias("redeem_fee"), F.col("p.address_id").alias("redeem_who"))
    joined = key.join(mint, TX, "left").join(redeem, TX, "left")
    is_mint = F.col("reserves_diff") > 0
    return joined.select(*TX, F.coalesce(F.when(is_mint, F.col("mint_fee")).otherwise(F.col("redeem_fee")), F.lit(0)).cast("long").alias("fee"), F.when(is_mint, F.col("mint_who")).otherwise(F.col("redeem_who")).alias("service"))


def bank_history(events: DataFrame, initial: tuple[int, int, int] = (0, 0, 0)) -> DataFrame:
    """The bank's state after each block with events: circ_sc, circ_rc, reserves, sc_net and rc_net as running sums in event order,
    the oracle as last posted. Sums are taken by block first. sc_net and rc_net cumulate the reserves that move with each coin."""
    change = lambda c, when: F.sum(F.when(when, F.col(c)).otherwise(0))
    real = F.col("kind") == "bank"
    block = events.groupBy("height").agg(
        F.sum("circ_sc_diff").alias("circ_sc"), F.sum("circ_rc_diff").alias("circ_rc"), F.sum("reserves_diff").alias("reserves"),
        change("reserves_diff", real & (F.col("circ_sc_diff") != 0)).alias("sc_net"), change("reserves_diff", real & (F.col("circ_rc_diff") != 0)).alias("rc_net"),
        F.max_by("oracle", F.when(F.col("oracle").isNotNull(), F.col("tx_idx"))).alias("oracle"),
    )
    run = forward_fill(prefix_sum(block, "height", ["circ_sc", "circ_rc", "reserves", "sc_net", "rc_net"]), "height", ["oracle"])
    sc, rc, reserves = initial
    return run.select("height", (F.col("circ_sc") + sc).alias("circ_sc"), (F.col("circ_rc") + rc).alias("circ_rc"), (F.col("reserves") + reserves).alias("reserves"), "sc_net", "rc_net", "oracle")


def rc_ticks(history: DataFrame) -> DataFrame:
    """(height, price) after each state change once there is an oracle value."""
    return history.where("oracle is not null").select("height", rc_price(F.col("oracle"), F.col("circ_sc"), F.col("circ_rc"), F.col("reserves")).alias("price"))


def ohlc(ticks: DataFrame, blocks: DataFrame, unit: str, price: str = "price") -> DataFrame:
    """(date, open, high, low, close) a day, week or month. Blocks without a price carry the last one, so a period that opens without
    an event opens at the previous close; periods without blocks are flat at it, one row each.
    ticks (height, seq, price): several for a block in order; blocks (height, timestamp): every block."""
    by_block = ticks.groupBy("height").agg(F.min_by(price, "seq").alias("o"), F.max(price).alias("h"), F.min(price).alias("l"), F.max_by(price, "seq").alias("c"))
    filled = forward_fill(blocks.select("height", "timestamp").join(by_block, "height", "left").withColumn("last", F.col("c")), "height", ["last"]).where("last is not null")
    whole = filled.select("height", period_date(utc_date(F.col("timestamp")), unit).alias("date"), *(F.coalesce(c, "last").alias(c) for c in "ohlc"))
    periods = whole.groupBy("date").agg(F.min_by("o", "height").alias("open"), F.max("h").alias("high"), F.min("l").alias("low"), F.max_by("c", "height").alias("close"))
    return gap_filled(periods, "date", unit, {"open": "close", "high": "close", "low": "close"})


def service_stats(fees: DataFrame, service: str = "service") -> DataFrame:
    """By service, none being a group: transactions, first and last time, fees and volume. fees has timestamp, fee, reserves_diff."""
    return fees.groupBy(service).agg(F.count("*").alias("tx_count"), F.min("timestamp").alias("first_tx"), F.max("timestamp").alias("last_tx"), F.sum("fee").alias("fees"), F.sum(F.abs("reserves_diff")).alias("volume"))


def bank_tx_index(events: DataFrame) -> DataFrame:
    """Bank transactions that change something, numbered from 1."""
    return dense_ids(events.where("kind = 'bank'"), TX, "idx", 1)


def held(assets: Column, asset_id: int) -> Column:
    return asset_amount(assets, asset_id)
