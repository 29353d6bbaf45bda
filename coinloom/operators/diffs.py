"""Expansion of inputs, dictionaries, and net changes by transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import address_type
from .helpers import dense_ids


def merged(df: DataFrame) -> DataFrame:
    """df as a side of a join that grows with the chain: boxes, inputs, dictionaries. It is sorted and merged, and never goes to the driver
    to be broadcast. Spark takes the bytes of a Parquet file for those of its rows, which for addresses were 75 times as many in memory."""
    return df.hint("merge")


def expand_inputs(inputs: DataFrame, boxes: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """inputs (height, tx_idx, box_id) with the boxes that they spend, and the time at which those were made. An equi-join on
    box_id, both sides of which can be bucketed by it; box_id is unique, so no key is hot."""
    spent = boxes.withColumnRenamed("height", "output_height").drop("tx_idx")
    out = inputs.select("height", "tx_idx", "box_id").join(merged(spent), "box_id")
    if headers is not None:
        out = out.join(headers.select(F.col("height").alias("output_height"), F.col("timestamp").alias("output_timestamp")), "output_height", "left")
    return out


def expand_data_inputs(data_inputs: DataFrame, boxes: DataFrame) -> DataFrame:
    """Boxes that are read and not spent; one may occur often, and unknown ones stay with nulls."""
    return data_inputs.join(merged(boxes.drop("height", "tx_idx")), "box_id", "left")


def unspent_boxes(outputs: DataFrame, inputs: DataFrame) -> DataFrame:
    return outputs.join(merged(inputs.select("box_id")), "box_id", "left_anti")


def index_addresses(outputs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(id, spot_height, address): ids by first appearance (height, tx_idx, out_idx), the position times ten plus the type.
    known: an earlier result, which keeps its ids."""
    first = outputs.groupBy("address").agg(F.min(F.struct("height", "tx_idx", "out_idx")).alias("at"))
    start = 1
    if known is not None:
        first = first.join(merged(known.select("address")), "address", "left_anti")
        start = (known.agg(F.max(F.floor(F.col("id") / 10))).first()[0] or 0) + 1
    numbered = dense_ids(first.select("address", "at.*"), ["height", "tx_idx", "out_idx"], "n", start)
    new = numbered.select((F.col("n") * 10 + address_type(F.col("address"))).alias("id"), F.col("height").alias("spot_height"), "address")
    return new if known is None else known.unionByName(new)


def index_tokens(outputs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(asset_id, spot_height, token_id) in order of first appearance; outputs have assets array<struct<token_id, amount>>."""
    each = outputs.select("height", "tx_idx", "out_idx", F.posexplode("assets").alias("k", "a"))
    first = each.groupBy(F.col("a.token_id").alias("token_id")).agg(F.min(F.struct("height", "tx_idx", "out_idx", "k")).alias("at"))
    start = 1
    if known is not None:
        first = first.join(merged(known.select("token_id")), "token_id", "left_anti")
        start = (known.agg(F.max("asset_id")).first()[0] or 0) + 1
    new = dense_ids(first.select("token_id", "at.*"), ["height", "tx_idx", "out_idx", "k"], "asset_id", start).select("asset_id", F.col("height").alias("spot_height"), "token_id")
    return new if known is None else known.unionByName(new)


def lookup(df: DataFrame, dictionary: DataFrame, text: str, id_col: str) -> DataFrame:
    """df with the id of a text; unknown texts get null."""
    return df.join(merged(dictionary.select(text, id_col)), text, "left")


def erg_diffs(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """(height, tx_idx, address_id, nano): what an address gains in a transaction, without zeros. Partial sums come before the
    one shuffle, on the transaction and address."""
    cols = ["height", "tx_idx", "address_id"]
    legs = outputs.select(*cols, F.col("value").alias("nano")).unionByName(inputs.select(*cols, (-F.col("value")).alias("nano")))
    return legs.groupBy(*cols).agg(F.sum("nano").alias("nano")).where("nano <> 0")


def token_diffs(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """(height, tx_idx, address_id, asset_id, value), from boxes with assets array<struct<asset_id, amount>>; null: none."""
    cols = ["height", "tx_idx", "address_id"]
    legs = lambda df, sign: df.select(*cols, F.explode("assets").alias("a")).select(*cols, "a.asset_id", (F.col("a.amount") * sign).alias("value"))
    return net_tokens(legs(outputs, 1).unionByName(legs(inputs, -1)))


def net_tokens(legs: DataFrame) -> DataFrame:
    """token_diffs of (height, tx_idx, address_id, asset_id, value), which need no exchange where they lie by transaction already."""
    return legs.groupBy("height", "tx_idx", "address_id", "asset_id").agg(F.sum("value").alias("value")).where("value <> 0")


def transacting_addresses(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """(height, n_addresses): distinct addresses among inputs and outputs; data inputs don't count."""
    return inputs.select("height", "address_id").union(outputs.select("height", "address_id")).groupBy("height").agg(F.countDistinct("address_id").alias("n_addresses"))


def semi(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys.select(*on), on, "left_semi")


def excluding(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return df.join(keys.select(*on), on, "left_anti")


def paged(df: DataFrame, order: list[Column], limit: int, offset: int = 0) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)
