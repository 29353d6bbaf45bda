"""Registered queries that begin at files: chain slices, price payloads and seeds are written from the driver's tables as a node or a
service gives them, with overlaps and broken lines, and read back by the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as fn
from .. import streaming
from ..constants import DAY_MS
from ..operators import diffs, exchanges, network, prices
from ..shared import materialize
from ..sources import checked_blocks, flatten_blocks, genesis_outputs, read_blocks, read_price_series
from ..sources.seeds import checked_seed, read_seed, resolved
from ..streaming.blocks import BlockFiles
from . import ledger as led
from .queries import _CLASS, _PRICE, _address, erg, query

#: Heights that neighbouring slices of a chain have in common.
OVERLAP = 8

_ADDRESS = "CASE o_custkey % 3 WHEN 0 THEN rpad('9' || o_custkey, 51, 'x') WHEN 1 THEN '88dhgzEuTX' || o_custkey ELSE 'c' || o_custkey END"
_BLOCKS = f"""o AS (SELECT o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS v, {_ADDRESS} AS address, 788918400000 + datediff('day', DATE '1995-01-01', o_orderdate::DATE) * 86400000 AS time,
    lag(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS spent, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS next, l.* FROM orders
    LEFT JOIN (SELECT l_orderkey, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey)"""


def chain_blocks(s, d) -> DataFrame:
    """Blocks as BLOCK has them, one for each order: it spends its customer's box of the order before (the first one: the genesis
    box), reads the box of the block before, and makes a box with an asset for each line (13 at most) and one for the fee."""
    lines = led.table(s, d, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", F.concat(F.lit("t"), "l_partkey").alias("id"), F.col("l_quantity").cast("long").alias("n")))).alias("lines"))
    before = F.lag("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    orders = led.table(s, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", F.round(F.col("o_totalprice") * 100).cast("long").alias("value"), before.alias("before"))
    k = F.col("o_orderkey")
    named = lambda letter, key: F.concat(F.lit(letter), key)
    box = lambda key: F.array(F.struct(key.alias("boxId")))
    out = lambda i, letter, address, value, assets, registers: F.struct(named(letter, k).alias("boxId"), value.alias("value"), address.alias("ergoTree"), assets.alias("assets"), k.cast("int").alias("creationHeight"), registers.alias("additionalRegisters"), named("x", k).alias("transactionId"), F.lit(i).alias("index"))
    no_assets = F.array().cast("array<struct<tokenId:string,amount:bigint>>")
    assets = F.coalesce(F.transform("lines", lambda a: F.struct(a["id"].alias("tokenId"), a["n"].alias("amount"))), no_assets)
    registers = F.create_map(F.lit("R4"), F.concat(F.lit("04"), F.lower(F.lpad(F.hex(k % 100), 2, "0"))))
    outputs = F.array(out(0, "o", _address("o_custkey"), F.col("value"), assets, F.create_map().cast("map<string,string>")), out(1, "f", F.lit("fee"), k % 100 + 1, no_assets, registers))
    spends = box(F.when(F.col("before").isNull(), named("g", F.col("o_custkey"))).otherwise(named("o", F.col("before"))))
    tx = F.struct(named("x", k).alias("id"), spends.alias("inputs"), F.when(k > 0, box(named("o", k - 1))).otherwise(F.array().cast("array<struct<boxId:string>>")).alias("dataInputs"), outputs.alias("outputs"), F.lit(1).alias("size"))
    time = F.lit(788_918_400_000) + (led.height_of(F.col("o_orderdate")) - 1) * DAY_MS
    votes = F.concat(F.lpad((k % 5).cast("string"), 2, "0"), F.lit("00fa"))
    header = F.struct(named("h", k).alias("id"), named("h", k - 1).alias("parentId"), k.cast("int").alias("height"), time.alias("timestamp"), (F.col("value") * 1000).cast("string").alias("difficulty"), votes.alias("votes"))
    field = F.array(F.array(F.lit("0002"), F.lower(F.lpad(F.hex(k % 1000), 8, "0"))))
    return orders.join(lines, k == F.col("l_orderkey"), "left").select(header.alias("header"), F.struct(named("h", k).alias("headerId"), F.array(tx).alias("transactions")).alias("blockTransactions"), F.struct(field.alias("fields")).alias("extension"))


def slices(s, d) -> list[str]:
    """Folders of JSON lines: two slices of the chain that overlap, and lines that were cut off while they were written."""
    path, blocks = streaming.scratch(s, "slices"), materialize(chain_blocks(s, d), "chain")
    height = F.col("header.height")
    middle = blocks.agg(F.max(height)).first()[0] // 2
    blocks.where(height < middle + OVERLAP).write.json(f"{path}/low", compression="gzip")
    blocks.where(height >= middle).write.json(f"{path}/high", compression="gzip")
    line = F.to_json(F.struct("header", "blockTransactions", "extension"))
    blocks.where(height % 50 == 0).select(F.substring(line, F.lit(1), (F.length(line) * 0.6).cast("int"))).write.text(f"{path}/cut", compression="gzip")
    return [f"{path}/{name}" for name in ("low", "high", "cut")]


def read_slices(s, d) -> dict[str, DataFrame]:
    """The slices' blocks, each once, flattened: lines are parsed once, and each table reads its columns."""
    good, _ = checked_blocks(read_blocks(s, slices(s, d)))
    return flatten_blocks(materialize(good, "blocks"))


@query(f"WITH {_BLOCKS} SELECT k AS height, 'h' || k AS header_id, 'h' || (k - 1) AS parent_id, CAST(time AS BIGINT) AS timestamp, v * 1000 AS difficulty, CAST(k % 5 AS INT) AS v1, 0 AS v2, -6 AS v3, CAST(k % 1000 AS INT) AS min_value_per_byte FROM o")
def file_headers(s, d):
    """Headers of chain slices, with their votes and the parameter that their extension sets."""
    flat = read_slices(s, d)
    votes = fn.parse_votes(F.col("votes"))
    heads = flat["headers"].select(F.col("height").cast("long").alias("height"), "header_id", "parent_id", "timestamp", F.col("difficulty").cast("long").alias("difficulty"), *(votes[i].cast("int").alias(f"v{i + 1}") for i in range(3)))
    return heads.join(network.network_parameters(flat["extension_fields"]).select("height", F.col("min_value_per_byte").cast("int").alias("min_value_per_byte")), "height", "left")


@query(f"""WITH {_BLOCKS} SELECT k AS height, 0 AS out_idx, 'o' || k AS box_id, address, v AS value, CAST(coalesce(n, 0) AS INT) AS n_assets, coalesce(q, 0) AS amount, NULL AS r4 FROM o
    UNION ALL SELECT k, 1, 'f' || k, 'fee', k % 100 + 1, 0, 0, '04' || printf('%02x', k % 100) FROM o""")
def file_outputs(s, d):
    out = read_slices(s, d)["outputs"]
    amount = F.aggregate("assets", F.lit(0).cast("long"), lambda n, a: n + a["amount"])
    return out.select(F.col("height").cast("long").alias("height"), F.col("out_idx").cast("int").alias("out_idx"), "box_id", "address", "value", F.size("assets").alias("n_assets"), amount.alias("amount"), F.get_json_object("registers", "$.R4").alias("r4"))


def genesis_boxes(s, d) -> DataFrame:
    """A box for each customer, from a file of boxes as a node gives them."""
    path = streaming.scratch(s, "genesis")
    c = led.table(s, d, "customer")
    c.select(F.concat(F.lit("g"), "c_custkey").alias("boxId"), F.lit(led.GENESIS_NANO).cast("long").alias("value"), _address("c_custkey").alias("ergoTree")).write.json(path)
    return s.read.schema("boxId string, value long, ergoTree string").json(path).select(F.col("boxId").alias("box_id"), F.col("ergoTree").alias("address"), "value")


@query(f"SELECT 'g' || c_custkey AS box_id, {_ADDRESS.replace('o_custkey', 'c_custkey')} AS address, CAST(1000000000 AS BIGINT) AS value, row_number() OVER (ORDER BY 'g' || c_custkey) - 1 AS out_idx, 0 AS height, 0 AS tx_idx FROM customer")
def file_genesis(s, d):
    return genesis_outputs(genesis_boxes(s, d)).withColumn("out_idx", F.col("out_idx").cast("long"))


@query(f"WITH {_BLOCKS} SELECT k AS height, address, v - coalesce(spent, 1000000000) AS nano FROM o WHERE v <> coalesce(spent, 1000000000) UNION ALL SELECT k, 'fee', k % 100 + 1 FROM o")
def file_diffs(s, d):
    """From files to diffs: inputs find the boxes that they spend, of the chain or of its genesis, and addresses get their ids."""
    flat, genesis = read_slices(s, d), genesis_boxes(s, d)
    made = flat["outputs"].select("height", "tx_idx", "out_idx", "box_id", "address", "value")
    every = made.unionByName(genesis_outputs(genesis).select(made.columns))
    ids = materialize(diffs.index_addresses(every), "ids")
    spent = diffs.expand_inputs(flat["inputs"], every)
    known = lambda df: df.select("height", "tx_idx", "address", "value").join(diffs.merged(ids.select(F.col("id").alias("address_id"), "address")), "address")
    net = diffs.erg_diffs(known(spent), known(made))
    return net.join(diffs.merged(ids.select(F.col("id").alias("address_id"), "address")), "address_id").select(F.col("height").cast("long").alias("height"), "address", "nano")


@query(f"WITH {_BLOCKS} SELECT k AS height, 'o' || (k - 1) AS box_id, lag(v) OVER (ORDER BY k) AS value FROM o QUALIFY k > 0")
def file_data_inputs(s, d):
    flat = read_slices(s, d)
    read = diffs.expand_data_inputs(flat["data_inputs"], flat["outputs"].select("height", "tx_idx", "box_id", "value"))
    return read.select(F.col("height").cast("long").alias("height"), "box_id", "value")


@query("SELECT 'no header' AS reason, count(*) AS n FROM orders WHERE o_orderkey % 50 = 0")
def file_blocks_rejected(s, d):
    _, bad = checked_blocks(read_blocks(s, slices(s, d)))
    return bad.groupBy("reason").agg(F.count("*").alias("n"))


@query(f"WITH {_BLOCKS} SELECT address, CAST(v AS BIGINT) AS nano, 1 AS n_boxes FROM o WHERE next IS NULL UNION ALL SELECT 'fee', CAST(sum(k % 100 + 1) AS BIGINT), count(*) FROM o")
def stream_block_files(s, d):
    """A stream of chain slices as files come in, each of which begins some blocks before the last one ended: unspent boxes by
    address, of tables that follow the chain."""
    path, blocks = streaming.scratch(s, "arriving"), materialize(chain_blocks(s, d), "chain")
    book = BlockFiles(s, path)
    height = F.col("header.height")
    top = blocks.agg(F.max(height)).first()[0]
    for i in range(3):
        lo, hi = top * i // 3 - OVERLAP, top * (i + 1) // 3
        blocks.where((height >= lo) & (height <= hi)).write.mode("append").json(f"{path}/source", compression="gzip")
        book.follow(f"{path}/source")
    return book.unspent().groupBy("address").agg(F.sum("value").alias("nano"), F.count("*").alias("n_boxes"))


_SINGLE = _PRICE.replace("avg(value) AS p0", "CAST(round(avg(value), 6) AS FLOAT) AS p0").replace("WINDOW w AS (ORDER BY t0))", "WHERE t0 > (SELECT min(t0) + 86400000 FROM pr) WINDOW w AS (ORDER BY t0))")


@query(f"""WITH {_SINGLE}, l AS (SELECT max(t0) AS t, arg_max(p0, t0) AS p FROM pr)
    SELECT height, CAST(CASE WHEN height <= 3 THEN CAST(5.581469768257971 AS FLOAT) ELSE p0 + (p1 - p0) * (CAST(timestamp - t0 AS FLOAT) / CAST(t1 - t0 AS FLOAT)) END AS DOUBLE) AS price, FALSE AS provisional FROM pu ASOF LEFT JOIN iv ON timestamp > t0 WHERE height <= 3 OR timestamp <= t1
    UNION ALL SELECT height, CAST(p AS DOUBLE), TRUE FROM pu, l WHERE height > 3 AND timestamp > t""")
def file_prices(s, d):
    """32-bit prices of blocks from payloads of a day each, which repeat the last day's points; points of the first day are old."""
    path = streaming.scratch(s, "payloads")
    points = materialize(led.hourly_prices(s, d).select("timestamp", F.round("price", 6).alias("price")), "points")
    day = F.floor(F.col("timestamp") / DAY_MS)
    both = points.select(F.explode(F.array(day, day + 1)).alias("day"), F.array(F.col("timestamp").cast("double"), "price").alias("point"))
    both.groupBy("day").agg(F.sort_array(F.collect_list("point")).alias("prices")).select("prices").write.json(path)  # 48 hours at most
    since = points.agg(F.min("timestamp")).first()[0] + DAY_MS
    blocks = led.events(s, d).where("event_type = 'purchase'").select("height", "timestamp")
    out = prices.interpolated(blocks, read_price_series(s, path, since), single=True)
    return out.withColumn("price", F.col("price").cast("double"))


def seeds(s, d) -> tuple[dict[str, DataFrame], DataFrame]:
    """(good rows by kind, (kind, reason) of rejected ones) of seed files with repeats, contradictions and rows that can't be used."""
    path = streaming.scratch(s, "seeds")
    supplier, key = led.table(s, d, "supplier"), F.col("s_suppkey")
    text = F.concat(F.lit("a"), led.supplier_id("s_suppkey"))
    third = F.when(key % 50 == 3, 77).otherwise(key % 50).cast("int")
    names = s.range(5).select(F.least("id", F.lit(3)).cast("int").alias("cex_id"), F.concat(F.lit("cex"), "id").alias("text_id"), F.concat(F.lit("Exchange "), "id").alias("name"))  # the fourth one has two names
    names.unionByName(names.where("cex_id = 0")).write.json(f"{path}/exchanges")
    main = supplier.where("s_suppkey % 50 < 5").select(third.alias("cex_id"), F.when(key % 50 == 4, "a b").otherwise(text).alias("address"))
    main.unionByName(main.where("cex_id = 1")).write.option("header", True).csv(f"{path}/main")
    led.table(s, d, "customer").where("c_custkey % 13 = 0").select(F.concat(F.lit("a"), led.customer_id("c_custkey")).alias("address")).write.json(f"{path}/ignored")
    miners = supplier.where("s_suppkey % 10 = 9").select(F.when(key % 20 == 9, text).otherwise(F.concat(F.lit("b"), key)).alias("address"), F.concat(F.lit("miner "), key).alias("label"), F.concat(F.lit("pool "), key % 3).alias("mining_pool"))
    miners.write.json(f"{path}/miners")
    supplier.where("s_suppkey % 10 = 5").select(F.concat(F.lit('{"address": "a'), "s_suppkey")).write.text(f"{path}/cut")
    good, bad = {}, []

    def take(kind, rows, known=None):
        good[kind], rejected = checked_seed(rows, kind, known)
        bad.append(rejected.select(F.lit(kind).alias("kind"), "reason"))

    take("exchanges", read_seed(s, f"{path}/exchanges", "exchanges"))
    take("main_addresses", read_seed(s, f"{path}/main", "main_addresses", "csv"), good["exchanges"])
    take("ignored", read_seed(s, f"{path}/ignored", "ignored"))
    take("miners", read_seed(s, [f"{path}/miners", f"{path}/cut"], "miners"))
    return good, bad[0].unionByName(bad[1]).unionByName(bad[2]).unionByName(bad[3])


def dictionary(s, d) -> DataFrame:
    """(id, address) of all suppliers and customers."""
    every = led.table(s, d, "supplier").select(led.supplier_id("s_suppkey").alias("id")).union(led.table(s, d, "customer").select(led.customer_id("c_custkey").alias("id")))
    return every.select("id", F.concat(F.lit("a"), "id").alias("address"))


_IGNORING = _CLASS.replace("AND address_id <> 2403", "AND address_id <> 2403 AND NOT (address_id % 10 = 1 AND (address_id // 10) % 13 = 0)")


@query(f"WITH {_IGNORING} SELECT address_id, 'Exchange ' || first AS exchange, spot_height FROM cl WHERE conflict_spot_height IS NULL")
def seeded_deposits(s, d):
    """Deposit addresses from the exchanges, main and ignored addresses of seed files."""
    good, _ = seeds(s, d)
    ids, moved = materialize(dictionary(s, d), "ids"), erg(s, d)
    main, ignored = (materialize(resolved(good[k], ids)[0], k) for k in ("main_addresses", "ignored"))
    found = exchanges.deposit_addresses(exchanges.deposit_candidates(moved, main, ignored))
    return found.join(good["exchanges"], "cex_id").select("address_id", F.col("name").alias("exchange"), "spot_height")


@query("""SELECT 'exchanges' AS kind, 'contradiction' AS reason, 2 AS n UNION ALL SELECT 'miners', 'no key', count(*) FROM supplier WHERE s_suppkey % 10 = 5 HAVING count(*) > 0
    UNION ALL SELECT 'main_addresses', CASE s_suppkey % 50 WHEN 3 THEN 'no exchange' ELSE 'no address' END, count(*) FROM supplier WHERE s_suppkey % 50 IN (3, 4) GROUP BY 2""")
def rejected_seeds(s, d):
    return seeds(s, d)[1].groupBy("kind", "reason").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN s_suppkey % 20 = 9 THEN CAST((s_suppkey + 1000000) * 10 + 2 AS BIGINT) END AS address_id, 'miner ' || s_suppkey AS label, 'pool ' || s_suppkey % 3 AS mining_pool FROM supplier WHERE s_suppkey % 10 = 9")
def seeded_miners(s, d):
    """Known miners by id; those that the dictionary doesn't hold yet have none."""
    found, pending = resolved(seeds(s, d)[0]["miners"], dictionary(s, d))
    return found.select("address_id", "label", "mining_pool").unionByName(pending.select(F.lit(None).cast("long").alias("address_id"), "label", "mining_pool"))


@query("SELECT o_orderkey, o_orderkey % 2 = 0 AS is_address, o_orderkey % 3 = 0 AS is_digest FROM orders")
def valid_input(s, d):
    """Addresses of letters and digits, digests of 64 of them."""
    k = F.col("o_orderkey")
    address = F.concat(F.when(k % 2 == 0, "Z0").otherwise(F.element_at(F.array(F.lit("z-"), F.lit("z "), F.lit("z_")), (k % 3 + 1).cast("int"))), k)
    digest = F.rpad(k.cast("string"), F.when(k % 3 == 0, 64).when(k % 3 == 1, 63).otherwise(65), F.lit("aF"))
    return led.table(s, d, "orders").select("o_orderkey", fn.valid(address, "address").alias("is_address"), fn.valid(digest, "digest").alias("is_digest"))
