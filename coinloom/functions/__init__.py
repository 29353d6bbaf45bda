"""Column functions: identifiers, votes, extension fields, registers, prices and calendars. All are built-in."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import DAY_MS, DEFAULT_RC_PRICE, MINER, MINER_PREFIX, OTHER, P2PK, WEEK_MS


def address_type(address: Column) -> Column:
    """1 for wallets, 2 for the mining contract, 3 for other scripts, from an address's text."""
    return F.when(address.startswith("9") & (F.length(address) == 51), P2PK).when(address.startswith(MINER_PREFIX), MINER).otherwise(OTHER)


def type_of_id(address_id: Column) -> Column:
    return F.pmod(address_id, F.lit(10)).cast("int")


def sequence_position(address_id: Column) -> Column:
    return F.floor(address_id / 10).cast("long")


def signed_byte(hex2: Column) -> Column:
    n = F.conv(hex2, 16, 10).cast("int")
    return F.when(n > 127, n - 256).otherwise(n)


def parse_votes(hex6: Column) -> Column:
    """Three signed votes from six hex digits; null where there are not six."""
    return F.when(F.length(hex6) == 6, F.array(*(signed_byte(F.substring(hex6, i, 2)).cast("short") for i in (1, 3, 5))))


def decode_extension(key: Column, value: Column) -> Column:
    """struct(kind, id, number, key16): parameters have key byte 0 and four bytes of value; byte 1 is an interlink."""
    number = F.conv(value, 16, 10).cast("long")
    number = F.when(number >= 2**31, number - 2**32).otherwise(number).cast("int")
    ident = F.conv(F.substring(key, 3, 2), 16, 10).cast("int")
    key16 = F.conv(key, 16, 10).cast("int")
    key16 = F.when(key16 > 32767, key16 - 65536).otherwise(key16)
    known = (F.substring(key, 1, 2) == "00") & (F.length(value) == 8) & (ident.between(0, 8) | (ident == 123))
    kind = F.when(known, "parameter").when(F.substring(key, 1, 2) == "01", "interlink").otherwise("unknown")
    return F.struct(kind.alias("kind"), F.when(known, ident).alias("id"), F.when(known, number).alias("number"), key16.alias("key16"))


def has_register(registers: Column, name: str) -> Column:
    return F.coalesce(F.get_json_object(registers, f"$.{name}").isNotNull(), F.lit(False))


#: Bytes of a long's groups: all but the last have their high bit set, and ten of them hold 64 bits at most.
SLONG = "^05(([89a-f][0-9a-f]){0,8}[0-7][0-9a-f]|([89a-f][0-9a-f]){9}0[01])$"


def decode_slong(hexes: Column | str) -> Column:
    """A serialized long: type byte 05, then a zig-zag number in groups of seven bits. Anything else, and what needs more than
    64 bits, gives null."""
    text = F.lower(F.col(hexes) if isinstance(hexes, str) else hexes)
    group = lambda i: F.coalesce(F.conv(F.substring(text, 2 * i + 3, 2), 16, 10).cast("long"), F.lit(0)).bitwiseAND(F.lit(127))
    n = functools.reduce(lambda a, i: a.bitwiseOR(F.shiftleft(group(i), 7 * i)), range(1, 10), group(0))
    return F.when(text.rlike(SLONG), F.shiftrightunsigned(n, 1).bitwiseXOR(-n.bitwiseAND(F.lit(1).cast("long"))))


def rc_price(oracle: Column, circ_sc: Column, circ_rc: Column, reserves: Column) -> Column:
    """The reserve coin's price in integers: equity over supply, or the default where either is not positive."""
    d = lambda c: c.cast("decimal(38,0)")
    liabilities = F.floor(d(oracle) * d(circ_sc) / 100)
    equity = F.greatest(F.lit(0).cast("decimal(38,0)"), (d(reserves) - liabilities).cast("decimal(38,0)"))
    return F.when((circ_rc > 0) & (equity > 0), F.floor(equity / d(circ_rc)).cast("long")).otherwise(F.lit(DEFAULT_RC_PRICE).cast("long"))


def to_display_units(circ_sc: Column) -> Column:
    return F.round(circ_sc.cast("decimal(38,2)") / 100, 2).cast("double")


def utc_date(ms: Column) -> Column:
    return F.to_date(F.timestamp_millis(ms))


def period_date(date: Column, unit: str) -> Column:
    """The day, the Monday of the week, or the first of the month."""
    return date if unit == "day" else F.trunc(date, unit).cast("date")


def ceil_to(ms: Column, step: int) -> Column:
    """The period boundary at or after ms; weeks start on Monday."""
    shift = 4 * DAY_MS if step == WEEK_MS else 0
    return (F.ceil((ms - shift) / step) * step + shift).cast("long")


#: Patterns of valid input (fixed values): addresses, digests, wallet addresses.
PATTERNS = {"address": r"\A[a-zA-Z0-9]+\z", "digest": r"\A[a-zA-Z0-9]{64}\z", "p2pk": r"\A9[a-zA-Z0-9]{50}\z"}


def valid(column: Column, kind: str) -> Column:
    return F.coalesce(column.rlike(PATTERNS[kind]), F.lit(False))


def base58(column: Column) -> Column:
    """Whether a text can be an encoded address: the alphabet lacks 0, O, I and l."""
    return F.coalesce(column.rlike(r"\A[1-9A-HJ-NP-Za-km-z]+\z"), F.lit(False))


def asset_amount(assets: Column, asset_id) -> Column:
    """How much of one asset a box holds."""
    return F.coalesce(F.aggregate(F.filter(assets, lambda a: a["asset_id"] == asset_id), F.lit(0).cast("long"), lambda n, a: n + a["amount"]), F.lit(0).cast("long"))


def holds_asset(assets: Column, asset_id) -> Column:
    return F.coalesce(F.exists(assets, lambda a: a["asset_id"] == asset_id), F.lit(False))
