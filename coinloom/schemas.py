"""Explicit schemas of blocks as read from files, of price payloads and of seeds."""

from pyspark.sql import types as T

L, S, I = T.LongType(), T.StringType(), T.IntegerType()


def struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


ASSET = struct(tokenId=S, amount=L)
OUTPUT = struct(boxId=S, value=L, ergoTree=S, assets=T.ArrayType(ASSET), creationHeight=I, additionalRegisters=T.MapType(S, S), transactionId=S, index=I)
INPUT = T.ArrayType(struct(boxId=S))
TRANSACTION = struct(id=S, inputs=INPUT, dataInputs=INPUT, outputs=T.ArrayType(OUTPUT), size=I)
HEADER = struct(id=S, parentId=S, height=I, timestamp=L, difficulty=S, votes=S, version=I, nBits=L, size=I)
BLOCK = struct(header=HEADER, blockTransactions=struct(headerId=S, transactions=T.ArrayType(TRANSACTION)), extension=struct(fields=T.ArrayType(T.ArrayType(S))), size=I)
PRICES = struct(prices=T.ArrayType(T.ArrayType(T.DoubleType())))
SEEDS = {
    "exchanges": struct(cex_id=I, text_id=S, name=S),
    "main_addresses": struct(cex_id=I, address=S),
    "ignored": struct(address=S),
    "miners": struct(address=S, label=S, mining_pool=S),
}
