"""Chain slices as files come in: checked, flattened, and followed by tables of boxes and of what spends them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.diffs import expand_inputs, unspent_boxes
from ..shared import materialize
from ..sources import checked_blocks, flatten_blocks, read_blocks
from . import run_available
from .chain import Chain
from .tables import table_or_empty

OUTPUTS = "height long, tx_idx long, out_idx long, box_id string, address string, value long"
INPUTS = "height long, tx_idx long, box_id string"
REJECTED = "height long, header_id string, reason string, batch long"


class BlockFiles:
    """Tables under a folder that follow the best chain of the blocks in files. Slices may overlap by as much as a rollback can go
    back; blocks that can't be used are kept with their reason, by batches, so one that comes again takes its own place."""

    def __init__(self, spark: SparkSession, path: str, span: int = 1000):
        self.spark, self.path = spark, path
        self.chain = Chain(spark, f"{path}/chain", {"outputs": OUTPUTS, "inputs": INPUTS}, span)

    def follow(self, source: str) -> None:
        """Take in the files that came into source since the last call."""
        run_available(read_blocks(self.spark, source, stream=True), self._take, f"{self.path}/checkpoint")

    def _take(self, batch: DataFrame, number: int) -> None:
        blocks = materialize(batch, "batch")  # lines are parsed once
        good, bad = checked_blocks(blocks)
        bad.select(F.col("height").cast("long").alias("height"), "header_id", "reason").write.mode("overwrite").parquet(f"{self.path}/rejected/batch={number}")
        flat = flatten_blocks(materialize(good, "blocks"))
        long = lambda df, *text: df.select(*(F.col(c).cast("long").alias(c) for c in df.columns if c in ("height", "tx_idx", "out_idx", "value")), *text)
        headers = long(flat["headers"], "header_id", "parent_id")
        if not headers.isEmpty():
            self.chain.follow(headers, {"outputs": long(flat["outputs"], "box_id", "address"), "inputs": long(flat["inputs"], "box_id")})

    def outputs(self) -> DataFrame:
        return self.chain.tables["outputs"].diffs()

    def inputs(self) -> DataFrame:
        return self.chain.tables["inputs"].diffs()

    def unspent(self) -> DataFrame:
        return unspent_boxes(self.outputs(), self.inputs())

    def spent(self) -> DataFrame:
        """Inputs with the boxes that they spend; boxes that no file holds have no row."""
        return expand_inputs(self.inputs(), self.outputs().drop("out_idx"))

    def rejected(self) -> DataFrame:
        return table_or_empty(self.spark, f"{self.path}/rejected", REJECTED)
