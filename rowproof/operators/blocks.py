"""Running totals from stored sums of blocks.

Rows lie in slices by block (a day, say). Beside them is a table of the sums that each batch
added to each block. The total before a block is a sum over that small table; only the blocks
that a report shows are opened.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowproof.functions.columns import named, named_all
from rowproof.schemas import schema_of
from rowproof.session import settle
from rowproof.sources.committed import CommittedStore
from rowproof.sources.tables import Slices

BLOCK = "block"
SUMS = schema_of("block bigint, total bigint, n bigint")


@dataclass(frozen=True)
class BlockTotals:
    """Rows of ``schema`` in the order of ``order``, whose first part decides the ``block``.

    ``block`` must not fall where the order rises; rows that come late find their block.
    """

    store: CommittedStore
    table: str
    schema: StructType
    value: str
    order: tuple[str, ...]
    block: Column

    def add(self, rows: DataFrame) -> None:
        """Store rows, and what they add to the sums of their blocks, in one commit."""
        rows = settle(rows.select(*named_all(self.schema.names)), "block-rows")
        block = self.block.cast("long")
        with self.store.commit(rows.sparkSession):
            self.store.append(rows, self.table, Slices(BLOCK, block))
            sums = rows.groupBy(block.alias(BLOCK)).agg(
                F.coalesce(F.sum(named(self.value)), F.lit(0)).cast("long").alias("total"), F.count(F.lit(1)).alias("n"))
            self.store.append(sums, f"{self.table}_sums")

    def sums(self, spark: SparkSession) -> DataFrame:
        """(block, total, n, before): one row per block, whatever the number of rows."""
        added = self.store.read(spark, f"{self.table}_sums", SUMS).groupBy(BLOCK).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        earlier = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        return added.withColumn("before", F.coalesce(F.sum("total").over(earlier), F.lit(0)))

    def last_blocks(self, spark: SparkSession, rows: int) -> list[int]:
        """The last blocks that hold at least ``rows`` rows together."""
        later = Window.orderBy(F.desc(BLOCK)).rowsBetween(Window.unboundedPreceding, -1)
        reach = self.sums(spark).withColumn("_later", F.coalesce(F.sum("n").over(later), F.lit(0)))
        return sorted(r[0] for r in reach.filter(F.col("_later") < rows).select(BLOCK).toLocalIterator())

    def report(self, spark: SparkSession, total: str, blocks: Sequence[int]) -> DataFrame:
        """Rows of some blocks with the sum of ``value`` over all rows up to each."""
        wanted = Slices(BLOCK, self.block.cast("long"), list(blocks))
        rows = self.store.read(spark, self.table, self.schema, slices=wanted).withColumn("_block", self.block.cast("long"))
        before = settle(self.sums(spark).filter(F.col(BLOCK).isin(list(blocks))).select(F.col(BLOCK).alias("_of"), "before"), "sums")
        inside = Window.partitionBy("_block").orderBy(*named_all(self.order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        placed = rows.join(before, F.col("_block") == F.col("_of"))
        so_far = F.coalesce(F.sum(named(self.value)).over(inside), F.lit(0)) + F.col("before")
        return placed.select(*named_all(self.schema.names), so_far.alias(total))
