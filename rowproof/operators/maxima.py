"""Zero values filled from group maxima that are kept up to date batch by batch.

The maxima are a table of their own, to which each batch adds the groups whose maximum rose.
Rows lie in slices by their group. A batch is filled from the merged maxima; rows stored earlier
are filled anew only in slices that hold a risen group with rows, and these slices change places
in the same commit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from rowproof.functions.columns import named, named_all
from rowproof.operators.lookup import lookup
from rowproof.session import settle
from rowproof.sources.committed import CommittedStore
from rowproof.sources.tables import Slices

GROUP, MAXIMUM, ZERO = "group_slice", "maximum", "was_zero"


@dataclass(frozen=True)
class MaintainedFill:
    """Rows of ``schema`` with zeros of ``value`` filled from the maximum of their ``by`` group."""

    store: CommittedStore
    table: str
    schema: StructType
    value: str
    by: tuple[str, ...]
    slices: int = 32

    @property
    def _stored(self) -> StructType:
        return StructType([*self.schema.fields, StructField(ZERO, BooleanType())])

    @property
    def _maxima(self) -> StructType:
        fields = [self.schema[n] for n in self.by]
        return StructType([*fields, StructField(MAXIMUM, self.schema[self.value].dataType)])

    def _slice(self) -> Column:
        parts = [x for n in self.by for x in (named(n), named(n).isNull())]
        return F.pmod(F.xxhash64(*parts), F.lit(self.slices)).cast("int")

    def _in(self, slices: Sequence[int] = ()) -> Slices:
        return Slices(GROUP, self._slice(), list(slices))

    def maxima(self, spark: SparkSession, slices: Sequence[int] | None = None) -> DataFrame:
        """The largest value of each group so far."""
        wanted = None if slices is None else self._in(slices)
        stored = self.store.read(spark, f"{self.table}_maxima", self._maxima, slices=wanted)
        return stored.groupBy(*named_all(self.by)).agg(F.max(MAXIMUM).alias(MAXIMUM))

    def rows(self, spark: SparkSession) -> DataFrame:
        return self.store.read(spark, self.table, self.schema)

    def _filled(self, rows: DataFrame, maxima: DataFrame) -> DataFrame:
        """Zeros (``was_zero``) replaced by their group's maximum, where there is one."""
        found = lookup(rows, maxima, {n: n for n in self.by}, {MAXIMUM: MAXIMUM})
        value = F.when(F.col(ZERO) & F.col(MAXIMUM).isNotNull(), F.col(MAXIMUM)).otherwise(named(self.value))
        return found.withColumn(self.value, value).select(*named_all(self._stored.names))

    def add(self, batch: DataFrame) -> int:
        """Store a batch; returns how many slices of earlier rows were filled anew."""
        spark = batch.sparkSession
        rows = batch.select(*[named(f.name).cast(f.dataType).alias(f.name) for f in self.schema])
        rows = settle(rows.withColumn(ZERO, F.coalesce(named(self.value) == 0, F.lit(False))), "batch")
        own = settle(
            rows.dropna(subset=list(self.by)).groupBy(*named_all(self.by)).agg(F.max(named(self.value)).alias("_own")), "own-maxima")
        met = sorted(r[0] for r in own.select(self._slice()).distinct().toLocalIterator())
        before = settle(self.maxima(spark, met), "maxima-before")
        merged = settle(
            lookup(own, before, {n: n for n in self.by}, {MAXIMUM: "_before"}).withColumn(MAXIMUM, F.greatest("_own", "_before")), "merged")
        risen = merged.filter(F.col("_own").isNotNull() & (F.col("_before").isNull() | (F.col("_own") > F.col("_before"))))
        again = sorted(r[0] for r in risen.filter("_before IS NOT NULL").select(self._slice()).distinct().toLocalIterator())
        with self.store.commit(spark) as commit:
            if again:
                old = self.store.parts(spark, self.table, self._in(again))
                earlier = self.store.read(spark, self.table, self._stored, slices=self._in(again))
                now = merged.select(*named_all(self.by), MAXIMUM).unionByName(
                    before.join(merged.select(*named_all(self.by)), list(self.by), "left_anti"))
                self.store.append(self._filled(earlier, settle(now, "maxima-now")), self.table, self._in())
                commit.removed += old
            self.store.append(self._filled(rows, merged.select(*named_all(self.by), MAXIMUM)), self.table, self._in())
            self.store.append(risen.select(*named_all(self.by), MAXIMUM), f"{self.table}_maxima", self._in())
        return len(again)
