"""Reconciliation of two tables by digests of slices.

Both sides lie in slices by the hash of their key, with a digest of each slice beside them: how
many rows, and sum and bitwise xor of their key hashes. Equal digests settle a slice without
reading it. Of slices that differ, finer digests are compared, and only parts that still differ
are reconciled row by row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowproof.functions.columns import named, named_all
from rowproof.operators.novelty import has_null, reconcile
from rowproof.schemas import schema_of
from rowproof.session import settle
from rowproof.sources.committed import CommittedStore
from rowproof.sources.tables import Slices

SLICE = "digest_slice"
#: Sums are kept modulo 2^64 by wrapping addition of two halves.
DIGESTS = schema_of("slice int, n bigint, keyless bigint, low bigint, high bigint, mixed bigint")
_MEASURES = ("n", "keyless", "low", "high", "mixed")


def _hash(keys: Sequence[str], seed: int = 7) -> Column:
    return F.xxhash64(*[x for k in keys for x in (named(k), named(k).isNull())], F.lit(seed))


def digests(rows: DataFrame, keys: Sequence[str], slice_: Column) -> DataFrame:
    """One row per slice. Digests of two sets of rows add up to that of both."""
    h = _hash(keys, 11)
    return rows.groupBy(slice_.alias("slice")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(has_null(keys)).alias("keyless"),
        F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"), F.sum(F.shiftrightunsigned(h, 32)).alias("high"), F.bit_xor(h).alias("mixed"))


def unequal(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Slices whose digests differ, or that one side lacks."""
    right = theirs.select(F.col("slice").alias("_s"), *[F.col(m).alias(f"_{m}") for m in _MEASURES])
    met = ours.join(right, F.col("slice") == F.col("_s"), "full")
    same = F.lit(True)
    for m in _MEASURES:
        same &= F.col(m).eqNullSafe(F.col(f"_{m}"))
    return met.filter(~same).select(F.coalesce("slice", "_s").alias("slice"))


@dataclass(frozen=True)
class DigestedTable:
    """A table in ``slices`` hash slices of its ``keys``, with their digests."""

    store: CommittedStore
    table: str
    schema: StructType
    keys: tuple[str, ...]
    slices: int = 64

    def slice(self) -> Column:
        return F.pmod(_hash(self.keys), F.lit(self.slices)).cast("int")

    def add(self, rows: DataFrame) -> None:
        rows = settle(rows.select(*named_all(self.schema.names)), "digested")
        with self.store.commit(rows.sparkSession):
            self.store.append(rows, self.table, Slices(SLICE, self.slice()))
            self.store.append(digests(rows, self.keys, self.slice()), f"{self.table}_digests")

    def digests(self, spark: SparkSession) -> DataFrame:
        """The digests of all commits, merged."""
        stored = self.store.read(spark, f"{self.table}_digests", DIGESTS)
        merged = [F.bit_xor(m).alias(m) if m == "mixed" else F.sum(m).alias(m) for m in _MEASURES]
        return stored.groupBy("slice").agg(*merged)

    def read(self, spark: SparkSession, slices: Sequence[int]) -> DataFrame:
        return self.store.read(spark, self.table, self.schema, slices=Slices(SLICE, self.slice(), list(slices)))


def reconcile_digested(source: DigestedTable, target: DigestedTable, spark: SparkSession, finer: int = 64) -> DataFrame:
    """What :func:`reconcile` gives for the whole tables, reading only slices that differ.

    Both sides must be sliced alike. Rows with a null key part match nothing, also where the
    digests are equal.
    """
    if (source.keys, source.slices) != (target.keys, target.slices):
        raise ValueError("both sides must be sliced by the same keys")
    keys = list(source.keys)
    ours, theirs = settle(source.digests(spark), "digests"), settle(target.digests(spark), "digests")
    # At most one number for each slice.
    differ = sorted(r[0] for r in unequal(ours, theirs).toLocalIterator())
    equal = ours.filter(~F.col("slice").isin(differ)).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("keyless"), F.lit(0)).alias("keyless"))
    if not differ:
        return _totals(equal, None)
    left, right = (t.read(spark, differ).select(*named_all(keys)) for t in (source, target))
    part = (F.pmod(_hash(keys, 13), F.lit(finer)) * source.slices + source.slice()).cast("int")
    left, right = settle(left.withColumn("_part", part), "left"), settle(right.withColumn("_part", part), "right")
    fine = [settle(digests(side, keys, F.col("_part")), "fine-digests") for side in (left, right)]
    open_ = settle(unequal(*fine).select(F.col("slice").alias("_part")), "unequal")
    settled = fine[0].join(open_, fine[0]["slice"] == open_["_part"], "left_anti").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("keyless"), F.lit(0)).alias("keyless"))
    rest = reconcile(left.join(open_, "_part", "left_semi"), right.join(open_, "_part", "left_semi"), keys)
    return _totals(equal.union(settled).agg(F.sum("n").alias("n"), F.sum("keyless").alias("keyless")), rest)


def _totals(equal: DataFrame, rest: DataFrame | None) -> DataFrame:
    same = equal.select(
        F.col("n").alias("source_rows"), F.col("n").alias("target_rows"), F.col("keyless").alias("only_in_source"), F.col("keyless").alias("only_in_target"))
    both = same if rest is None else same.unionByName(rest)
    return both.agg(*[F.sum(c).alias(c) for c in same.columns])
