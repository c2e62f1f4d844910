"""Rows not yet in a table, and two-way reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowproof.functions.columns import named, named_all


def has_null(keys: Sequence[str]) -> Column:
    """True when any of the columns is null."""
    result = F.lit(False)
    for key in keys:
        result = result | named(key).isNull()
    return result


def new_rows(
    incoming: DataFrame, existing: DataFrame, keys: Sequence[str], null_safe: bool = True
) -> DataFrame:
    """Rows of ``incoming`` whose whole key is not in ``existing``.

    ``null_safe`` treats null key parts as equal, so a row with a null key is new only
    once; without it such a row is always new. Keys of ``existing`` are made distinct
    with map-side combine first, so a hot key there reaches the join as one row.

    The join compares structs, in which null equals null. Their hash differs from that of
    the distinct keys, so each side gets a shuffle of its own, and adaptive execution can
    split the hot keys of ``incoming``.
    """
    known = existing.select(*named_all(keys))
    if not null_safe:
        known = known.dropna()
    known = known.distinct().select(F.struct(*named_all(keys)).alias("_known"))
    return incoming.join(known, F.struct(*named_all(keys)) == F.col("_known"), "left_anti")


def new_rows_lossless(
    incoming: DataFrame, existing: DataFrame, keys: Sequence[str]
) -> DataFrame:
    """:func:`new_rows` in which a row with a null key part is compared as a whole.

    Such a row cannot be told from others by its key, so it counts as known only when
    ``existing`` holds the very same row. Nothing is lost and nothing is loaded twice.
    """
    null_key = has_null(keys)
    keyed = new_rows(incoming.filter(~null_key), existing, keys, null_safe=False)
    unkeyed = new_rows(incoming.filter(null_key), existing.filter(null_key), incoming.columns)
    return keyed.unionByName(unkeyed)


def key_balance(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key on each side, as ``in_source`` and ``in_target``, with one shuffle."""
    ours = source.select(*named_all(keys), F.lit(1).alias("_s"), F.lit(0).alias("_t"))
    theirs = target.select(*named_all(keys), F.lit(0).alias("_s"), F.lit(1).alias("_t"))
    return ours.union(theirs).groupBy(*named_all(keys)).agg(
        F.sum("_s").alias("in_source"), F.sum("_t").alias("in_target")
    )


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row counts of both sides and of the rows only one side has.

    Counts are of rows, not of keys. A null key part matches nothing.
    """
    null_key = has_null(keys)
    only_source = null_key | (F.col("in_target") == 0)
    only_target = null_key | (F.col("in_source") == 0)

    def total(column: str, condition: Column = F.lit(True)) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0))

    return key_balance(source, target, keys).agg(
        total("in_source").alias("source_rows"),
        total("in_target").alias("target_rows"),
        total("in_source", only_source).alias("only_in_source"),
        total("in_target", only_target).alias("only_in_target"),
    )


def rows_only_in(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whole rows of ``left`` with no match in ``right``; a null key part matches nothing."""
    return new_rows(left, right, keys, null_safe=False)
