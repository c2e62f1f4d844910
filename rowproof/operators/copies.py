"""Whole-row copies, key duplicates and row differences.

Each is an aggregation with map-side combine, so a row or key that makes up a large part
of the input shrinks to one row per input task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowproof.functions.columns import named, named_all
from rowproof.operators.novelty import new_rows

COPIES = "_copies"


def count_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with the number of times each occurs; nulls are equal."""
    return df.groupBy(*named_all(df.columns)).agg(F.count(F.lit(1)).alias(COPIES))


def distinct_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*named_all(columns)) if columns else df).distinct()


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by the other columns in order, nulls first."""
    rest = [name for name in df.columns if name not in keys]
    if not rest:
        return distinct_rows(df, df.columns)
    smallest = F.min(F.struct(*named_all(rest))).alias("_row")
    kept = df.groupBy(*named_all(keys)).agg(smallest)
    return kept.select(*[
        named(name) if name in keys else F.col("_row").getField(name).alias(name)
        for name in df.columns
    ])


def expand_copies(df: DataFrame, ordinal: str = "ordinal", chunk: int = 100_000) -> DataFrame:
    """Undo :func:`count_copies`: each row ``_copies`` times, numbered from 1.

    Rows with more than ``chunk`` copies are dealt to tasks in chunks of as many, so a hot row is
    spread. All others are numbered where they are, without a shuffle.
    """
    columns = named_all(name for name in df.columns if name != COPIES)
    one = F.lit(1).cast("long")
    last_chunk = F.floor((F.col(COPIES) - 1) / chunk).cast("long")
    chunk_start = F.col("_chunk") * chunk + 1
    chunk_end = F.least(F.col(COPIES), (F.col("_chunk") + 1) * chunk)
    few = df.filter(F.col(COPIES) <= chunk).select(
        *columns, F.explode(F.sequence(one, F.col(COPIES))).alias(ordinal))
    many = (
        df.filter(F.col(COPIES) > chunk)
        .withColumn("_chunk", F.explode(F.sequence(one - 1, last_chunk)))
        .repartition(*columns, F.col("_chunk"))
        .select(*columns, F.explode(F.sequence(chunk_start, chunk_end)).alias(ordinal))
    )
    return few.unionByName(many)


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that are not in ``right``; nulls are equal.

    Copies are removed from both sides before they meet in a join.
    """
    return new_rows(distinct_rows(left), right, left.columns)
