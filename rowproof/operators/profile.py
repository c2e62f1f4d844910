"""Per-column null profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowproof.functions.columns import named


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column, one row per column, from a single aggregation."""
    counts = df.agg(*[F.count_if(named(name).isNull()).alias(name) for name in df.columns])
    pairs = F.array(*[
        F.struct(F.lit(name).alias("column_name"), named(name).alias("null_count"))
        for name in df.columns
    ])
    return counts.select(F.inline(pairs))
