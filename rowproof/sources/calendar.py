"""Daily calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowproof.functions.dates import weekday_name
from rowproof.reference_data import CALENDAR_END, CALENDAR_START


def with_calendar_parts(days: DataFrame, date: str = "full_date") -> DataFrame:
    """Adds year, quarter, month and the name of the day."""
    day = F.col(date)
    return days.select(
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        weekday_name(day).alias("day_of_week"),
    )


def days_between(bounds: DataFrame, first: Column, last: Column) -> DataFrame:
    """Every day from ``first`` to ``last``, both included, for each row of ``bounds``."""
    return bounds.select(
        F.explode(F.sequence(first, last, F.expr("interval 1 day"))).alias("full_date")
    )


def calendar(
    spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END
) -> DataFrame:
    """Time dimension from ``start`` to ``end``."""
    one_row = spark.range(1)
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return with_calendar_parts(days_between(one_row, first, last))
