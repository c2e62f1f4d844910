"""Dimension and fact frames derived from registration rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from rowproof.functions.columns import named
from rowproof.functions.dates import KNOWN_FORMATS, parse_date_any
from rowproof.functions.flags import standardize_flag
from rowproof.functions.numbers import to_int
from rowproof.operators.copies import distinct_rows
from rowproof.reference_data import FEE_COLUMNS
from rowproof.schemas import REGISTRATION_TYPES
from rowproof.sources.calendar import days_between, with_calendar_parts

# Source column and result name of the dimensions that hold one column.
SINGLE_COLUMN_DIMS = {
    "make_dim": ("Make", "make"),
    "model_dim": ("Model", "model"),
    "primary_use_dim": ("Primary Use", "primary_use"),
    "electric_utility_dim": ("Electric Utility", "electric_utility_name"),
    "state_dim": ("State", "state"),
    "transaction_type_dim": ("Transaction Type", "transaction_type"),
}

PLACE_COLUMNS = {"City": "city", "State": "state", "County": "county"}

VEHICLE_COLUMNS = {
    "DOL Vehicle ID": "dol_vehicle_id",
    "VIN (1-10)": "vin_prefix",
    "Model Year": "model_year",
    "Make": "make",
    "Model": "model",
    "Primary Use": "primary_use",
    "Electric Utility": "electric_utility",
}
# Vehicles are identified by a number, in the dimension and in the facts.
VEHICLE_KEY_TYPE = "bigint"
VEHICLE_REQUIRED = ("dol_vehicle_id", "vin_prefix", "model_year", "make", "model")

MEASURES = {
    "Base MSRP": "base_msrp",
    "Sale Price": "sale_price",
    "Odometer Reading": "odometer_reading",
    "Electric Range": "electric_range",
}


# The columns that staging reads, as cleaned registrations hold them.
SOURCE_SCHEMA = StructType([
    StructField(name, {"int": IntegerType(), "bigint": LongType()}.get(REGISTRATION_TYPES.get(name), StringType()))
    for name in (
        *VEHICLE_COLUMNS, *PLACE_COLUMNS, "Transaction Type", "Transaction Date", "Sale Date",
        *MEASURES, *FEE_COLUMNS,
    )
])


def distinct_dim(
    df: DataFrame, columns: Mapping[str, str], required: Sequence[str] = ()
) -> DataFrame:
    """Distinct values of some columns under new names; ``required`` ones may not be null."""
    picked = df.select(*[named(source).alias(name) for source, name in columns.items()])
    return distinct_rows(picked.dropna(subset=list(required)) if required else picked)


def stage_single(df: DataFrame, source: str, name: str, keep_null: bool = False) -> DataFrame:
    return distinct_dim(df, {source: name}, () if keep_null else (name,))


def stage_city(df: DataFrame, keep_null: bool = False) -> DataFrame:
    columns = {source: PLACE_COLUMNS[source] for source in ("City", "State")}
    return distinct_dim(df, columns, () if keep_null else ("city", "state"))


def stage_location(df: DataFrame, keep_null: bool = False) -> DataFrame:
    required = () if keep_null else ("city", "state", "county")
    return distinct_dim(df, PLACE_COLUMNS, required)


def _fee_flags(trim: bool, raw: bool) -> list[Column]:
    return [
        (named(source) if raw else standardize_flag(named(source), unknown="no", trim=trim)).alias(
            name
        )
        for source, name in FEE_COLUMNS.items()
    ]


def stage_fee(df: DataFrame, trim: bool = True, raw: bool = False) -> DataFrame:
    """Distinct combinations of the three fee flags, each yes or no unless ``raw``."""
    return distinct_rows(df.select(*_fee_flags(trim, raw)))


def stage_vehicle(df: DataFrame, required: Sequence[str] = VEHICLE_REQUIRED) -> DataFrame:
    """Distinct vehicles. An id that is no number is null, and so missing; the rule
    :func:`rowproof.operators.rules.readable` reports such rows with their text."""
    vehicle_id = to_int(named("DOL Vehicle ID"), VEHICLE_KEY_TYPE)
    return distinct_dim(df.withColumn("DOL Vehicle ID", vehicle_id), VEHICLE_COLUMNS, required)


def stage_fact(
    df: DataFrame, formats: Sequence[str] = KNOWN_FORMATS, raw_flags: bool = False
) -> DataFrame:
    """One row per transaction, with parsed dates, integer measures and yes/no flags.

    ``raw_flags`` leaves the flags as they are, to match a fee dimension staged that way.
    """
    return df.select(
        to_int(named("DOL Vehicle ID"), VEHICLE_KEY_TYPE).alias("dol_vehicle_id"),
        parse_date_any(named("Transaction Date"), formats).alias("transaction_date"),
        parse_date_any(named("Sale Date"), formats).alias("sale_date"),
        *[named(source).alias(name) for source, name in PLACE_COLUMNS.items()],
        named("Transaction Type").alias("transaction_type"),
        *[to_int(named(source)).alias(name) for source, name in MEASURES.items()],
        *_fee_flags(trim=True, raw=raw_flags),
    )


def stage_star(spark: SparkSession, df: DataFrame) -> dict[str, DataFrame]:
    """All staged frames by table name. The calendar covers the years of the facts' dates."""
    staged = {
        table: stage_single(df, source, name)
        for table, (source, name) in SINGLE_COLUMN_DIMS.items()
    }
    staged["fee_dim"] = stage_fee(df)
    staged["city_dim"] = stage_city(df)
    staged["location_dim"] = stage_location(df)
    staged["vehicle_dim"] = stage_vehicle(df)
    staged["facts"] = stage_fact(df)
    staged["time_dim"] = stage_days(staged["facts"])
    return staged


# Years that a calendar may cover; a mistyped date must not make it grow without end.
FIRST_YEAR, LAST_YEAR = 1900, 2100
_FACT_DAYS = ("transaction_date", "sale_date")


def _plausible(day: str, first_year: int, last_year: int) -> Column:
    return F.when(F.year(day).between(first_year, last_year), F.col(day))


def stage_days(facts: DataFrame, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> DataFrame:
    """Calendar from the first to the last year in which a fact was dealt or sold.

    Dates outside ``first_year`` to ``last_year`` do not widen it; :func:`days_outside` counts them.
    """
    days = [_plausible(day, first_year, last_year) for day in _FACT_DAYS]
    bounds = facts.agg(
        F.least(*[F.min(day) for day in days]).alias("first"),
        F.greatest(*[F.max(day) for day in days]).alias("last"),
    )
    first = F.make_date(F.year("first"), F.lit(1), F.lit(1))
    last = F.make_date(F.year("last"), F.lit(12), F.lit(31))
    return with_calendar_parts(days_between(bounds, first, last))


def days_outside(facts: DataFrame, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR) -> DataFrame:
    """One row: how many facts have each date outside the years of the calendar."""
    return facts.agg(*[
        F.count_if(F.col(day).isNotNull() & _plausible(day, first_year, last_year).isNull()).alias(day) for day in _FACT_DAYS
    ])
