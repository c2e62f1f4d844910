"""The two cleaning flows as a whole."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from checks.registry import check, shape, table
from checks.transforms import MONEY_COLUMNS, MONEY_SQL
from rowproof.plans.cleaning import PipelineResult, clean_lobbying, clean_registrations
from rowproof.reference_data import (
    FEE_COLUMNS,
    LATEST_MODEL_YEAR,
    MANDATORY_REGISTRATION_COLUMNS,
    SALE_DATE_FILL_TYPES,
)
from rowproof.schemas import REGISTRATION_TYPES
from rowproof.sources.listing import align

FILE_ID = 1
AS_OF = datetime.date(2001, 1, 1)

# Columns of the registration shape, in order.
_COLUMNS = [
    "DOL Vehicle ID", "VIN (1-10)", "Model Year", "Year", "Make", "Model", "Primary Use",
    "Electric Utility", "City", "State", "County", "Postal Code", "Legislative District",
    "Transaction Type", "Transaction Date", "Sale Date", "Base MSRP", "Sale Price",
    "Odometer Reading", "Electric Range", *FEE_COLUMNS,
]


def _typed(name: str) -> str:
    if name not in REGISTRATION_TYPES:
        return f"`{name}`"
    digits = f"regexp_extract(`{name}`, '^([+-]?[0-9]+)([.][0-9]*)?$', 1)"
    return f"TRY_CAST({digits} AS {REGISTRATION_TYPES[name]}) AS `{name}`"


def _late(name: str) -> str:
    date = f"CAST(try_strptime(`{name}`, '%B %d %Y') AS DATE)"
    return f"coalesce({date} > DATE '{AS_OF}', FALSE)"


_LATE = f"({_late('Transaction Date')} OR {_late('Sale Date')})"
_COMPLETE = " AND ".join(f"`{name}` IS NOT NULL" for name in MANDATORY_REGISTRATION_COLUMNS)
_DISTINCT = f"""
    SELECT DISTINCT {", ".join(_typed(name) for name in _COLUMNS)}
    FROM <registrations_redelivered> AS g
"""
_FEES = ", ".join(
    f"CASE WHEN `{name}` IS NULL OR lower(`{name}`) IN ('no', 'not applicable') THEN 'no' "
    f"ELSE lower(`{name}`) END AS `{name}`"
    for name in FEE_COLUMNS
)
_FILL_TYPES = ", ".join(f"'{kind}'" for kind in SALE_DATE_FILL_TYPES)


def _cleaned(spark: SparkSession, sf_dir: str) -> PipelineResult:
    text = shape(spark, sf_dir, "registrations_redelivered")
    return clean_registrations(align(text, text.columns, REGISTRATION_TYPES), FILE_ID, AS_OF)


@check(
    "clean_registrations",
    f"""
    WITH d AS ({_DISTINCT}),
         v AS (SELECT * FROM d WHERE NOT {_LATE} AND {_COMPLETE}),
         m AS (SELECT `Model`, `Make`, max(`Electric Range`) AS top FROM v GROUP BY ALL)
    SELECT v.* REPLACE (
               CASE WHEN `Electric Range` = 0 AND top IS NOT NULL THEN top
                    ELSE `Electric Range` END AS `Electric Range`,
               CASE WHEN `Model Year` > {LATEST_MODEL_YEAR} THEN `Year`
                    ELSE `Model Year` END AS `Model Year`,
               CASE WHEN `Transaction Type` IN ({_FILL_TYPES}) AND `Sale Date` IS NULL
                    THEN `Transaction Date` ELSE `Sale Date` END AS `Sale Date`,
               {_FEES}),
           CAST(month(strptime(`Transaction Date`, '%B %d %Y')) AS INTEGER)
               AS `Transaction Month`,
           CAST(dayofweek(strptime(`Transaction Date`, '%B %d %Y')) + 1 AS INTEGER)
               AS `Transaction Day of Week`
    FROM v LEFT JOIN m ON v.`Model` = m.`Model` AND v.`Make` = m.`Make`
    """,
)
def registrations_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).valid


_JSON = "to_json({" + ", ".join(f"'{name}': `{name}`" for name in _COLUMNS) + "})"
_FIRST_GAP = " ".join(
    f"WHEN `{name}` IS NULL THEN '{name}'" for name in MANDATORY_REGISTRATION_COLUMNS
)


@check(
    "clean_registrations_errors",
    f"""
    SELECT md5('{FILE_ID}|1|' || {_JSON}) AS record_id, {FILE_ID} AS processing_file_id,
           CASE WHEN {_LATE} THEN 'Transaction Date / Sale Date' ELSE CASE {_FIRST_GAP} END END
               AS column_name,
           CASE WHEN {_LATE} THEN 1012 ELSE 1001 END AS error_code
    FROM ({_DISTINCT}) AS d WHERE {_LATE} OR NOT ({_COMPLETE})
    UNION ALL
    SELECT md5('{FILE_ID}|1|{{"error": "Duplicate records found"}}'), {FILE_ID}, 'N/A', 1015
    FROM <registrations_redelivered> AS g
    HAVING count(*) > (SELECT count(*) FROM ({_DISTINCT}) AS d)
    """,
)
def registration_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cleaned(spark, sf_dir).ledger.columns


@check(
    "clean_lobbying",
    f"""
    SELECT *, CAST({" + ".join(MONEY_COLUMNS)} AS DECIMAL(15,2)) AS total_financials
    FROM ({MONEY_SQL.format(lineitem="lineitem")}) AS m WHERE itemized_expenses IS NOT NULL
    """,
)
def lobbying_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(MONEY_SQL, lineitem=table(spark, sf_dir, "lineitem"))
    return clean_lobbying(rows, FILE_ID).valid
