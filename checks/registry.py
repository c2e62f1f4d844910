"""Registration of queries and the input shapes they share."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rowproof.reference_data import LOBBYING_MONEY_COLUMNS
from rowproof.schemas import LOBBYING_FILE
from rowproof.session import prepare

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@dataclass(frozen=True)
class Check:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CHECKS: dict[str, Check] = {}


def check(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is the same result in DuckDB's dialect."""

    def register(function: Callable[[SparkSession, str], DataFrame]):
        if name in CHECKS:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # The SQL side knows no time zones.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(prepare(spark, sf_dir), sf_dir)

        CHECKS[name] = Check(run, None if sql is None else duck(sql).strip())
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Input shapes. The given tables hold no nulls, text dates or flags, so each shape turns
# some ordinary values into the faults the operators look for. One text serves both
# dialects; DATE_TEXT(c) stands for the date c written as month name, day and year.
SHAPES: dict[str, str] = {}

SHAPES["orders_gaps"] = """
    SELECT o_orderkey,
           CASE WHEN o_totalprice <= 400000 THEN o_custkey END AS o_custkey,
           NULLIF(o_orderstatus, 'P') AS o_orderstatus,
           CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) AS o_totalprice,
           CAST(o_orderdate AS DATE) AS o_orderdate,
           NULLIF(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority
    FROM orders
"""

# Orders of status F are delivered twice.
SHAPES["orders_redelivered"] = f"""
    SELECT * FROM ({SHAPES['orders_gaps']}) AS a
    UNION ALL
    SELECT * FROM ({SHAPES['orders_gaps']}) AS b WHERE o_orderstatus = 'F'
"""

SHAPES["orders_dates"] = """
    SELECT o_orderkey, o_orderstatus,
           CASE o_orderstatus WHEN 'P' THEN 'on ' || DATE_TEXT(o_orderdate)
                ELSE DATE_TEXT(o_orderdate) END AS transaction_date,
           CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN NULL
                WHEN '5-LOW' THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
                ELSE DATE_TEXT(o_orderdate) END AS sale_date
    FROM orders
"""

# The customer dimension holds no customer in debt.
SHAPES["solvent_customers"] = """
    SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_acctbal >= 0
"""

# Orders in the layout of the registration file, every column as text.
SHAPES["registrations"] = """
    SELECT CAST(o_custkey AS STRING) AS `DOL Vehicle ID`,
           'VIN' || CAST(o_custkey AS STRING) AS `VIN (1-10)`,
           CAST(2005 + c_nationkey AS STRING) AS `Model Year`,
           CAST(year(o_orderdate) AS STRING) AS `Year`,
           c_mktsegment AS `Make`,
           n_name AS `Model`,
           o_orderpriority AS `Primary Use`,
           NULLIF(o_orderstatus, 'P') AS `Electric Utility`,
           n_name AS `City`,
           r_name AS `State`,
           NULLIF(c_mktsegment, 'MACHINERY') AS `County`,
           CAST(c_nationkey AS STRING) AS `Postal Code`,
           CAST(n_regionkey AS STRING) AS `Legislative District`,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'Original Title'
                WHEN '2-HIGH' THEN 'Transfer Title' WHEN '3-MEDIUM' THEN 'Registration Renewal'
                ELSE 'Original Registration' END AS `Transaction Type`,
           DATE_TEXT(o_orderdate) AS `Transaction Date`,
           CASE WHEN o_orderstatus <> 'P' THEN DATE_TEXT(o_orderdate) END AS `Sale Date`,
           CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) AS `Base MSRP`,
           CAST(o_orderkey AS STRING) AS `Sale Price`,
           o_orderpriority AS `Odometer Reading`,
           CASE WHEN o_totalprice < 150000 THEN '0'
                ELSE CAST(o_orderkey AS STRING) END AS `Electric Range`,
           CASE o_orderstatus WHEN 'F' THEN ' Yes' WHEN 'O' THEN 'No'
                ELSE 'Not Applicable' END AS `Electric Vehicle Fee Paid`,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'YES' WHEN '2-HIGH' THEN 'unknown'
                WHEN '3-MEDIUM' THEN 'no' END AS `Transportation Electrification Fee Paid`,
           CASE WHEN c_acctbal < 0 THEN 'no' ELSE 'Yes' END
               AS `Hybrid Vehicle Electrification Fee Paid`
    FROM orders
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
"""

# Some vehicle ids are no numbers.
SHAPES["registrations_bad_ids"] = SHAPES["registrations"].replace(
    "CAST(o_custkey AS STRING) AS `DOL Vehicle ID`",
    "CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_custkey AS STRING) || 'X'"
    " ELSE CAST(o_custkey AS STRING) END AS `DOL Vehicle ID`",
)

# Dates in all spellings that staging reads: one-digit days, blanks around, ISO, slashes.
SHAPES["orders_spelled"] = """
    SELECT o_orderkey,
           CASE o_orderpriority
                WHEN '1-URGENT' THEN replace(DATE_TEXT(o_orderdate), ' 0', ' ')
                WHEN '2-HIGH' THEN '  ' || DATE_TEXT(o_orderdate) || ' '
                WHEN '3-MEDIUM' THEN CAST(CAST(o_orderdate AS DATE) AS STRING)
                WHEN '5-LOW' THEN 'no date'
                ELSE DATE_TEXT(o_orderdate) END AS transaction_date,
           CAST(NULL AS STRING) AS sale_date
    FROM orders
"""

# Registrations of status F are delivered twice.
SHAPES["registrations_redelivered"] = f"""
    SELECT * FROM ({SHAPES['registrations']}) AS a
    UNION ALL
    SELECT * FROM ({SHAPES['registrations']}) AS b WHERE `Electric Utility` = 'F'
"""

# The same with odometers that are no numbers.
SHAPES["registrations_arriving"] = SHAPES["registrations_redelivered"].replace(
    "o_orderpriority AS `Odometer Reading`",
    "CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE CAST(o_orderkey AS STRING) END AS `Odometer Reading`",
)

# Orders in the layout of the lobbying file, every column as text; years, amounts and dates
# that cannot be read.
_LOBBYING_TEXTS = {
    "form_submission_id": "CAST(o_orderkey AS STRING)",
    "reporting_year": "CASE o_orderpriority WHEN '5-LOW' THEN 'year ' || CAST(year(o_orderdate) AS STRING)"
    " ELSE CAST(year(o_orderdate) AS STRING) END",
    "reporting_period": "NULLIF(o_orderpriority, '4-NOT SPECIFIED')",
    "compensation": "CASE o_orderstatus WHEN 'P' THEN 'USD ' || CAST(o_custkey AS STRING)"
    " ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) END",
    "expense_date": "CASE o_orderpriority WHEN '3-MEDIUM' THEN DATE_TEXT(o_orderdate)"
    " ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T00:00:00.000' END",
    "monitoring_only": "'No'",
    **{name: "'10.50'" for name in LOBBYING_MONEY_COLUMNS[1:]},
}
SHAPES["lobbying"] = "SELECT {} FROM orders".format(", ".join(
    f"{_LOBBYING_TEXTS.get(name, repr(name))} AS `{name}`" for name in LOBBYING_FILE.names
))

_DATE_TEXT = re.compile(r"DATE_TEXT\((\w+)\)")
_SHAPE = re.compile(r"<(\w+)>")


def duck(sql: str) -> str:
    """DuckDB text: shapes written in place, names quoted its way."""
    sql = _SHAPE.sub(lambda m: f"({SHAPES[m.group(1)]})", sql)
    return _DATE_TEXT.sub(r"strftime(\1, '%B %d %Y')", sql).replace("`", '"')


def shape(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named input shape as a frame."""
    text = _DATE_TEXT.sub(r"date_format(\1, 'MMMM dd yyyy')", SHAPES[name])
    used = [t for t in TABLES if re.search(rf"\b(FROM|JOIN)\s+{t}\b", text)]
    for t in used:
        text = re.sub(rf"\b(FROM|JOIN)\s+{t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})
