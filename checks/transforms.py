"""Cleansing transforms, projections and the calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, shape, table
from rowproof.functions.dates import (
    month_of,
    parse_date,
    parse_date_any,
    weekday_name,
    weekday_number,
)
from rowproof.functions.flags import standardize_flag
from rowproof.functions.names import graph_safe, normalize_names, rename, snake, trim_lower
from rowproof.functions.numbers import fill_for_kinds, money_total, replace_above, to_int
from rowproof.operators.impute import fill_zero_from_group, zero_fill_audit
from rowproof.sources.calendar import days_between, with_calendar_parts

MONEY_SQL = """
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST(l_quantity AS DECIMAL(15,2)) AS compensation,
           CAST(l_extendedprice AS DECIMAL(15,2)) AS reimbursed_expenses,
           CAST(l_discount AS DECIMAL(15,2)) AS expenses_less_than_75,
           CAST(l_tax AS DECIMAL(15,2)) AS lobbying_expenses_for_non,
           CASE WHEN l_returnflag <> 'N' THEN CAST(l_linenumber AS DECIMAL(15,2)) END
               AS itemized_expenses
    FROM {lineitem}
"""
MONEY_COLUMNS = [
    "compensation", "reimbursed_expenses", "expenses_less_than_75",
    "lobbying_expenses_for_non", "itemized_expenses",
]


@check(
    "derive_total",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CAST({" + ".join(MONEY_COLUMNS)} AS DECIMAL(15,2)) AS total_financials
    FROM ({MONEY_SQL.format(lineitem="lineitem")}) AS m
    """,
)
def derive_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.sql(MONEY_SQL, lineitem=table(spark, sf_dir, "lineitem"))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        money_total(MONEY_COLUMNS).alias("total_financials"),
    )


# Tax as whole percent, often zero; line 7 has no group.
_TAXED_SQL = """
    SELECT l_orderkey, l_partkey, l_suppkey, NULLIF(l_linenumber, 7) AS line,
           CAST(round(l_tax * 100) AS INT) AS tax
    FROM {lineitem}
"""
_GROUPED = """
    SELECT t.*, g.top FROM ({taxed}) AS t
    LEFT JOIN (SELECT l_suppkey, line, max(tax) AS top FROM ({taxed}) AS u GROUP BY ALL) AS g
      ON t.l_suppkey = g.l_suppkey AND t.line = g.line
""".format(taxed=_TAXED_SQL.format(lineitem="lineitem"))


def _taxed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_TAXED_SQL, lineitem=table(spark, sf_dir, "lineitem"))


@check(
    "impute_group_max",
    f"""
    SELECT l_orderkey, l_partkey, l_suppkey, line,
           CASE WHEN tax = 0 AND top IS NOT NULL THEN top ELSE tax END AS tax
    FROM ({_GROUPED}) AS j
    """,
)
def impute_group_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_zero_from_group(_taxed(spark, sf_dir), "tax", ["l_suppkey", "line"])


@check(
    "impute_before_after",
    f"""
    SELECT l_orderkey, l_partkey, tax AS value_before, coalesce(top, tax) AS value_after
    FROM ({_GROUPED}) AS j WHERE tax = 0
    """,
)
def impute_before_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _taxed(spark, sf_dir)
    return zero_fill_audit(rows, "tax", ["l_suppkey", "line"], ["l_orderkey", "l_partkey"])


@check(
    "repair_out_of_range",
    """
    SELECT p_partkey, CASE WHEN size > 40 THEN CAST(floor(p_retailprice) AS INTEGER)
                           ELSE size END AS size
    FROM (SELECT *, NULLIF(p_size, 7) AS size FROM part) AS p
    """,
)
def repair_out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").withColumn("size", F.expr("nullif(p_size, 7)"))
    price = F.floor("p_retailprice").cast("int")
    return parts.select("p_partkey", replace_above(F.col("size"), 40, price).alias("size"))


@check(
    "conditional_fill",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderstatus IN ('F', 'O') AND sale_date IS NULL
                THEN transaction_date ELSE sale_date END AS sale_date
    FROM <orders_dates> AS g
    """,
)
def conditional_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = fill_for_kinds(
        F.col("sale_date"), F.col("transaction_date"), F.col("o_orderstatus"), ["F", "O"]
    )
    return shape(spark, sf_dir, "orders_dates").select("o_orderkey", filled.alias("sale_date"))


@check(
    "date_parts",
    """
    SELECT o_orderkey, CAST(month(d) AS INTEGER) AS transaction_month,
           CAST(dayofweek(d) + 1 AS INTEGER) AS transaction_day_of_week,
           dayname(d) AS day_name
    FROM (SELECT o_orderkey, CAST(try_strptime(transaction_date, '%B %d %Y') AS DATE) AS d
          FROM <orders_dates> AS g) AS p
    """,
)
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    date = parse_date(F.col("transaction_date"))
    return shape(spark, sf_dir, "orders_dates").select(
        "o_orderkey",
        month_of(date).alias("transaction_month"),
        weekday_number(date).alias("transaction_day_of_week"),
        weekday_name(date).alias("day_name"),
    )


@check(
    "parse_dates",
    """
    SELECT o_orderkey, CAST(try_strptime(transaction_date, '%B %d %Y') AS DATE)
               AS transaction_date,
           CAST(try_strptime(sale_date, '%B %d %Y') AS DATE) AS sale_date
    FROM <orders_dates> AS g
    """,
)
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, "orders_dates").select(
        "o_orderkey",
        parse_date(F.col("transaction_date")).alias("transaction_date"),
        parse_date(F.col("sale_date")).alias("sale_date"),
    )


@check(
    "parse_dates_multi",
    """
    SELECT o_orderkey,
           coalesce(CAST(try_strptime(sale_date, '%B %d %Y') AS DATE),
                    CAST(try_strptime(sale_date, '%Y-%m-%d') AS DATE)) AS sale_date
    FROM <orders_dates> AS g
    """,
)
def parse_dates_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, "orders_dates").select(
        "o_orderkey", parse_date_any(F.col("sale_date")).alias("sale_date")
    )


# Flags as a registration clerk might write them.
_FLAG = """
    CASE o_orderpriority WHEN '1-URGENT' THEN 'YES' WHEN '2-HIGH' THEN ' Yes'
         WHEN '3-MEDIUM' THEN 'Not Applicable' WHEN '5-LOW' THEN 'Maybe' END
"""


def _flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_FLAG).alias("flag"))


@check(
    "standardize_flag_keep",
    f"""
    SELECT o_orderkey,
           CASE WHEN lower(flag) IS NULL OR lower(flag) IN ('no', 'not applicable')
                THEN 'no' ELSE lower(flag) END AS flag
    FROM (SELECT o_orderkey, {_FLAG} AS flag FROM orders) AS f
    """,
)
def flag_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir).withColumn("flag", standardize_flag(F.col("flag")))


@check(
    "standardize_flag_strict",
    f"""
    SELECT o_orderkey,
           CASE WHEN lower(trim(flag)) = 'yes' THEN 'yes' ELSE 'no' END AS flag,
           CASE WHEN lower(flag) = 'yes' THEN 'yes' ELSE 'no' END AS flag_untrimmed
    FROM (SELECT o_orderkey, {_FLAG} AS flag FROM orders) AS f
    """,
)
def flag_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flags(spark, sf_dir).select(
        "o_orderkey",
        standardize_flag(F.col("flag"), unknown="no", trim=True).alias("flag"),
        standardize_flag(F.col("flag"), unknown="no").alias("flag_untrimmed"),
    )


@check(
    "cast_tolerant",
    """
    SELECT o_orderkey,
           CAST(trunc(CAST(o_totalprice AS DECIMAL(15,2))) AS INTEGER) AS price,
           TRY_CAST(o_orderpriority AS INTEGER) AS priority,
           CAST(o_custkey AS INTEGER) AS customer
    FROM <orders_gaps> AS g
    """,
)
def cast_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, "orders_gaps").select(
        "o_orderkey",
        to_int(F.col("o_totalprice")).alias("price"),
        to_int(F.col("o_orderpriority")).alias("priority"),
        to_int(F.concat(F.lit(" "), F.col("o_custkey").cast("string"))).alias("customer"),
    )


@check(
    "proj_rename",
    "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderpriority FROM orders",
)
def proj_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return rename(orders, {"o_orderkey": "order_id", "o_custkey": "customer_id"})


_ODD_NAMES = {
    " Order ID ": "o_orderkey",
    "Order Date": "o_orderdate",
    "2019 HB Priority (Level)": "o_orderpriority",
}


def _oddly_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(*[F.col(source).alias(name) for name, source in _ODD_NAMES.items()])


@check(
    "normalize_names",
    """
    SELECT o_orderkey AS "order id", o_orderdate AS "order date",
           o_orderpriority AS "2019 hb priority (level)"
    FROM orders
    """,
)
def names_trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_names(_oddly_named(spark, sf_dir), trim_lower)


@check(
    "normalize_names_snake",
    """
    SELECT o_orderkey AS order_id, o_orderdate AS order_date,
           o_orderpriority AS "2019_hb_priority_(level)"
    FROM orders
    """,
)
def names_snake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_names(_oddly_named(spark, sf_dir), snake)


@check(
    "normalize_names_graph",
    """
    SELECT o_orderkey AS order_id, o_orderdate AS order_date,
           o_orderpriority AS hb_priority_level_2019
    FROM orders
    """,
)
def names_graph_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_names(_oddly_named(spark, sf_dir), graph_safe)


@check(
    "time_dim",
    """
    SELECT CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year,
           CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
           dayname(d) AS day_of_week
    FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate),
                                        INTERVAL 1 DAY)) AS d
          FROM orders) AS days
    """,
)
def time_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar from the first to the last order."""
    bounds = table(spark, sf_dir, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("first"),
        F.max(F.to_date("o_orderdate")).alias("last"),
    )
    return with_calendar_parts(days_between(bounds, F.col("first"), F.col("last")))
