"""Validation, ledgers, copies, profiles and foreign keys."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, shape, table
from rowproof.functions.columns import named
from rowproof.operators.copies import (
    count_copies,
    distinct_rows,
    except_rows,
    one_per_key,
)
from rowproof.operators.ledger import (
    attach_codes,
    code_for,
    duplicate_ledger,
    error_reference,
    ledger_of,
    numbered_rejects,
)
from rowproof.operators.lookup import lookup, missing_counts, reference_check, resolve_references
from rowproof.operators.metrics import error_metrics, run_metrics
from rowproof.operators.profile import null_profile
from rowproof.operators.rules import not_in_future, not_null, readable, required
from rowproof.operators.validate import FINDINGS, Validation, validate
from rowproof.reference_data import ERROR_MESSAGES
from rowproof.session import settle
from rowproof.sources.capture import category_of, with_registered_category

FILE_ID = 1
AS_OF = datetime.date(2001, 1, 1)
GAP_COLUMNS = ["o_custkey", "o_orderstatus", "o_orderpriority"]
ALL_COLUMNS = [
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
]

_JSON_SQL = "CAST(to_json({" + ", ".join(f"'{c}': {c}" for c in ALL_COLUMNS) + "}) AS STRING)"
_ANY_GAP = " OR ".join(f"{c} IS NULL" for c in GAP_COLUMNS)


def _findings(checked: Validation, key: str = "o_orderkey") -> DataFrame:
    found = checked.rejected.select(named(key), F.explode(FINDINGS).alias("f"))
    return found.select(
        named(key),
        F.col("f.column_name").alias("column_name"),
        code_for(F.col("f.error_message")).alias("error_code"),
    )


def _per_column(code: int, columns: list[str], source: str = "<orders_gaps>") -> str:
    return " UNION ALL ".join(
        f"SELECT o_orderkey, '{c}' AS column_name, {code} AS error_code "
        f"FROM {source} AS g WHERE {c} IS NULL"
        for c in columns
    )


@check("validate_all_not_null", _per_column(1002, GAP_COLUMNS))
def validate_all_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = shape(spark, sf_dir, "orders_gaps")
    return _findings(validate(df, not_null(df.columns)))


@check(
    "validate_split",
    f"""
    SELECT o_orderkey, ({_ANY_GAP}) AS rejected,
           CAST(o_custkey IS NULL AS INTEGER) + CAST(o_orderstatus IS NULL AS INTEGER)
               + CAST(o_orderpriority IS NULL AS INTEGER) AS broken_rules
    FROM <orders_gaps> AS g
    """,
)
def validate_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = validate(shape(spark, sf_dir, "orders_gaps"), not_null(ALL_COLUMNS))
    valid = checked.valid.select(
        "o_orderkey", F.lit(False).alias("rejected"), F.lit(0).alias("broken_rules")
    )
    rejected = checked.rejected.select(
        "o_orderkey", F.lit(True).alias("rejected"), F.size(FINDINGS).alias("broken_rules")
    )
    return valid.union(rejected)


@check(
    "validate_duplicates",
    """
    WITH repeated AS (
        SELECT 1 FROM <orders_redelivered> AS g
        GROUP BY o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                 o_orderpriority
        HAVING count(*) > 1
    ), entry AS (
        SELECT '{"error": "Duplicate records found"}' AS record_text
        FROM repeated HAVING count(*) > 0
    )
    SELECT md5('1|1|' || record_text) AS record_id, 1 AS processing_file_id,
           'N/A' AS column_name, 1015 AS error_code
    FROM entry
    """,
)
def validate_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ledger entry stands for all copies of the file."""
    counted = count_copies(shape(spark, sf_dir, "orders_redelivered"))
    return duplicate_ledger(counted, FILE_ID).columns


@check(
    "validate_duplicates_per_row",
    f"""
    SELECT md5('1|1|' || record_text) AS record_id, 1 AS processing_file_id, record_text
    FROM (
        SELECT {_JSON_SQL} AS record_text FROM <orders_redelivered> AS g
        GROUP BY o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
                 o_orderpriority
        HAVING count(*) > 1
    ) AS r
    """,
)
def validate_duplicates_per_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_copies(shape(spark, sf_dir, "orders_redelivered"))
    return duplicate_ledger(counted, FILE_ID, per_row=True).records


_PARSED = (
    "CAST(try_strptime(trim({c}), ['%B %d %Y', '%B %d, %Y', '%Y-%m-%d', '%m/%d/%Y']) AS DATE)"
)
_TRANSACTION, _SALE = _PARSED.format(c="transaction_date"), _PARSED.format(c="sale_date")
_LATE = (
    f"(coalesce({_TRANSACTION} > DATE '2001-01-01', FALSE)"
    f" OR coalesce({_SALE} > DATE '2001-01-01', FALSE))"
)
_UNREAD = (
    f"((transaction_date IS NOT NULL AND {_TRANSACTION} IS NULL)"
    f" OR (sale_date IS NOT NULL AND {_SALE} IS NULL))"
)
_DATES = ["transaction_date", "sale_date"]


@check(
    "validate_future_date",
    f"""
    SELECT o_orderkey, 'transaction_date / sale_date' AS column_name, 1012 AS error_code
    FROM <orders_dates> AS g WHERE {_LATE}
    """,
)
def validate_future_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = shape(spark, sf_dir, "orders_dates")
    return _findings(validate(df, not_in_future(_DATES, AS_OF)))


@check(
    "validate_unparseable_date",
    f"""
    SELECT o_orderkey, 'transaction_date / sale_date' AS column_name,
           CASE WHEN {_LATE} THEN 1012 ELSE 1005 END AS error_code
    FROM <orders_dates> AS g WHERE {_LATE} OR {_UNREAD}
    """,
)
def validate_unparseable_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = shape(spark, sf_dir, "orders_dates")
    rules = not_in_future(_DATES, AS_OF, unparseable="reject")
    return _findings(validate(df, rules, attribution="first"))


@check(
    "validate_date_spellings",
    f"""
    SELECT o_orderkey, 'transaction_date / sale_date' AS column_name,
           CASE WHEN {_LATE} THEN 1012 ELSE 1005 END AS error_code
    FROM <orders_spelled> AS g WHERE {_LATE} OR {_UNREAD}
    """,
)
def validate_date_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule judges every spelling that staging would load as a date."""
    df = shape(spark, sf_dir, "orders_spelled")
    rules = not_in_future(_DATES, AS_OF, unparseable="reject")
    return _findings(validate(df, rules, attribution="first"))


@check(
    "validate_types",
    """
    SELECT `Sale Price`, 'DOL Vehicle ID' AS column_name, 1003 AS error_code
    FROM <registrations_bad_ids> AS g WHERE `DOL Vehicle ID` LIKE '%X'
    UNION ALL
    SELECT `Sale Price`, 'City' AS column_name, 1006 AS error_code
    FROM <registrations_bad_ids> AS g WHERE `City` IS NOT NULL
    """,
)
def validate_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Integers, decimals and, as a decimal, a column that holds names only."""
    df = shape(spark, sf_dir, "registrations_bad_ids")
    rules = [
        readable("DOL Vehicle ID", "bigint"),
        readable("Model Year"),
        readable("Base MSRP", "decimal(15,2)"),
        readable("City", "decimal(15,2)"),
    ]
    return _findings(validate(df, rules, attribution="all"), "Sale Price")


@check(
    "validate_mandatory_first",
    f"""
    SELECT o_orderkey,
           CASE WHEN o_custkey IS NULL THEN 'o_custkey'
                WHEN o_orderstatus IS NULL THEN 'o_orderstatus'
                ELSE 'o_orderpriority' END AS column_name,
           1001 AS error_code
    FROM <orders_gaps> AS g WHERE {_ANY_GAP}
    """,
)
def validate_mandatory_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = shape(spark, sf_dir, "orders_gaps")
    return _findings(validate(df, required(GAP_COLUMNS), attribution="first"))


@check("validate_mandatory_all", _per_column(1001, GAP_COLUMNS))
def validate_mandatory_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _findings(validate(shape(spark, sf_dir, "orders_gaps"), required(GAP_COLUMNS)))


@check(
    "validate_optional_columns",
    """
    SELECT 'o_clerk' AS column_name, FALSE AS applied, CAST(0 AS BIGINT) AS broken_rows
    UNION ALL
    SELECT 'o_orderpriority', TRUE, count(*) FROM <orders_gaps> AS g
    WHERE o_orderpriority IS NULL HAVING count(*) > 0
    """,
)
def validate_optional_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule whose column the table lacks is skipped and reported as such."""
    df = shape(spark, sf_dir, "orders_gaps")
    checked = validate(df, required(["o_clerk", "o_orderpriority"]))
    found = checked.rejected.select(F.explode(FINDINGS).alias("f"))
    broken = found.groupBy(F.col("f.column_name").alias("column_name")).agg(
        F.lit(True).alias("applied"), F.count(F.lit(1)).alias("broken_rows")
    )
    names = F.array(*[F.lit(rule.reported_as) for rule in checked.skipped])
    skipped = spark.range(1).select(
        F.explode(names).alias("column_name"),
        F.lit(False).alias("applied"),
        F.lit(0).cast("long").alias("broken_rows"),
    )
    return broken.union(skipped)


_NUMBERED = f"""
    SELECT *, md5('1|' || CAST(row_number() OVER (PARTITION BY record_text) AS STRING)
                  || '|' || record_text) AS record_id
    FROM (
        SELECT *, {_JSON_SQL} AS record_text FROM <orders_redelivered> AS g WHERE {_ANY_GAP}
    ) AS j
"""


def _redelivered_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = shape(spark, sf_dir, "orders_redelivered")
    return numbered_rejects(validate(df, not_null(df.columns)), FILE_ID)


@check(
    "error_records",
    f"SELECT record_id, 1 AS processing_file_id, record_text FROM ({_NUMBERED}) AS n",
)
def error_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_of(_redelivered_rejects(spark, sf_dir)).records


@check(
    "error_columns",
    " UNION ALL ".join(
        f"SELECT record_id, 1 AS processing_file_id, '{c}' AS column_name, 1002 AS error_code "
        f"FROM ({_NUMBERED}) AS n WHERE {c} IS NULL"
        for c in GAP_COLUMNS
    ),
)
def error_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_of(_redelivered_rejects(spark, sf_dir)).columns


def _two_code_rules() -> list:
    return required(["o_custkey"]) + not_null(["o_orderstatus", "o_orderpriority"])


@check(
    "error_metrics",
    f"""
    SELECT CAST(year(o_orderdate) AS BIGINT) AS processing_file_id,
           count(*) AS error_count,
           count(DISTINCT CASE WHEN o_custkey IS NULL THEN 1001 END)
             + count(DISTINCT CASE WHEN o_orderstatus IS NULL OR o_orderpriority IS NULL
                                   THEN 1002 END) AS distinct_error_count
    FROM <orders_redelivered> AS g WHERE {_ANY_GAP} GROUP BY 1
    """,
)
def error_metrics_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order year stands for one processed file."""
    checked = validate(shape(spark, sf_dir, "orders_redelivered"), _two_code_rules())
    rejects = numbered_rejects(checked, F.year("o_orderdate").cast("long"))
    ledger = ledger_of(settle(rejects, "rejects"))
    return error_metrics(ledger.records, ledger.columns)


_MESSAGES = "CASE o_orderpriority " + " ".join(
    f"WHEN '{priority}' THEN '{ERROR_MESSAGES[code]}'"
    for priority, code in (("1-URGENT", 1001), ("2-HIGH", 1002), ("3-MEDIUM", 1015))
) + " ELSE 'Unknown problem' END"


@check(
    "error_code_lookup",
    f"""
    SELECT error_message,
           CASE error_message {" ".join(
               f"WHEN '{text}' THEN {code}" for code, text in ERROR_MESSAGES.items()
           )} END AS error_code,
           count(*) AS n
    FROM (SELECT {_MESSAGES} AS error_message FROM orders) AS m GROUP BY 1, 2
    """,
)
def error_code_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "orders").select(F.expr(_MESSAGES).alias("error_message"))
    coded = attach_codes(messages, error_reference(spark))
    return coded.groupBy("error_message", "error_code").agg(F.count(F.lit(1)).alias("n"))


@check(
    "run_metrics",
    f"""
    SELECT count(*) AS initial_count,
           count(*) FILTER (WHERE NOT ({_ANY_GAP})) AS processed_count,
           count(*) FILTER (WHERE {_ANY_GAP}) AS error_count,
           CAST(max(CAST(o_custkey IS NULL AS INTEGER))
             + max(CAST(o_orderstatus IS NULL OR o_orderpriority IS NULL AS INTEGER))
             AS BIGINT) AS distinct_error_count
    FROM <orders_gaps> AS g
    """,
)
def metrics_of_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_metrics(validate(shape(spark, sf_dir, "orders_gaps"), _two_code_rules()))


@check(
    "null_profile",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count "
        "FROM <orders_gaps> AS g"
        for c in ALL_COLUMNS
    ),
)
def profile_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_profile(shape(spark, sf_dir, "orders_gaps"))


@check(
    "filter_required",
    """
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM <orders_gaps> AS g
    WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL
    """,
)
def filter_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = shape(spark, sf_dir, "orders_gaps")
    kept = df.dropna(subset=["o_orderstatus", "o_orderpriority"])
    return kept.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@check(
    "distinct_dim",
    "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM <orders_gaps> AS g",
)
def distinct_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_rows(shape(spark, sf_dir, "orders_gaps"), GAP_COLUMNS)


@check(
    "dedup_by_key",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
    FROM (
        SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_partkey, l_suppkey, l_quantity) AS place
        FROM lineitem
    ) AS r WHERE place = 1
    """,
)
def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"
    )
    return one_per_key(lines, ["l_orderkey", "l_linenumber"])


@check(
    "except_rows",
    """
    SELECT o_custkey, o_orderpriority FROM <orders_gaps> AS a
    EXCEPT
    SELECT o_custkey, o_orderpriority FROM <orders_gaps> AS b WHERE o_orderstatus = 'F'
    """,
)
def rows_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = shape(spark, sf_dir, "orders_gaps")
    columns = ["o_custkey", "o_orderpriority"]
    return except_rows(df.select(*columns), df.filter("o_orderstatus = 'F'").select(*columns))


def _orders_with_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = shape(spark, sf_dir, "solvent_customers")
    return lookup(
        orders, customers, {"o_custkey": "c_custkey"}, {"c_nationkey": "nation_id"}
    )


@check(
    "fk_missing",
    """
    SELECT count(*) - count(c_nationkey) AS nation_id
    FROM orders LEFT JOIN <solvent_customers> AS c ON o_custkey = c_custkey
    """,
)
def fk_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return missing_counts(_orders_with_nation(spark, sf_dir), ["nation_id"])


@check(
    "fk_drop",
    """
    SELECT o_orderkey, o_custkey, c_nationkey AS nation_id
    FROM orders JOIN <solvent_customers> AS c ON o_custkey = c_custkey
    """,
)
def fk_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_references(_orders_with_nation(spark, sf_dir), ["nation_id"], "drop")


@check(
    "fk_quarantine",
    """
    SELECT o_orderkey, 'nation_id' AS column_name, 1014 AS error_code
    FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM <solvent_customers> AS c WHERE o_custkey = c_custkey)
    """,
)
def fk_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _findings(reference_check(_orders_with_nation(spark, sf_dir), ["nation_id"]))


_REGISTRY = """
    SELECT source AS file_category_name, CAST(min(doc_id) AS INTEGER) AS file_schema_id
    FROM {documents} AS d GROUP BY source
    HAVING sum(CASE WHEN lang = 'de' THEN 1 ELSE 0 END)
         > sum(CASE WHEN lang = 'es' THEN 1 ELSE 0 END)
"""


@check(
    "category_gate",
    f"""
    SELECT d.doc_id, d.source AS category, r.file_schema_id
    FROM documents AS d LEFT JOIN ({_REGISTRY.format(documents="documents")}) AS r
      ON d.source = r.file_category_name
    """,
)
def category_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files named after their source; the registry knows some sources."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    registry = settle(spark.sql(_REGISTRY, documents=documents), "registry")
    file_name = F.concat_ws("_", "source", F.col("doc_id").cast("string"))
    files = documents.select("doc_id", category_of(file_name).alias("category"))
    return with_registered_category(files, registry)
