"""Sources, sinks, run registration and run state."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, shape, table
from rowproof.functions.dates import date_text, parse_date
from rowproof.operators.identity import running_total
from rowproof.operators.metrics import latest_batch_count, run_state
from rowproof.operators.novelty import new_rows
from rowproof.schemas import schema_of
from rowproof.session import scratch_path
from rowproof.plans.staging import stage_city, stage_single
from rowproof.sinks.files import write_by_value, write_csv, write_staged
from rowproof.sinks.targets import project_to
from rowproof.sources.capture import file_facts
from rowproof.sources.csv import read_csv, read_csv_text
from rowproof.sources.listing import latest_file, merge_yearly
from rowproof.sources.tables import ParquetStore


@check("src_csv_typed", "SELECT * FROM <orders_gaps> AS g")
def src_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = shape(spark, sf_dir, "orders_gaps")
    path = scratch_path(spark, "csv-typed")
    write_csv(df, path)
    return read_csv(spark, path, df.schema)


@check(
    "src_csv_string",
    """
    SELECT CAST(o_orderkey AS STRING) AS o_orderkey, CAST(o_custkey AS STRING) AS o_custkey,
           o_orderstatus, o_totalprice, CAST(o_orderdate AS STRING) AS o_orderdate,
           o_orderpriority
    FROM <orders_gaps> AS g
    """,
)
def src_csv_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv-text")
    write_csv(shape(spark, sf_dir, "orders_gaps"), path)
    return read_csv_text(spark, path)


@check("sink_csv_roundtrip", "SELECT doc_id, text, lang FROM documents")
def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts with quotes, commas and line breaks survive the file."""
    df = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = scratch_path(spark, "csv-roundtrip")
    write_csv(df, path)
    return read_csv(spark, path, df.schema, multi_line=True)


@check("src_csv_inferred", "SELECT * FROM <orders_gaps> AS g")
def src_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types are inferred; money comes back as double and is told so by the cast."""
    df = shape(spark, sf_dir, "orders_gaps")
    path = scratch_path(spark, "csv-inferred")
    write_csv(df, path)
    found = read_csv(spark, path)
    exact = F.col("o_totalprice").cast("decimal(15,2)").cast("string")
    return found.withColumn("o_totalprice", exact).to(df.schema)


@check(
    "date_text_and_back",
    """
    SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day_text,
           CAST(o_orderdate AS DATE) AS day
    FROM orders
    """,
)
def date_text_and_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    text = date_text(F.col("o_orderdate").cast("date"))
    return orders.select("o_orderkey", text.alias("day_text"), parse_date(text, "yyyy-MM-dd").alias("day"))


@check(
    "sink_staged_set",
    """
    SELECT 'city_dim' AS staged, `City` || '/' || `State` AS member FROM <registrations> AS g GROUP BY ALL
    UNION ALL
    SELECT 'state_dim', `State` FROM <registrations> AS h GROUP BY ALL
    """,
)
def sink_staged_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged frames written side by side below one folder and read back."""
    df = shape(spark, sf_dir, "registrations")
    root = scratch_path(spark, "staged-set")
    write_staged({"city_dim": stage_city(df), "state_dim": stage_single(df, "State", "state")}, root)
    cities, states = (spark.read.parquet(f"{root}/{name}") for name in ("city_dim", "state_dim"))
    place = F.concat_ws("/", "city", "state").alias("member")
    return cities.select(F.lit("city_dim").alias("staged"), place).union(
        states.select(F.lit("state_dim"), "state")
    )


_DAILY = """
    SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM {events} GROUP BY 1, 2
"""


@check("src_latest_file", _DAILY.format(events="events"))
def src_latest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts of ever more events are dropped in one folder; the last file has them all."""
    events = table(spark, sf_dir, "events")
    folder = scratch_path(spark, "drop-folder")
    for rows in (events.filter("event_type = 'view'"), events.filter("event_type <> 'error'"), events):
        daily = spark.sql(_DAILY, events=rows)
        daily.coalesce(1).write.mode("append").csv(folder, header=True)
    return read_csv(spark, latest_file(spark, folder), "day date, event_type string, n bigint")


_MONTHLY = """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
           CAST(month(o_orderdate) AS INTEGER) AS month,
           o_orderpriority AS priority, count(*) AS n
    FROM {orders} GROUP BY 1, 2, 3
"""


@check(
    "src_multi_year_merge",
    f"""
    SELECT month, priority, n, CAST(NULL AS INTEGER) AS clerk
    FROM ({_MONTHLY.format(orders="orders")}) AS m
    """,
)
def src_multi_year_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly folders with an older and a newer file each; all of them are found."""
    orders = table(spark, sf_dir, "orders")
    base = scratch_path(spark, "yearly")
    for rows in (orders.filter("o_orderstatus = 'F'"), orders):
        monthly = spark.sql(_MONTHLY, orders=rows).repartition("year")
        monthly.write.mode("append").partitionBy("year").csv(base, header=True)
    return merge_yearly(
        spark,
        base,
        folder_name="year={year}",
        columns=["month", "priority", "n", "clerk"],
        types={"month": "int", "n": "bigint", "clerk": "int"},
    )


@check(
    "src_table_or_empty",
    """
    SELECT o_orderstatus, count(*) AS new_rows, CAST(0 AS BIGINT) AS rows_before
    FROM orders GROUP BY 1
    """,
)
def src_table_or_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against a table that does not exist yet, every row is new."""
    orders = table(spark, sf_dir, "orders")
    store = ParquetStore(scratch_path(spark, "no-such-store"))
    missing = store.read(spark, "orders_archive", orders.schema)
    fresh = new_rows(orders, missing, ["o_orderkey"])
    before = missing.agg(F.count(F.lit(1)).alias("n")).first().n
    return fresh.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("new_rows"), F.lit(before).cast("long").alias("rows_before")
    )


@check("src_table_projection", "SELECT o_orderkey, o_orderpriority FROM orders")
def src_table_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "orders").schema
    store = ParquetStore(sf_dir)
    return store.read(spark, "orders.parquet", schema, ["o_orderkey", "o_orderpriority"])


@check(
    "capture_file_facts",
    """
    SELECT 'orders' AS category, 'o_orderkey, o_custkey, o_orderpriority' AS header_text,
           count(*) AS record_count, TRUE AS has_size
    FROM orders
    """,
)
def capture_file_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An export in part files is captured as one arrival."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    folder = scratch_path(spark, "orders_export")
    write_csv(orders, folder)
    facts = file_facts(spark, [folder], multi_line=False)
    has_size = (F.col("input_file_size") > 0).alias("has_size")
    return facts.select("category", "header_text", "record_count", has_size)


_TARGET = schema_of("o_orderkey int, price money, ordered_on date, monitoring_only boolean")
_LOADED_AT = datetime.datetime(2024, 1, 25, 12, 0, tzinfo=datetime.timezone.utc)


@check(
    "sink_target_projection",
    """
    SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey,
           CAST(o_totalprice AS DECIMAL(15,2)) AS price,
           CAST(o_orderdate AS DATE) AS ordered_on,
           CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS monitoring_only,
           TIMESTAMP '2024-01-25 12:00:00' AS created_at
    FROM orders
    """,
)
def sink_target_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.expr("CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'no' ELSE '?' END")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").alias("price"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("ordered_on"),
        flag.alias("monitoring_only"),
    )
    return project_to(orders, _TARGET, created_at=_LOADED_AT)


@check(
    "sink_partition_by_year",
    """
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
    """,
)
def sink_partition_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year")
    )
    path = scratch_path(spark, "by-year")
    write_by_value(orders, path, "year")
    schema = "o_orderkey bigint, o_totalprice double, year int"
    return spark.read.schema(schema).option("header", True).csv(path)


@check(
    "latest_batch_count",
    """
    SELECT count(*) AS processed_count FROM events
    WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
    """,
)
def latest_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day of events is a batch."""
    events = table(spark, sf_dir, "events").select(F.to_date("ts").alias("created_at"))
    return latest_batch_count(events)


@check(
    "cumulative_counts",
    """
    SELECT day, event_type, n, CAST(sum(n) OVER (ORDER BY day, event_type) AS BIGINT) AS total
    FROM (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2)
         AS r
    """,
)
def cumulative_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each day and type of events is a run."""
    events = table(spark, sf_dir, "events")
    runs = events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n")
    )
    return running_total(runs, "n", ["day", "event_type"], "total")


_RUN_EVENTS = """
    SELECT user_id AS processing_file_id, ts AS event_time,
           CASE WHEN event_type = 'signup' THEN ts END AS start_time,
           CASE WHEN event_type = 'purchase' THEN ts END AS end_time,
           CASE WHEN event_type = 'click' THEN CAST(floor(value) AS BIGINT) END AS processed,
           CASE WHEN event_type = 'error' THEN CAST(floor(value) AS BIGINT) END AS errors
    FROM {events}
"""


@check(
    "run_state_latest",
    f"""
    SELECT processing_file_id,
           arg_max(start_time, event_time) FILTER (WHERE start_time IS NOT NULL)
               AS process_start_time,
           arg_max(end_time, event_time) FILTER (WHERE end_time IS NOT NULL)
               AS process_end_time,
           arg_max(processed, event_time) FILTER (WHERE processed IS NOT NULL)
               AS processed_count,
           arg_max(errors, event_time) FILTER (WHERE errors IS NOT NULL) AS error_count
    FROM ({_RUN_EVENTS.format(events="events")}) AS e GROUP BY 1
    """,
)
def run_state_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user stands for a run whose events set one field at a time."""
    events = spark.sql(_RUN_EVENTS, events=table(spark, sf_dir, "events"))
    fields = {
        "start_time": "process_start_time",
        "end_time": "process_end_time",
        "processed": "processed_count",
        "errors": "error_count",
    }
    return run_state(events, "processing_file_id", "event_time", fields)
