"""State that is kept beside tables: keys, maxima, block sums, digests, compacted months."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.loads import _registration_table, _sides, _MATCH, _SIDES
from checks.registry import check, shape, table
from checks.transforms import _GROUPED, _taxed
from rowproof import schemas
from rowproof.functions.columns import named_all
from rowproof.operators.blocks import BlockTotals
from rowproof.operators.digests import DigestedTable, reconcile_digested
from rowproof.operators.keystore import DIGEST, KeyStore, split_repeats
from rowproof.operators.maxima import MaintainedFill
from rowproof.plans import staging, warehouse
from rowproof.plans.sliced import load_dim_sliced
from rowproof.schemas import schema_of
from rowproof.session import scratch_path, settle
from rowproof.sources.committed import CommittedStore


def _store(spark: SparkSession, label: str) -> CommittedStore:
    return CommittedStore(scratch_path(spark, label))


@check(
    "load_dim_sliced",
    """
    SELECT `Make` || '/' || `Model` AS model, count(*) AS times, TRUE AS ids_differ
    FROM (SELECT DISTINCT `Make`, `Model` FROM <registrations> AS g) AS d GROUP BY 1
    """,
)
def load_dim_sliced_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members arrive by year, each year with all that came before; each is stored once."""
    dim = warehouse.Dimension("models", "id", ("model",), schema_of("id bigint, model string"))
    rows = settle(shape(spark, sf_dir, "registrations").select(
        F.concat_ws("/", "Make", "Model").alias("model"), F.col("Year").cast("int").alias("year")), "models")
    store = _store(spark, "load-sliced")
    for year in (1993, 1995, 2000):
        load_dim_sliced(spark, store, dim, rows.filter(F.col("year") <= year), slices=16, blocks=16, lease_block=64)
    stored = store.read(spark, dim.table, dim.schema)
    ids = stored.agg((F.count_distinct("id") == F.count("model")).alias("ids_differ"))
    return stored.groupBy("model").agg(F.count(F.lit(1)).alias("times")).join(F.broadcast(ids))


@check(
    "impute_group_max_maintained",
    f"""
    SELECT l_orderkey, l_partkey, l_suppkey, line,
           CASE WHEN tax = 0 AND top IS NOT NULL THEN top ELSE tax END AS tax
    FROM ({_GROUPED}) AS j
    """,
)
def impute_group_max_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, of which later ones raise maxima of groups stored before."""
    rows = settle(_taxed(spark, sf_dir), "taxed")
    fill = MaintainedFill(_store(spark, "maxima"), "lines", rows.schema, "tax", ("l_suppkey", "line"))
    for part in range(3):
        fill.add(rows.filter(F.pmod("l_orderkey", F.lit(3)) == part))
    return fill.rows(spark)


@check(
    "cumulative_counts_blocks",
    """
    SELECT day, event_type, n, total FROM (
        SELECT day, event_type, n, CAST(sum(n) OVER (ORDER BY day, event_type) AS BIGINT) AS total,
               max(day) OVER () AS last
        FROM (SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2) AS r
    ) AS t WHERE day > last - 3
    """,
)
def cumulative_counts_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs come by type, so every day is added to again; the report opens the last three days."""
    events = table(spark, sf_dir, "events")
    runs = settle(events.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n")), "runs")
    totals = BlockTotals(_store(spark, "blocks"), "runs", runs.schema, "n", ("day", "event_type"), F.unix_date("day"))
    late = F.col("event_type").isin("click", "view")
    for part in (runs.filter(~late), runs.filter(late & (F.dayofmonth("day") % 2 == 0)), runs.filter(late & (F.dayofmonth("day") % 2 == 1))):
        totals.add(part)
    last = runs.agg(F.unix_date(F.max("day"))).first()[0]
    return totals.report(spark, "total", [last - 2, last - 1, last])


@check(
    "reconcile_digest_tree",
    f"""{_SIDES}
    SELECT (SELECT count(*) FROM s) AS source_rows, (SELECT count(*) FROM t) AS target_rows,
           (SELECT count(*) FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {_MATCH})) AS only_in_source,
           (SELECT count(*) FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {_MATCH})) AS only_in_target
    """,
)
def reconcile_digest_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each side is stored in three batches, with digests that are merged."""
    store, keys, tables = _store(spark, "digests"), ("o_custkey", "o_orderdate"), []
    for name, side in zip(("source", "target"), _sides(spark, sf_dir), strict=True):
        side = settle(side.select(*named_all(keys)), "side")
        digested = DigestedTable(store, name, side.schema, keys)
        for part in range(3):
            digested.add(side.filter(F.pmod(F.xxhash64(*keys), F.lit(3)) == part))
        tables.append(digested)
    return reconcile_digested(*tables, spark)


@check(
    "repeats_across_files",
    """
    SELECT file, count(*) AS n_rows, count(*) - count(*) FILTER (WHERE k = 1) AS n_repeats FROM (
        SELECT CAST(year(o_orderdate) AS INTEGER) AS file,
               row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY year(o_orderdate), o_orderkey) AS k
        FROM orders
    ) AS r GROUP BY 1
    """,
)
def repeats_across_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each year is a file; a pair that an earlier file, or the file itself, has had is a repeat."""
    store = _store(spark, "repeats")
    seen = KeyStore(store, "seen", DIGEST)
    orders = table(spark, sf_dir, "orders")
    rows = settle(orders.select("o_custkey", "o_orderpriority", F.year("o_orderdate").alias("file"), "o_orderkey"), "pairs")
    counts = None
    for (year,) in sorted(map(tuple, rows.select("file").distinct().collect())):
        with store.commit(spark, f"file {year}"):
            first, again = split_repeats(seen, rows.filter(F.col("file") == year), ["o_custkey", "o_orderpriority"])
            judged = first.withColumn("r", F.lit(0)).union(again.withColumn("r", F.lit(1)))
            counts = judged if counts is None else counts.union(judged)
    return counts.groupBy("file").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("r").cast("long").alias("n_repeats"))


@check(
    "compact_fact_months",
    """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n_facts, TRUE AS few_files
    FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer) GROUP BY 1
    """,
)
def compact_fact_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts arrive in twelve batches; months with many small files are rewritten in between."""
    store = _store(spark, "facts")
    rows = settle(staging.stage_fact(_registration_table(spark, sf_dir)).select("dol_vehicle_id", "transaction_date", "sale_price"), "facts")
    schema = schemas.schema_of("dol_vehicle_id bigint, transaction_date date, sale_price int")
    months = warehouse.by_month(rows)
    for part in range(12):
        store.append(rows.filter(F.pmod("sale_price", F.lit(12)) == part), "facts", months)
        if part % 4 == 3:
            store.compact(spark, "facts", schema, months, most_files=2)
    files: dict[str, int] = {}
    for p in store.parts(spark, "facts"):
        files[p.slice] = files.get(p.slice, 0) + p.files
    month = F.trunc("transaction_date", "month").alias("month")
    return store.read(spark, "facts", schema).groupBy(month).agg(F.count(F.lit(1)).alias("n_facts")).withColumn(
        "few_files", F.lit(max(files.values()) <= 4))
