"""Lookups, new-row detection, reconciliation, staging and loads."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import check, shape, table
from rowproof import schemas
from rowproof.operators.copies import distinct_rows
from rowproof.operators.identity import assign_ids
from rowproof.operators.lookup import lookup
from rowproof.operators.novelty import new_rows, reconcile, rows_only_in
from rowproof.plans import staging, warehouse
from rowproof.plans.cleaning import clean_registrations
from rowproof.session import scratch_path, settle
from rowproof.sources.calendar import days_between, with_calendar_parts
from rowproof.sources.listing import align
from rowproof.sources.tables import ParquetStore

# Rows up to this day count as loaded earlier.
LOADED_UNTIL = "1998-12-31"


@check(
    "dim_lookup_left",
    """
    SELECT o_orderkey, c_name AS customer, c_mktsegment AS segment
    FROM orders LEFT JOIN <solvent_customers> AS c ON o_custkey = c_custkey
    """,
)
def dim_lookup_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    take = {"c_name": "customer", "c_mktsegment": "segment"}
    customers = shape(spark, sf_dir, "solvent_customers")
    return lookup(orders, customers, {"o_custkey": "c_custkey"}, take).drop("o_custkey")


@check(
    "dim_lookup_composite",
    """
    WITH flags AS (
        SELECT l_returnflag, l_linestatus, l_linenumber,
               min(l_suppkey) AS flag_id
        FROM lineitem WHERE l_returnflag <> 'N' GROUP BY ALL
    )
    SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, f.flag_id
    FROM lineitem AS l LEFT JOIN flags AS f
      ON l.l_returnflag = f.l_returnflag AND l.l_linestatus = f.l_linestatus
     AND l.l_linenumber = f.l_linenumber
    """,
)
def dim_lookup_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_returnflag", "l_linestatus", "l_linenumber"]
    known = lines.filter("l_returnflag <> 'N'")
    flags = settle(known.groupBy(*keys).agg(F.min("l_suppkey").alias("flag_id")), "flags")
    rows = lines.select("l_orderkey", "l_partkey", *keys)
    found = lookup(rows, flags, {key: key for key in keys}, {"flag_id": "flag_id"})
    return found.drop("l_returnflag", "l_linestatus")


@check(
    "dim_lookup_chain",
    """
    SELECT o_orderkey, c_mktsegment AS segment, n_name AS nation, r_name AS region
    FROM orders LEFT JOIN <solvent_customers> AS c ON o_custkey = c_custkey
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
    """,
)
def dim_lookup_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    df = lookup(
        df,
        shape(spark, sf_dir, "solvent_customers"),
        {"o_custkey": "c_custkey"},
        {"c_nationkey": "nation_key", "c_mktsegment": "segment"},
    )
    df = lookup(
        df,
        table(spark, sf_dir, "nation"),
        {"nation_key": "n_nationkey"},
        {"n_name": "nation", "n_regionkey": "region_key"},
    )
    df = lookup(
        df, table(spark, sf_dir, "region"), {"region_key": "r_regionkey"}, {"r_name": "region"}
    )
    return df.select("o_orderkey", "segment", "nation", "region")


_PAIR = ["o_custkey", "o_orderpriority"]
_LOADED = f"o_orderdate <= DATE '{LOADED_UNTIL}'"


def _arrivals(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    df = shape(spark, sf_dir, "orders_gaps")
    columns = ["o_orderkey", *_PAIR]
    return df.select(*columns), df.filter(_LOADED).select(*columns)


@check(
    "anti_new_rows",
    f"""
    SELECT o_orderkey, o_custkey, o_orderpriority FROM <orders_gaps> AS a
    WHERE NOT EXISTS (
        SELECT 1 FROM <orders_gaps> AS b WHERE {_LOADED}
          AND a.o_custkey = b.o_custkey AND a.o_orderpriority = b.o_orderpriority)
    """,
)
def anti_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming, existing = _arrivals(spark, sf_dir)
    return new_rows(incoming, existing, _PAIR, null_safe=False).select("o_orderkey", *_PAIR)


_NULL_SAFE_SQL = f"""
    SELECT o_orderkey, o_custkey, o_orderpriority FROM <orders_gaps> AS a
    WHERE NOT EXISTS (
        SELECT 1 FROM <orders_gaps> AS b WHERE {_LOADED}
          AND a.o_custkey IS NOT DISTINCT FROM b.o_custkey
          AND a.o_orderpriority IS NOT DISTINCT FROM b.o_orderpriority)
"""


@check("anti_new_rows_nullsafe", _NULL_SAFE_SQL)
def anti_new_rows_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    incoming, existing = _arrivals(spark, sf_dir)
    return new_rows(incoming, existing, _PAIR)


@check(
    "anti_composite_key",
    f"SELECT DISTINCT o_custkey, o_orderpriority FROM ({_NULL_SAFE_SQL}) AS n",
)
def anti_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New combinations, though each single value has been seen before."""
    incoming, existing = _arrivals(spark, sf_dir)
    return new_rows(distinct_rows(incoming, _PAIR), existing, _PAIR)


_SIDES = """
    WITH s AS (SELECT * FROM <orders_redelivered> AS g WHERE o_orderdate >= DATE '1996-01-01'),
         t AS (SELECT * FROM <orders_gaps> AS g WHERE o_orderdate <= DATE '2000-12-31')
"""
_MATCH = "s.o_custkey = t.o_custkey AND s.o_orderdate = t.o_orderdate"


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    source = shape(spark, sf_dir, "orders_redelivered").filter("o_orderdate >= '1996-01-01'")
    target = shape(spark, sf_dir, "orders_gaps").filter("o_orderdate <= '2000-12-31'")
    return source, target


@check(
    "reconcile_two_way",
    f"""{_SIDES}
    SELECT (SELECT count(*) FROM s) AS source_rows, (SELECT count(*) FROM t) AS target_rows,
           (SELECT count(*) FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE {_MATCH}))
               AS only_in_source,
           (SELECT count(*) FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {_MATCH}))
               AS only_in_target
    """,
)
def reconcile_two_way(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile(*_sides(spark, sf_dir), ["o_custkey", "o_orderdate"])


@check(
    "reconcile_rows",
    f"""{_SIDES}
    SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM s WHERE {_MATCH})
    """,
)
def reconcile_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, target = _sides(spark, sf_dir)
    return rows_only_in(target, source, ["o_custkey", "o_orderdate"])


@check(
    "assign_surrogate_ids",
    """
    SELECT 1000 + row_number() OVER (ORDER BY o_custkey NULLS FIRST,
                                     o_orderpriority NULLS FIRST) AS pair_id,
           o_custkey, o_orderpriority
    FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM <orders_gaps> AS g) AS p
    """,
)
def assign_surrogate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = distinct_rows(shape(spark, sf_dir, "orders_gaps"), _PAIR)
    return assign_ids(pairs, "pair_id", _PAIR, start=1000)


# --- Staging -----------------------------------------------------------------------


def _registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape(spark, sf_dir, "registrations")


@check(
    "stage_single_dim",
    """
    SELECT DISTINCT `Electric Utility` AS electric_utility_name FROM <registrations> AS g
    WHERE `Electric Utility` IS NOT NULL
    """,
)
def stage_single_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, name = staging.SINGLE_COLUMN_DIMS["electric_utility_dim"]
    return staging.stage_single(_registrations(spark, sf_dir), source, name)


@check(
    "stage_single_dim_with_null",
    "SELECT DISTINCT `Electric Utility` AS electric_utility_name FROM <registrations> AS g",
)
def stage_single_dim_with_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, name = staging.SINGLE_COLUMN_DIMS["electric_utility_dim"]
    return staging.stage_single(_registrations(spark, sf_dir), source, name, keep_null=True)


@check(
    "stage_city",
    "SELECT DISTINCT `City` AS city, `State` AS state FROM <registrations> AS g",
)
def stage_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_city(_registrations(spark, sf_dir))


@check(
    "stage_location",
    """
    SELECT DISTINCT `City` AS city, `State` AS state, `County` AS county
    FROM <registrations> AS g WHERE `County` IS NOT NULL
    """,
)
def stage_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_location(_registrations(spark, sf_dir))


_FEES_SQL = ", ".join(
    f"CASE WHEN lower(trim(`{source}`)) = 'yes' THEN 'yes' ELSE 'no' END AS {name}"
    for source, name in staging.FEE_COLUMNS.items()
)


@check("stage_fee", f"SELECT DISTINCT {_FEES_SQL} FROM <registrations> AS g")
def stage_fee(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_fee(_registrations(spark, sf_dir))


_VEHICLE_SQL = "SELECT DISTINCT CAST(`DOL Vehicle ID` AS BIGINT) AS dol_vehicle_id, " + ", ".join(
    f"`{source}` AS {name}"
    for source, name in staging.VEHICLE_COLUMNS.items() if name != "dol_vehicle_id"
) + " FROM <registrations> AS g"


@check("stage_vehicle", _VEHICLE_SQL)
def stage_vehicle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_vehicle(_registrations(spark, sf_dir))


_INT = "TRY_CAST(regexp_extract(\"{c}\", '^([+-]?[0-9]+)([.][0-9]*)?$', 1) AS INTEGER) AS {n}"
_STAGED_FACTS = f"""
    SELECT CAST(`DOL Vehicle ID` AS BIGINT) AS dol_vehicle_id,
           CAST(strptime(`Transaction Date`, '%B %d %Y') AS DATE) AS transaction_date,
           CAST(strptime(`Sale Date`, '%B %d %Y') AS DATE) AS sale_date,
           `City` AS city, `State` AS state, `County` AS county,
           `Transaction Type` AS transaction_type,
           {", ".join(_INT.format(c=c, n=n) for c, n in staging.MEASURES.items())},
           {_FEES_SQL}
    FROM <registrations> AS g
"""


@check("stage_fact", _STAGED_FACTS)
def stage_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stage_fact(_registrations(spark, sf_dir))


# --- Loads -------------------------------------------------------------------------
# Each load runs twice: with the rows loaded earlier, then with all rows.


def _store(spark: SparkSession, label: str) -> ParquetStore:
    return ParquetStore(scratch_path(spark, label))


def _registration_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registrations as a columnar table, as a finished cleaning run leaves them."""
    return settle(_registrations(spark, sf_dir), "registrations")


def _two_batches(df: DataFrame) -> list[DataFrame]:
    return [df.filter(F.col("Year") <= LOADED_UNTIL[:4]), df]


def _numbered_in_two(key: str, source: str, id_column: str) -> str:
    """Ids of the earlier rows first, then of the new ones, each in key order."""
    keys = ", ".join(f"{k} NULLS FIRST" for k in key.split(", "))
    return f"""
        SELECT row_number() OVER (ORDER BY first_year > '{LOADED_UNTIL[:4]}', {keys})
                   AS {id_column}, {key}
        FROM (SELECT {key}, min(first_year) AS first_year FROM ({source}) AS s GROUP BY {key})
             AS k
    """


@check(
    "load_independent_dim",
    _numbered_in_two(
        "vin",
        "SELECT `VIN (1-10)` AS vin, CASE WHEN `Year` <= '1998' THEN '1998' ELSE '9999' END"
        " AS first_year FROM <registrations> AS g",
        "vin_id",
    ),
)
def load_independent_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension with one natural key, here the many-valued VIN prefix."""
    dim = warehouse.Dimension(
        "vin_dim", "vin_id", ("vin",), schemas.schema_of("vin_id bigint, vin string")
    )
    store = _store(spark, "load-vin")
    for batch in _two_batches(_registration_table(spark, sf_dir)):
        warehouse.load_dim(spark, store, dim, staging.stage_single(batch, "VIN (1-10)", "vin"))
    return warehouse.read_dim(spark, store, dim)


def _load_places(spark: SparkSession, store: ParquetStore, df: DataFrame) -> None:
    states = staging.stage_single(df, "State", "state")
    warehouse.load_dim(spark, store, warehouse.STATE, states)
    warehouse.load_city_dim(spark, store, staging.stage_city(df))
    warehouse.load_location_dim(spark, store, staging.stage_location(df))


# Every state, city and county occurs in the earlier rows, so ids follow the key order.
_STATE_IDS = """
    SELECT row_number() OVER (ORDER BY state) AS state_id, state
    FROM (SELECT DISTINCT `State` AS state FROM <registrations> AS g) AS s
"""
_CITY_IDS = f"""
    SELECT row_number() OVER (ORDER BY city, state_id) AS city_id, city, state_id, state
    FROM (SELECT DISTINCT `City` AS city, `State` AS state FROM <registrations> AS g) AS c
    JOIN ({_STATE_IDS}) AS s USING (state)
"""
_LOCATION_IDS = f"""
    SELECT row_number() OVER (ORDER BY city_id, state_id, county) AS location_id,
           city_id, state_id, county, city, state
    FROM (SELECT DISTINCT `City` AS city, `State` AS state, `County` AS county
          FROM <registrations> AS g WHERE `County` IS NOT NULL) AS l
    JOIN ({_CITY_IDS}) AS c USING (city, state)
"""


@check("load_city_dim", f"SELECT city_id, city, state_id FROM ({_CITY_IDS}) AS c")
def load_city_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "load-city")
    for batch in _two_batches(_registration_table(spark, sf_dir)):
        _load_places(spark, store, batch)
    return warehouse.read_dim(spark, store, warehouse.CITY)


@check(
    "load_location_dim",
    f"SELECT location_id, city_id, state_id, county FROM ({_LOCATION_IDS}) AS l",
)
def load_location_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "load-location")
    for batch in _two_batches(_registration_table(spark, sf_dir)):
        _load_places(spark, store, batch)
    return warehouse.read_dim(spark, store, warehouse.LOCATION)


_VEHICLE_PARTS = (
    warehouse.MAKE, warehouse.MODEL, warehouse.PRIMARY_USE, warehouse.ELECTRIC_UTILITY,
)


def _staged_singles(
    df: DataFrame, dims: tuple[warehouse.Dimension, ...]
) -> dict[warehouse.Dimension, DataFrame]:
    return {dim: staging.stage_single(df, *staging.SINGLE_COLUMN_DIMS[dim.table]) for dim in dims}


def _load_vehicles(spark: SparkSession, store: ParquetStore, df: DataFrame) -> None:
    warehouse.load_dims(spark, store, _staged_singles(df, _VEHICLE_PARTS))
    warehouse.load_vehicle_dim(spark, store, staging.stage_vehicle(df), on_missing="drop")


def _ids(source: str, name: str) -> str:
    return f"""
        SELECT row_number() OVER (ORDER BY v) AS {name}_id, v AS {name}
        FROM (SELECT DISTINCT `{source}` AS v FROM <registrations> AS g
              WHERE `{source}` IS NOT NULL) AS d
    """


# One row per vehicle: the smallest by the other columns, among those with all ids.
_VEHICLE_IDS = f"""
    SELECT row_number() OVER (ORDER BY dol_vehicle_id) AS vehicle_id, * EXCLUDE (place)
    FROM (
        SELECT CAST(dol_vehicle_id AS BIGINT) AS dol_vehicle_id, vin_prefix,
               CAST(model_year AS INTEGER) AS model_year, make_id, model_id, primary_use_id,
               electric_utility_id,
               row_number() OVER (
                   PARTITION BY dol_vehicle_id
                   ORDER BY vin_prefix, CAST(model_year AS INTEGER), make_id, model_id,
                            primary_use_id, electric_utility_id) AS place
        FROM ({_VEHICLE_SQL}) AS v
        JOIN ({_ids("Make", "make")}) AS a USING (make)
        JOIN ({_ids("Model", "model")}) AS b USING (model)
        JOIN ({_ids("Primary Use", "primary_use")}) AS c USING (primary_use)
        JOIN ({_ids("Electric Utility", "electric_utility")}) AS d USING (electric_utility)
    ) AS r WHERE place = 1
"""


@check("load_vehicle_dim", _VEHICLE_IDS)
def load_vehicle_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded twice from all rows; the second load adds nothing."""
    store = _store(spark, "load-vehicle")
    df = _registration_table(spark, sf_dir)
    _load_vehicles(spark, store, df)
    _load_vehicles(spark, store, df)
    return warehouse.read_dim(spark, store, warehouse.VEHICLE)


def _load_all_dims(spark: SparkSession, store: ParquetStore, df: DataFrame) -> None:
    singles = (*_VEHICLE_PARTS, warehouse.STATE, warehouse.TRANSACTION_TYPE)
    fee = {warehouse.FEE: staging.stage_fee(df)}
    warehouse.load_dims(spark, store, {**_staged_singles(df, singles), **fee})
    warehouse.load_city_dim(spark, store, staging.stage_city(df))
    warehouse.load_location_dim(spark, store, staging.stage_location(df))
    warehouse.load_vehicle_dim(spark, store, staging.stage_vehicle(df), on_missing="drop")


_FEE_FLAGS = ", ".join(warehouse.FEE_FLAGS)
_FACTS = f"""
    SELECT vehicle_id, transaction_date, sale_date, location_id, transaction_type_id,
           transaction_type, base_msrp, sale_price, odometer_reading, electric_range, fee_id
    FROM ({_STAGED_FACTS}) AS f
    LEFT JOIN ({_LOCATION_IDS}) AS l USING (city, state, county)
    LEFT JOIN ({_ids("Transaction Type", "transaction_type")}) AS t USING (transaction_type)
    LEFT JOIN (
        SELECT row_number() OVER (ORDER BY {_FEE_FLAGS}) AS fee_id, *
        FROM (SELECT DISTINCT {_FEES_SQL} FROM <registrations> AS g) AS d
    ) AS e USING ({_FEE_FLAGS})
    LEFT JOIN ({_VEHICLE_IDS}) AS v ON f.dol_vehicle_id = v.dol_vehicle_id
"""
_EARLIER = f"transaction_date <= DATE '{LOADED_UNTIL}'"
_FACT_SQL = """
    WITH facts AS ({facts})
    SELECT * EXCLUDE ({extra}) FROM facts WHERE {keep}
      AND ({earlier} OR NOT EXISTS (
        SELECT 1 FROM facts AS old WHERE old.{earlier} AND ({match})))
"""


def _same(*columns: str) -> str:
    return " AND ".join(f"old.{c} IS NOT DISTINCT FROM facts.{c}" for c in columns)


@check(
    "load_fact",
    _FACT_SQL.format(
        facts=_FACTS,
        extra="transaction_type",
        keep="TRUE",
        earlier=_EARLIER,
        match="old.vehicle_id = facts.vehicle_id AND old.transaction_date = facts.transaction_date"
        " OR facts.vehicle_id IS NULL AND " + _same(*schemas.FACTS.names),
    ),
)
def load_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "load-fact")
    df = _registration_table(spark, sf_dir)
    _load_all_dims(spark, store, df)
    for batch in _two_batches(df):
        warehouse.load_fact(spark, store, staging.stage_fact(batch))
    return store.read(spark, warehouse.FACT_TABLE, schemas.FACTS)


@check(
    "load_fact_bad_keys",
    """
    SELECT count(*) AS n_facts,
           count(*) FILTER (WHERE `DOL Vehicle ID` NOT LIKE '%X' AND `DOL Vehicle ID` IN (
               SELECT `DOL Vehicle ID` FROM <registrations_bad_ids> AS v
               WHERE `Electric Utility` IS NOT NULL)) AS n_with_vehicle
    FROM <registrations_bad_ids> AS g
    """,
)
def load_fact_bad_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that are no numbers neither stop the load nor find a vehicle; no fact is lost."""
    store = _store(spark, "load-bad-keys")
    df = settle(shape(spark, sf_dir, "registrations_bad_ids"), "bad-ids")
    _load_all_dims(spark, store, df)
    warehouse.load_fact(spark, store, staging.stage_fact(df))
    facts = store.read(spark, warehouse.FACT_TABLE, schemas.FACTS)
    return facts.agg(
        F.count(F.lit(1)).alias("n_facts"), F.count("vehicle_id").alias("n_with_vehicle")
    )


@check(
    "load_star_days",
    """
    SELECT CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year,
           CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
           dayname(d) AS day_of_week
    FROM (SELECT unnest(generate_series(
              CAST(date_trunc('year', min(o_orderdate)) AS DATE),
              CAST(date_trunc('year', max(o_orderdate)) AS DATE) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
              INTERVAL 1 DAY)) AS d
          FROM orders) AS days
    """,
)
def load_star_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar covers the years of the facts."""
    return staging.stage_days(staging.stage_fact(_registrations(spark, sf_dir)))


@check(
    "load_vehicle_quarantine",
    """
    SELECT DISTINCT CAST(`DOL Vehicle ID` AS BIGINT) AS dol_vehicle_id,
           'electric_utility_id' AS missing_ids
    FROM <registrations> AS g WHERE `Electric Utility` IS NULL
    """,
)
def load_vehicle_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicles without a utility are set aside, once, however often they arrive."""
    store = _store(spark, "load-quarantine")
    df = _registration_table(spark, sf_dir)
    warehouse.load_dims(spark, store, _staged_singles(df, _VEHICLE_PARTS))
    for _ in range(2):
        warehouse.load_vehicle_dim(spark, store, staging.stage_vehicle(df), on_missing="quarantine")
    schema = schemas.schema_of("dol_vehicle_id bigint, missing_ids string")
    return distinct_rows(store.read(spark, f"{warehouse.VEHICLE.table}_quarantine", schema))


_MANDATORY = ("County", "City", "State", "Postal Code", "Legislative District", "Model")


@check(
    "clean_then_load",
    f"""
    SELECT transaction_date, count(*) AS n_facts
    FROM (
        SELECT DISTINCT *, CAST(strptime(`Transaction Date`, '%B %d %Y') AS DATE) AS transaction_date
        FROM <registrations_redelivered> AS g
        WHERE {" AND ".join(f"`{c}` IS NOT NULL" for c in _MANDATORY)}
    ) AS d
    WHERE transaction_date <= DATE '{LOADED_UNTIL}'
    GROUP BY 1
    """,
)
def clean_then_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are cleaned, stored, and the star is loaded from what is stored, twice."""
    store = _store(spark, "clean-then-load")
    text = settle(shape(spark, sf_dir, "registrations_redelivered"), "delivered")
    typed = align(text, text.columns, schemas.REGISTRATION_TYPES)
    as_of = datetime.date.fromisoformat(LOADED_UNTIL)
    store.append(clean_registrations(typed, 1, as_of).valid, warehouse.PROCESSED_TABLE)
    warehouse.load_processed(spark, store)
    warehouse.load_processed(spark, store)
    facts = store.read(spark, warehouse.FACT_TABLE, schemas.FACTS)
    return facts.groupBy("transaction_date").agg(F.count(F.lit(1)).alias("n_facts"))


@check(
    "load_fact_drop",
    _FACT_SQL.format(
        facts=_FACTS,
        extra="transaction_type_id",
        keep="vehicle_id IS NOT NULL AND location_id IS NOT NULL",
        earlier=_EARLIER,
        match=_same("vehicle_id", "transaction_date", "sale_date"),
    ),
)
def load_fact_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = _store(spark, "load-fact-drop")
    df = _registration_table(spark, sf_dir)
    _load_all_dims(spark, store, df)
    for batch in _two_batches(df):
        warehouse.load_fact_by_type_name(spark, store, staging.stage_fact(batch))
    table_name = f"{warehouse.FACT_TABLE}_by_type_name"
    return store.read(spark, table_name, schemas.FACTS_BY_TYPE_NAME)


@check(
    "load_time_dim",
    """
    SELECT CAST(d AS DATE) AS full_date, CAST(year(d) AS INTEGER) AS year,
           CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
           dayname(d) AS day_of_week
    FROM (SELECT unnest(generate_series(min(l_shipdate), max(l_shipdate),
                                        INTERVAL 1 DAY)) AS d
          FROM lineitem) AS days
    """,
)
def load_time_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar of the shipping days, loaded twice."""
    bounds = table(spark, sf_dir, "lineitem").agg(
        F.min(F.to_date("l_shipdate")).alias("first"),
        F.max(F.to_date("l_shipdate")).alias("last"),
    )
    days = with_calendar_parts(days_between(bounds, F.col("first"), F.col("last")))
    store = _store(spark, "load-time")
    warehouse.load_time_dim(spark, store, days)
    warehouse.load_time_dim(spark, store, days)
    return warehouse.read_dim(spark, store, warehouse.TIME)
