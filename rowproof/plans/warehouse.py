"""Incremental loads of dimensions and facts. Running a load again adds nothing.

Every load keeps the natural key of its dimension unique, so lookups never multiply rows.
"""

from __future__ import annotations

from collections.abc import Mapping, MutableMapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rowproof import schemas
from rowproof.functions.columns import named
from rowproof.operators.copies import distinct_rows, one_per_key
from rowproof.operators.identity import assign_ids
from rowproof.operators.lookup import (
    MissingReferences,
    lookup,
    missing_counts,
    resolve_references,
)
from rowproof.operators.metrics import counted_write
from rowproof.operators.novelty import has_null, new_rows, new_rows_lossless
from rowproof.reference_data import FEE_COLUMNS
from rowproof.plans.staging import SOURCE_SCHEMA, stage_star
from rowproof.session import prepare, scratch_scope, settle, settle_measured
from rowproof.sources.csv import read_csv_text
from rowproof.sources.listing import latest_file
from rowproof.sources.tables import EMPTY_VERSION, Slices, TableStore


@dataclass(frozen=True, eq=False)
class Dimension:
    """A table whose rows are identified by a natural key and numbered by ``id_column``."""

    table: str
    id_column: str | None
    natural_key: tuple[str, ...]
    schema: StructType

    @property
    def columns(self) -> list[str]:
        return [name for name in self.schema.names if name != self.id_column]


FEE_FLAGS = tuple(FEE_COLUMNS.values())

MAKE = Dimension("make_dim", "make_id", ("make",), schemas.MAKE_DIM)
MODEL = Dimension("model_dim", "model_id", ("model",), schemas.MODEL_DIM)
PRIMARY_USE = Dimension(
    "primary_use_dim", "primary_use_id", ("primary_use",), schemas.PRIMARY_USE_DIM
)
ELECTRIC_UTILITY = Dimension(
    "electric_utility_dim",
    "electric_utility_id",
    ("electric_utility_name",),
    schemas.ELECTRIC_UTILITY_DIM,
)
STATE = Dimension("state_dim", "state_id", ("state",), schemas.STATE_DIM)
TRANSACTION_TYPE = Dimension(
    "transaction_type_dim",
    "transaction_type_id",
    ("transaction_type",),
    schemas.TRANSACTION_TYPE_DIM,
)
FEE = Dimension("fee_dim", "fee_id", FEE_FLAGS, schemas.FEE_DIM)
CITY = Dimension("city_dim", "city_id", ("city", "state_id"), schemas.CITY_DIM)
LOCATION = Dimension(
    "location_dim", "location_id", ("city_id", "state_id", "county"), schemas.LOCATION_DIM
)
VEHICLE = Dimension("vehicle_dim", "vehicle_id", ("dol_vehicle_id",), schemas.VEHICLE_DIM)
TIME = Dimension("time_dim", None, ("full_date",), schemas.TIME_DIM)

INDEPENDENT = (MAKE, MODEL, PRIMARY_USE, ELECTRIC_UTILITY, STATE, TRANSACTION_TYPE, FEE)

# Columns of staged frames that name a member of another dimension.
REFERRING = {
    "city_dim": ("state",),
    "location_dim": ("city", "state"),
    "vehicle_dim": ("make", "model", "primary_use", "electric_utility"),
}

PROCESSED_TABLE = "processed_registrations"
FACT_TABLE = "vehicle_transactions_facts"
FACT_MONTH = "transaction_month"
FACT_KEY = ("vehicle_id", "transaction_date")
FACT_KEY_WITH_SALE = ("vehicle_id", "transaction_date", "sale_date")


def read_dim(spark: SparkSession, store: TableStore, dim: Dimension) -> DataFrame:
    return store.read(spark, dim.table, dim.schema)


# Versions of tables whose natural key is known to be unique, by store and table.
_UNIQUE: dict[tuple[object, str, tuple[str, ...]], object] = {}


def has_unique_key(spark: SparkSession, store: TableStore, dim: Dimension) -> bool:
    """Whether no natural key occurs twice in a dimension.

    Tested once for each version of the table; versions that :func:`load_dim` writes need no
    test, since it keeps a unique key unique. Stores without versions are never taken for unique.
    """
    version = _version(spark, store, dim)
    if version is None:
        return False
    place = (store, dim.table, dim.natural_key)
    if _UNIQUE.get(place) != version:
        keys = store.read(spark, dim.table, dim.schema, columns=list(dim.natural_key))
        repeated = keys.dropna().groupBy(*[named(k) for k in dim.natural_key]).count().filter("count > 1")
        if not repeated.isEmpty():
            return False
        _UNIQUE[place] = version
    return True


def _version(spark: SparkSession, store: TableStore, dim: Dimension) -> object:
    version = getattr(store, "version", None)
    return version(spark, dim.table) if version else None


def _read_dims(spark: SparkSession, store: TableStore, *dims: Dimension) -> tuple[list[DataFrame], bool]:
    """Dimensions, and whether lookups must guard against repeated keys."""
    return [read_dim(spark, store, d) for d in dims], not all(has_unique_key(spark, store, d) for d in dims)


def load_dim(
    spark: SparkSession,
    store: TableStore,
    dim: Dimension,
    incoming: DataFrame,
    keep_null_keys: bool = False,
    left_out: MutableMapping[str, int] | None = None,
) -> int:
    """Append the rows whose natural key is new; returns how many.

    Rows with a key part that is null, or cannot be read as its type, are left out; their number
    is put in ``left_out`` under the table's name. Each new key is loaded once. Where the store does not number rows itself, ids go on
    from the largest one present, in the order of the natural key.
    """
    types = {field.name: field.dataType for field in dim.schema}
    rows = incoming.select(*[named(c).try_cast(types[c]).alias(c) for c in dim.columns])
    watched = Observation()
    if left_out is not None:
        rows = rows.observe(watched, F.count_if(has_null(dim.natural_key)).alias("unkeyed"))
    if not keep_null_keys:
        rows = rows.dropna(subset=list(dim.natural_key))
    existing = read_dim(spark, store, dim)
    before, place = _version(spark, store, dim), (store, dim.table, dim.natural_key)
    unique = before is not None and (before == EMPTY_VERSION or _UNIQUE.get(place) == before)
    fresh = new_rows(one_per_key(rows, dim.natural_key), existing, dim.natural_key)
    if dim.id_column is None or store.assigns_ids:
        added = counted_write(fresh, lambda df: store.append(df, dim.table))
        if left_out is not None:
            left_out[dim.table] = watched.get["unkeyed"]
        return added
    fresh, measured = settle_measured(fresh, "new-members")
    added = measured["rows"]
    if left_out is not None:
        left_out[dim.table] = watched.get["unkeyed"]
    if added:
        last = existing.agg(F.max(dim.id_column)).first()[0] or 0
        numbered = assign_ids(fresh, dim.id_column, dim.natural_key, start=last)
        store.append(numbered, dim.table)
        if unique:
            _UNIQUE[place] = _version(spark, store, dim)
    return added


def load_dims(
    spark: SparkSession,
    store: TableStore,
    staged: Mapping[Dimension, DataFrame],
    left_out: MutableMapping[str, int] | None = None,
) -> dict[str, int]:
    """Load dimensions that do not refer to each other, side by side.

    Each load is a few short jobs; run together they share the executors.
    """
    with ThreadPoolExecutor(max_workers=max(1, len(staged))) as pool:
        running = {
            dim.table: pool.submit(
                copy_context().run, load_dim, spark, store, dim, rows, False, left_out
            )
            for dim, rows in staged.items()
        }
        return {table: load.result() for table, load in running.items()}


def city_rows(df: DataFrame, state_dim: DataFrame, guarded: bool = True) -> DataFrame:
    """Adds the id of the state. ``guarded`` lookups never multiply rows, whatever the table."""
    return lookup(df, state_dim, {"state": "state"}, {"state_id": "state_id"}, unique=guarded)


def location_rows(
    df: DataFrame, state_dim: DataFrame, city_dim: DataFrame, guarded: bool = True
) -> DataFrame:
    """Adds the ids of state and city; a city is identified together with its state."""
    return lookup(
        city_rows(df, state_dim, guarded),
        city_dim,
        {"city": "city", "state_id": "state_id"},
        {"city_id": "city_id"},
        unique=guarded,
    )


def vehicle_rows(
    df: DataFrame,
    make_dim: DataFrame,
    model_dim: DataFrame,
    primary_use_dim: DataFrame,
    electric_utility_dim: DataFrame,
    guarded: bool = True,
) -> DataFrame:
    """Replaces the descriptive texts by the ids of their dimensions."""
    df = lookup(df, make_dim, {"make": "make"}, {"make_id": "make_id"}, unique=guarded)
    df = lookup(df, model_dim, {"model": "model"}, {"model_id": "model_id"}, unique=guarded)
    df = lookup(
        df,
        primary_use_dim,
        {"primary_use": "primary_use"},
        {"primary_use_id": "primary_use_id"},
        unique=guarded,
    )
    df = lookup(
        df,
        electric_utility_dim,
        {"electric_utility": "electric_utility_name"},
        {"electric_utility_id": "electric_utility_id"},
        unique=guarded,
    )
    return df.drop("make", "model", "primary_use", "electric_utility")


def with_references(
    spark: SparkSession,
    store: TableStore,
    rows: DataFrame,
    ids: Sequence[str],
    on_missing: str,
    table: str,
) -> DataFrame:
    """Rows whose ids were all found; what becomes of the others is ``on_missing``.

    ``fail`` and ``drop`` are those of :func:`resolve_references`. ``quarantine`` appends them,
    once each, to ``<table>_quarantine`` with the names of the ids they lack.
    """
    if on_missing != "quarantine":
        return resolve_references(rows, ids, on_missing)
    rows = settle(rows, "references")
    names = [F.when(named(name).isNull(), F.lit(name)) for name in ids]
    aside = rows.filter(has_null(ids)).withColumn("missing_ids", F.concat_ws(",", *names))
    kept_aside = f"{table}_quarantine"
    known = store.read(spark, kept_aside, aside.schema)
    store.append(new_rows(distinct_rows(aside), known, aside.columns), kept_aside)
    return rows.dropna(subset=list(ids))


def load_city_dim(
    spark: SparkSession, store: TableStore, staged: DataFrame, on_missing: str = "fail"
) -> int:
    (states,), guarded = _read_dims(spark, store, STATE)
    rows = city_rows(staged, states, guarded)
    found = with_references(spark, store, rows, ["state_id"], on_missing, CITY.table)
    return load_dim(spark, store, CITY, found)


def load_location_dim(
    spark: SparkSession, store: TableStore, staged: DataFrame, on_missing: str = "fail"
) -> int:
    (states, cities), guarded = _read_dims(spark, store, STATE, CITY)
    rows = location_rows(staged, states, cities, guarded)
    ids = ["city_id", "state_id"]
    found = with_references(spark, store, rows, ids, on_missing, LOCATION.table)
    return load_dim(spark, store, LOCATION, found)


def load_vehicle_dim(
    spark: SparkSession,
    store: TableStore,
    staged: DataFrame,
    on_missing: str = "fail",
    required_ids: Sequence[str] = (
        "make_id",
        "model_id",
        "primary_use_id",
        "electric_utility_id",
    ),
) -> int:
    dims, guarded = _read_dims(spark, store, MAKE, MODEL, PRIMARY_USE, ELECTRIC_UTILITY)
    rows = vehicle_rows(staged, *dims, guarded=guarded)
    found = with_references(spark, store, rows, required_ids, on_missing, VEHICLE.table)
    return load_dim(spark, store, VEHICLE, found)


def load_time_dim(spark: SparkSession, store: TableStore, days: DataFrame) -> int:
    return load_dim(spark, store, TIME, days)


def fact_rows(
    staged: DataFrame, dims: Mapping[str, DataFrame], guarded: bool = True
) -> DataFrame:
    """Staged transactions with the ids of all dimensions; no row is lost or multiplied, even
    where a table written by others repeats a key, unless ``guarded`` is off. Without the guard
    each lookup is a join with the table's files, whose size the planner knows.

    Small dimensions come first, so that rows are narrow when the vehicle lookup, the one
    that may need a shuffle, is reached.
    """
    df = location_rows(staged, dims["state_dim"], dims["city_dim"], guarded)
    place = {"city_id": "city_id", "state_id": "state_id", "county": "county"}
    df = lookup(df, dims["location_dim"], place, {"location_id": "location_id"}, unique=guarded)
    df = lookup(
        df,
        dims["transaction_type_dim"],
        {"transaction_type": "transaction_type"},
        {"transaction_type_id": "transaction_type_id"},
        unique=guarded,
    )
    flags = {flag: flag for flag in FEE_FLAGS}
    df = lookup(df, dims["fee_dim"], flags, {"fee_id": "fee_id"}, unique=guarded)
    narrow = df.drop("city", "state", "county", "city_id", "state_id", *FEE_FLAGS)
    return lookup(
        narrow,
        dims["vehicle_dim"],
        {"dol_vehicle_id": "dol_vehicle_id"},
        {"vehicle_id": "vehicle_id"},
        unique=guarded,
    )


def load_fact(
    spark: SparkSession,
    store: TableStore,
    staged: DataFrame,
    key: Sequence[str] = FACT_KEY,
    schema: StructType = schemas.FACTS,
    on_missing: str | None = None,
    required_ids: Sequence[str] = ("location_id", "vehicle_id"),
    null_keys: str = "whole_row",
    distinct_batch: bool = False,
    table: str = FACT_TABLE,
) -> int:
    """Append transactions whose key is not in the fact table yet; returns how many.

    Rows of one batch are not compared with each other unless ``distinct_batch`` is set.
    ``on_missing`` is None (keep rows with unknown ids), "drop", "quarantine" or "fail". Where a key part
    is null, ``null_keys`` says what is compared: the "whole_row", the key with nulls taken
    as "equal", or nothing, which makes the row "new" every time.
    """
    if null_keys not in ("whole_row", "equal", "new"):
        raise ValueError("null_keys must be 'whole_row', 'equal' or 'new'")
    tables = (STATE, CITY, LOCATION, TRANSACTION_TYPE, FEE, VEHICLE)
    frames, guarded = _read_dims(spark, store, *tables)
    rows = fact_rows(staged, {dim.table: df for dim, df in zip(tables, frames)}, guarded)
    if on_missing:
        rows = with_references(spark, store, rows, required_ids, on_missing, table)
    types = {field.name: field.dataType for field in schema}
    rows = rows.select(*[named(c).try_cast(types[c]).alias(c) for c in schema.names])
    if distinct_batch:
        rows = distinct_rows(rows)
    # Written once, because several steps read it.
    rows, measured = settle_measured(rows, "facts", unkeyed=F.count_if(has_null(key)))
    slices = by_month(rows) if "transaction_date" in key else None
    if null_keys == "whole_row" and measured["unkeyed"]:
        fresh = new_rows_lossless(rows, store.read(spark, table, schema, slices=slices), key)
    else:
        existing = store.read(spark, table, schema, columns=list(key), slices=slices)
        fresh = new_rows(rows, existing, key, null_safe=null_keys == "equal")
    if slices:
        fresh = slices.arranged(fresh)
    return counted_write(fresh, lambda df: store.append(df, table, slices))


def by_month(rows: DataFrame) -> Slices:
    """Facts lie in one slice per month, those without a date in one of their own.

    Rows that are equal in key are of one month, so a batch meets the months it holds and not
    the whole table. There are few months, whatever the number of rows.
    """
    day = F.col("transaction_date")
    month = F.year(day) * 100 + F.month(day)
    held = rows.select(month.alias("m")).distinct().toLocalIterator()
    return Slices(FACT_MONTH, month, [row.m for row in held])


def load_fact_by_type_name(spark: SparkSession, store: TableStore, staged: DataFrame) -> int:
    """Earlier fact layout: the type stays text, rows without place or vehicle are dropped."""
    return load_fact(
        spark,
        store,
        staged,
        key=FACT_KEY_WITH_SALE,
        schema=schemas.FACTS_BY_TYPE_NAME,
        on_missing="drop",
        null_keys="equal",
        table=f"{FACT_TABLE}_by_type_name",
    )


def load_latest_file(
    spark: SparkSession,
    store: TableStore,
    folder: str,
    on_missing: str = "fail",
    multi_line: bool = True,
) -> dict[str, int]:
    """Stage the newest CSV file of a folder and load every table from it.

    The file is parsed once; staging reads single columns of the settled copy.
    """
    path = latest_file(spark, folder)
    prepare(spark, path)
    with scratch_scope(spark):
        rows = settle(read_csv_text(spark, path, multi_line), "registrations")
        return load_star(spark, store, stage_star(spark, rows), on_missing)


def check_staged_references(staged: Mapping[str, DataFrame]) -> None:
    """Raise :class:`MissingReferences` where a staged row refers to nothing."""
    counts: dict[str, int] = {}
    for table, columns in REFERRING.items():
        found = missing_counts(staged[table], columns).first()
        counts |= {f"{table}.{name}": found[name] for name in columns}
    if any(counts.values()):
        raise MissingReferences(counts)


def load_processed(
    spark: SparkSession, store: TableStore, on_missing: str = "quarantine"
) -> dict[str, int]:
    """Load every table from the cleaned registrations that processing stored.

    Rows that validation rejected, and copies, are not among them.
    """
    with scratch_scope(spark):
        rows = settle(store.read(spark, PROCESSED_TABLE, SOURCE_SCHEMA), "registrations")
        return load_star(spark, store, stage_star(spark, rows), on_missing)


def load_star(
    spark: SparkSession,
    store: TableStore,
    staged: Mapping[str, DataFrame],
    on_missing: str = "fail",
) -> dict[str, int]:
    """Load every table in foreign-key order; returns the rows added to each.

    Every text that is staged becomes a member of its dimension, so the references that will
    be missing are the empty ones. With ``fail`` they are counted before anything is written;
    ``drop`` leaves such cities, locations and vehicles out, ``quarantine`` sets them aside.
    Facts keep unknown ids as null. The staged frames should come from a columnar table, of
    which each reads its own columns.
    """
    if on_missing == "fail":
        check_staged_references(staged)
    independent = (*INDEPENDENT, TIME)
    added = load_dims(spark, store, {dim: staged[dim.table] for dim in independent})
    added[CITY.table] = load_city_dim(spark, store, staged["city_dim"], on_missing)
    added[LOCATION.table] = load_location_dim(spark, store, staged["location_dim"], on_missing)
    added[VEHICLE.table] = load_vehicle_dim(spark, store, staged["vehicle_dim"], on_missing)
    added[FACT_TABLE] = load_fact(spark, store, staged["facts"])
    return added
