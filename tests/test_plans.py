import datetime
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from samples import REGISTRATION, TOTALS, lobbying_rows, registration, registration_rows, write_rows

from rowproof import schemas
from rowproof.operators.lookup import MissingReferences
from rowproof.operators.rules import required
from rowproof.plans import staging, warehouse
from rowproof.plans.cleaning import clean_registrations
from rowproof.plans.runs import (
    error_counts,
    process_file,
    run_report,
    run_totals,
    stored_ledger,
)
from rowproof.sources.capture import UnknownCategory
from rowproof.sources.listing import align
from rowproof.sources.tables import ParquetStore
from rowproof.streaming.arrivals import validate_arrivals


@pytest.fixture
def registry(spark):
    return spark.createDataFrame(
        [(1, "EV", "x"), (2, "EVTRA", "y"), (3, "ODD", "z")], schemas.FILE_SCHEMAS
    )


def test_lobbying_file_end_to_end(spark, tmp_path, registry):
    path = tmp_path / "EV_20250301.csv"
    write_rows(path, lobbying_rows(), schemas.LOBBYING_FILE.names)
    store = ParquetStore(str(tmp_path / "store"))
    run_id = process_file(spark, store, str(path), registry)

    loaded = spark.read.parquet(store.path("processed_lobbying_data"))
    assert loaded.columns == ["record_id", *schemas.LOBBYING_TARGET.names, "created_at"]
    totals = {r.form_submission_id: r.total_financials for r in loaded.collect()}
    assert totals == {line: Decimal(total) for line, total in TOTALS.items()}
    first = loaded.first()
    assert first.monitoring_only is False
    assert first.expense_date == datetime.date(2023, 1, 5)
    assert first.expense_purpose == 'a "quoted", text'

    columns = store.read(spark, "column_error_report", schemas.COLUMN_ERRORS)
    assert sorted((r.column_name, r.error_code) for r in columns.collect()) == [
        ("expense_paid_to", 1002), ("principal_lobbyist_name", 1002), ("reporting_period", 1002),
    ]
    state = run_report(spark, store).first()
    assert state.processing_file_id == run_id == 1
    assert (state.initial_count, state.processed_count) == (6, 4)
    assert (state.error_count, state.distinct_error_count) == (2, 1)
    assert error_counts(stored_ledger(spark, store, run_id)) == (2, 1)
    assert error_counts(stored_ledger(spark, store, 99)) == (0, 0)
    assert state.process_end_time >= state.process_start_time
    assert state.input_file_size == path.stat().st_size

    assert process_file(spark, store, str(path), registry) == 2
    again = spark.read.parquet(store.path("processed_lobbying_data"))
    assert sorted(r.record_id for r in again.collect()) == [1, 2, 3, 4, 5, 6, 7, 8]
    totals = run_totals(spark, store).orderBy("processing_file_id").collect()
    assert [r.total_count for r in totals] == [6, 12]


def test_registration_file_end_to_end(spark, tmp_path, registry):
    path = tmp_path / "EVTRA_2020.csv"
    write_rows(path, registration_rows(), list(REGISTRATION))
    store = ParquetStore(str(tmp_path / "store"))
    process_file(spark, store, str(path), registry)
    state = run_report(spark, store).first()
    assert (state.initial_count, state.processed_count) == (15, 10)
    assert (state.error_count, state.distinct_error_count) == (5, 3)


def test_unregistered_category_writes_nothing(spark, tmp_path, registry):
    path = tmp_path / "NEW_1.csv"
    path.write_text("a\n1\n")
    store = ParquetStore(str(tmp_path / "store"))
    with pytest.raises(UnknownCategory):
        process_file(spark, store, str(path), registry)
    assert not (tmp_path / "store").exists()


@pytest.fixture
def cleaned(spark):
    text = spark.createDataFrame(
        [tuple(v or None for v in row.values()) for row in registration_rows()],
        ", ".join(f"`{name}` string" for name in REGISTRATION),
    )
    df = align(text, text.columns, schemas.REGISTRATION_TYPES)
    return clean_registrations(df, 5, as_of=datetime.date(2024, 1, 1))


def test_registrations_are_charged_to_the_first_rule(cleaned):
    found = cleaned.ledger.columns.groupBy("column_name", "error_code").count().collect()
    assert {tuple(r) for r in found} == {
        ("N/A", 1015, 1), ("Transaction Date / Sale Date", 1012, 2), ("City", 1001, 2),
    }
    assert cleaned.ledger.records.count() == 5


def test_registrations_are_standardised(cleaned):
    rows = {r["DOL Vehicle ID"]: r for r in cleaned.valid.collect()}
    assert sorted(rows) == [100, 103, 104, 107, 108, 109, 110, 111, 112, 113]
    assert [rows[i]["Electric Range"] for i in (100, 107, 108, 109)] == [50, 50, 0, 0]
    assert rows[110]["Model Year"] == 2020
    assert rows[111]["Sale Date"] == "May 04 2020"
    assert rows[112]["Sale Date"] is None
    assert (rows[100]["Transaction Month"], rows[100]["Transaction Day of Week"]) == (5, 2)
    assert rows[103]["Transaction Month"] is None and rows[104]["Transaction Month"] is None
    fees = [name for name in REGISTRATION if name.endswith("Fee Paid")]
    assert [rows[100][f] for f in fees] == ["yes", "no", "no"]
    assert [rows[113][f] for f in fees] == ["yes", "no", "unknown"]
    assert rows[100]["Sale Price"] == 30000


def test_missing_columns_skip_their_steps(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "City string")
    result = clean_registrations(df, 1, as_of=datetime.date(2024, 1, 1))
    assert [r.City for r in result.valid.collect()] == ["a"]
    assert len(result.skipped_rules) == 6


@pytest.fixture
def registrations(spark):
    rows = [
        registration(),
        registration(transaction_date="June 01 2020"),
        registration(dol_vehicle_id="200", city="C1", county="L", make="M2"),
        registration(dol_vehicle_id="300", city="C1", state="OR", county="K"),
        registration(dol_vehicle_id="400", electric_utility=None),
        registration(dol_vehicle_id="500", county=None),
    ]
    return spark.createDataFrame(
        [tuple(row.values()) for row in rows], ", ".join(f"`{name}` string" for name in REGISTRATION)
    )


def tables(spark, store):
    names = {d.table: d.schema for d in (*warehouse.INDEPENDENT, warehouse.CITY, warehouse.LOCATION,
                                         warehouse.VEHICLE, warehouse.TIME)}
    names[warehouse.FACT_TABLE] = schemas.FACTS
    return {n: sorted(map(str, store.read(spark, n, s).collect())) for n, s in names.items()}


def test_star_load_is_complete_and_repeatable(spark, tmp_path, registrations):
    store = ParquetStore(str(tmp_path))
    staged = staging.stage_star(spark, registrations)
    added = warehouse.load_star(spark, store, staged, on_missing="drop")
    assert added == {
        "make_dim": 2, "model_dim": 1, "primary_use_dim": 1, "electric_utility_dim": 1,
        "state_dim": 2, "transaction_type_dim": 1, "fee_dim": 1, "city_dim": 2,
        "location_dim": 3, "vehicle_dim": 4, "time_dim": 366, "vehicle_transactions_facts": 6,
    }
    before = tables(spark, store)
    again = warehouse.load_star(spark, store, staged, on_missing="drop")
    assert set(again.values()) == {0}
    assert tables(spark, store) == before

    facts = store.read(spark, warehouse.FACT_TABLE, schemas.FACTS)
    assert facts.filter("vehicle_id IS NULL").count() == 1
    assert facts.filter("location_id IS NULL").count() == 1
    assert facts.select("location_id").distinct().count() == 4


def test_latest_file_is_staged_and_loaded(spark, tmp_path):
    write_rows(tmp_path / "EVTRA_2020.csv", [registration()], list(REGISTRATION))
    store = ParquetStore(str(tmp_path / "store"))
    added = warehouse.load_latest_file(spark, store, str(tmp_path))
    assert added["vehicle_dim"] == added["vehicle_transactions_facts"] == 1
    fact = store.read(spark, warehouse.FACT_TABLE, schemas.FACTS).first()
    assert (fact.vehicle_id, fact.location_id, fact.fee_id, fact.sale_price) == (1, 1, 1, 30000)


def test_new_batch_continues_the_ids(spark, tmp_path):
    store = ParquetStore(str(tmp_path))
    makes = spark.createDataFrame([("b",), ("a",), (None,)], "make string")
    assert warehouse.load_dim(spark, store, warehouse.MAKE, makes) == 2
    more = spark.createDataFrame([("c",), ("a",), ("0",)], "make string")
    assert warehouse.load_dim(spark, store, warehouse.MAKE, more) == 2
    ids = {r.make: r.make_id for r in warehouse.read_dim(spark, store, warehouse.MAKE).collect()}
    assert ids == {"a": 1, "b": 2, "0": 3, "c": 4}


def test_null_key_is_loaded_once_when_kept(spark, tmp_path):
    store = ParquetStore(str(tmp_path))
    makes = spark.createDataFrame([("a",), (None,)], "make string")
    for expected in (2, 0):
        assert warehouse.load_dim(spark, store, warehouse.MAKE, makes, keep_null_keys=True) == expected


def test_missing_reference_stops_a_load(spark, tmp_path, registrations):
    store = ParquetStore(str(tmp_path))
    with pytest.raises(MissingReferences):
        warehouse.load_city_dim(spark, store, staging.stage_city(registrations))
    assert not (tmp_path / "city_dim").exists()


def test_older_fact_layout_drops_unknown_rows(spark, tmp_path, registrations):
    store = ParquetStore(str(tmp_path))
    staged = staging.stage_star(spark, registrations)
    warehouse.load_star(spark, store, staged, on_missing="drop")
    assert warehouse.load_fact_by_type_name(spark, store, staged["facts"]) == 4
    assert warehouse.load_fact_by_type_name(spark, store, staged["facts"]) == 0


def test_unmatched_facts_of_a_later_batch_are_not_lost(spark, tmp_path, registrations):
    store = ParquetStore(str(tmp_path))
    facts = staging.stage_fact(registrations)
    first, second = facts.filter("dol_vehicle_id = 100"), facts.filter("dol_vehicle_id = 500")
    assert warehouse.load_fact(spark, store, first) == 2
    changed = second.withColumn("sale_price", F.lit(1))
    assert warehouse.load_fact(spark, store, changed) == 1
    assert warehouse.load_fact(spark, store, changed) == 0
    with pytest.raises(ValueError):
        warehouse.load_fact(spark, store, changed, null_keys="skip")


def test_raw_flags(spark, registrations, rows):
    fees = rows(staging.stage_fee(registrations, raw=True))
    assert fees == [("Yes", "No", "Not Applicable")]
    assert staging.stage_fact(registrations, raw_flags=True).first().electric_vehicle_fee == "Yes"


def test_batch_duplicates_stay_unless_asked(spark, tmp_path, registrations):
    staged = staging.stage_fact(registrations)
    twice = staged.union(staged)
    kept, single = ParquetStore(str(tmp_path / "a")), ParquetStore(str(tmp_path / "b"))
    assert warehouse.load_fact(spark, kept, twice) == 12
    assert warehouse.load_fact(spark, single, twice, distinct_batch=True) < 12


def test_arriving_files(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    schema = schemas.schema_of("id int, city string")

    def run():
        validate_arrivals(
            spark, str(inbox), schema, required(["city"]), out, str(tmp_path / "chk")
        ).awaitTermination(120)

    (inbox / "a.csv").write_text("id,city\n1,x\n2,\n")
    run()
    (inbox / "b.csv").write_text("id,city\n3,\n4,y\n5,z\n")
    run()
    run()
    assert spark.read.parquet(f"{out}/valid").count() == 3
    records = spark.read.parquet(f"{out}/record_errors").orderBy("processing_file_id").collect()
    assert [(r.processing_file_id, r.record_text) for r in records] == [
        ("a.csv", '{"id":2,"city":null}'), ("b.csv", '{"id":3,"city":null}'),
    ]
    codes = spark.read.parquet(f"{out}/column_errors").select(F.sum("error_code")).first()[0]
    assert codes == 2002


def test_an_id_that_is_no_number_neither_stops_a_load_nor_loses_a_fact(spark, tmp_path, registrations):
    store = ParquetStore(str(tmp_path))
    bad = registrations.withColumn("DOL Vehicle ID", F.concat("DOL Vehicle ID", F.lit("X")))
    added = warehouse.load_star(spark, store, staging.stage_star(spark, bad), on_missing="drop")
    assert added["vehicle_dim"] == 0
    assert added[warehouse.FACT_TABLE] == registrations.distinct().count()


def test_a_repeated_dimension_key_does_not_multiply_facts(spark, tmp_path, registrations):
    store = ParquetStore(str(tmp_path))
    staged = staging.stage_star(spark, registrations)
    warehouse.load_star(spark, store, staged, on_missing="drop")
    twice = spark.createDataFrame([(901, "WA"), (902, "WA")], schemas.STATE_DIM)
    store.append(twice, "state_dim")
    dims = {d.table: warehouse.read_dim(spark, store, d) for d in (
        warehouse.STATE, warehouse.CITY, warehouse.LOCATION, warehouse.TRANSACTION_TYPE,
        warehouse.FEE, warehouse.VEHICLE)}
    assert warehouse.fact_rows(staged["facts"], dims).count() == staged["facts"].count()


def test_model_year_cap_is_an_argument(spark, registrations):
    late = registrations.withColumn("Model Year", F.lit("2031"))
    kept = clean_registrations(late, 1, as_of=datetime.date(2035, 1, 1), latest_model_year=2035).valid
    assert {str(r["Model Year"]) for r in kept.select("Model Year").collect()} == {"2031"}


def test_arriving_quotes_and_line_breaks(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    (inbox / "a.csv").write_text('id,city\n1,"a ""q"", b"\n2,"two\nlines"\n')
    schema = schemas.schema_of("id int, city string")
    validate_arrivals(spark, str(inbox), schema, required(["city"]), out, str(tmp_path / "chk")).awaitTermination(120)
    got = {r.id: r.city for r in spark.read.parquet(f"{out}/valid").collect()}
    assert got == {1: 'a "q", b', 2: "two\nlines"}


def test_a_failing_load_writes_nothing(spark, tmp_path, registrations):
    store = ParquetStore(str(tmp_path / "store"))
    with pytest.raises(MissingReferences):
        warehouse.load_star(spark, store, staging.stage_star(
            spark, registrations.withColumn("Electric Utility", F.lit(None).cast("string"))))
    assert not (tmp_path / "store").exists()


def test_rejected_rows_and_copies_do_not_reach_the_facts(spark, tmp_path, registry):
    path = tmp_path / "EVTRA_2020.csv"
    write_rows(path, registration_rows(), list(REGISTRATION))
    store = ParquetStore(str(tmp_path / "store"))
    process_file(spark, store, str(path), registry)
    added = warehouse.load_processed(spark, store)
    assert added[warehouse.FACT_TABLE] == run_report(spark, store).first().processed_count
    assert set(warehouse.load_processed(spark, store).values()) == {0}


def test_a_batch_reads_only_its_months_of_the_facts(spark, tmp_path, registrations):
    store = ParquetStore(str(tmp_path))
    facts = staging.stage_fact(registrations)
    other = facts.withColumn("transaction_date", F.lit(datetime.date(1999, 5, 1)))
    warehouse.load_fact(spark, store, facts.union(other))
    batch = other.select("transaction_date").union(spark.sql("SELECT CAST(NULL AS DATE)"))
    slices = warehouse.by_month(batch)
    assert sorted(slices.wanted, key=str) == [199905, None]
    old = store.read(spark, warehouse.FACT_TABLE, schemas.FACTS, list(warehouse.FACT_KEY), slices)
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*transaction_month", plan)
    assert {r.transaction_date for r in old.collect()} == {datetime.date(1999, 5, 1)}
    assert store.read(spark, warehouse.FACT_TABLE, schemas.FACTS).columns == schemas.FACTS.names


def test_rules_are_tried_once_and_their_findings_stored(spark):
    rows = spark.createDataFrame([("1", "January 2 2020", None), ("1", "January 2 2020", None)], "County string, `Sale Date` string, Model string")
    result = clean_registrations(rows, 1)
    assert "size(_findings" in result.valid._jdf.queryExecution().optimizedPlan().toString()
    assert result.valid.columns == rows.columns
    assert "_findings" not in result.validation.source.columns
