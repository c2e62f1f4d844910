import datetime
import json
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowproof.operators.copies import COPIES, count_copies, expand_copies, one_per_key
from rowproof.operators.ledger import (
    attach_codes,
    code_for,
    duplicate_ledger,
    error_reference,
    ledger_of,
    numbered_rejects,
)
from rowproof.operators.metrics import error_metrics, run_metrics
from rowproof.operators.profile import null_profile
from rowproof.operators.rules import not_in_future, not_null, one_of, readable, required
from rowproof.operators.validate import FINDINGS, validate

AS_OF = datetime.date(2024, 1, 1)


def names(df, key):
    found = df.select(key, F.explode(FINDINGS).alias("f")).select(key, "f.column_name")
    return sorted((r[0], r[1]) for r in found.collect())


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [(1, "a", "x"), (2, None, "x"), (3, None, None), (4, "d", None)], "id int, a string, b string"
    )


def test_all_and_first_attribution(people):
    rules = required(["a", "b"])
    assert names(validate(people, rules).rejected, "id") == [(2, "a"), (3, "a"), (3, "b"), (4, "b")]
    first = validate(people, rules, attribution="first").rejected
    assert names(first, "id") == [(2, "a"), (3, "a"), (4, "b")]
    with pytest.raises(ValueError):
        validate(people, rules, attribution="some")


def test_rule_without_its_column_is_skipped(people, rows):
    checked = validate(people, required(["a", "missing"]))
    assert [rule.reported_as for rule in checked.skipped] == ["missing"]
    assert rows(checked.valid, "id") == [(1,), (4,)]


def test_no_rules_reject_nothing(people):
    checked = validate(people, [])
    assert checked.valid.count() == 4
    assert checked.rejected.count() == 0
    assert checked.annotated.filter(F.size(FINDINGS) > 0).count() == 0


def test_empty_input(spark):
    df = spark.createDataFrame([], "id int, a string")
    checked = validate(df, not_null(["a"]))
    metrics = run_metrics(checked).first()
    assert tuple(metrics) == (0, 0, 0, 0)
    assert ledger_of(numbered_rejects(checked, 1)).records.count() == 0


def test_future_dates(spark):
    df = spark.createDataFrame(
        [
            (1, "January 02 2024", "May 01 2020"),
            (2, "May 01 2020", "January 02 2024"),
            (3, "January 01 2024", None),
            (4, "someday", "May 01 2020"),
            (5, "someday", "January 02 2024"),
            (6, None, None),
        ],
        "id int, t string, s string",
    )
    kept = validate(df, not_in_future(["t", "s"], AS_OF))
    assert names(kept.rejected, "id") == [(1, "t / s"), (2, "t / s"), (5, "t / s")]
    strict = validate(df, not_in_future(["t", "s"], AS_OF, unparseable="reject"))
    codes = strict.rejected.select("id", F.explode(FINDINGS).alias("f")).select(
        "id", code_for(F.col("f.error_message"))
    )
    assert sorted(map(tuple, codes.collect())) == [(1, 1012), (2, 1012), (4, 1005), (5, 1005), (5, 1012)]


def test_future_date_in_every_spelling_that_loads(spark):
    texts = [("March 5 2099",), (" March 05 2099",), ("2099-03-05",), ("03/05/2099",), ("March 5, 2099",)]
    df = spark.createDataFrame(texts, "t string")
    assert validate(df, not_in_future(["t"], AS_OF)).valid.count() == 0


def test_readable_numbers(spark):
    df = spark.createDataFrame([("12", "1.5"), ("12X", "abc"), (None, None), (" 7 ", "-2")], "i string, d string")
    checked = validate(df, [readable("i", "bigint"), readable("d", "decimal(9,2)")], "all")
    found = checked.rejected.select("i", F.explode(FINDINGS).alias("f")).select("i", code_for(F.col("f.error_message")))
    assert sorted(map(tuple, found.collect())) == [("12X", 1003), ("12X", 1006)]


def test_future_date_needs_both_columns(spark):
    df = spark.createDataFrame([("January 02 2999",)], "t string")
    assert validate(df, not_in_future(["t", "s"])).valid.count() == 1


def test_one_of(spark):
    df = spark.createDataFrame([("Yes",), ("nope",), (None,)], "flag string")
    assert validate(df, [one_of("flag", ["yes", "no"])]).rejected.count() == 1


def test_null_rules_are_pushed_to_the_scan(spark, tmp_path, people):
    people.write.parquet(str(tmp_path / "p"))
    valid = validate(spark.read.parquet(str(tmp_path / "p")), not_null(["a", "b"])).valid
    plan = valid._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(a)" in plan and "IsNotNull(b)" in plan


def test_ledger_numbers_equal_records(spark):
    df = spark.createDataFrame(
        [(1, None), (1, None), (2, "x"), (None, None)], "id int, a string"
    )
    ledger = ledger_of(numbered_rejects(validate(df, not_null(["id", "a"])), 9))
    records = ledger.records.collect()
    assert len({r.record_id for r in records}) == 3
    assert {r.processing_file_id for r in records} == {9}
    assert sorted(r.record_text for r in records) == [
        '{"id":1,"a":null}', '{"id":1,"a":null}', '{"id":null,"a":null}',
    ]
    columns = ledger.columns.collect()
    assert sorted((c.column_name, c.error_code) for c in columns) == [
        ("a", 1002), ("a", 1002), ("a", 1002), ("id", 1002),
    ]
    assert {c.record_id for c in columns} == {r.record_id for r in records}
    metrics = error_metrics(ledger.records, ledger.columns).first()
    assert tuple(metrics) == (9, 3, 1)


def test_record_text_is_json_with_iso_times(spark):
    df = spark.sql(
        "SELECT CAST(NULL AS STRING) AS a, TIMESTAMP '2024-01-25 08:30:00' AS at,"
        " TIMESTAMP '2024-01-25 08:30:00.25' AS later, DATE '2024-01-01' AS day"
    )
    text = numbered_rejects(validate(df, not_null(["a"])), 1).first().record_text
    assert json.loads(text) == {
        "a": None,
        "at": "2024-01-25T08:30:00",
        "later": "2024-01-25T08:30:00.250000",
        "day": "2024-01-01",
    }


def test_duplicates_one_entry_per_file(spark):
    df = spark.createDataFrame([(1, "a")] * 5 + [(2, None)] * 2 + [(3, "c")], "id int, a string")
    counted = count_copies(df)
    assert counted.count() == 3
    ledger = duplicate_ledger(counted, 4)
    assert [r.record_text for r in ledger.records.collect()] == ['{"error": "Duplicate records found"}']
    assert [(c.column_name, c.error_code) for c in ledger.columns.collect()] == [("N/A", 1015)]
    assert duplicate_ledger(counted, 4, per_row=True).records.count() == 2


def test_no_duplicates_no_entry(spark):
    counted = count_copies(spark.createDataFrame([(1,), (2,)], "id int"))
    assert duplicate_ledger(counted, 1).records.count() == 0


def test_expand_copies_in_chunks(spark):
    df = spark.createDataFrame([("hot", 1000), ("one", 1), ("ten", 10)], f"k string, {COPIES} bigint")
    got = expand_copies(df, chunk=10).groupBy("k").agg(
        F.count("*").alias("n"), F.count_distinct("ordinal").alias("d"), F.max("ordinal").alias("m")
    )
    assert {tuple(r) for r in got.collect()} == {("hot",) + (1000,) * 3, ("one", 1, 1, 1), ("ten",) + (10,) * 3}


def test_rows_with_few_copies_are_numbered_without_a_second_shuffle(spark):
    texts = spark.range(20_000).select(F.sha2((F.col("id") % 19_000).cast("string"), 512).alias("k"))
    got = expand_copies(count_copies(texts))
    assert (got.count(), got.distinct().count(), got.filter("ordinal = 2").count()) == (20_000, 20_000, 1000)

    def shuffled(df):
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        files = lambda: {n for n in manager.getAllFiles().mkString("|").split("|") if n.endswith(".data") and "/shuffle_" in n}
        before = files()
        df.write.format("noop").mode("overwrite").save()
        return sum(os.path.getsize(n) for n in files() - before)

    assert 0 < shuffled(got) < 1.5 * shuffled(count_copies(texts))


def test_one_per_key_is_deterministic(spark, rows):
    df = spark.createDataFrame(
        [(1, "b", 1), (1, "a", 2), (1, "a", 1), (2, None, 5), (2, "z", 0), (None, "q", 1)],
        "k int, t string, v int",
    )
    assert rows(one_per_key(df, ["k"])) == [(None, "q", 1), (1, "a", 1), (2, None, 5)]


def test_codes_by_reference_table(spark):
    reference = error_reference(spark)
    assert reference.count() == 30
    df = spark.createDataFrame([("Duplicate record detected",), ("no such text",)], "error_message string")
    assert {tuple(r) for r in attach_codes(df, reference).collect()} == {
        ("Duplicate record detected", 1015), ("no such text", None),
    }


def test_null_profile(people, rows):
    assert rows(null_profile(people)) == [("a", 2), ("b", 2), ("id", 0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from([None, "x"]), st.sampled_from([None, "y"]))))
def test_every_row_is_either_valid_or_rejected(spark, data):
    df = spark.createDataFrame(data, "id int, a string, b string")
    checked = validate(df, required(["a", "b"]), attribution="first")
    metrics = run_metrics(checked).first()
    ledger = ledger_of(numbered_rejects(checked, 1))
    assert metrics.initial_count == len(data) == metrics.processed_count + metrics.error_count
    assert checked.valid.count() == metrics.processed_count
    assert ledger.records.count() == ledger.columns.count() == metrics.error_count
