import pytest
from pyspark.sql import functions as F

from rowproof.operators.identity import assign_ids, running_total
from rowproof.operators.impute import fill_zero_from_group, zero_fill_audit
from rowproof.operators.lookup import (
    MissingReferences,
    lookup,
    missing_counts,
    reference_check,
    resolve_references,
)
from rowproof.operators.metrics import counted_write, latest_batch_count, run_state
from rowproof.operators.novelty import key_balance, new_rows, new_rows_lossless, reconcile, rows_only_in


@pytest.fixture
def dim(spark):
    return spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, None, "x")], "id int, k string, p string")


@pytest.fixture
def facts(spark):
    return spark.createDataFrame([("f1", "a"), ("f2", "c"), ("f3", None)], "f string, key string")


def test_lookup_keeps_rows_and_null_finds_nothing(facts, dim, rows):
    got = lookup(facts, dim, {"key": "k"}, {"id": "dim_id"})
    assert got.columns == ["f", "key", "dim_id"]
    assert rows(got) == [("f1", "a", 1), ("f2", "c", None), ("f3", None, None)]


def test_unique_lookup_does_not_multiply(facts, dim, rows):
    twice = dim.union(dim.withColumn("id", F.col("id") + 10))
    assert lookup(facts, twice, {"key": "k"}, {"id": "dim_id"}).count() == 4
    got = lookup(facts, twice, {"key": "k"}, {"id": "dim_id"}, unique=True)
    assert rows(got, "f", "dim_id") == [("f1", 1), ("f2", None), ("f3", None)]


def test_reference_policies(facts, dim, rows):
    joined = lookup(facts, dim, {"key": "k"}, {"id": "dim_id"})
    with pytest.raises(MissingReferences) as caught:
        resolve_references(joined, ["dim_id"])
    assert caught.value.counts == {"dim_id": 2}
    assert rows(resolve_references(joined, ["dim_id"], "drop"), "f") == [("f1",)]
    assert rows(reference_check(joined, ["dim_id"]).rejected, "f") == [("f2",), ("f3",)]
    assert missing_counts(joined, ["dim_id"]).first().dim_id == 2
    complete = joined.dropna()
    assert rows(resolve_references(complete, ["dim_id"]), "f") == [("f1",)]
    with pytest.raises(ValueError):
        resolve_references(joined, ["dim_id"], "ignore")


def test_new_rows_and_null_keys(spark, rows):
    incoming = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "c")], "k int, t string")
    existing = spark.createDataFrame([(1, "a"), (None, "c")], "k int, t string")
    assert rows(new_rows(incoming, existing, ["k", "t"])) == [(2, "b")]
    assert rows(new_rows(incoming, existing, ["k", "t"], null_safe=False)) == [
        (None, "c"), (None, "c"), (2, "b"),
    ]


def test_rows_without_a_full_key_are_compared_whole(spark, rows):
    columns = "k int, d int, v string"
    existing = spark.createDataFrame([(1, 1, "a"), (None, 1, "a"), (None, 1, None)], columns)
    incoming = spark.createDataFrame(
        [(1, 1, "z"), (None, 1, "a"), (None, 1, "b"), (None, 1, None), (2, None, "c"), (2, 1, "d")],
        columns,
    )
    fresh = new_rows_lossless(incoming, existing, ["k", "d"])
    assert rows(fresh) == [(None, 1, "b"), (2, None, "c"), (2, 1, "d")]
    assert new_rows_lossless(incoming, existing.union(fresh), ["k", "d"]).count() == 0


def test_new_rows_with_wider_existing_key(spark, rows):
    incoming = spark.createDataFrame([(1,), (2,)], "k int")
    existing = spark.createDataFrame([(1,)], "k bigint")
    assert rows(new_rows(incoming, existing, ["k"])) == [(2,)]


def test_composite_key_is_tested_as_a_whole(spark, rows):
    existing = spark.createDataFrame([("yes", "no"), ("no", "yes")], "a string, b string")
    incoming = spark.createDataFrame([("yes", "yes"), ("yes", "no")], "a string, b string")
    assert rows(new_rows(incoming, existing, ["a", "b"])) == [("yes", "yes")]


def test_reconcile_counts_rows_not_keys(spark, rows):
    source = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    target = spark.createDataFrame([(1,), (3,), (3,), (3,), (None,)], "k int")
    assert tuple(reconcile(source, target, ["k"]).first()) == (4, 5, 2, 4)
    assert rows(rows_only_in(source, target, ["k"])) == [(None,), (2,)]
    assert rows(key_balance(source, target, ["k"])) == [(None, 1, 1), (1, 2, 1), (2, 1, 0), (3, 0, 3)]
    nothing = source.filter("false")
    assert tuple(reconcile(nothing, nothing, ["k"]).first()) == (0, 0, 0, 0)


def test_impute_from_group(spark, rows):
    df = spark.createDataFrame(
        [(1, "m", "a", 0), (2, "m", "a", 30), (3, "m", "a", None), (4, "m", None, 0),
         (5, "m", None, 9), (6, "n", "a", 0)],
        "id int, model string, make string, rng int",
    )
    filled = fill_zero_from_group(df, "rng", ["model", "make"])
    assert filled.columns == df.columns
    assert rows(filled, "id", "rng") == [(1, 30), (2, 30), (3, None), (4, 0), (5, 9), (6, 0)]
    audit = zero_fill_audit(df, "rng", ["model", "make"], ["id"])
    assert rows(audit) == [(1, 0, 30), (4, 0, 0), (6, 0, 0)]


def test_ids_are_dense_and_ordered(spark):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 37 % 5000).alias("k"))
    got = assign_ids(df.union(spark.sql("SELECT CAST(NULL AS BIGINT)")), "n", ["k"], start=10)
    ids = {r.k: r.n for r in got.collect()}
    assert ids[None] == 11
    assert all(ids[k] == k + 12 for k in range(5000))


def test_ids_without_an_order(spark):
    got = assign_ids(spark.range(0, 1000, numPartitions=6), "n", [], start=5)
    assert sorted(r.n for r in got.collect()) == list(range(6, 1006))
    assert "Exchange hash" not in got._jdf.queryExecution().executedPlan().toString().split("Broadcast")[0]


def test_running_total(spark):
    df = spark.range(0, 1000, numPartitions=5).select("id", F.lit(2).alias("v"))
    got = running_total(df, "v", ["id"], "total")
    assert all(r.total == 2 * (r.id + 1) for r in got.collect())


def test_ids_of_nothing(spark):
    df = spark.createDataFrame([], "k int")
    assert assign_ids(df, "n", ["k"]).count() == 0


def test_latest_batch(spark):
    df = spark.createDataFrame([(1,), (3,), (3,), (2,)], "created_at int")
    assert latest_batch_count(df).first().processed_count == 2
    assert latest_batch_count(df.filter("false")).first().processed_count == 0


def test_run_state_takes_newest_value_of_each_field(spark):
    events = spark.createDataFrame(
        [(1, 10, "start", None), (1, 20, None, 5), (1, 30, None, 7), (2, 5, "s", None)],
        "run int, at int, a string, b int",
    )
    state = run_state(events, "run", "at", {"a": "a", "b": "b"})
    assert {tuple(r) for r in state.collect()} == {(1, "start", 7), (2, "s", None)}


def test_counted_write(spark, tmp_path):
    df = spark.range(12)
    assert counted_write(df, lambda d: d.write.parquet(str(tmp_path / "a"))) == 12
    assert counted_write(df.filter("false"), lambda d: d.write.parquet(str(tmp_path / "b"))) == 0


def test_keys_of_unlike_type_are_refused(spark):
    dim = spark.createDataFrame([(1, 10)], "k bigint, v int")
    with pytest.raises(TypeError):
        lookup(spark.createDataFrame([("1",)], "k string"), dim, {"k": "k"}, {"v": "v"})


def test_run_state_of_events_at_one_time_is_the_greatest_value(spark):
    events = spark.createDataFrame([(1, 5, 3), (1, 5, 9), (1, 4, 99), (1, 6, None)], "r int, t int, v int")
    assert run_state(events, "r", "t", {"v": "n"}).first().n == 9
