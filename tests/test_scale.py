"""Plans that must hold when tables are too big to broadcast and keys are skewed."""

import pytest
from pyspark.sql import functions as F

from rowproof import session
from rowproof.operators.copies import count_copies, except_rows
from rowproof.operators.lookup import lookup
from rowproof.operators.novelty import new_rows
from rowproof.session import path_exists, prepare, scratch_path, scratch_scope, settle
from rowproof.sinks.files import write_by_value


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def shuffled_joins(spark):
    """No broadcasts, and a low bound for what counts as a skewed partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.01",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def skewed(spark, tmp_path):
    """Two thirds of the rows share one key."""
    rows = spark.range(0, 60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 500).cast("int").alias("k"),
        F.md5(F.col("id").cast("string")).alias("payload"),
    )
    rows.write.parquet(str(tmp_path / "skewed"))
    return spark.read.parquet(str(tmp_path / "skewed"))


@pytest.fixture
def keys(spark, tmp_path):
    spark.range(0, 400).select(F.col("id").cast("int").alias("k"), "id").write.parquet(str(tmp_path / "keys"))
    return spark.read.parquet(str(tmp_path / "keys"))


@pytest.mark.parametrize("null_safe", [True, False])
def test_hot_keys_are_split_in_new_rows(shuffled_joins, skewed, keys, null_safe):
    fresh = new_rows(skewed, keys.filter("k <> 1"), ["k"], null_safe)
    assert len(fresh.collect()) == fresh.count() > 40_000
    assert "skew=true" in plan_after_run(fresh)


@pytest.mark.parametrize("unique", [True, False])
def test_hot_keys_are_split_in_lookups(shuffled_joins, skewed, keys, unique):
    found = lookup(skewed, keys, {"k": "k"}, {"id": "key_id"}, unique=unique)
    assert len(found.collect()) == 60_000
    assert "skew=true" in plan_after_run(found)


def plan_after_run(df):
    df.collect()
    return plan(df)


def test_small_dimension_is_broadcast_by_its_size(skewed, keys):
    assert "BroadcastHashJoin" in plan(lookup(skewed, keys, {"k": "k"}, {"id": "key_id"}))


def test_copies_shrink_before_the_shuffle(skewed):
    text = plan(count_copies(skewed.select("k")))
    before_exchange = text[text.index("Exchange"):]
    assert "partial_count" in before_exchange


def test_hot_value_is_split_when_written(spark, shuffled_joins, skewed, tmp_path):
    from_many_tasks = skewed.withColumn("year", F.col("k"))
    write_by_value(from_many_tasks.filter("year < 4"), str(tmp_path / "out"), "year")
    hot = list((tmp_path / "out" / "year=1").glob("*.csv"))
    cold = list((tmp_path / "out" / "year=2").glob("*.csv"))
    assert len(hot) > 1
    assert len(cold) == 1


def test_except_removes_copies_before_the_join(shuffled_joins, skewed, keys):
    left, right = skewed.select("k"), keys.select("k")
    got = except_rows(left, right)
    assert {r.k for r in got.collect()} == {r.k for r in left.subtract(right).collect()}
    assert plan(got).count("HashAggregate") >= 4


def test_shuffles_are_sized_by_the_input(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text("x" * 1000)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "c.csv").write_text("x" * 1000)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(key, None)
    prepare(spark, str(tmp_path))
    assert spark.conf.get(key) == spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(session, "INPUT_BYTES_PER_PARTITION", 100)
    prepare(spark, str(tmp_path))
    assert spark.conf.get(key) == "20"
    spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_settled_frames_end_with_their_scope(spark):
    with scratch_scope(spark):
        path = scratch_path(spark, "inside")
        spark.range(3).write.parquet(path)
        assert path_exists(spark, path)
        inner = settle(spark.range(2), "inner")
        assert inner.count() == 2
    assert not path_exists(spark, path)
    outside = settle(spark.range(4), "outside")
    assert outside.count() == 4
