"""State that is kept beside tables and brought up to date batch by batch."""

import datetime
import random
import threading

import pytest
from pyspark.sql import functions as F

from rowproof import schemas
from rowproof.operators.blocks import BlockTotals
from rowproof.operators.digests import DigestedTable, reconcile_digested
from rowproof.operators.impute import fill_zero_from_group
from rowproof.operators.keystore import DIGEST, KeyStore, split_repeats
from rowproof.operators.lookup import lookup
from rowproof.operators.maxima import MaintainedFill
from rowproof.operators.novelty import reconcile
from rowproof.operators.rules import required
from rowproof.plans import staging, warehouse
from rowproof.plans.sliced import load_dim_sliced
from rowproof.sources.committed import CommittedStore
from rowproof.sources.tables import MixedLayout, ParquetStore, Slices
from rowproof.streaming.arrivals import validate_arrivals

KEYS = schemas.schema_of("a bigint, b string")


def keys(spark, rows):
    return spark.createDataFrame(rows, KEYS)


def test_new_keys_equal_the_anti_join_and_open_few_slices(spark, tmp_path):
    store = CommittedStore(str(tmp_path))
    known = KeyStore(store, "known", KEYS, slices=16, blocks=4)
    first = [(k, f"x{k % 3}") for k in range(300)] + [(None, "n"), (None, None), (5, None), (1, "x1"), (1, "x1")]
    with store.commit(spark):
        new = known.new_keys(keys(spark, first))
        known.add(new)
    assert sorted(map(tuple, new.collect()), key=str) == sorted(set(first), key=str)
    second = [(7, "x1"), (7, "y"), (None, "n"), (None, "m"), (5, None), (900, None)]
    assert sorted(map(tuple, known.new_keys(keys(spark, second)).collect()), key=str) == sorted([(7, "y"), (None, "m"), (900, None)], key=str)
    # A batch of one known key opens its slice alone; keys that no filter knows open none.
    possible = known.possible(keys(spark, [(7, "x1")])).collect()
    assert len(possible) == 1
    opened = known.open(spark, [possible[0]["key_slice"]])
    assert all(f"key_slice={possible[0]['key_slice']}/" in f for f in opened.inputFiles()) and opened.inputFiles()
    fresh = keys(spark, [(10_000 + k, "z") for k in range(1000)])
    assert known.possible(fresh).count() < 60
    assert known.new_keys(fresh).count() == 1000
    assert known.new_keys(keys(spark, [])).count() == 0


def test_keys_of_many_commits(spark, tmp_path):
    store = CommittedStore(str(tmp_path))
    known = KeyStore(store, "known", KEYS, slices=2, blocks=1)
    for k in range(4):
        with store.commit(spark):
            known.add(known.new_keys(keys(spark, [(j, "k") for j in range(10 * k, 10 * k + 15)])))
    rows = store.read(spark, "known", KEYS)
    assert rows.count() == rows.distinct().count() == 45
    known.compact(spark, most_files=1)
    assert store.read(spark, "known", KEYS).count() == 45
    assert known.new_keys(keys(spark, [(44, "k"), (45, "k")])).collect() == [(45, "k")]


def test_a_repeat_is_charged_once_over_all_batches(spark, tmp_path):
    store = CommittedStore(str(tmp_path))
    seen = KeyStore(store, "seen", DIGEST, slices=4, blocks=2)
    batch = lambda rows, file: spark.createDataFrame([(*r, file) for r in rows], "a string, b string, file bigint")

    def judge(rows, file):
        with store.commit(spark, f"file {file}") as commit:
            if commit is None:
                return None
            first, again = split_repeats(seen, batch(rows, file), ["a", "b"])
            return sorted(map(tuple, first.collect()), key=str), sorted(map(tuple, again.collect()), key=str)

    assert judge([("x", None), ("x", ""), ("y", "1"), ("y", "1")], 1) == ([("x", "", 1), ("x", None, 1), ("y", "1", 1)], [("y", "1", 1)])
    assert judge([("x", None), ("z", "2")], 2) == ([("z", "2", 2)], [("x", None, 2)])
    assert judge([("x", None)], 2) is None
    # A batch that dies is judged as new when it comes again.
    with pytest.raises(ZeroDivisionError), store.commit(spark, "file 3"):
        split_repeats(seen, batch([("q", "1")], 3), ["a", "b"])
        1 / 0  # noqa: B018
    assert judge([("q", "1")], 3) == ([("q", "1", 3)], [])


FILL = schemas.schema_of("k bigint, g string, h string, v int")


def test_three_batches_equal_one_run(spark, tmp_path):
    luck = random.Random(5)
    rows = [(k, luck.choice(["a", "b", "c", None]), luck.choice(["x", "y"]), luck.choice([0, 0, None, luck.randrange(1, 90)])) for k in range(90)]
    rows += [(100, "late", "x", 0), (101, "late", "x", 0)]
    fill = MaintainedFill(CommittedStore(str(tmp_path)), "t", FILL, "v", ("g", "h"), slices=5)
    again = [fill.add(spark.createDataFrame(part, FILL)) for part in (rows[:30], rows[30:], [(200, "late", "x", 7), (201, "a", "x", 500)], [(300, "c", "x", 0)])]
    assert again[0] == 0 and again[2] >= 1 and again[3] == 0
    everything = spark.createDataFrame([*rows, (200, "late", "x", 7), (201, "a", "x", 500), (300, "c", "x", 0)], FILL)
    want = sorted(map(tuple, fill_zero_from_group(everything, "v", ["g", "h"]).collect()), key=str)
    assert sorted(map(tuple, fill.rows(spark).collect()), key=str) == want
    fill.add(spark.createDataFrame([], FILL))
    assert fill.rows(spark).count() == len(want)


RUNS = schemas.schema_of("run bigint, at timestamp, n bigint")


def test_reports_read_few_blocks(spark, tmp_path):
    start = datetime.datetime(2024, 1, 1)
    rows = [(k, start + datetime.timedelta(hours=7 * k), k % 5 if k % 11 else None) for k in range(60)]
    totals = BlockTotals(CommittedStore(str(tmp_path)), "runs", RUNS, "n", ("at", "run"), F.unix_date(F.col("at").cast("date")))
    frame = lambda part: spark.createDataFrame(part, RUNS)
    for part in (rows[:25], rows[30:], rows[25:30]):  # some come late
        totals.add(frame(part))
    so_far, want = 0, {}
    for run, _, n in rows:
        so_far += n or 0
        want[run] = so_far
    blocks = totals.last_blocks(spark, 6)
    report = totals.report(spark, "total", blocks)
    found = {r.run: r.total for r in report.collect()}
    assert len(found) >= 6 and max(found) == 59 and found == {k: want[k] for k in found}
    assert len(blocks) < 5 and all(any(f"block={b}/" in f for b in blocks) for f in report.inputFiles() if "/runs/" in f)
    every = [r.block for r in totals.sums(spark).select("block").collect()]
    assert {r.run: r.total for r in totals.report(spark, "total", every).collect()} == want


PAIRS = schemas.schema_of("a bigint, b string, c int")


def test_digests_equal_the_full_reconciliation(spark, tmp_path):
    store = CommittedStore(str(tmp_path))
    rows = [(k, f"k{k % 7}", k) for k in range(500)] + [(None, "n", 1), (3, None, 2), (1, "k1", 9), (1, "k1", 9)]
    other = [r for r in rows if r[0] not in (10, 11)] + [(10, "other", 1), (2000, "new", 1), (1, "k1", 9)]
    frame = lambda part: spark.createDataFrame(part, PAIRS)
    tables = [DigestedTable(store, name, PAIRS, ("a", "b"), slices=32) for name in ("s", "t", "e")]
    tables[0].add(frame(rows[:200]))
    tables[0].add(frame(rows[200:]))
    tables[1].add(frame(other))
    for left, right, a, b in ((0, 1, rows, other), (1, 0, other, rows), (0, 0, rows, rows), (0, 2, rows, []), (2, 2, [], [])):
        found = reconcile_digested(tables[left], tables[right], spark).first().asDict()
        assert found == reconcile(frame(a), frame(b), ["a", "b"]).first().asDict()
    with pytest.raises(ValueError):
        reconcile_digested(tables[0], DigestedTable(store, "t", PAIRS, ("a",), 32), spark)


def test_uniqueness_is_tested_once_a_version(spark, tmp_path, monkeypatch):
    store = ParquetStore(str(tmp_path))
    dim = warehouse.Dimension("d", "id", ("name",), schemas.schema_of("id bigint, name string"))
    rows = lambda *names: spark.createDataFrame([(n,) for n in names], "name string")
    assert warehouse.has_unique_key(spark, store, dim)  # nothing is there
    warehouse.load_dim(spark, store, dim, rows("a", "b", "b"))
    # What the load wrote needs no test, and joins with it aggregate nothing.
    monkeypatch.setattr(ParquetStore, "read", None)
    assert warehouse.has_unique_key(spark, store, dim)
    monkeypatch.undo()
    plan = lookup(rows("a"), warehouse.read_dim(spark, store, dim), {"name": "name"}, {"id": "id"})
    assert "Aggregate" not in plan._jdf.queryExecution().optimizedPlan().toString()
    # A table that others wrote to is tested again.
    spark.createDataFrame([(9, "a")], dim.schema).write.mode("append").parquet(store.path("d"))
    assert not warehouse.has_unique_key(spark, store, dim)
    committed = CommittedStore(str(tmp_path / "c"))
    warehouse.load_dim(spark, committed, dim, rows("x"))
    assert warehouse.has_unique_key(spark, committed, dim)


def test_layouts_are_not_mixed(spark, tmp_path):
    store, rows = ParquetStore(str(tmp_path)), spark.createDataFrame([(1, "b")], KEYS)
    store.append(rows, "t")
    with pytest.raises(MixedLayout):
        store.append(rows, "t", Slices("part", F.col("a")))
    store.append(rows, "u", Slices("part", F.col("a")))
    with pytest.raises(MixedLayout):
        store.append(rows, "u")
    assert store.read(spark, "u", KEYS).count() == 1


def test_sliced_loads_at_once_store_each_member_once(spark, tmp_path):
    store = CommittedStore(str(tmp_path))
    dim = warehouse.Dimension("d", "id", ("name",), schemas.schema_of("id bigint, name string"))
    rows = lambda a, b: spark.createDataFrame([(f"n{k}",) for k in range(a, b)] + [(None,)], "name string")
    results = []

    def load(a, b):
        results.append(load_dim_sliced(spark, store, dim, rows(a, b), slices=4, blocks=2, lease_block=16))

    loads = [threading.Thread(target=load, args=x) for x in ((0, 30), (20, 50))]
    for t in loads:
        t.start()
    for t in loads:
        t.join()
    stored = store.read(spark, "d", dim.schema).collect()
    assert sorted(r.name for r in stored) == sorted(f"n{k}" for k in range(50)) and len({r.id for r in stored}) == 50
    assert sum(n for n, _ in results) == 50 and {unkeyed for _, unkeyed in results} == {1}
    assert load_dim_sliced(spark, store, dim, rows(0, 50), slices=4, blocks=2) == (0, 1)


@pytest.mark.parametrize("store_of", [ParquetStore, CommittedStore])
def test_rows_without_a_key_are_counted(spark, tmp_path, store_of):
    store = store_of(str(tmp_path))
    rows = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c"), ("2", "d")], "n string, name string")
    dim = warehouse.Dimension("d", "id", ("n",), schemas.schema_of("id bigint, n int, name string"))
    bare = warehouse.Dimension("e", None, ("n",), schemas.schema_of("n int, name string"))
    left_out = {}
    assert warehouse.load_dims(spark, store, {dim: rows, bare: rows}, left_out) == {"d": 2, "e": 2}
    assert left_out == {"d": 2, "e": 2}


def test_a_stray_year_does_not_widen_the_calendar(spark):
    facts = spark.sql("SELECT DATE'2020-05-04' AS transaction_date, DATE'9999-01-01' AS sale_date UNION ALL SELECT DATE'0001-01-01', NULL")
    assert staging.stage_days(facts).count() == 366
    assert tuple(staging.days_outside(facts).first()) == (1, 1)


def test_the_stream_charges_a_row_delivered_in_two_files_once(spark, tmp_path):
    folder, output = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    schema = schemas.schema_of("a int, b string")
    store = CommittedStore(str(tmp_path / "store"))
    seen = KeyStore(store, "seen", DIGEST, slices=4, blocks=2)

    def run(checkpoint="c"):
        validate_arrivals(spark, str(folder), schema, required(["b"]), output, str(tmp_path / checkpoint), seen=seen).awaitTermination()
        valid = spark.read.parquet(f"{output}/valid").collect()
        codes = spark.read.parquet(f"{output}/column_errors").collect()
        return sorted(r.a for r in valid), sorted((str(r.processing_file_id), r.error_code) for r in codes)

    (folder / "one.csv").write_text("a,b\n1,x\n2,y\n3,\n")
    assert run() == ([1, 2], [("one.csv", 1001)])
    (folder / "two.csv").write_text("a,b\n1,x\n4,z\n4,z\n")
    expected = ([1, 2, 4], [("one.csv", 1001), ("two.csv", 1015), ("two.csv", 1015)])
    assert run() == expected
    # A stream that lost its checkpoint and replays batch 0 finds that batch done.
    assert run("other") == expected
