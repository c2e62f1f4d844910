import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from samples import REGISTRATION, registration, registration_rows, write_rows

from rowproof.schemas import schema_of
from rowproof.session import shared_dir
from rowproof.sinks.files import write_by_value, write_csv, write_staged
from rowproof.sources.calendar import calendar
from rowproof.sources.capture import (
    UnknownCategory,
    file_facts,
    require_category,
    with_registered_category,
)
from rowproof.sources.csv import read_csv, read_csv_text
from rowproof.sources.listing import latest_file, merge_yearly
from rowproof.sources.tables import JdbcStore, ParquetStore, is_missing_table


def put(path, text, at=None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    if at is not None:
        os.utime(path, (at, at))


def test_typed_and_text_csv(spark, tmp_path, rows):
    put(tmp_path / "a.csv", 'id,name\n1,"x, ""y"""\n2,\nbad,z\n')
    typed = read_csv(spark, str(tmp_path / "a.csv"), "id int, name string")
    assert rows(typed) == [(None, "z"), (1, 'x, "y"'), (2, None)]
    assert read_csv_text(spark, str(tmp_path / "a.csv")).dtypes == [("id", "string"), ("name", "string")]
    assert read_csv(spark, str(tmp_path / "a.csv")).columns == ["id", "name"]


def test_header_must_fit_the_schema(spark, tmp_path):
    put(tmp_path / "a.csv", "name,id\nx,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path / "a.csv"), "id int, name string").collect()


def test_latest_file(spark, tmp_path):
    put(tmp_path / "b.csv", "x\n1\n", at=1_600_000_000)
    put(tmp_path / "a.csv", "x\n2\n", at=1_700_000_000)
    put(tmp_path / "c.txt", "x\n3\n", at=1_800_000_000)
    assert latest_file(spark, str(tmp_path)).endswith("/a.csv")
    put(tmp_path / "z.csv", "x\n2\n", at=1_700_000_000)
    assert latest_file(spark, str(tmp_path)).endswith("/z.csv")
    with pytest.raises(FileNotFoundError):
        latest_file(spark, str(tmp_path), "*.parquet")


def test_yearly_folders_are_merged_by_name(spark, tmp_path, rows):
    put(tmp_path / "P_2010" / "old.csv", "a,b\n9,9\n", at=1_600_000_000)
    put(tmp_path / "P_2010" / "new.csv", "b,a,extra\n2,1,e\n", at=1_700_000_000)
    put(tmp_path / "P_2011" / "only.csv", "a\nx\n")
    put(tmp_path / "P_2013" / "note.txt", "no data")
    put(tmp_path / "P_2099" / "late.csv", "a,b\n5,5\n")
    merged = merge_yearly(
        spark, str(tmp_path), range(2010, 2014), "P_{year}", ["b", "a", "c"], {"b": "int", "c": "date"}
    )
    assert merged.dtypes == [("b", "int"), ("a", "string"), ("c", "date")]
    assert rows(merged) == [(None, "x", None), (2, "1", None)]
    assert merge_yearly(spark, str(tmp_path), [1990], "P_{year}", ["a"]) is None
    found = merge_yearly(spark, str(tmp_path), folder_name="P_{year}", columns=["a"])
    assert rows(found) == [("1",), ("5",), ("x",)]


def test_file_facts_and_registry(spark, tmp_path):
    put(tmp_path / "EV_20250301.csv", 'id,"name, full"\n1,"two\nlines"\n2,x\n')
    put(tmp_path / "EVTRA_2020.csv", "a\n")
    paths = [str(tmp_path / "EV_20250301.csv"), str(tmp_path / "EVTRA_2020.csv")]
    facts = {r.file_name: r for r in file_facts(spark, paths).collect()}
    ev = facts["EV_20250301.csv"]
    assert (ev.category, ev.header_text, ev.record_count) == ("EV", "id, name, full", 2)
    assert ev.input_file_size == os.path.getsize(paths[0])
    assert facts["EVTRA_2020.csv"].record_count == 0

    registry = spark.createDataFrame([(7, "EV")], "file_schema_id int, file_category_name string")
    gated = with_registered_category(file_facts(spark, paths), registry)
    assert {r.category: r.file_schema_id for r in gated.collect()} == {"EV": 7, "EVTRA": None}
    with pytest.raises(UnknownCategory, match="EVTRA"):
        require_category(gated)
    assert require_category(gated.filter("category = 'EV'")).count() == 1


def test_facts_of_odd_names_and_of_folders(spark, tmp_path):
    name = "EV_new+old file 100%.csv"
    put(tmp_path / name, "a\n1\n2\n")
    put(tmp_path / "EV_parts" / "a.csv", "a,b\n1,2\n")
    put(tmp_path / "EV_parts" / "b.csv", "a,b\n3,4\n5,6\n")
    facts = file_facts(spark, [str(tmp_path / name), f"{tmp_path}/EV_parts/"]).collect()
    assert [(f.file_name, f.record_count, f.header_text) for f in facts] == [
        (name, 2, "a"), ("EV_parts", 3, "a, b"),
    ]
    assert facts[1].input_file_size == 20


def test_file_without_header_is_refused(spark, tmp_path):
    put(tmp_path / "EV_1.csv", "")
    with pytest.raises(ValueError, match="header"):
        file_facts(spark, [str(tmp_path / "EV_1.csv")])


def test_csv_output(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 'say "hi"'), (2, None)], "id int, t string")
    assert write_csv(df.repartition(2), str(tmp_path / "many")) == 2
    assert write_csv(df.repartition(2), str(tmp_path / "one"), single_file=True) == 2
    assert len([f for f in os.listdir(tmp_path / "one") if f.endswith(".csv")]) == 1
    assert rows(read_csv(spark, str(tmp_path / "many"), "id int, t string")) == [(1, 'say "hi"'), (2, None)]


def test_split_by_value(spark, tmp_path):
    df = spark.range(10).select("id", (F.col("id") % 3 + 2010).alias("Year"))
    write_by_value(df, str(tmp_path / "y"), "Year")
    assert sorted(f for f in os.listdir(tmp_path / "y") if "=" in f) == ["Year=2010", "Year=2011", "Year=2012"]
    assert spark.read.csv(str(tmp_path / "y" / "Year=2010"), header=True).count() == 4


def test_staged_outputs(spark, tmp_path):
    write_staged({"a": spark.range(3), "b": spark.range(4)}, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s" / "b")).count() == 4


def test_calendar(spark):
    days = calendar(spark)
    assert days.count() == 5844
    last = days.orderBy(F.desc("full_date")).first()
    assert (str(last.full_date), last.year, last.quarter, last.month, last.day_of_week) == (
        "2025-12-31", 2025, 4, 12, "Wednesday",
    )


def test_missing_table_is_empty(spark, tmp_path):
    store = ParquetStore(str(tmp_path))
    schema = schema_of("id bigint, name string")
    assert store.read(spark, "t", schema).count() == 0
    store.append(spark.createDataFrame([(1, "a")], schema), "t")
    store.append(spark.createDataFrame([(2, "b")], schema), "t")
    assert store.read(spark, "t", schema).count() == 2
    assert store.read(spark, "t", schema, ["name"]).columns == ["name"]


def test_unreadable_table_is_not_taken_for_empty(spark, tmp_path):
    put(tmp_path / "t" / "part.parquet", "not parquet")
    with pytest.raises(Exception):
        ParquetStore(str(tmp_path)).read(spark, "t", schema_of("id bigint")).collect()


class FakeReader:
    """Stands in for the JDBC calls; no database is started for a test."""

    def __init__(self, outcome):
        self.outcome, self.calls = outcome, []

    @property
    def read(self):
        return self

    def jdbc(self, *args, **kwargs):
        self.calls.append((args, kwargs))
        if isinstance(self.outcome, Exception):
            raise self.outcome
        return self.outcome


class DatabaseError(Exception):
    def __init__(self, state):
        self.java_exception = type("J", (), {"getSQLState": staticmethod(lambda: state)})


def test_jdbc_options(spark):
    source = FakeReader(spark.range(2))
    options = {"column": "id", "lowerBound": 0, "upperBound": 9, "numPartitions": 3}
    store = JdbcStore("jdbc:x", {"user": "u"}, "dw", {"facts": options})
    schema = schema_of("id bigint")
    assert store.read(source, "facts", schema, ["id"]).columns == ["id"]
    assert source.calls == [(("jdbc:x", "dw.facts"), {"properties": {"user": "u"}, **options})]
    assert store.assigns_ids


def test_only_a_missing_jdbc_table_is_empty(spark):
    assert is_missing_table(DatabaseError("42S02"))
    assert not is_missing_table(DatabaseError("08001"))
    with pytest.raises(DatabaseError):
        JdbcStore("jdbc:x", {}).read(FakeReader(DatabaseError("08001")), "t", schema_of("id bigint"))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_registration_sample_layout(spark, tmp_path):
    path = tmp_path / "EVTRA_2020.csv"
    write_rows(path, registration_rows() + [registration()], list(REGISTRATION))
    assert read_csv_text(spark, str(path)).count() == 16


def test_brace_glob_without_match(spark, tmp_path):
    with pytest.raises(AnalysisException):
        spark.read.format("binaryFile").load(f"{tmp_path}/{{a,b}}").count()
