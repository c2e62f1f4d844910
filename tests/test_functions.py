import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowproof.functions.dates import (
    date_text,
    month_of,
    parse_date,
    parse_date_any,
    weekday_name,
    weekday_number,
)
from rowproof.functions.flags import standardize_flag, yes_no_to_boolean
from rowproof.functions.names import graph_safe, normalize_names, snake, trim_lower
from rowproof.functions.numbers import fill_for_kinds, money_total, replace_above, to_int


def values(spark, texts, expression, kind="string"):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, c {kind}")
    return [r.v for r in df.select("i", expression(F.col("c")).alias("v")).orderBy("i").collect()]


def test_name_rules():
    assert trim_lower(" Make ") == "make"
    assert snake(" Base MSRP ") == "base_msrp"
    assert graph_safe("2019 HB 2042: Electric Range (mi)") == "hb_2042_electric_range_mi_2019"
    assert graph_safe("VIN (1-10)") == "vin_110"
    assert graph_safe(" Année ") == "année"


def test_colliding_names_are_refused(spark):
    df = spark.range(1).select(F.lit(1).alias("A b"), F.lit(2).alias("a_b"))
    with pytest.raises(ValueError, match="a_b"):
        normalize_names(df)


FLAGS = [None, "Yes", "YES", " yes", "No", "Not Applicable", "Maybe", ""]


def test_flag_keeps_unknown_text(spark):
    assert values(spark, FLAGS, standardize_flag) == [
        "no", "yes", "yes", " yes", "no", "no", "maybe", "",
    ]


def test_flag_strict(spark):
    strict = values(spark, FLAGS, lambda c: standardize_flag(c, unknown="no", trim=True))
    assert strict == ["no", "yes", "yes", "yes", "no", "no", "no", "no"]
    with pytest.raises(ValueError):
        standardize_flag(F.col("c"), unknown="other")


def test_boolean_flag(spark):
    assert values(spark, ["Yes", " no ", "x", None], yes_no_to_boolean) == [
        True, False, None, None,
    ]


def test_registration_date(spark):
    texts = ["March 05 2020", "March 5 2020", " March 05 2020", "2020-03-05", "soon", None,
             "February 30 2020"]
    day = datetime.date(2020, 3, 5)
    assert values(spark, texts, parse_date) == [day, None, None, None, None, None, None]
    assert values(spark, texts, lambda c: parse_date(c, trim=True))[2] == day


def test_date_of_any_known_format(spark):
    texts = ["March 5 2020", "March 05, 2020", "2020-03-05", "03/05/2020", " 2020-03-05 ", "5.3.",
             None]
    day = datetime.date(2020, 3, 5)
    assert values(spark, texts, parse_date_any) == [day] * 5 + [None, None]


def test_format_without_outline_still_parses(spark):
    assert values(spark, ["05Mar2020T"], lambda c: parse_date(c, "ddMMMyyyy'T'")) == [
        datetime.date(2020, 3, 5)
    ]


def test_date_parts(spark):
    sunday = [datetime.date(2024, 6, 2)]
    assert values(spark, sunday, weekday_number, "date") == [1]
    assert values(spark, sunday, weekday_name, "date") == ["Sunday"]
    assert values(spark, sunday, month_of, "date") == [6]
    assert values(spark, sunday, date_text, "date") == ["2024-06-02"]


def test_tolerant_integer(spark):
    texts = ["12", " -7 ", "12.99", "12.", "+3", "1e3", "abc", "", None, "99999999999", ".5"]
    assert values(spark, texts, to_int) == [
        12, -7, 12, 12, 3, None, None, None, None, None, None,
    ]
    assert values(spark, ["99999999999"], lambda c: to_int(c, "bigint")) == [99999999999]


def test_money_total_is_exact_and_null_when_a_part_is(spark):
    df = spark.createDataFrame([("0.10", "0.20"), ("1", None)], "a string, b string")
    totals = [r.t for r in df.select(money_total(["a", "b"]).alias("t")).collect()]
    assert totals == [Decimal("0.30"), None]


def test_replace_above(spark):
    assert values(
        spark, [2024, 2026, None], lambda c: replace_above(c, 2025, F.lit(2020)), "int"
    ) == [2024, 2020, None]


def test_fill_for_kinds(spark):
    df = spark.createDataFrame(
        [(1, "A", None), (2, "B", None), (3, "A", "old"), (4, None, None)],
        "i int, kind string, target string",
    )
    filled = fill_for_kinds(F.col("target"), F.lit("new"), F.col("kind"), ["A"])
    assert [r.v for r in df.orderBy("i").select(filled.alias("v")).collect()] == [
        "new", None, "old", None,
    ]
