from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from polfin.functions import congress as k
from polfin.functions import scalars as s
from polfin.functions.columns import c, sanitize


def values(spark, expression, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expression).collect()]


@pytest.mark.parametrize(
    ("day", "number"),
    [
        ("1979-01-03", 96),
        ("1979-06-15", 96),
        ("1980-12-31", 96),
        ("1981-01-02", 96),
        ("1981-01-03", 97),
        ("2023-01-02", 117),
        ("2023-01-03", 118),
        ("2024-12-31", 118),
        ("2025-01-03", 119),
        ("1935-01-03", 74),
        ("1935-01-02", 73),
        ("1789-03-04", 1),
    ],
)
def test_congress_number(spark, day, number):
    found = spark.range(1).select(k.congress_of(F.lit(day).cast("date"))).first()[0]
    assert found == number


def test_congress_number_over_all_days(spark):
    """Counting Congresses day by day from the first one gives the same numbers."""
    days = spark.sql("SELECT explode(sequence(DATE '1789-01-03', DATE '2036-12-31')) AS day")
    starts = F.when((F.dayofyear("day") == 3) & (F.year("day") % 2 == 1), 1).otherwise(0)
    rows = days.select("day", k.congress_of(F.col("day")).alias("n"), starts.alias("starts")).orderBy("day").collect()
    running = 0
    for r in rows:
        running += r["starts"]
        assert r["n"] == running, r["day"]


def test_congress_years(spark):
    rows = spark.createDataFrame([(96,), (118,), (74,), (1,)], "n int").select(
        k.congress_start_year(F.col("n")), k.congress_end_year(F.col("n")), k.congress_years(F.col("n"))
    )
    assert [tuple(r[:2]) + tuple(r[2]) for r in rows.collect()] == [
        (1979, 1981, 1979, 1980),
        (2023, 2025, 2023, 2024),
        (1935, 1937, 1935, 1936),
        (1789, 1791, 1789, 1790),
    ]


def test_strip_year(spark):
    found = values(spark, s.strip_year(F.col("x")), [("100751980",), ("S4VT000332020",), ("1980",), ("ab",), (None,)], "x string")
    assert found == ["10075", "S4VT00033", "", "", None]


def test_split_ids(spark):
    found = values(spark, s.split_ids(F.col("x")), [("A,B",), ("A,",), ("",), (None,), (" A",)], "x string")
    assert found == [["A", "B"], ["A", ""], [], [], [" A"]]


def test_iso_dates(spark):
    rows = [("2020-01-03",), ("2020-01-03T10:00",), ("2020-1-3",), ("2020",), ("",), (None,), ("2021-02-29",)]
    assert values(spark, s.iso_date(F.col("x")), rows, "x string") == [dt.date(2020, 1, 3)] * 2 + [None] * 5
    assert values(spark, s.whole_iso_date(F.col("x")), rows, "x string") == [dt.date(2020, 1, 3)] + [None] * 6


def test_first_filled(spark):
    rows = [("a", "b"), ("", "b"), (None, "b"), ("", ""), (None, None)]
    assert values(spark, s.first_filled(F.col("x"), F.col("y")), rows, "x string, y string") == ["a", "b", "b", None, None]


def test_tolerant_bigint(spark):
    assert values(spark, s.to_bigint(F.col("x")), [("12",), ("12a",), ("",), (None,), ("12.7",)], "x string") == [
        12, None, None, None, 13,
    ]


@pytest.mark.parametrize(
    ("a", "b", "same"),
    [
        (None, None, True),
        (None, "x", False),
        ("x", None, False),
        ("1.0", "1", True),
        ("1.0000001", "1.0000002", True),
        ("1.0", "1.1", False),
        ("Nan", "Nan", True),
        ("Nan", "nan", False),
        ("Nan", "1.0", False),
        ("abc", "abc", True),
        ("abc", "1", False),
        ("01234", "1234", True),
    ],
)
def test_same_value(spark, a, b, same):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(s.same_value(F.col("a"), F.col("b"))).first()[0] is same


def test_normal_values(spark):
    text = [("  x ",), ("NaN",), ("n/a",), ("",), ("\\N",), (None,), ("null",)]
    assert values(spark, s.normal_text(F.col("x")), text, "x string") == ["x", None, None, None, "\\N", None, None]
    dime = s.normal_text(F.col("x"), ("\\N", ""), s.EXPORT_BLANK_WORDS)
    assert values(spark, dime, text, "x string") == ["x", None, "n/a", None, None, None, "null"]
    numbers = [(float("nan"),), (1.23456789,), (-0.0,), (None,)]
    assert values(spark, s.normal_number(F.col("x")), numbers, "x double") == [None, 1.234568, 0.0, None]


def test_tolerances(spark):
    rows = [(100.0, 100.009), (100.0, 100.02), (1e9, 1e9 + 900), (1e9, 1e9 + 1100), (None, 1.0)]
    found = values(spark, s.within_relative(F.col("a"), F.col("e")), rows, "e double, a double")
    assert found == [True, False, True, False, None]


def test_percent_of_nothing(spark):
    assert values(spark, s.percent(F.col("a"), F.col("b")), [(1, 4), (0, 0)], "a bigint, b bigint") == [25.0, 0.0]


def test_decode(spark):
    assert values(spark, s.party_name(F.col("x")), [(100.0,), (328.0,), (1.0,), (None,)], "x double") == [
        "Democrat", "Independent", None, None,
    ]
    assert values(spark, s.contributor_type_name(F.col("x")), [("U",), ("I",)], "x string") == ["Union", None]


def test_sanitize(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, c int")
    assert sanitize(df).columns == ["a_b", "c"]
    assert df.select(c("a.b")).first()[0] == 1
    with pytest.raises(ValueError):
        sanitize(spark.createDataFrame([(1, 2)], "`a.b` int, a_b int"))
