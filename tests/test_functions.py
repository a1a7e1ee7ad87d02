import hashlib
from datetime import date, datetime

import pytest
from comparing import rows
from pyspark.sql import functions as F

from wattline.functions import (
    rounded,
    exact_sum,
    calendar_columns,
    cast_columns,
    date_spine,
    degree_days,
    ensure_columns,
    load_audit_columns,
    pence_to_pounds,
    surrogate_key,
    trim_strings,
)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_surrogate_key_hashes_joined_parts(spark):
    df = spark.createDataFrame([("a", 1, date(2026, 1, 2)), (None, None, None)], "x string, y int, z date")
    keys = df.select(surrogate_key("x").alias("one"), surrogate_key("x", "y", "z").alias("three")).collect()
    assert tuple(keys[0]) == (sha("a"), sha("a||1||2026-01-02"))
    assert tuple(keys[1]) == (sha("__null__"), sha("__null__||__null__||__null__"))
    with pytest.raises(ValueError):
        surrogate_key()


def test_surrogate_key_of_equal_joined_text_collides(spark):
    df = spark.createDataFrame([("a||b", "c"), ("a", "b||c")], "x string, y string")
    assert df.select(surrogate_key("x", "y").alias("k")).distinct().count() == 1


@pytest.mark.parametrize(("pence", "pounds"), [(28.5, 0.29), (100.5, 1.01), (0.0, 0.0), (None, None), (53.2, 0.53)])
def test_pence_to_pounds_rounds_half_up(spark, pence, pounds):
    df = spark.createDataFrame([(pence,)], "p double")
    assert df.select(pence_to_pounds("p")).first()[0] == pounds


def test_trim_removes_spaces_only_and_keeps_other_types(spark):
    df = spark.createDataFrame([("  a ", "\tb\t", 1, "")], "x string, y string, n int, z string")
    assert rows(trim_strings(df)) == [("a", "\tb\t", 1, "")]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("abc", (None, None, None, None, None)),
        ("", (None, None, None, None, None)),
        ("5.0", (5.0, None, None, None, None)),
        ("7", (7.0, None, 7, None, None)),
        ("True", (None, True, None, None, None)),
        ("2026-01-02", (None, None, None, date(2026, 1, 2), datetime(2026, 1, 2))),
        ("2026-01-02 03:04:05+00:00", (None, None, None, date(2026, 1, 2), datetime(2026, 1, 2, 3, 4, 5))),
    ],
)
def test_casts_turn_malformed_text_into_null(spark, text, expected):
    kinds = {"a": "double", "b": "boolean", "c": "bigint", "d": "date", "e": "timestamp"}
    df = spark.createDataFrame([(text,) * 5], ", ".join(f"{c} string" for c in kinds))
    assert tuple(cast_columns(df, kinds).first()) == expected


def test_ensure_columns_adds_only_what_is_missing(spark):
    df = spark.createDataFrame([("a",)], "x string")
    assert ensure_columns(df, {"x": "int"}) is df
    assert rows(ensure_columns(df, {"x": "int", "y": "double"})) == [("a", None)]


def test_load_columns_are_given_not_read_from_the_clock(spark):
    at = datetime(2026, 1, 2, 3)
    df = load_audit_columns(spark.range(1), at, "run-7")
    assert tuple(df.select("dbt_loaded_at", "dbt_invocation_id").first()) == (at, "run-7")


@pytest.mark.parametrize(
    ("mean", "heating", "cooling"),
    [(5.25, 10.25, 0.0), (15.5, 0.0, 0.0), (22.0, 0.0, 0.0), (25.555, 0.0, 3.56), (None, None, None)],
)
def test_degree_days(spark, mean, heating, cooling):
    df = spark.createDataFrame([(mean,)], "t double")
    measures = degree_days(F.col("t"))
    assert tuple(df.select(*measures.values()).first()) == (heating, cooling)


def test_calendar_covers_both_ends_and_names_days(spark):
    year = date_spine(spark, date(2026, 1, 1), date(2026, 12, 31)).select(*calendar_columns())
    assert year.count() == 365
    days = {r.date_day: r for r in year.collect()}
    saturday, sunday, monday = (days[date(2026, 1, d)] for d in (3, 4, 5))
    assert (saturday.day_of_week, saturday.is_weekend, saturday.day_name) == (7, True, "Sat")
    assert (sunday.day_of_week, sunday.is_weekend) == (1, True)
    assert (monday.is_weekend, monday.date_sk, monday.month_name) == (False, 20260105, "January")
    assert days[date(2026, 1, 1)].week_of_year == 1
    assert days[date(2026, 12, 31)].week_of_year == 53
    leap = date_spine(spark, date(2024, 2, 28), date(2024, 3, 1)).select(*calendar_columns()).collect()
    assert [r.date_day.day for r in leap] == [28, 29, 1]
    assert leap[0].month_end_date == date(2024, 2, 29)
    assert leap[0].month_start_date == date(2024, 2, 1)


def test_absurd_values_do_not_stop_sums_and_rounding(spark):
    df = spark.createDataFrame([(10.0**15,), (8 * 10.0**14,), (1.5,)], "v double")
    row = df.select(exact_sum("v").cast("double").alias("s"), rounded(F.max("v"), 2).alias("r")).first()
    assert row.s == 1.8e15 + 1.5 and row.r == 1e15
