from datetime import date, datetime

import pytest
from comparing import rows

from wattline.operators.incremental import high_watermark, newer_rows, require_unique, sync_columns, upsert


def test_watermark_of_an_empty_table_is_the_first_day(spark):
    empty = spark.createDataFrame([], "d date, t timestamp")
    assert high_watermark(empty, "d") == date(1900, 1, 1)
    assert high_watermark(empty, "t") == datetime(1900, 1, 1)


def test_rows_at_the_watermark_are_included_and_older_late_rows_are_not(spark):
    days = spark.createDataFrame([(date(2026, 1, d),) for d in (1, 2, 3)], "d date")
    done = days.filter("d <= date'2026-01-02'")
    assert newer_rows(days, None, "d").count() == 3
    assert rows(newer_rows(days, done, "d")) == [(date(2026, 1, 2),), (date(2026, 1, 3),)]
    assert newer_rows(days, done, "d", lookback_days=1).count() == 3
    assert newer_rows(days, days.limit(0), "d").count() == 3


def test_the_watermark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select date'2026-01-01' as d, 1 as n").write.parquet(path)
    scan = spark.read.parquet(path)
    plan = newer_rows(scan, scan, "d")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2026-01-01)" in plan


def people(spark, *values):
    return spark.createDataFrame(values, "id string, area string, n int")


@pytest.mark.parametrize("broadcast_rows", [100, 0])
def test_upsert_updates_adds_keeps_and_repeats(spark, broadcast_rows):
    target = people(spark, ("a", "x", 1), ("b", "x", 1))
    batch = people(spark, ("b", "x", 2), ("c", "x", 2))
    once = upsert(target, batch, "id", broadcast_rows)
    assert rows(once, "id", "n") == [("a", 1), ("b", 2), ("c", 2)]
    assert rows(upsert(once, batch, "id", broadcast_rows)) == rows(once)


@pytest.mark.parametrize("broadcast_rows", [100, 0])
def test_upsert_on_two_columns_matches_nulls(spark, broadcast_rows):
    target = people(spark, ("a", "x", 1), ("a", None, 1), ("a", "y", 1))
    batch = people(spark, ("a", None, 2), ("a", "x", 2))
    assert rows(upsert(target, batch, ["id", "area"], broadcast_rows)) == [
        ("a", "x", 2),
        ("a", "y", 1),
        ("a", None, 2),
    ]


def test_upsert_can_delete_what_the_batch_no_longer_has(spark):
    target, batch = people(spark, ("a", "x", 1)), people(spark, ("b", "x", 2))
    assert rows(upsert(target, batch, "id", delete_missing=True), "id") == [("b",)]


def test_columns_follow_the_batch(spark):
    target = people(spark, ("a", "x", 1))
    batch = spark.createDataFrame([("b", 2.5)], "id string, score double")
    assert rows(upsert(target, batch, "id")) == [("a", None), ("b", 2.5)]
    assert sync_columns(target, batch.schema).columns == ["id", "score"]


def test_repeated_keys_in_a_batch_are_refused(spark):
    require_unique(people(spark, ("a", "x", 1), ("a", "y", 1)), ["id", "area"])
    with pytest.raises(ValueError, match="repeats key"):
        require_unique(people(spark, ("a", "x", 1), ("a", "y", 1)), ["id"])
