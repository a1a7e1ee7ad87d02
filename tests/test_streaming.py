from datetime import datetime, timedelta

import pytest
from comparing import rows
from raw_area import DRIFTED, drifted, reading, write_daily, write_raw_area

from wattline.plans.build import Build
from wattline.sources.registry import SOURCES
from wattline.streaming.ingest import ingest_new_files, read_ingested
from wattline.plans.marts import daily_usage
from wattline.streaming import usage as usage_stream
from wattline.streaming.usage import UsageTables, fold_usage, rows_behind, run_usage_stream, streamed_daily_usage, usage_progress

T0 = datetime(2026, 1, 1, 12)
SCHEMA = (
    "reading_id string, meter_id string, customer_id string, reading_timestamp timestamp, region string, "
    "consumption_kwh double, voltage double, is_late_arriving boolean"
)


def test_each_file_is_ingested_once(spark, tmp_path):
    raw, out, log = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "log")
    write_raw_area(raw)
    source = SOURCES["meter_readings"]
    ingest_new_files(spark, source, str(raw), out, log, Build("r1", T0), files_per_batch=1)
    assert read_ingested(spark, out).count() == 10
    days = {"2026-01-05": [DRIFTED, drifted(reading(10, "M2", "C2", 5, "3.5"), "FW_2", "-62")]}
    write_daily(raw, "meter_readings", "reading_date", days)
    for _ in range(2):
        ingest_new_files(spark, source, str(raw), out, log, Build("r2", T0))
        assert rows(read_ingested(spark, out).groupBy("_run_id").count()) == [("r1", 10), ("r2", 1)]
    assert rows(read_ingested(spark, out).filter("reading_id in ('R1', 'R10')"), "reading_id", "firmware_version") == [
        ("R1", None),
        ("R10", "FW_2"),
    ]


def at(hours, number, meter="M1", late=False):
    number = number if number is None else f"R{number}"
    return (number, meter, "C1", T0 + timedelta(hours=hours), "London", 1.5, 230.0, late)


@pytest.fixture
def feed(spark, tmp_path):
    folder, out, log = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "log")

    def run(*values, delay="120 hours"):
        if values:
            spark.createDataFrame(values, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        run_usage_stream(spark.readStream.schema(SCHEMA).parquet(folder), out, log, delay)

    run.folder, run.out = folder, out
    return run


def shown(spark, feed):
    columns = ("reading_date", "reading_count", "active_meter_count", "total_consumption_kwh", "late_arriving_reading_count")
    return [(str(r[0]), *r[1:]) for r in rows(streamed_daily_usage(spark, feed.out), *columns)]


def test_open_days_are_shown_ids_count_once_and_late_rows_are_kept_aside(spark, feed):
    feed(at(0, 1), at(1, 2, "M2"), at(48, 3))
    assert shown(spark, feed) == [("2026-01-01", 2, 2, 3.0, 0), ("2026-01-03", 1, 1, 1.5, 0)]
    # Four days later: a repeated id, a late row that still counts, and the newest row.
    feed(at(0, 1), at(2, 4, late=True), at(100, 5), at(100, 5))
    feed(at(150, 6))
    # The watermark has passed the first day: a new row for it and a copy of a forgotten id are set aside.
    feed(at(3, 7, late=True), at(0, 1), at(151, 8))
    wanted = [
        ("2026-01-01", 3, 2, 4.5, 1),
        ("2026-01-03", 1, 1, 1.5, 0),
        ("2026-01-05", 1, 1, 1.5, 0),
        ("2026-01-07", 2, 1, 3.0, 0),
    ]
    assert shown(spark, feed) == wanted
    assert rows(rows_behind(spark, feed.out, SCHEMA), "reading_id") == [("R1",), ("R7",)]
    counted = ("batch_id", "rows", "accepted", "repeated", "behind")
    assert rows(usage_progress(spark, feed.out), *counted) == [(0, 3, 3, 0, 0), (1, 4, 2, 2, 0), (2, 1, 1, 0, 0), (3, 3, 1, 0, 2)]


def test_a_repeated_batch_counts_once(spark, feed, monkeypatch):
    feed(at(0, 1), at(1, 2))
    before = usage_stream.meter_days
    monkeypatch.setattr(usage_stream, "meter_days", lambda readings: 1 / 0)
    with pytest.raises(Exception, match="division"):
        feed(at(2, 3), at(0, 1))
    monkeypatch.setattr(usage_stream, "meter_days", before)
    feed()
    feed()
    assert shown(spark, feed) == [("2026-01-01", 3, 1, 4.5, 0)]


def test_a_fold_changes_nothing_that_is_read(spark, feed):
    for day in range(4):
        feed(at(24 * day, day), at(24 * day + 1, None), at(0, 0), delay="48 hours")
    before = shown(spark, feed), rows(usage_progress(spark, feed.out))
    fold_usage(spark, feed.out, "48 hours")
    assert (shown(spark, feed), rows(usage_progress(spark, feed.out))) == before
    tables = UsageTables(spark, feed.out)
    assert [kind for kind, _, _ in tables.folders("days")] == ["fold"]
    assert rows(tables.read("seen", "reading_id string, reading_timestamp timestamp"), "reading_id") == [("R2",), ("R3",)]
    feed(at(72, 3), at(74, 9), delay="48 hours")
    fold_usage(spark, feed.out, "48 hours")
    fold_usage(spark, feed.out, "48 hours")
    assert shown(spark, feed)[-1] == ("2026-01-04", 3, 1, 4.5, 0)
    once = spark.read.schema(SCHEMA).parquet(feed.folder).dropDuplicates(["reading_id", "reading_timestamp"])
    behind = rows_behind(spark, feed.out, SCHEMA).count()
    assert sum(r[1] for r in shown(spark, feed)) == once.count() and behind == 1


def test_readings_without_an_id_are_not_copies_of_each_other(spark, feed):
    feed(*[at(0, None)] * 10, delay="1 hours")
    feed(at(72, 1), at(73, 2), delay="1 hours")
    assert [r[:2] for r in shown(spark, feed)] == [("2026-01-01", 10), ("2026-01-04", 2)]


def test_the_stream_agrees_with_the_batch(spark, feed):
    values = [at(n * 7 % 90, n % 40, f"M{n % 3}", n % 5 == 0) for n in range(60)]
    for n in range(0, 60, 20):
        feed(*values[n : n + 20])
    once = spark.createDataFrame(list({v[0]: v for v in reversed(values)}.values()), SCHEMA)
    dated = once.selectExpr("*", "cast(reading_timestamp as date) as reading_date")
    found = streamed_daily_usage(spark, feed.out)
    assert rows(found, "reading_date", "region", "reading_count") == rows(daily_usage(dated), "reading_date", "region", "reading_count")
