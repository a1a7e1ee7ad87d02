"""Judging load by load gives what judging the whole landing table gives."""

import random
import re
from datetime import datetime, timedelta

import pytest
from comparing import rows

from wattline.operators.audit import create_audit_tables
from wattline.operators.rulesets import BILLING, CUSTOMERS, READINGS
from wattline.operators.sinks import create_schemas, land_table, publish
from wattline.plans import validation
from wattline.plans.build import Build
from wattline.plans.validation import validate_new_rows, validate_source

T0 = datetime(2026, 1, 10)
COLUMNS = (
    "reading_id string, meter_id string, customer_id string, reading_timestamp string, reading_date string, "
    "consumption_kwh string, voltage string, region string, generated_at_utc string, _ingested_at_utc timestamp"
)


def load(draw, number, size=60):
    """Rows with all kinds of faults; ids return in later loads, also on other days."""
    data = []
    for _ in range(size):
        day = draw.randrange(1, 16)
        data.append(
            (
                draw.choice([None, "", *[f"R{i}" for i in range(70)]]),
                draw.choice(["M1", "M2", None]) if draw.random() < 0.2 else "M1",
                "C1",
                draw.choice(["abc", f"2026-01-{day:02d} 10:00:00", f"2026-01-{day:02d} 10:00:00"]),
                draw.choice([f"2026-01-{day:02d}"] * 9 + [None]),
                draw.choice(["1.5", "1.5", "-1", "200", "x"]),
                draw.choice(["230", "230", "100", None]),
                "London",
                "2026-01-01",
                T0 + timedelta(days=number),
            )
        )
    return data


def build(number):
    return Build(f"run-{number}", T0 + timedelta(days=number, hours=1), "test")


def outcome(spark, schema, part):
    shown = (
        "reading_id", "meter_id", "reading_timestamp", "reading_date", "consumption_kwh", "voltage",
        "_ingested_at_utc", "quarantine_reason", "is_duplicate_reading", "is_future_timestamp",
    )
    return rows(spark.table(f"{schema}.meter_readings_{part}"), *shown)


@pytest.mark.parametrize("seed", [1, 2])
def test_growth_equals_a_full_run(spark, seed):
    draw, whole, grown = random.Random(seed), f"whole{seed}", f"grown{seed}"
    create_schemas(spark, whole, grown)
    for schema in (whole, grown):
        create_audit_tables(spark, schema)
    for number in range(3):
        new = spark.createDataFrame(load(draw, number), COLUMNS).coalesce(1)
        new.cache()
        if number == 2:
            new = new.selectExpr("*", "'FW' as firmware_version", "'x' as brand_new")
        for schema in (whole, grown):
            land_table(new, f"{schema}.meter_readings_raw", "incremental")
        full = validate_source(spark, READINGS, whole, whole, whole, build(number))
        step = validate_new_rows(spark, READINGS, grown, grown, grown, build(number))
        counted = ("bronze_records", "clean_records", "quarantined_records", "duplicate_records")
        assert [step[c] for c in counted[:3]] == [full[c] for c in counted[:3]]
        for part in ("clean", "quarantine"):
            assert outcome(spark, grown, part) == outcome(spark, whole, part)
    assert spark.table(f"{grown}.meter_readings_verdicts").count() == 180


def test_untouched_rows_keep_their_processing_time(spark):
    schema = "times"
    create_schemas(spark, schema)
    create_audit_tables(spark, schema)

    def add(number, *ids):
        data = [
            (i, "M1", "C1", f"2026-01-0{d} 10:00:00", f"2026-01-0{d}", "1", "230", "x", "2026-01-01", T0 + timedelta(number))
            for i, d in ids
        ]
        land_table(spark.createDataFrame(data, COLUMNS), f"{schema}.meter_readings_raw", "incremental")
        validate_new_rows(spark, READINGS, schema, schema, schema, build(number))

    add(0, ("a", 1), ("b", 1), ("c", 2))
    add(1, ("a", 3), ("d", 1))
    times = rows(spark.table(f"{schema}.meter_readings_clean"), "reading_id", "silver_processed_at_utc")
    old, new = build(0).as_of, build(1).as_of
    assert times == [("a", new), ("b", old), ("c", old), ("d", new)]
    gone = rows(spark.table(f"{schema}.meter_readings_quarantine"), "reading_id", "quarantine_reason", "quarantined_at_utc")
    assert gone == [("a", "Duplicate reading_id", new)]
    # A run without new rows leaves everything as it is.
    validate_new_rows(spark, READINGS, schema, schema, schema, build(2))
    assert rows(spark.table(f"{schema}.meter_readings_clean"), "reading_id", "silver_processed_at_utc") == times


def test_sources_without_a_day_are_refused(spark):
    with pytest.raises(ValueError, match="load by load"):
        validate_new_rows(spark, CUSTOMERS, "times", "times", "times", build(0))


BILL_COLUMNS = (
    "billing_event_id string, customer_id string, tariff_id string, billing_date string, total_consumption_kwh string, "
    "total_amount string, payment_status string, payment_method string, _ingested_at_utc timestamp"
)


def bills(draw, number):
    return [
        (
            draw.choice([None, *[f"B{i}" for i in range(60)]]),
            draw.choice(["C1", "C2", "C3", "C4", None]),
            draw.choice(["T1", "T2", ""]),
            draw.choice([f"2026-01-{draw.randrange(1, 6):02d}"] * 9 + [None]),
            "1",
            draw.choice(["5", "-5"]),
            "Paid",
            "Card",
            T0 + timedelta(days=number),
        )
        for _ in range(40)
    ]


def test_growth_equals_a_full_run_when_references_change(spark, tmp_path):
    draw, whole, grown = random.Random(3), "whole_bills", "grown_bills"
    create_schemas(spark, whole, grown)
    known = ({"C1", "C2"}, {"C1", "C3", "C4"}, {"C1", "C2", "C3"}, {"C1", "C2", "C3"})
    columns = ("billing_event_id", "customer_id", "billing_date", "total_amount", "_ingested_at_utc", "quarantine_reason")
    for schema in (whole, grown):
        create_audit_tables(spark, schema)
        publish(spark.createDataFrame([("T1",)], "tariff_id string"), f"{schema}.tariffs_clean", "t")
    for number, customers in enumerate(known):
        frame = spark.createDataFrame([(c,) for c in [*customers, None]], "customer_id string")
        new = spark.createDataFrame(bills(draw, number), BILL_COLUMNS).coalesce(1)
        new = new.selectExpr("*", *[f"cast(null as string) as {c}" for c in BILLING.casts if c not in new.columns]).cache()
        for schema in (whole, grown):
            publish(frame, f"{schema}.customers_clean", f"r{number}")
            if number < 3:
                land_table(new, f"{schema}.billing_events_raw", "incremental")
        full = validate_source(spark, BILLING, whole, whole, whole, build(number))
        step = validate_new_rows(spark, BILLING, grown, grown, grown, build(number))
        counted = ("bronze_records", "clean_records", "quarantined_records")
        assert [step[c] for c in counted] == [full[c] for c in counted]
        for part in ("clean", "quarantine"):
            names = [c for c in columns if c in spark.table(f"{whole}.billing_events_{part}").columns]
            assert rows(spark.table(f"{grown}.billing_events_{part}"), *names) == rows(spark.table(f"{whole}.billing_events_{part}"), *names)
    # Nothing changed before the last run: no verdict is younger than the run before.
    times = spark.table(f"{grown}.billing_events_verdicts").select("processed_at_utc").distinct()
    assert build(3).as_of not in {r[0] for r in times.collect()}


def test_many_changed_keys_and_marks_are_not_broadcast(spark, monkeypatch):
    """Reference keys and marks are saved in small files, whatever memory their rows need."""
    plans, write = {}, validation._written

    def noted(df, purpose):
        plans.setdefault(purpose, []).append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, purpose)

    monkeypatch.setattr(validation, "_written", noted)
    monkeypatch.setattr(validation, "BROADCAST_ROWS", -1)
    draw, schema = random.Random(5), "many_keys"
    create_schemas(spark, schema)
    create_audit_tables(spark, schema)
    publish(spark.createDataFrame([("T1",)], "tariff_id string"), f"{schema}.tariffs_clean", "t")
    for number, customers in enumerate((["C1", "C1", "C2", None], ["C2", "C3", "C3", None])):
        publish(spark.createDataFrame([(c,) for c in customers], "customer_id string"), f"{schema}.customers_clean", f"r{number}")
        new = spark.createDataFrame(bills(draw, number), BILL_COLUMNS).coalesce(1)
        new = new.selectExpr("*", *[f"cast(null as string) as {c}" for c in BILLING.casts if c not in new.columns])
        land_table(new, f"{schema}.billing_events_raw", "incremental")
        if number:
            rule = next(r for r in BILLING.rules if r.column == "customer_id" and r.reference)
            references = {rule.reference: spark.table(f"{schema}.customers_clean")}
            moved = validation._changed_keys(spark, f"{schema}.billing_events_verdicts", rule, references)
            assert rows(moved) == [("C1",), ("C3",)]
        validate_new_rows(spark, BILLING, schema, schema, schema, build(number))
    assert "Join" not in "".join(plans["changed-keys"])
    assert not [p for p in plans["marked"] if re.search("BroadcastHashJoin[^\n]* LeftOuter", p)]
    assert all(re.search("SortMergeJoin[^\n]* LeftOuter", p) for p in plans["marked"])


def test_many_new_files_are_joined(spark, monkeypatch):
    monkeypatch.setattr(validation, "LISTED_FILES", 0)
    schema = "many_files"
    create_schemas(spark, schema)
    create_audit_tables(spark, schema)
    for number in range(2):
        new = spark.createDataFrame(load(random.Random(number), number, 20), COLUMNS).repartition(3)
        land_table(new, f"{schema}.meter_readings_raw", "incremental")
        assert validate_new_rows(spark, READINGS, schema, schema, schema, build(number))["bronze_records"] == 20 * (number + 1)


@pytest.mark.parametrize("times", [(0, 0, 0), (2, 0, 1)])
def test_loads_may_share_a_time_or_come_late(spark, times):
    """Also when a run is lost before it records its files: the next judges their rows again."""
    draw, whole, grown = random.Random(7), f"whole_late{times[0]}", f"grown_late{times[0]}"
    create_schemas(spark, whole, grown)
    for schema in (whole, grown):
        create_audit_tables(spark, schema)
    log = f"{grown}.meter_readings_verdicts_files"
    for number, time in enumerate(times):
        new = spark.createDataFrame(load(draw, time), COLUMNS).coalesce(1)
        land_table(new, f"{grown}.meter_readings_raw", "incremental")
        step = validate_new_rows(spark, READINGS, grown, grown, grown, build(5))
        if number == 2:
            kept = [tuple(r) for r in spark.table(log).collect()][:1]
            spark.sql(f"truncate table {log}")
            spark.createDataFrame(kept, "file_path string, run_id string").write.insertInto(log)
            step = validate_new_rows(spark, READINGS, grown, grown, grown, build(5))
        full = validate_source(spark, READINGS, grown, whole, whole, build(5))
        assert spark.table(f"{grown}.meter_readings_verdicts").count() == 60 * (number + 1)
        counted = ("bronze_records", "clean_records", "quarantined_records")
        assert [step[c] for c in counted] == [full[c] for c in counted]
        for part in ("clean", "quarantine"):
            assert outcome(spark, grown, part) == outcome(spark, whole, part)
