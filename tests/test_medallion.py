from datetime import datetime, timedelta

import pytest
from comparing import rows
from raw_area import DRIFTED, drifted, reading, write_daily, write_raw_area

from wattline.operators import checks
from wattline.operators.audit import audit_of_run, unfinished_steps
from wattline.operators.checks import FAIL, ChecksFailed
from wattline.plans.build import Build
from wattline.plans.gold import Gold
from wattline.plans.medallion import (
    Layout,
    landing_counts,
    run_all,
    run_landing,
    run_validation,
    validated_counts,
)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    write_raw_area(base)
    layout = Layout("b1", "s1", "g1", "a1")
    first = Build("run-1", datetime(2026, 1, 8, 12), "test")
    report = run_all(spark, str(base), first, layout, stop_on_failure=False, load_by_load=True)
    return base, layout, report.collect()


def test_landing_keeps_every_row_as_text(spark, built):
    _, layout, _ = built
    counts = dict(rows(landing_counts(spark, layout)))
    assert counts == {
        "b1.customers_raw": 4,
        "b1.tariffs_raw": 3,
        "b1.meters_raw": 3,
        "b1.meter_readings_raw": 10,
        "b1.weather_raw": 2,
        "b1.outage_events_raw": 2,
        "b1.billing_events_raw": 4,
    }
    raw = spark.table("b1.meter_readings_raw")
    kinds = {f.name: f.dataType.simpleString() for f in raw.schema.fields}
    assert kinds.pop("_ingested_at_utc") == "timestamp"
    assert set(kinds.values()) == {"string"}
    assert rows(raw.filter("reading_id = 'R9'"), "firmware_version", "signal_strength_dbm", "region") == [
        ("FW_2", "-61", "North West")
    ]
    assert rows(raw.filter("reading_id = 'R1'"), "firmware_version") == [(None,)]


def test_validation_splits_and_explains(spark, built):
    _, layout, _ = built
    assert rows(spark.table("s1.customers_quarantine"), "customer_id", "quarantine_reason") == [
        ("C3", "Invalid email format")
    ]
    assert rows(spark.table("s1.meters_quarantine"), "meter_id", "quarantine_reason") == [
        ("M3", "customer_id does not exist in customers_clean")
    ]
    assert rows(spark.table("s1.billing_events_quarantine"), "billing_event_id", "quarantine_reason") == [
        ("B3", "Missing tariff_id"),
        ("B4", "customer_id does not exist in customers_clean"),
    ]
    reasons = rows(spark.table("s1.meter_readings_quarantine"), "reading_id", "quarantine_reason")
    assert reasons == [
        ("R4", "Missing customer_id"),
        ("R5", "Negative consumption_kwh"),
        ("R7", "Duplicate reading_id"),
        ("R8", "Consumption outlier greater than 100 kWh"),
    ]
    # R6 has no voltage: its verdict is unknown and it lands in neither table.
    assert [r[0] for r in rows(spark.table("s1.meter_readings_clean"), "reading_id")] == [
        "R1", "R2", "R3", "R7", "R9",
    ]
    counts = dict(rows(validated_counts(spark, layout)))
    assert counts["s1.weather_clean"] == counts["s1.weather_quarantine"] == 1
    assert "quarantine_reason" in spark.table("s1.meter_readings_clean").columns
    assert "quarantine_reason" not in spark.table("s1.customers_clean").columns
    assert "_duplicate_rank" in spark.table("s1.customers_quarantine").columns


def test_audits_have_one_row_per_source(spark, built):
    landing = audit_of_run(spark.table("a1.bronze_ingestion_audit"), "run-1")
    assert landing.count() == 7
    assert rows(landing.filter("source_name = 'meter_readings'"), "status", "records_loaded") == [
        ("SUCCESS", 10)
    ]
    validation = audit_of_run(spark.table("a1.silver_processing_audit"), "run-1")
    counted = validation.filter("source_table = 'b1.meter_readings_raw'")
    names = ("bronze_records", "clean_records", "quarantined_records", "duplicate_records", "status")
    assert rows(counted, *names) == [(10, 5, 4, 1, "SUCCESS")]


def test_reports_and_checks(spark, built):
    _, _, report = built
    daily = spark.table("g1.mart_daily_energy_summary")
    shown = (
        "reading_date", "region", "reading_count", "active_meter_count", "total_consumption_kwh",
        "late_arriving_reading_count", "weather_condition", "total_revenue_amount",
    )
    assert [(str(r[0]), *r[1:]) for r in rows(daily, *shown)] == [
        ("2026-01-01", "London", 2, 1, 1.75, 0, "Rain", 1.08),
        ("2026-01-01", "North West", 1, 1, 2.0, 1, None, 2.5),
        ("2026-01-04", "London", 1, 1, 0.25, 0, None, 0.0),
        ("2026-01-04", "North West", 1, 1, 4.5, 0, None, 0.0),
    ]
    customers = spark.table("g1.mart_customer_energy_summary")
    assert rows(customers, "customer_id", "meter_count", "reading_count", "total_billed_amount", "paid_amount") == [
        ("C1", 1, 3, 1.08, 1.08),
        ("C2", 1, 2, 2.5, 0.0),
        ("C4", 0, 1, 0.0, 0.0),
    ]
    assert [r for r in report if r.status == FAIL] == []
    assert len(report) == 140


def test_sources_are_fresh_for_thirty_days(spark, built):
    _, layout, _ = built
    for days, status in ((0, "pass"), (31, "warn"), (91, "error")):
        later = Build("run-z", datetime(2026, 1, 8, 12) + timedelta(days=days), "test")
        ages = Gold(spark, layout.validated, layout.reporting, later).freshness()
        assert {r[0] for r in rows(ages, "status")} == {status}


def test_second_run_loads_new_files_only_and_keeps_history(spark, built, tmp_path):
    base, layout, _ = built
    days = {"2026-01-05": [DRIFTED, drifted(reading(10, "M2", "C2", 5, "3.5"), "FW_2", "-62")]}
    write_daily(base, "meter_readings", "reading_date", days)
    customers = base / "customers" / "customers_20260101.csv"
    customers.write_text(customers.read_text().replace("North West", "London"))

    second = Build("run-2", datetime(2026, 1, 9, 12), "test")
    run_all(spark, str(base), second, layout, stop_on_failure=False, load_by_load=True)
    landed = audit_of_run(spark.table("a1.bronze_ingestion_audit"), "run-2")
    assert rows(landed.filter("load_type = 'incremental'"), "source_name", "records_loaded") == [
        ("billing_events", 0),
        ("meter_readings", 1),
        ("outage_events", 0),
        ("weather", 0),
    ]
    assert spark.table("g1.fact_meter_readings").count() == 6
    assert spark.table("g1.fact_meter_readings").select("meter_reading_sk").distinct().count() == 6
    history = spark.table("g1.dim_customers_scd")
    assert rows(history.filter("customer_id = 'C2'"), "region", "is_current_record") == [
        ("London", True),
        ("North West", False),
    ]
    assert history.filter("customer_id = 'C1'").count() == 1
    assert spark.table("g1.mart_daily_energy_summary").count() == 5
    times = rows(spark.table("s1.meter_readings_clean").groupBy("silver_processed_at_utc").count())
    assert times == [(datetime(2026, 1, 8, 12), 5), (datetime(2026, 1, 9, 12), 1)]
    judged = audit_of_run(spark.table("a1.silver_processing_audit"), "run-2")
    assert rows(judged.filter("source_table = 'b1.meter_readings_raw'"), "bronze_records", "clean_records") == [(11, 6)]


def test_a_lost_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    write_raw_area(tmp_path)
    layout, run = Layout("b4", "s4", "g4", "a4"), Build("run-1", datetime(2026, 1, 8, 12), "test")
    with monkeypatch.context() as broken:
        broken.setattr(Gold, "build_histories", lambda self: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_all(spark, str(tmp_path), run, layout)
    assert rows(unfinished_steps(spark.table("a4.run_steps"))) == [("run-1", "histories")]
    report = run_all(spark, str(tmp_path), run, layout, resume=True)
    assert [r for r in report.collect() if r.status == FAIL] == []
    ledger = spark.table("a4.run_steps")
    assert unfinished_steps(ledger).count() == 0
    times = {r[0]: r[1] for r in rows(ledger.where("state = 'STARTED'").groupBy("step").count())}
    assert times.pop("histories") == 2 and set(times.values()) == {1}
    assert spark.table("a4.bronze_ingestion_audit").count() == 7
    assert rows(spark.table("g4.fact_meter_readings").groupBy("meter_sk").count()) != []


def test_failed_landing_is_recorded_and_raised(spark, tmp_path):
    layout = Layout("b2", "s2", "g2", "a2")
    run = Build("run-x", datetime(2026, 1, 8), "test")
    with pytest.raises(Exception, match="customers"):
        run_landing(spark, str(tmp_path / "nothing"), run, layout)
    audit = rows(spark.table("a2.bronze_ingestion_audit"), "source_name", "status", "records_loaded")
    assert audit == [("customers", "FAILED", 0)]


def test_failed_validation_is_recorded_and_raised(spark):
    layout = Layout("b3", "s3", "g3", "a3")
    with pytest.raises(LookupError, match="b3.customers_raw"):
        run_validation(spark, Build("run-y", datetime(2026, 1, 8), "test"), layout)
    assert rows(spark.table("a3.silver_processing_audit"), "status", "bronze_records") == [("FAILED", 0)]


def test_a_failing_check_stops_the_run(spark):
    broken = spark.createDataFrame([("C1",), ("C1",)], "customer_id string")
    report = checks.check_report({"t": broken}, checks.key("t", "customer_id"))
    with pytest.raises(ChecksFailed, match="unique t.customer_id: 1"):
        checks.require_passed(report)
