"""One row per rule, and one per tested column that is null."""

from datetime import datetime

import pytest
from comparing import rows

from wattline.operators.rules import NULL_DROPS
from wattline.operators.rulesets import RULE_SETS
from wattline.operators.validate import (
    billing_profile,
    clean_rows,
    drift_profile,
    flag_rows,
    judged_rows,
    outcome_counts,
    quarantine_summary,
    quarantined_rows,
    readings_profile,
    split_rows,
    standardise,
    validate,
    verdict,
    view_of_clean,
    view_of_quarantined,
)

NOW = datetime(2026, 1, 8)
LOAD = {"generated_at_utc": "2026-01-07 00:00:00", "_ingested_at_utc": "2026-01-07 01:00:00"}
GOOD = {
    "meter_readings": dict(
        reading_id="R1", customer_id="C1", meter_id="M1", reading_timestamp="2026-01-01 10:00:00",
        reading_date="2026-01-01", consumption_kwh="1.5", voltage="230", region="London",
        ingestion_delay_hours=None, signal_strength_dbm="-70",
    ),
    "customers": dict(
        customer_id="C1", customer_name="Ann", email="ann@example.com", region="London",
        account_status="Active", registration_date="2024-01-01",
    ),
    "tariffs": dict(
        tariff_id="T1", tariff_name="Std", standing_charge_pence_per_day="53.2", unit_rate_pence_per_kwh="28.5",
        green_energy_flag="True", effective_start_date="2025-01-01", effective_end_date="2025-06-01",
    ),
    "meters": dict(
        meter_id="M1", customer_id="C1", tariff_id="T1", meter_type="SMETS1", meter_status="Active",
        installation_date="2024-01-01",
    ),
    "weather": dict(
        weather_id="W1", weather_date="2026-01-01", region="London", avg_temperature_c="5", min_temperature_c="1",
        max_temperature_c="9", humidity_percent="80", wind_speed_mph="10", weather_condition="Rain",
        heating_degree_days="10", cooling_degree_days="0",
    ),
    "outage_events": dict(
        outage_id="O1", region="London", outage_type="Storm Damage", severity="High",
        outage_start_timestamp="2026-01-01 01:00:00", outage_end_timestamp="2026-01-01 02:00:00",
        duration_minutes="60", affected_customers="5", resolved_flag="True",
    ),
    "billing_events": dict(
        billing_event_id="B1", customer_id="C1", tariff_id="T1", billing_date="2026-01-01",
        billing_period_start="2026-01-01", billing_period_end="2026-01-01", due_date="2026-01-15",
        paid_at="2026-01-02", total_consumption_kwh="1", standing_charge_amount="1", energy_charge_amount="1",
        vat_amount="1", total_amount="9", billing_quality_issue_injected="False", payment_status="Paid",
        payment_method="Card",
    ),
}

# Source, changed columns, the reason text expected ('' = clean, None = no verdict).
CASES = [
    ("meter_readings", {}, ""),
    ("meter_readings", {"reading_id": " "}, "Missing reading_id"),
    ("meter_readings", {"reading_id": None}, "Missing reading_id"),
    ("meter_readings", {"customer_id": None}, "Missing customer_id"),
    ("meter_readings", {"meter_id": ""}, "Missing meter_id"),
    ("meter_readings", {"reading_timestamp": "abc"}, "Missing or invalid reading_timestamp"),
    ("meter_readings", {"consumption_kwh": "abc"}, "Missing or invalid consumption_kwh"),
    ("meter_readings", {"consumption_kwh": "-0.1"}, "Negative consumption_kwh"),
    ("meter_readings", {"consumption_kwh": "100.1"}, "Consumption outlier greater than 100 kWh"),
    ("meter_readings", {"consumption_kwh": "NaN"}, "Consumption outlier greater than 100 kWh"),
    ("meter_readings", {"reading_timestamp": "2026-01-08 00:00:01"}, "Future reading_timestamp"),
    ("meter_readings", {"voltage": "199.9"}, "Voltage outside expected range 200-260"),
    ("meter_readings", {"voltage": "260.1"}, "Voltage outside expected range 200-260"),
    ("meter_readings", {"voltage": None}, None),
    ("meter_readings", {"voltage": "abc", "meter_id": None}, "Missing meter_id"),
    ("meter_readings", {"consumption_kwh": "0", "voltage": "200"}, ""),
    ("meter_readings", {"consumption_kwh": "100", "voltage": "260"}, ""),
    ("meter_readings", {"voltage": "1", "customer_id": ""}, "Missing customer_id; Voltage outside expected range 200-260"),
    ("customers", {}, ""),
    ("customers", {"customer_id": None}, "Missing customer_id"),
    ("customers", {"customer_name": ""}, "Missing customer_name"),
    ("customers", {"email": "ann@example"}, "Invalid email format"),
    ("customers", {"email": None}, ""),
    ("customers", {"region": None}, "Missing region"),
    ("customers", {"account_status": "active"}, "Invalid account_status"),
    ("customers", {"account_status": None}, ""),
    ("customers", {"registration_date": "soon"}, "Missing or invalid registration_date"),
    ("tariffs", {}, ""),
    ("tariffs", {"tariff_id": None}, "Missing tariff_id"),
    ("tariffs", {"tariff_name": None}, "Missing tariff_name"),
    ("tariffs", {"standing_charge_pence_per_day": "-1"}, "Invalid standing charge"),
    ("tariffs", {"standing_charge_pence_per_day": None}, "Invalid standing charge"),
    ("tariffs", {"standing_charge_pence_per_day": "0"}, ""),
    ("tariffs", {"unit_rate_pence_per_kwh": "0"}, "Invalid unit rate"),
    ("tariffs", {"unit_rate_pence_per_kwh": "x"}, "Invalid unit rate"),
    ("tariffs", {"effective_start_date": None}, "Missing effective_start_date"),
    ("tariffs", {"effective_end_date": "2024-12-31"}, "effective_end_date earlier than effective_start_date"),
    ("tariffs", {"effective_end_date": None}, ""),
    ("meters", {}, ""),
    ("meters", {"meter_id": None}, "Missing meter_id"),
    ("meters", {"customer_id": None}, "Missing customer_id"),
    ("meters", {"customer_id": ""}, "Missing customer_id; customer_id does not exist in customers_clean"),
    ("meters", {"customer_id": "C9"}, "customer_id does not exist in customers_clean"),
    ("meters", {"tariff_id": None}, "Missing tariff_id"),
    ("meters", {"tariff_id": "T9"}, "tariff_id does not exist in tariffs_clean"),
    ("meters", {"meter_type": "ANALOGUE"}, "Invalid meter_type"),
    ("meters", {"meter_type": None}, ""),
    ("meters", {"meter_status": "Lost"}, "Invalid meter_status"),
    ("meters", {"meter_status": None}, ""),
    ("meters", {"installation_date": None}, "Missing or invalid installation_date"),
    ("weather", {}, ""),
    ("weather", {"weather_id": None}, "Missing weather_id"),
    ("weather", {"weather_date": None}, "Missing weather_date"),
    ("weather", {"region": ""}, "Missing region"),
    ("weather", {"avg_temperature_c": None}, "Average temperature outside expected range"),
    ("weather", {"avg_temperature_c": "-30.1"}, "Average temperature outside expected range"),
    ("weather", {"avg_temperature_c": "45.1"}, "Average temperature outside expected range"),
    ("weather", {"avg_temperature_c": "-30"}, ""),
    ("weather", {"max_temperature_c": "0"}, "max_temperature_c lower than min_temperature_c"),
    ("weather", {"max_temperature_c": None}, ""),
    ("weather", {"humidity_percent": "101"}, "Humidity outside expected range 0-100"),
    ("weather", {"humidity_percent": None}, "Humidity outside expected range 0-100"),
    ("weather", {"wind_speed_mph": "-1"}, "Wind speed outside expected range"),
    ("weather", {"wind_speed_mph": None}, "Wind speed outside expected range"),
    ("weather", {"weather_condition": "Hail"}, "Invalid weather_condition"),
    ("weather", {"weather_condition": None}, ""),
    ("outage_events", {}, ""),
    ("outage_events", {"outage_id": None}, "Missing outage_id"),
    ("outage_events", {"region": None}, "Missing region"),
    ("outage_events", {"outage_type": "Meteor"}, "Invalid outage_type"),
    ("outage_events", {"outage_type": None}, ""),
    ("outage_events", {"severity": "Total"}, "Invalid severity"),
    ("outage_events", {"severity": None}, ""),
    ("outage_events", {"outage_start_timestamp": None}, "Missing outage_start_timestamp"),
    ("outage_events", {"outage_end_timestamp": None}, "Missing outage_end_timestamp"),
    ("outage_events", {"outage_end_timestamp": "2025-01-01"}, "outage_end_timestamp earlier than outage_start_timestamp"),
    ("outage_events", {"duration_minutes": "0"}, "Invalid duration_minutes"),
    ("outage_events", {"duration_minutes": None}, "Invalid duration_minutes"),
    ("outage_events", {"affected_customers": "-1"}, "Invalid affected_customers"),
    ("outage_events", {"affected_customers": None}, "Invalid affected_customers"),
    ("outage_events", {"affected_customers": "0"}, ""),
    ("billing_events", {}, ""),
    ("billing_events", {"billing_event_id": None}, "Missing billing_event_id"),
    ("billing_events", {"customer_id": None}, "Missing customer_id"),
    ("billing_events", {"tariff_id": None}, "Missing tariff_id"),
    ("billing_events", {"customer_id": "C9"}, "customer_id does not exist in customers_clean"),
    ("billing_events", {"tariff_id": "T9"}, "tariff_id does not exist in tariffs_clean"),
    ("billing_events", {"billing_date": "x"}, "Missing billing_date"),
    ("billing_events", {"total_consumption_kwh": None}, "Invalid total_consumption_kwh"),
    ("billing_events", {"total_consumption_kwh": "-1"}, "Invalid total_consumption_kwh"),
    ("billing_events", {"total_amount": None}, "Missing total_amount"),
    ("billing_events", {"total_amount": "-1"}, "Negative total_amount"),
    ("billing_events", {"total_amount": "1000"}, ""),
    ("billing_events", {"total_amount": "1000.01"}, "High total_amount greater than £1000"),
    ("billing_events", {"payment_status": "Lost"}, "Invalid payment_status"),
    ("billing_events", {"payment_status": None}, ""),
    ("billing_events", {"payment_status": None, "paid_at": None}, ""),
    ("billing_events", {"payment_method": "Cheque"}, "Invalid payment_method"),
    ("billing_events", {"payment_method": None}, ""),
    ("billing_events", {"billing_period_end": "2025-12-31"}, "billing_period_end earlier than billing_period_start"),
    ("billing_events", {"billing_period_end": None}, ""),
    ("billing_events", {"paid_at": None}, "Paid billing event missing paid_at"),
    ("billing_events", {"paid_at": None, "payment_status": "Pending"}, ""),
]


@pytest.fixture(scope="module")
def references(spark):
    return {
        "customers_clean": spark.createDataFrame([("C1",), ("C1",)], "customer_id string"),
        "tariffs_clean": spark.createDataFrame([("T1",)], "tariff_id string"),
    }


def frame(spark, source, changes):
    """Rows of a source, each a good row with changes; keys are made unique unless changed."""
    good = {**GOOD[source], **LOAD}
    key = RULE_SETS[source].key
    data = [
        (n, *{**good, key: f"{good[key]}-{n}", **change}.values()) for n, change in enumerate(changes)
    ]
    return spark.createDataFrame(data, "n long, " + ", ".join(f"{c} string" for c in good))


def flagged(spark, source, changes, references):
    rules = RULE_SETS[source]
    typed = standardise(frame(spark, source, changes), rules)
    return flag_rows(typed, rules, NOW, references, position=("n",)), rules


@pytest.mark.parametrize("source", list(GOOD))
def test_reasons_and_verdicts(spark, references, source):
    cases = [(change, reason) for name, change, reason in CASES if name == source]
    result, rules = flagged(spark, source, [change for change, _ in cases], references)
    judged = result.withColumn("v", verdict(rules.flags, rules.null_verdict)).collect()
    found = {r.n: (r.quarantine_reason, r.v) for r in judged}
    for n, (change, reason) in enumerate(cases):
        outcome = {None: ("", None), "": ("", "clean")}.get(reason, (reason, "quarantine"))
        assert found[n] == outcome, change


@pytest.mark.parametrize("source", list(GOOD))
def test_duplicates_are_the_last_reason(spark, references, source):
    key = RULE_SETS[source].key
    changes = [{key: "same"}, {key: "same", "_ingested_at_utc": "2026-01-07 02:00:00"}, {key: None}, {key: None}]
    result, rules = flagged(spark, source, changes, references)
    assert rows(result.filter(rules.duplicate_flag), "n", "quarantine_reason") == [(0, f"Duplicate {key}")]


def test_a_faulty_newest_row_takes_its_valid_twin_along(spark, references):
    changes = [{"reading_id": "x"}, {"reading_id": "x", "meter_id": "", "_ingested_at_utc": "2026-01-07 05:00:00"}]
    result, rules = flagged(spark, "meter_readings", changes, references)
    assert clean_rows(result, rules, NOW).count() == 0
    assert rows(quarantined_rows(result, rules, NOW), "n", "quarantine_reason") == [
        (0, "Duplicate reading_id"),
        (1, "Missing meter_id"),
    ]


@pytest.mark.parametrize("source", list(GOOD))
def test_input_equals_clean_plus_quarantined_plus_undecided(spark, references, source):
    changes = [change for name, change, _ in CASES if name == source]
    result, rules = flagged(spark, source, changes, references)
    clean, bad = split_rows(result, rules, NOW)
    counts = outcome_counts(result, rules).first()
    undecided = result.filter(verdict(rules.flags, rules.null_verdict).isNull()).count()
    assert (undecided > 0) == (rules.null_verdict == NULL_DROPS)
    assert counts.bronze_records == len(changes) == clean.count() + bad.count() + undecided
    assert (counts.clean_records, counts.quarantined_records) == (clean.count(), bad.count())


def test_columns_of_both_outcomes(spark, references):
    for source, kept, dropped in (
        ("meter_readings", "quarantine_reason", "duplicate_rank"),
        ("customers", "is_invalid_email", "quarantine_reason"),
    ):
        result, rules = flagged(spark, source, [{}], references)
        clean, bad = split_rows(result, rules, NOW)
        assert kept in clean.columns and dropped not in clean.columns
        assert clean.columns[-1] == "silver_processed_at_utc"
        assert bad.columns[-1] == "quarantined_at_utc"
        assert rules.rank in bad.columns and "quarantine_reason" in bad.columns
        judged = judged_rows(result, rules, NOW)
        assert set(view_of_clean(judged, rules).columns) == set(clean.columns)
        assert set(view_of_quarantined(judged).columns) == set(bad.columns)


def test_validate_in_one_call(spark, references):
    raw = frame(spark, "billing_events", [{}, {"tariff_id": "T9"}])
    clean, bad, counts = validate(raw, RULE_SETS["billing_events"], NOW, references, position=("n",))
    assert (clean.count(), bad.count(), tuple(counts.first())) == (1, 1, (2, 1, 1, 0))


def test_missing_reference_table_is_named(spark):
    raw = frame(spark, "meters", [{}])
    with pytest.raises(ValueError, match="customers_clean"):
        validate(raw, RULE_SETS["meters"], NOW, {}, position=("n",))
    with pytest.raises(ValueError, match="null verdict"):
        verdict(["a"], "maybe")


def test_rule_counts():
    assert sum(len(r.rules) for r in RULE_SETS.values()) == 67


def test_late_columns_are_added_before_the_casts(spark, references):
    raw = frame(spark, "meter_readings", [{}]).drop("signal_strength_dbm", "ingestion_delay_hours")
    typed = standardise(raw, RULE_SETS["meter_readings"])
    kinds = dict(typed.dtypes)
    assert kinds["signal_strength_dbm"] == kinds["ingestion_delay_hours"] == "double"
    assert "firmware_version" in kinds


def test_summary_is_ordered_by_count(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "quarantine_reason string")
    assert [tuple(r) for r in quarantine_summary(df).collect()] == [("b", 2), ("a", 1)]


def test_profiles_count_copies_of_whole_rows(spark):
    good = ("C1", "M1", datetime(2026, 1, 1), 1.0)
    data = [good, good, good, (None, "M1", None, -1.0), ("C1", None, datetime(2027, 1, 1), 200.0)]
    readings = spark.createDataFrame(
        data, "customer_id string, meter_id string, reading_timestamp timestamp, consumption_kwh double"
    )
    assert readings_profile(readings, NOW).first().asDict() == {
        "total_rows": 5,
        "missing_customer_id": 1,
        "missing_meter_id": 1,
        "negative_consumption": 1,
        "consumption_outliers": 1,
        "future_timestamps": 1,
        "duplicate_rows": 2,
    }
    billing = spark.createDataFrame([(None, -1.0), ("T", 2000.0), ("T", 2000.0)], "tariff_id string, total_amount double")
    assert tuple(billing_profile(billing).first()) == (3, 1, 1, 2, 1)
    assert tuple(billing_profile(billing.limit(0)).first()) == (0, 0, 0, 0, 0)
    assert rows(drift_profile(billing, ["tariff_id", "firmware_version"])) == [
        ("firmware_version", False),
        ("tariff_id", True),
    ]
