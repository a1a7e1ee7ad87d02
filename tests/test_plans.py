from datetime import date

import pytest
from comparing import rows
from pyspark.sql import functions as F

from wattline.plans import dimensions, marts
from wattline.operators.skew import salted_lookup
from wattline.plans.billing import billing_charges

D = date(2026, 1, 1)


def readings(spark, *values):
    return spark.createDataFrame(
        [(f"R{n}", *v) for n, v in enumerate(values)],
        "reading_id string, customer_id string, meter_id string, region string, reading_date date, "
        "consumption_kwh double, voltage double, is_late_arriving boolean",
    )


def bills(spark, *values):
    return spark.createDataFrame(
        values,
        "billing_event_id string, customer_id string, region string, billing_date date, total_amount double, "
        "total_consumption_kwh double, payment_status string",
    )


def customers(spark, *ids):
    data = [(f"s{i}", i, "n", "London", "Residential", "Flat", "Active") for i in ids]
    return spark.createDataFrame(
        data,
        "customer_sk string, customer_id string, customer_name string, region string, customer_segment string, "
        "property_type string, account_status string",
    )


def test_customer_without_readings_counts_one_and_has_null_sums(spark):
    summary = marts.customer_energy_summary(
        customers(spark, "C1", "C2"),
        readings(spark, ("C1", "M1", "x", D, 1000.0, None, None)),
        bills(spark, ("B1", "C1", "x", D, 5.0, 1.0, "Failed"), ("B2", "C1", "x", D, 7.0, 1.0, "Other")),
    ).orderBy("customer_id")
    first, second = summary.collect()
    # A sum of exactly the limit is not high use.
    assert (first.reading_count, first.total_consumption_kwh, first.is_high_consumption_customer) == (1, 1000.0, False)
    assert (first.total_billed_amount, first.paid_amount, first.unpaid_or_problem_amount) == (12.0, 0.0, 5.0)
    assert (second.meter_count, second.reading_count, second.total_consumption_kwh) == (0, 1, None)
    assert (second.is_high_consumption_customer, second.total_billed_amount, second.billing_event_count) == (False, 0.0, 0)


def test_high_use_is_above_the_limit(spark):
    rows_in = readings(spark, ("C1", "M1", "x", D, 1000.0, None, None), ("C1", "M2", "x", D, 0.001, None, None))
    summary = marts.customer_energy_summary(customers(spark, "C1"), rows_in, bills(spark, ("B", "C9", "x", D, 1.0, 1.0, "Paid")))
    assert rows(summary, "meter_count", "reading_count", "is_high_consumption_customer") == [(2, 2, True)]


def test_daily_usage_counts_distinct_and_keeps_null_regions(spark):
    usage = marts.daily_usage(
        readings(
            spark,
            ("C1", "M1", "x", D, 1.0, 230.0, True),
            ("C1", "M1", "x", D, 2.0, None, False),
            ("C2", "M2", "x", D, 4.5, 231.0, None),
            (None, "M3", None, D, 1.0, 230.0, False),
        )
    )
    names = (
        "region", "reading_count", "active_meter_count", "active_customer_count", "total_consumption_kwh",
        "avg_consumption_kwh", "max_half_hour_consumption_kwh", "avg_voltage", "late_arriving_reading_count",
    )
    assert rows(usage, *names) == [
        ("x", 3, 2, 2, 7.5, 2.5, 4.5, 230.5, 1),
        (None, 1, 1, 0, 1.0, 1.0, 1.0, 230.0, 0),
    ]


def test_repeated_billing_events_are_counted_once_but_summed(spark):
    billed = marts.daily_billing(bills(spark, ("B1", "C", "x", D, 1.0, 1.0, "Paid"), ("B1", "C", "x", D, 1.0, 1.0, "Paid")))
    assert rows(billed, "total_revenue_amount", "billing_event_count") == [(2.0, 1)]


@pytest.fixture(scope="module")
def plans(spark):
    meters = spark.createDataFrame(
        [("M1", "C1", "T1", "x"), ("M2", "C1", "T1", "x"), ("M3", "C1", "T2", "x"), ("M4", "C4", None, "x"), ("M5", "C5", "T1", None)],
        "meter_id string, customer_id string, tariff_id string, region string",
    )
    tariffs = spark.createDataFrame(
        [("T1", 53.2, 28.5), ("T2", 49.8, 30.2)],
        "tariff_id string, standing_charge_pence_per_day double, unit_rate_pence_per_kwh double",
    )
    return meters, tariffs


def test_charges(spark, plans):
    used = readings(
        spark,
        ("C1", "M1", "x", D, 0.5, None, None),
        ("C1", "M2", "x", D, 0.5, None, None),
        ("C1", "M3", "x", D, 2.0, None, None),
        ("C4", "M4", "x", D, 1.0, None, None),
        ("C5", "M5", None, D, 1.0, None, None),
        ("C1", "M1", "x", D, 101.0, None, None),
        ("C1", "M1", "x", D, -1.0, None, None),
        (None, "M1", "x", D, 1.0, None, None),
    )
    charged = billing_charges(used, *plans)
    names = (
        "customer_id", "tariff_id", "total_consumption_kwh", "standing_charge_amount", "energy_charge_amount",
        "vat_amount", "total_amount",
    )
    assert rows(charged, *names) == [
        # Two meters on one tariff share a row; 28.5 pence round up to 0.29.
        ("C1", "T1", 1.0, 0.53, 0.29, 0.04, 0.86),
        ("C1", "T2", 2.0, 0.5, 0.6, 0.06, 1.16),
        ("C4", None, 1.0, None, None, None, None),
        # Null regions match each other.
        ("C5", "T1", 1.0, 0.53, 0.29, 0.04, 0.86),
    ]
    assert {r[0] for r in rows(charged, "due_date")} == {date(2026, 1, 15)}


def test_charges_are_the_same_when_half_of_the_meters_share_a_tariff_that_is_not_broadcast(spark):
    used = readings(spark, *[(f"C{n % 90}", f"M{n % 180}", "x", date(2026, 1, 1 + n % 5), n % 7 / 4, None, None) for n in range(900)])
    meters = spark.createDataFrame(
        [(f"M{n}", f"C{n % 90}", None if n % 9 == 0 else "T0" if n % 2 else f"T{n % 5}", "x") for n in range(180)],
        "meter_id string, customer_id string, tariff_id string, region string",
    )
    rates = [*[(f"T{n}", 50.0 + n, 20.0 + n) for n in range(4)], (None, 1.0, 2.0), ("T1", 60.0, 30.0)]
    tariffs = spark.createDataFrame(rates, "tariff_id string, standing_charge_pence_per_day double, unit_rate_pence_per_kwh double")
    plain = rows(billing_charges(used, meters, tariffs))
    assert plain == rows(billing_charges(used, meters, tariffs, broadcast_rows=0, hot_rows=50))
    assert plain == rows(billing_charges(used, meters, tariffs, broadcast_rows=0))


def test_rows_of_a_hot_key_are_dealt_evenly(spark):
    made = spark.range(20_000).selectExpr("id", "case when id % 2 = 0 then 'hot' when id % 4 = 1 then null else cast(id as string) end as k")
    lookup = spark.createDataFrame([("hot", 1), (None, 2), ("3", 3)], "k string, v int")
    joined = salted_lookup(made, lookup, "k", broadcast_rows=0, hot_rows=100, salts=16)
    assert rows(joined.groupBy("v").count()) == [(1, 10_000), (2, 5_000), (3, 1), (None, 4_999)]
    shares = made.where("k = 'hot'").selectExpr("pmod(xxhash64(id, k), 16) as share").groupBy("share").count().collect()
    assert len(shares) == 16 and max(r["count"] for r in shares) < 2 * min(r["count"] for r in shares)


def test_regions_come_from_all_sources_without_null(spark, run):
    frames = [spark.createDataFrame([(r,) for r in names], "region string") for names in (["a", None], ["b", "a"], ["c"])]
    regions = dimensions.dim_regions(frames, run)
    assert rows(regions, "region") == [("a",), ("b",), ("c",)]
    assert regions.select(F.length("region_sk")).distinct().collect()[0][0] == 64


def test_flags_of_dimensions_are_false_for_null(spark, run):
    staged = spark.createDataFrame(
        [("M1", "Active"), ("M2", None)],
        "meter_id string, meter_status string",
    ).selectExpr(
        "meter_id as meter_sk", "meter_id", "'C1' as customer_id", "'T1' as tariff_id", "'x' as region",
        "'SMETS1' as meter_type", "meter_status", "date'2026-01-01' as installation_date",
        "timestamp'2026-01-01' as silver_processed_at_utc",
    )
    owners = spark.createDataFrame([("C1", "sc")], "customer_id string, customer_sk string")
    prices = spark.createDataFrame([("T2", "st")], "tariff_id string, tariff_sk string")
    dim = dimensions.dim_meters(staged, owners, prices, run)
    assert rows(dim, "meter_id", "customer_sk", "tariff_sk", "is_active_meter") == [
        ("M1", "sc", None, True),
        ("M2", "sc", None, False),
    ]
