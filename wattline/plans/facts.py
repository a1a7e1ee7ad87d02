"""Facts: staged rows with the keys of their dimensions.

Lookups carry two or three narrow columns and have one row per key. Every function takes
the rows to build, so the same code serves a first build and an incremental one.
The column lists of the four facts are fixed values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.operators.skew import lookup_join
from wattline.plans.build import Build


def with_region_and_date(rows: DataFrame, regions: DataFrame, dates: DataFrame, day: str) -> DataFrame:
    placed = lookup_join(rows, regions.select("region", "region_sk"), "region")
    days = dates.select(F.col("date_day").alias(day), "date_sk")
    return lookup_join(placed, days, day)


def fact_meter_readings(
    readings: DataFrame, meters: DataFrame, regions: DataFrame, dates: DataFrame, run: Build
) -> DataFrame:
    """The customer key is the meter owner's; ``customer_id`` stays the one on the reading."""
    metered = lookup_join(
        readings, meters.select("meter_id", "meter_sk", "customer_sk", "tariff_sk"), "meter_id"
    )
    keyed = with_region_and_date(metered, regions, dates, "reading_date")
    return run.stamp(
        keyed.select(
            "meter_reading_sk",
            "meter_sk",
            "customer_sk",
            "tariff_sk",
            "region_sk",
            "date_sk",
            "reading_id",
            "meter_id",
            "customer_id",
            "reading_timestamp",
            "reading_date",
            "consumption_kwh",
            "voltage",
            "reading_source",
            "meter_status",
            "region",
            "is_late_arriving",
            "ingestion_delay_hours",
            "firmware_version",
            "signal_strength_dbm",
            "meter_reading_quality_code",
            "silver_processed_at_utc",
        )
    )


def fact_billing_events(
    billing: DataFrame,
    customers: DataFrame,
    tariffs: DataFrame,
    regions: DataFrame,
    dates: DataFrame,
    run: Build,
) -> DataFrame:
    owned = lookup_join(billing, customers.select("customer_id", "customer_sk"), "customer_id")
    priced = lookup_join(owned, tariffs.select("tariff_id", "tariff_sk"), "tariff_id")
    keyed = with_region_and_date(priced, regions, dates, "billing_date")
    return run.stamp(
        keyed.select(
            "billing_event_sk",
            "customer_sk",
            "tariff_sk",
            "region_sk",
            "date_sk",
            "billing_event_id",
            "customer_id",
            "tariff_id",
            "region",
            "billing_date",
            "billing_period_start",
            "billing_period_end",
            "total_consumption_kwh",
            "standing_charge_amount",
            "energy_charge_amount",
            "vat_amount",
            "total_amount",
            "payment_status",
            "payment_method",
            "due_date",
            "paid_at",
            "billing_quality_issue_injected",
            "silver_processed_at_utc",
        )
    )


def fact_outage_events(outages: DataFrame, regions: DataFrame, dates: DataFrame, run: Build) -> DataFrame:
    dated = outages.withColumn("outage_date", F.col("outage_start_timestamp").cast("date"))
    keyed = with_region_and_date(dated, regions, dates, "outage_date")
    return run.stamp(
        keyed.select(
            "outage_sk",
            "region_sk",
            "date_sk",
            "outage_id",
            "region",
            "outage_type",
            "severity",
            "outage_start_timestamp",
            "outage_end_timestamp",
            "outage_date",
            "duration_minutes",
            "affected_customers",
            "resolved_flag",
            "silver_processed_at_utc",
        )
    )


def fact_weather_daily(weather: DataFrame, regions: DataFrame, dates: DataFrame, run: Build) -> DataFrame:
    keyed = with_region_and_date(weather, regions, dates, "weather_date")
    return run.stamp(
        keyed.select(
            "weather_sk",
            "region_sk",
            "date_sk",
            "weather_id",
            "weather_date",
            "region",
            "avg_temperature_c",
            "min_temperature_c",
            "max_temperature_c",
            "humidity_percent",
            "wind_speed_mph",
            "weather_condition",
            "heating_degree_days",
            "cooling_degree_days",
            "silver_processed_at_utc",
        )
    )
