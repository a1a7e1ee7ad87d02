"""Dimensions. Each is rebuilt whole from its staging models."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions import calendar_columns, date_spine, surrogate_key
from wattline.operators.skew import lookup_join
from wattline.plans.build import Build


def dim_customers(staged: DataFrame, run: Build) -> DataFrame:
    shaped = staged.select(
        "customer_sk",
        "customer_id",
        "customer_name",
        "email",
        "phone_number",
        "postcode",
        "region",
        "customer_segment",
        "property_type",
        "account_status",
        "registration_date",
        F.col("account_status").eqNullSafe("Active").alias("is_active_customer"),
        "source_system",
        "silver_processed_at_utc",
    )
    return run.stamp(shaped)


def dim_tariffs(staged: DataFrame, run: Build) -> DataFrame:
    shaped = staged.select(
        "tariff_sk",
        "tariff_id",
        "tariff_name",
        "standing_charge_pence_per_day",
        "standing_charge_amount_per_day",
        "unit_rate_pence_per_kwh",
        "unit_rate_amount_per_kwh",
        "green_energy_flag",
        "effective_start_date",
        "effective_end_date",
        F.col("effective_end_date").isNull().alias("is_current_tariff"),
    )
    return run.stamp(shaped)


def dim_meters(staged: DataFrame, customers: DataFrame, tariffs: DataFrame, run: Build) -> DataFrame:
    owned = lookup_join(staged, customers.select("customer_id", "customer_sk"), "customer_id")
    priced = lookup_join(owned, tariffs.select("tariff_id", "tariff_sk"), "tariff_id")
    shaped = priced.select(
        "meter_sk",
        "meter_id",
        "customer_sk",
        "tariff_sk",
        "customer_id",
        "tariff_id",
        "region",
        "meter_type",
        "meter_status",
        "installation_date",
        F.col("meter_status").eqNullSafe("Active").alias("is_active_meter"),
        "silver_processed_at_utc",
    )
    return run.stamp(shaped)


def distinct_regions(frames: Iterable[DataFrame]) -> DataFrame:
    """All region names of several sources, without null.

    Each source is reduced before the union, so only names are shuffled.
    """
    names = [f.select("region").distinct() for f in frames]
    return reduce(DataFrame.union, names).distinct().filter(F.col("region").isNotNull())


def dim_regions(frames: Iterable[DataFrame], run: Build) -> DataFrame:
    names = distinct_regions(frames)
    return run.stamp(names.select(surrogate_key("region").alias("region_sk"), "region"))


def dim_date(
    spark: SparkSession,
    run: Build,
    first: date = date(2026, 1, 1),
    last: date = date(2026, 12, 31),
) -> DataFrame:
    return run.stamp(date_spine(spark, first, last).select(*calendar_columns()))
