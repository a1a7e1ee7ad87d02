"""Daily charges calculated from readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions import exact_sum
from wattline.operators.skew import BROADCAST_ROWS, HOT_GROUP_ROWS, salted_lookup

# The tax rate, the days until payment and the largest reading that is billed.
VAT_RATE = "0.05"
DAYS_TO_PAY = 14
MAX_BILLABLE_KWH = 100


def billable(readings: DataFrame, max_kwh: float = MAX_BILLABLE_KWH) -> DataFrame:
    return readings.filter(
        F.col("customer_id").isNotNull()
        & F.col("meter_id").isNotNull()
        & F.col("consumption_kwh").between(0, max_kwh)
    )


def _pounds(value: Column) -> Column:
    return F.round(value, 2).cast("decimal(18,2)")


def _pence(name: str) -> Column:
    """A pence column as pounds, kept exact: narrow decimals multiply without losing digits."""
    return F.col(name).cast("decimal(12,6)") * F.lit("0.01").cast("decimal(3,2)")


def billing_charges(
    readings: DataFrame,
    meters: DataFrame,
    tariffs: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Energy, standing charge and tax per day, customer and tariff, each step in whole pence.

    Readings are summed per meter-day before they meet the meters, and per tariff before they meet the rates; a tariff
    that most customers have is dealt to many tasks there. A meter without a tariff keeps its
    usage with null charges.
    """
    meter_days = (
        billable(readings)
        .groupBy("reading_date", "customer_id", "meter_id", "region")
        .agg(exact_sum("consumption_kwh").alias("kwh"))
    )
    plans = meters.select(
        F.col("meter_id").alias("_meter"),
        F.col("customer_id").alias("_customer"),
        "tariff_id",
        F.col("region").alias("_region"),
    ).distinct()
    rates = tariffs.select(
        "tariff_id",
        "standing_charge_pence_per_day",
        "unit_rate_pence_per_kwh",
    ).distinct()
    planned = meter_days.join(
        plans,
        (F.col("meter_id") == F.col("_meter"))
        & (F.col("customer_id") == F.col("_customer"))
        & F.col("region").eqNullSafe(F.col("_region")),
        "left",
    )
    daily = planned.groupBy("reading_date", "customer_id", "tariff_id", "region").agg(F.sum("kwh").alias("kwh"))
    priced = salted_lookup(daily, rates, "tariff_id", broadcast_rows, hot_rows)

    usage = priced.withColumn("kwh", F.round("kwh", 3).cast("decimal(18,3)"))
    charged = usage.withColumns(
        {
            "energy": _pounds(F.col("kwh") * _pence("unit_rate_pence_per_kwh")),
            "standing": _pounds(_pence("standing_charge_pence_per_day")),
        }
    )
    taxed = charged.withColumn(
        "vat", _pounds((F.col("energy") + F.col("standing")) * F.lit(VAT_RATE).cast("decimal(3,2)"))
    )
    return taxed.select(
        "customer_id",
        "tariff_id",
        "region",
        F.col("reading_date").alias("billing_date"),
        F.col("reading_date").alias("billing_period_start"),
        F.col("reading_date").alias("billing_period_end"),
        F.col("kwh").cast("double").alias("total_consumption_kwh"),
        F.col("standing").cast("double").alias("standing_charge_amount"),
        F.col("energy").cast("double").alias("energy_charge_amount"),
        F.col("vat").cast("double").alias("vat_amount"),
        (F.col("energy") + F.col("standing") + F.col("vat")).cast("double").alias("total_amount"),
        F.date_add("reading_date", DAYS_TO_PAY).alias("due_date"),
    )
