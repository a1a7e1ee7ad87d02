"""Reporting tables.

Readings outnumber everything else, so they are summed per meter first. Distinct counts
then run over meter-days instead of raw readings, and a busy region or customer reaches
the second shuffle already reduced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions import exact, exact_avg, exact_sum, rounded, surrogate_key

# Limits and words used in the reports.
HIGH_USE_KWH = 1000
UNPAID_STATUSES = ("Pending", "Overdue", "Failed")


def usage_per_meter(readings: DataFrame, by: list[str]) -> DataFrame:
    """Additive measures per group, meter and customer; partial sums leave each task."""
    return readings.groupBy(*dict.fromkeys([*by, "meter_id", "customer_id"])).agg(
        F.count(F.lit(1)).alias("readings"),
        F.count("consumption_kwh").alias("kwh_count"),
        exact_sum("consumption_kwh").alias("kwh"),
        F.max("consumption_kwh").alias("max_kwh"),
        F.count("voltage").alias("voltage_count"),
        exact_sum("voltage").alias("voltage"),
        F.count_if("is_late_arriving").alias("late"),
        F.min("reading_date").alias("first_date"),
        F.max("reading_date").alias("last_date"),
    )


def daily_usage(readings: DataFrame) -> DataFrame:
    per_meter = usage_per_meter(readings, ["reading_date", "region"])
    return usage_from_meter_days(per_meter)


def usage_from_meter_days(per_meter: DataFrame) -> DataFrame:
    summed = per_meter.groupBy("reading_date", "region").agg(
        F.sum("readings").alias("reading_count"),
        F.countDistinct("meter_id").alias("active_meter_count"),
        F.countDistinct("customer_id").alias("active_customer_count"),
        F.sum("kwh").alias("kwh"),
        F.sum("kwh_count").alias("kwh_count"),
        F.max("max_kwh").alias("max_kwh"),
        F.sum("voltage").alias("voltage"),
        F.sum("voltage_count").alias("voltage_count"),
        F.sum("late").alias("late_arriving_reading_count"),
    )
    return summed.select(
        "reading_date",
        "region",
        "reading_count",
        "active_meter_count",
        "active_customer_count",
        rounded("kwh", 3).alias("total_consumption_kwh"),
        rounded(exact_avg("kwh", "kwh_count"), 3).alias("avg_consumption_kwh"),
        rounded("max_kwh", 3).alias("max_half_hour_consumption_kwh"),
        rounded(exact_avg("voltage", "voltage_count"), 2).alias("avg_voltage"),
        "late_arriving_reading_count",
    )


def daily_billing(billing: DataFrame) -> DataFrame:
    """Billed totals per day and region. Events are combined per id before they are counted."""
    per_event = billing.groupBy("billing_date", "region", "billing_event_id").agg(
        exact_sum("total_amount").alias("amount"),
        exact_sum("total_consumption_kwh").alias("kwh"),
    )
    return per_event.groupBy("billing_date", "region").agg(
        F.sum("amount").cast("double").alias("total_revenue_amount"),
        F.sum("kwh").cast("double").alias("billed_consumption_kwh"),
        F.count("billing_event_id").alias("billing_event_count"),
    )


def daily_energy_summary(readings: DataFrame, weather: DataFrame, billing: DataFrame) -> DataFrame:
    """Usage per day and region with its weather and billed totals.

    All sides are reduced to days and regions before they meet. A second weather row for
    one day and region gives a second summary row.
    """
    usage = daily_usage(readings)
    conditions = weather.select(
        F.col("weather_date").alias("reading_date"),
        "region",
        "avg_temperature_c",
        "weather_condition",
        "heating_degree_days",
        "cooling_degree_days",
    )
    billed = daily_billing(billing).withColumnRenamed("billing_date", "reading_date")
    joined = usage.join(conditions, ["reading_date", "region"], "left").join(
        billed, ["reading_date", "region"], "left"
    )
    return joined.select(
        surrogate_key("reading_date", "region").alias("daily_energy_summary_sk"),
        *usage.columns,
        "avg_temperature_c",
        "weather_condition",
        "heating_degree_days",
        "cooling_degree_days",
        F.coalesce("total_revenue_amount", F.lit(0.0)).alias("total_revenue_amount"),
        F.coalesce("billed_consumption_kwh", F.lit(0.0)).alias("billed_consumption_kwh"),
        F.coalesce("billing_event_count", F.lit(0)).alias("billing_event_count"),
    )


def customer_billing(billing: DataFrame) -> DataFrame:
    """Billed, paid and open amounts per customer."""
    amount = exact("total_amount")
    zero = exact(F.lit(0))
    per_event = billing.groupBy("customer_id", "billing_event_id").agg(
        F.sum(amount).alias("billed"),
        exact_sum("total_consumption_kwh").alias("kwh"),
        F.sum(F.when(F.col("payment_status") == "Paid", amount).otherwise(zero)).alias("paid"),
        F.sum(F.when(F.col("payment_status").isin(*UNPAID_STATUSES), amount).otherwise(zero)).alias("open"),
    )
    return per_event.groupBy("customer_id").agg(
        F.sum("billed").cast("double").alias("total_billed_amount"),
        F.sum("kwh").cast("double").alias("total_billed_consumption_kwh"),
        F.count("billing_event_id").alias("billing_event_count"),
        F.sum("paid").cast("double").alias("paid_amount"),
        F.sum("open").cast("double").alias("unpaid_or_problem_amount"),
    )


def customer_usage(readings: DataFrame) -> DataFrame:
    return (
        usage_per_meter(readings, ["customer_id"])
        .groupBy("customer_id")
        .agg(
            F.count("meter_id").alias("meter_count"),
            F.sum("readings").alias("readings"),
            F.sum("kwh").alias("kwh"),
            F.sum("kwh_count").alias("kwh_count"),
            F.max("max_kwh").alias("max_kwh"),
            F.min("first_date").alias("first_reading_date"),
            F.max("last_date").alias("latest_reading_date"),
        )
    )


def customer_energy_summary(customers: DataFrame, readings: DataFrame, billing: DataFrame) -> DataFrame:
    """One row per customer, including those without readings or bills.

    Readings and bills are reduced to one row per customer before the join. A customer
    without readings counts one (empty) reading, as a row count after a left join does.
    """
    usage = customer_usage(readings.filter(F.col("customer_id").isNotNull()))
    billed = customer_billing(billing.filter(F.col("customer_id").isNotNull()))
    joined = customers.join(usage, "customer_id", "left").join(billed, "customer_id", "left")

    def or_zero(name: str):
        return F.coalesce(F.col(name), F.lit(0)).alias(name)

    return joined.select(
        "customer_sk",
        "customer_id",
        "customer_name",
        "region",
        "customer_segment",
        "property_type",
        "account_status",
        or_zero("meter_count"),
        F.coalesce("readings", F.lit(1)).alias("reading_count"),
        rounded("kwh", 3).alias("total_consumption_kwh"),
        rounded(exact_avg("kwh", "kwh_count"), 3).alias("avg_half_hour_consumption_kwh"),
        rounded("max_kwh", 3).alias("max_half_hour_consumption_kwh"),
        "first_reading_date",
        "latest_reading_date",
        or_zero("total_billed_amount"),
        or_zero("total_billed_consumption_kwh"),
        or_zero("billing_event_count"),
        or_zero("paid_amount"),
        or_zero("unpaid_or_problem_amount"),
        F.coalesce(F.col("kwh") > HIGH_USE_KWH, F.lit(False)).alias("is_high_consumption_customer"),
    )


def late_arrivals(readings: DataFrame) -> DataFrame:
    """Late readings and their mean delay per day and region."""
    late = F.coalesce(F.col("is_late_arriving"), F.lit(False))
    counted = readings.groupBy("reading_date", "region").agg(
        F.count(F.lit(1)).alias("reading_count"),
        F.count_if(late).alias("late_arriving_reading_count"),
        F.count(F.when(late, F.col("ingestion_delay_hours"))).alias("delays"),
        F.sum(F.when(late, exact("ingestion_delay_hours"))).alias("delay"),
    )
    return counted.select(
        "reading_date",
        "region",
        "reading_count",
        "late_arriving_reading_count",
        rounded(exact_avg("delay", "delays"), 2).alias("avg_delay_hours"),
    )
