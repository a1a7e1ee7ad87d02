"""Calendar rows and weather-demand measures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Base temperatures in Celsius.
HEATING_BASE_C = 15.5
COOLING_BASE_C = 22.0


def degree_days(avg_temperature: Column) -> dict[str, Column]:
    """Heating and cooling demand of a day, from its mean temperature."""
    heating = F.greatest(F.lit(0.0), F.lit(HEATING_BASE_C) - avg_temperature)
    cooling = F.greatest(F.lit(0.0), avg_temperature - F.lit(COOLING_BASE_C))
    known = avg_temperature.isNotNull()
    return {
        "heating_degree_days": F.when(known, F.round(heating.cast("decimal(18,6)"), 2).cast("double")),
        "cooling_degree_days": F.when(known, F.round(cooling.cast("decimal(18,6)"), 2).cast("double")),
    }


def date_spine(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day, both ends included."""
    days = (last - first).days
    return spark.range(0, days + 1, numPartitions=1).select(
        F.date_add(F.lit(first), F.col("id").cast("int")).alias("date_day")
    )


def calendar_columns(day: str = "date_day") -> list[Column]:
    """The columns of the date dimension, all derived from one date column."""
    d = F.col(day)
    return [
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_sk"),
        d.alias("date_day"),
        F.year(d).alias("year_number"),
        F.quarter(d).alias("quarter_number"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "E").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        F.trunc(d, "month").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
    ]
