"""The raw sources: where they lie, how they are loaded and where they land."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from wattline.operators.checks import Check, key, not_null
from wattline.sources.csv import read_csv, read_drifting_csv


@dataclass(frozen=True)
class Source:
    name: str
    pattern: str
    load_type: str
    first_column: str
    drifting: bool = False
    multiline: bool = False

    @property
    def landing_table(self) -> str:
        return f"{self.name}_raw"

    @property
    def folder_key(self) -> str | None:
        """The column that names the daily folders, if the source has any."""
        return self.pattern.split("=")[0].split("/")[-1] if "=" in self.pattern else None

    def path(self, base: str) -> str:
        return f"{base.rstrip('/')}/{self.name}/{self.pattern}"

    def read(self, spark: SparkSession, paths: str | list[str], corrupt_column: str | None = None) -> DataFrame:
        """Text rows of the source, with the text of malformed lines in ``corrupt_column`` if it is given.

        A source that grows file by file is read by each file's own header, since a new file may
        name its columns in another order; a full load pays for the look at headers only
        where malformed lines are asked for.
        """
        if self.load_type == "incremental" or corrupt_column:
            return read_drifting_csv(
                spark, paths, self.first_column, self.multiline, self.folder_key, corrupt_column
            )
        return read_csv(spark, paths, multiline=self.multiline, folder_key=self.folder_key)


# The layout of the raw area.
SOURCES = {
    s.name: s
    for s in (
        Source("customers", "*.csv", "full", "customer_id"),
        Source("tariffs", "*.csv", "full", "tariff_id"),
        Source("meters", "*.csv", "full", "meter_id"),
        Source(
            "meter_readings",
            "reading_date=*/meter_readings_*.csv",
            "incremental",
            "reading_id",
            drifting=True,
        ),
        Source("weather", "weather_date=*/weather_*.csv", "incremental", "weather_id"),
        Source(
            "outage_events",
            "outage_start_timestamp=*/outage_events_*.csv",
            "incremental",
            "outage_id",
        ),
        Source("billing_events", "billing_date=*/billing_events_*.csv", "incremental", "billing_event_id"),
    )
}

# What every reader of the validated tables may rely on.
SOURCE_CHECKS: list[Check] = [
    *key("customers_clean", "customer_id"),
    *key("tariffs_clean", "tariff_id"),
    *key("meters_clean", "meter_id"),
    *not_null("meters_clean", "customer_id", "tariff_id"),
    *key("meter_readings_clean", "reading_id"),
    *not_null("meter_readings_clean", "meter_id", "customer_id", "consumption_kwh"),
    *key("weather_clean", "weather_id"),
    *key("outage_events_clean", "outage_id"),
    *key("billing_events_clean", "billing_event_id"),
    *not_null("billing_events_clean", "customer_id", "tariff_id"),
]
