"""Staging models: a surrogate key, the source's columns in their final types, lineage."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions import pence_to_pounds, surrogate_key
from wattline.plans.build import Build

LINEAGE = (
    "source_file_name",
    "source_system",
    "generated_at_utc",
    "_source_file_path",
    "_run_id",
    "_environment",
    "silver_processed_at_utc",
)


@dataclass(frozen=True)
class Pounds:
    """A new column in pounds from one in pence."""

    name: str
    pence: str


@dataclass(frozen=True)
class Staging:
    """Columns of one model: a name, a name with the type it is cast to, or pence that become pounds."""

    source: str
    key: str
    key_name: str
    columns: tuple[str | tuple[str, str] | Pounds, ...]
    lineage: tuple[str, ...] = field(default=LINEAGE)

    def select_list(self, available: list[str]) -> list[Column]:
        chosen = [surrogate_key(self.key).alias(self.key_name)]
        for entry in self.columns:
            if isinstance(entry, Pounds):
                chosen.append(pence_to_pounds(entry.pence).alias(entry.name))
            elif isinstance(entry, tuple):
                name, kind = entry
                chosen.append(F.col(name).try_cast(kind).alias(name))
            else:
                chosen.append(F.col(entry))
        return chosen + [F.col(c) for c in self.lineage if c in available]

    def build(self, clean: DataFrame, run: Build) -> DataFrame:
        return run.stamp(clean.select(*self.select_list(clean.columns)))


# The columns of the staging models and their types.
STAGING: Mapping[str, Staging] = {
    "stg_customers": Staging(
        "customers",
        "customer_id",
        "customer_sk",
        (
            "customer_id", "customer_name", "email", "phone_number", "postcode", "region",
            "customer_segment", "property_type", "account_status", ("registration_date", "date"),
        ),
    ),
    "stg_tariffs": Staging(
        "tariffs",
        "tariff_id",
        "tariff_sk",
        (
            "tariff_id", "tariff_name", ("standing_charge_pence_per_day", "double"),
            Pounds("standing_charge_amount_per_day", "standing_charge_pence_per_day"),
            ("unit_rate_pence_per_kwh", "double"),
            Pounds("unit_rate_amount_per_kwh", "unit_rate_pence_per_kwh"),
            ("green_energy_flag", "boolean"), ("effective_start_date", "date"),
            ("effective_end_date", "date"),
        ),
    ),
    "stg_meters": Staging(
        "meters",
        "meter_id",
        "meter_sk",
        (
            "meter_id", "customer_id", "tariff_id", "region", "meter_type", "meter_status",
            ("installation_date", "date"),
        ),
    ),
    "stg_meter_readings": Staging(
        "meter_readings",
        "reading_id",
        "meter_reading_sk",
        (
            "reading_id", "meter_id", "customer_id", ("reading_timestamp", "timestamp"),
            ("reading_date", "date"), ("consumption_kwh", "double"), ("voltage", "double"),
            "reading_source", "meter_status", "region", ("is_late_arriving", "boolean"),
            ("ingestion_delay_hours", "double"), ("data_quality_issue_injected", "boolean"),
            "firmware_version", ("signal_strength_dbm", "double"), "meter_reading_quality_code",
        ),
    ),
    "stg_weather": Staging(
        "weather",
        "weather_id",
        "weather_sk",
        (
            "weather_id", ("weather_date", "date"), "region", ("avg_temperature_c", "double"),
            ("min_temperature_c", "double"), ("max_temperature_c", "double"),
            ("humidity_percent", "double"), ("wind_speed_mph", "double"), "weather_condition",
            ("heating_degree_days", "double"), ("cooling_degree_days", "double"),
        ),
    ),
    "stg_outage_events": Staging(
        "outage_events",
        "outage_id",
        "outage_sk",
        (
            "outage_id", "region", "outage_type", "severity", ("outage_start_timestamp", "timestamp"),
            ("outage_end_timestamp", "timestamp"), ("duration_minutes", "double"),
            ("affected_customers", "bigint"), ("resolved_flag", "boolean"),
        ),
    ),
    "stg_billing_events": Staging(
        "billing_events",
        "billing_event_id",
        "billing_event_sk",
        (
            "billing_event_id", "customer_id", "tariff_id", "region", ("billing_date", "date"),
            ("billing_period_start", "date"), ("billing_period_end", "date"),
            ("total_consumption_kwh", "double"), ("standing_charge_amount", "double"),
            ("energy_charge_amount", "double"), ("vat_amount", "double"), ("total_amount", "double"),
            "payment_status", "payment_method", ("due_date", "date"), ("paid_at", "date"),
            ("billing_quality_issue_injected", "boolean"),
        ),
    ),
}


def stage(name: str, clean: DataFrame, run: Build) -> DataFrame:
    return STAGING[name].build(clean, run)
