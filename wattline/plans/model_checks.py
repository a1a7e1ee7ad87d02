"""The checks declared on staging models, dimensions, facts, marts and histories."""

from __future__ import annotations

from wattline.operators.checks import Check, accepted, between, key, not_null, positive, refers
from wattline.operators.rulesets import (
    ACCOUNT_STATUSES,
    MAX_HUMIDITY,
    MAX_VOLTAGE,
    METER_STATUSES,
    METER_TYPES,
    MIN_VOLTAGE,
    OUTAGE_SEVERITIES,
    PAYMENT_METHODS,
    PAYMENT_STATUSES,
    WEATHER_CONDITIONS,
)

# Which columns of which tables are checked, and how.
STAGING_CHECKS: list[Check] = [
    *key("stg_customers", "customer_sk", "customer_id"),
    *accepted("stg_customers", "account_status", ACCOUNT_STATUSES),
    *key("stg_tariffs", "tariff_sk", "tariff_id"),
    *positive("stg_tariffs", "standing_charge_pence_per_day", "unit_rate_pence_per_kwh"),
    *key("stg_meters", "meter_sk", "meter_id"),
    *refers("stg_meters", "customer_id", "stg_customers"),
    *refers("stg_meters", "tariff_id", "stg_tariffs"),
    *accepted("stg_meters", "meter_type", METER_TYPES),
    *accepted("stg_meters", "meter_status", METER_STATUSES),
    *key("stg_meter_readings", "meter_reading_sk", "reading_id"),
    *refers("stg_meter_readings", "meter_id", "stg_meters"),
    *refers("stg_meter_readings", "customer_id", "stg_customers"),
    *not_null("stg_meter_readings", "consumption_kwh"),
    *positive("stg_meter_readings", "consumption_kwh"),
    *between("stg_meter_readings", "voltage", MIN_VOLTAGE, MAX_VOLTAGE),
    *key("stg_weather", "weather_sk", "weather_id"),
    *between("stg_weather", "humidity_percent", 0, MAX_HUMIDITY),
    *accepted("stg_weather", "weather_condition", WEATHER_CONDITIONS),
    *key("stg_outage_events", "outage_sk", "outage_id"),
    *accepted("stg_outage_events", "severity", OUTAGE_SEVERITIES),
    *positive("stg_outage_events", "duration_minutes"),
    *key("stg_billing_events", "billing_event_sk", "billing_event_id"),
    *refers("stg_billing_events", "customer_id", "stg_customers"),
    *refers("stg_billing_events", "tariff_id", "stg_tariffs"),
    *not_null("stg_billing_events", "total_amount"),
    *positive("stg_billing_events", "total_amount"),
    *accepted("stg_billing_events", "payment_status", PAYMENT_STATUSES),
    *accepted("stg_billing_events", "payment_method", PAYMENT_METHODS),
]

MODEL_CHECKS: list[Check] = [
    *key("dim_customers", "customer_sk", "customer_id"),
    *accepted("dim_customers", "account_status", ACCOUNT_STATUSES),
    *key("dim_tariffs", "tariff_sk", "tariff_id"),
    *positive("dim_tariffs", "unit_rate_amount_per_kwh"),
    *key("dim_meters", "meter_sk", "meter_id"),
    *refers("dim_meters", "customer_sk", "dim_customers"),
    *refers("dim_meters", "tariff_sk", "dim_tariffs"),
    *key("dim_regions", "region_sk", "region"),
    *key("dim_date", "date_sk", "date_day"),
    *key("fact_meter_readings", "meter_reading_sk"),
    *refers("fact_meter_readings", "meter_sk", "dim_meters"),
    *refers("fact_meter_readings", "customer_sk", "dim_customers"),
    *not_null("fact_meter_readings", "consumption_kwh"),
    *positive("fact_meter_readings", "consumption_kwh"),
    *between("fact_meter_readings", "voltage", MIN_VOLTAGE, MAX_VOLTAGE),
    *key("fact_billing_events", "billing_event_sk"),
    *refers("fact_billing_events", "customer_sk", "dim_customers"),
    *refers("fact_billing_events", "tariff_sk", "dim_tariffs"),
    *not_null("fact_billing_events", "total_amount"),
    *positive("fact_billing_events", "total_amount"),
    *key("fact_weather_daily", "weather_sk"),
    *refers("fact_weather_daily", "region_sk", "dim_regions"),
    *key("fact_outage_events", "outage_sk"),
    *positive("fact_outage_events", "duration_minutes"),
    *key("mart_daily_energy_summary", "daily_energy_summary_sk"),
    *not_null("mart_daily_energy_summary", "reading_date", "region"),
    *positive("mart_daily_energy_summary", "total_consumption_kwh"),
    *key("mart_customer_energy_summary", "customer_sk", "customer_id"),
    *positive("mart_customer_energy_summary", "total_consumption_kwh", "total_billed_amount"),
]

HISTORY_CHECKS: list[Check] = [
    check
    for subject in ("customer", "tariff", "meter")
    for check in (
        *key(f"dim_{subject}s_scd", f"{subject}_version_sk"),
        *not_null(f"dim_{subject}s_scd", f"{subject}_id", "valid_from_timestamp", "is_current_record"),
    )
]
