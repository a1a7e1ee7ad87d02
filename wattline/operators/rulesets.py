"""The seven sources: column types, rules and their messages."""

from __future__ import annotations

from wattline.operators.rules import (
    NULL_DROPS,
    Rule,
    RuleSet,
    absent,
    blank,
    duplicate,
    outside,
    unknown,
)

# Accepted words, limits and formats the sources agree on.
ACCOUNT_STATUSES = ("Active", "Suspended", "Closed")
METER_TYPES = ("SMETS1", "SMETS2")
METER_STATUSES = ("Active", "Faulty", "Disconnected")
WEATHER_CONDITIONS = ("Clear", "Cloudy", "Rain", "Heavy Rain", "Snow", "Fog", "Windy")
OUTAGE_SEVERITIES = ("Low", "Medium", "High", "Critical")
OUTAGE_TYPES = (
    "Planned Maintenance",
    "Network Fault",
    "Storm Damage",
    "Equipment Failure",
    "Third Party Damage",
)
PAYMENT_STATUSES = ("Paid", "Pending", "Failed", "Overdue")
PAYMENT_METHODS = ("Direct Debit", "Card", "Bank Transfer", "Prepayment")
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
MAX_READING_KWH = 100
MIN_VOLTAGE, MAX_VOLTAGE = 200, 260
MIN_MEAN_TEMPERATURE, MAX_MEAN_TEMPERATURE = -30, 45
MAX_HUMIDITY = 100
MAX_WIND_MPH = 100
HIGH_BILL_POUNDS = 1000

LOAD_TIMES = {"generated_at_utc": "timestamp", "_ingested_at_utc": "timestamp"}

READINGS = RuleSet(
    source="meter_readings",
    key="reading_id",
    casts={
        "reading_timestamp": "timestamp",
        "reading_date": "date",
        "consumption_kwh": "double",
        "voltage": "double",
        "ingestion_delay_hours": "double",
        "signal_strength_dbm": "double",
        **LOAD_TIMES,
    },
    rules=(
        blank("reading_id"),
        blank("customer_id"),
        blank("meter_id"),
        absent("reading_timestamp", "Missing or invalid reading_timestamp"),
        absent("consumption_kwh", "Missing or invalid consumption_kwh", "is_missing_consumption"),
        Rule("is_negative_consumption", "Negative consumption_kwh", "consumption_kwh < 0"),
        Rule(
            "is_consumption_outlier",
            f"Consumption outlier greater than {MAX_READING_KWH} kWh",
            f"consumption_kwh > {MAX_READING_KWH}",
        ),
        Rule("is_future_timestamp", "Future reading_timestamp", "reading_timestamp > {now}"),
        Rule(
            "is_invalid_voltage",
            f"Voltage outside expected range {MIN_VOLTAGE}-{MAX_VOLTAGE}",
            f"voltage < {MIN_VOLTAGE} or voltage > {MAX_VOLTAGE}",
        ),
        duplicate("reading_id", "is_duplicate_reading"),
    ),
    null_verdict=NULL_DROPS,
    rank="duplicate_rank",
    clean_drops=("duplicate_rank",),
    day="reading_date",
    late_columns={
        "ingestion_delay_hours": "string",
        "firmware_version": "string",
        "signal_strength_dbm": "string",
        "meter_reading_quality_code": "string",
    },
)

CUSTOMERS = RuleSet(
    source="customers",
    key="customer_id",
    casts={"registration_date": "date", **LOAD_TIMES},
    rules=(
        blank("customer_id"),
        blank("customer_name"),
        Rule("is_invalid_email", "Invalid email format", f"not (email rlike r'{EMAIL_PATTERN}')"),
        blank("region"),
        outside("account_status", ACCOUNT_STATUSES),
        absent("registration_date", "Missing or invalid registration_date"),
        duplicate("customer_id"),
    ),
)

TARIFFS = RuleSet(
    source="tariffs",
    key="tariff_id",
    casts={
        "standing_charge_pence_per_day": "double",
        "unit_rate_pence_per_kwh": "double",
        "green_energy_flag": "boolean",
        "effective_start_date": "date",
        "effective_end_date": "date",
        **LOAD_TIMES,
    },
    rules=(
        blank("tariff_id"),
        blank("tariff_name"),
        Rule(
            "is_invalid_standing_charge",
            "Invalid standing charge",
            "coalesce(standing_charge_pence_per_day < 0, true)",
        ),
        Rule("is_invalid_unit_rate", "Invalid unit rate", "coalesce(unit_rate_pence_per_kwh <= 0, true)"),
        absent("effective_start_date"),
        Rule(
            "is_invalid_effective_date_range",
            "effective_end_date earlier than effective_start_date",
            "effective_end_date is not null and effective_end_date < effective_start_date",
        ),
        duplicate("tariff_id"),
    ),
)

METERS = RuleSet(
    source="meters",
    key="meter_id",
    casts={"installation_date": "date", **LOAD_TIMES},
    rules=(
        blank("meter_id"),
        blank("customer_id"),
        blank("tariff_id"),
        unknown("customer_id", "customers_clean"),
        unknown("tariff_id", "tariffs_clean"),
        outside("meter_type", METER_TYPES),
        outside("meter_status", METER_STATUSES),
        absent("installation_date", "Missing or invalid installation_date"),
        duplicate("meter_id"),
    ),
)

WEATHER = RuleSet(
    source="weather",
    key="weather_id",
    casts={
        "weather_date": "date",
        "avg_temperature_c": "double",
        "min_temperature_c": "double",
        "max_temperature_c": "double",
        "humidity_percent": "double",
        "wind_speed_mph": "double",
        "heating_degree_days": "double",
        "cooling_degree_days": "double",
        **LOAD_TIMES,
    },
    rules=(
        blank("weather_id"),
        absent("weather_date"),
        blank("region"),
        Rule(
            "is_invalid_avg_temperature",
            "Average temperature outside expected range",
            "coalesce(avg_temperature_c not between "
            f"{MIN_MEAN_TEMPERATURE} and {MAX_MEAN_TEMPERATURE}, true)",
        ),
        Rule(
            "is_invalid_temperature_range",
            "max_temperature_c lower than min_temperature_c",
            "max_temperature_c < min_temperature_c",
        ),
        Rule(
            "is_invalid_humidity",
            f"Humidity outside expected range 0-{MAX_HUMIDITY}",
            f"coalesce(humidity_percent not between 0 and {MAX_HUMIDITY}, true)",
        ),
        Rule(
            "is_invalid_wind_speed",
            "Wind speed outside expected range",
            f"coalesce(wind_speed_mph not between 0 and {MAX_WIND_MPH}, true)",
        ),
        outside("weather_condition", WEATHER_CONDITIONS),
        duplicate("weather_id"),
    ),
    day="weather_date",
)

OUTAGES = RuleSet(
    source="outage_events",
    key="outage_id",
    casts={
        "outage_start_timestamp": "timestamp",
        "outage_end_timestamp": "timestamp",
        "duration_minutes": "double",
        "affected_customers": "bigint",
        "resolved_flag": "boolean",
        **LOAD_TIMES,
    },
    rules=(
        blank("outage_id"),
        blank("region"),
        outside("outage_type", OUTAGE_TYPES),
        outside("severity", OUTAGE_SEVERITIES),
        absent("outage_start_timestamp", flag="is_missing_start_timestamp"),
        absent("outage_end_timestamp", flag="is_missing_end_timestamp"),
        Rule(
            "is_invalid_timestamp_range",
            "outage_end_timestamp earlier than outage_start_timestamp",
            "coalesce(outage_end_timestamp < outage_start_timestamp, false)",
        ),
        Rule("is_invalid_duration", "Invalid duration_minutes", "coalesce(duration_minutes <= 0, true)"),
        Rule(
            "is_invalid_affected_customers",
            "Invalid affected_customers",
            "coalesce(affected_customers < 0, true)",
        ),
        duplicate("outage_id"),
    ),
)

BILLING = RuleSet(
    source="billing_events",
    key="billing_event_id",
    casts={
        "billing_date": "date",
        "billing_period_start": "date",
        "billing_period_end": "date",
        "due_date": "date",
        "paid_at": "date",
        "total_consumption_kwh": "double",
        "standing_charge_amount": "double",
        "energy_charge_amount": "double",
        "vat_amount": "double",
        "total_amount": "double",
        "billing_quality_issue_injected": "boolean",
        **LOAD_TIMES,
    },
    rules=(
        blank("billing_event_id"),
        blank("customer_id"),
        blank("tariff_id"),
        unknown("customer_id", "customers_clean"),
        unknown("tariff_id", "tariffs_clean"),
        absent("billing_date"),
        Rule(
            "is_invalid_total_consumption",
            "Invalid total_consumption_kwh",
            "coalesce(total_consumption_kwh < 0, true)",
        ),
        absent("total_amount"),
        Rule("is_negative_total_amount", "Negative total_amount", "total_amount < 0"),
        Rule(
            "is_high_total_amount",
            f"High total_amount greater than £{HIGH_BILL_POUNDS}",
            f"total_amount > {HIGH_BILL_POUNDS}",
        ),
        outside("payment_status", PAYMENT_STATUSES),
        outside("payment_method", PAYMENT_METHODS),
        Rule(
            "is_invalid_billing_period",
            "billing_period_end earlier than billing_period_start",
            "coalesce(billing_period_end < billing_period_start, false)",
        ),
        Rule(
            "is_paid_without_paid_at",
            "Paid billing event missing paid_at",
            "payment_status = 'Paid' and paid_at is null",
        ),
        duplicate("billing_event_id"),
    ),
    day="billing_date",
)

RULE_SETS = {r.source: r for r in (CUSTOMERS, TARIFFS, METERS, READINGS, WEATHER, OUTAGES, BILLING)}
