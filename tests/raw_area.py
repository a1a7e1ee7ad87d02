"""A small raw area on disk: seven sources as CSV files with one fault of each kind."""

from __future__ import annotations

import csv
from pathlib import Path

STAMP = "2026-01-07 23:00:00"
META = ["source_file_name", "source_system", "generated_at_utc"]

CUSTOMERS = [
    "customer_id customer_name email phone_number postcode region customer_segment property_type "
    "account_status registration_date".split(),
    ["C1", "Ann", "ann@example.com", "1", "A1", "London", "Residential", "Flat", "Active", "2024-01-01"],
    ["C2", " Bo ", "bo@example.org", "2", "B2", "North West", "Commercial", "Office", "Closed", "2024-02-01"],
    ["C3", "Cy", "not an address", "3", "C3", "London", "Residential", "Flat", "Active", "2024-03-01"],
    ["C4", "Di", "di@example.com", "4", "D4", "South East", "Residential", "Flat", "Active", "2024-04-01"],
]
TARIFFS = [
    "tariff_id tariff_name standing_charge_pence_per_day unit_rate_pence_per_kwh green_energy_flag "
    "effective_start_date effective_end_date".split(),
    ["T1", "Standard", "53.20", "28.50", "False", "2025-01-01", ""],
    ["T2", "Green", "49.80", "30.20", "True", "2025-01-01", "2025-12-31"],
    ["T3", "Broken", "-1", "30.20", "True", "2025-01-01", ""],
]
METERS = [
    "meter_id customer_id tariff_id region meter_type meter_status installation_date".split(),
    ["M1", "C1", "T1", "London", "SMETS1", "Active", "2024-05-01"],
    ["M2", "C2", "T2", "North West", "SMETS2", "Faulty", "2024-06-01"],
    ["M3", "C9", "T1", "London", "SMETS2", "Active", "2024-06-01"],
]
READING_COLUMNS = (
    "reading_id meter_id customer_id reading_timestamp reading_date consumption_kwh voltage reading_source "
    "meter_status region is_late_arriving data_quality_issue_injected"
).split()
DRIFTED = READING_COLUMNS[:8] + ["firmware_version"] + READING_COLUMNS[8:] + ["signal_strength_dbm"]


def reading(number, meter, customer, day, kwh, voltage="230.0", hour=10, late="False"):
    at = f"2026-01-{day:02d} {hour:02d}:00:00"
    region = {"M1": "London", "M2": "North West"}.get(meter, "London")
    return [
        f"R{number}", meter, customer, at, at[:10], kwh, voltage, "smart_meter", "Active", region, late, "False",
    ]


def drifted(row, firmware, signal):
    return row[:8] + [firmware] + row[8:] + [signal]


READINGS = {
    "2026-01-01": [
        READING_COLUMNS,
        reading(1, "M1", "C1", 1, "0.5"),
        reading(2, "M1", "C1", 1, "1.25", hour=11),
        reading(3, "M2", "C2", 1, "2.0", late="True"),
        reading(4, "M1", "", 1, "0.4"),
        reading(5, "M1", "C1", 1, "-3"),
        reading(6, "M1", "C1", 1, "0.7", voltage=""),
    ],
    "2026-01-04": [
        DRIFTED,
        drifted(reading(7, "M1", "C1", 4, "0.25"), "FW_1", "-70.5"),
        drifted(reading(7, "M1", "C1", 4, "0.25"), "FW_1", "-70.5"),
        drifted(reading(8, "M2", "C2", 4, "150"), "FW_2", "-60"),
        drifted(reading(9, "M2", "C2", 4, "4.5"), "FW_2", "-61"),
    ],
}
WEATHER_COLUMNS = (
    "weather_id weather_date region avg_temperature_c min_temperature_c max_temperature_c humidity_percent "
    "wind_speed_mph weather_condition heating_degree_days cooling_degree_days"
).split()
WEATHER = {
    "2026-01-01": [
        WEATHER_COLUMNS,
        ["W1", "2026-01-01", "London", "5.5", "2", "9", "80", "10", "Rain", "10.0", "0.0"],
        ["W2", "2026-01-01", "North West", "4.5", "1", "8", "180", "10", "Rain", "11.0", "0.0"],
    ]
}
OUTAGE_COLUMNS = (
    "outage_id region outage_type severity outage_start_timestamp outage_end_timestamp duration_minutes "
    "affected_customers resolved_flag"
).split()
OUTAGES = {
    "2026-01-01": [
        OUTAGE_COLUMNS,
        ["O1", "London", "Storm Damage", "High", "2026-01-01", "2026-01-01 02:00:00", "120", "900", "True"],
        ["O2", "London", "Meteor", "High", "2026-01-01", "2026-01-01 02:00:00", "120", "900", "True"],
    ]
}
BILLING_COLUMNS = (
    "billing_event_id customer_id tariff_id region billing_date billing_period_start billing_period_end "
    "total_consumption_kwh standing_charge_amount energy_charge_amount vat_amount total_amount payment_status "
    "payment_method due_date paid_at billing_quality_issue_injected"
).split()


def bill(number, customer, tariff, region, day, amount, status="Paid", paid="2026-01-05"):
    date = f"2026-01-{day:02d}"
    return [
        f"B{number}", customer, tariff, region, date, date, date, "1.75", "0.53", "0.5", "0.05", amount, status,
        "Card", "2026-01-15", paid, "False",
    ]


BILLING = {
    "2026-01-01": [
        BILLING_COLUMNS,
        bill(1, "C1", "T1", "London", 1, "1.08"),
        bill(2, "C2", "T2", "North West", 1, "2.50", "Pending", ""),
        bill(3, "C2", "", "North West", 1, "2.50"),
        bill(4, "C9", "T1", "London", 1, "2.50"),
    ]
}


def write_file(path: Path, table: list[list[str]]) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    header, *body = table
    with path.open("w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow([*header, *META])
        writer.writerows([*row, path.name, "meter_feed", STAMP] for row in body)


def write_daily(base: Path, source: str, folder: str, days: dict) -> None:
    for day, table in days.items():
        name = f"{source}_{day.replace('-', '')}.csv"
        write_file(base / source / f"{folder}={day}" / name, table)


def write_raw_area(base: Path) -> None:
    write_file(base / "customers" / "customers_20260101.csv", CUSTOMERS)
    write_file(base / "tariffs" / "tariffs_20260101.csv", TARIFFS)
    write_file(base / "meters" / "meters_20260101.csv", METERS)
    write_daily(base, "meter_readings", "reading_date", READINGS)
    write_daily(base, "weather", "weather_date", WEATHER)
    write_daily(base, "outage_events", "outage_start_timestamp", OUTAGES)
    write_daily(base, "billing_events", "billing_date", BILLING)
