"""Version history of dimension rows (type 2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.functions import surrogate_key

VALIDITY = ("dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


@dataclass(frozen=True)
class History:
    """Which columns identify a row and which open a new version when they change."""

    key: str
    checked: tuple[str, ...]
    columns: tuple[str, ...]
    version_key: str


def open_versions(current: DataFrame, history: History, run_time: datetime) -> DataFrame:
    at = F.lit(run_time).cast("timestamp")
    return current.select(*history.columns).withColumns(
        {
            "dbt_scd_id": surrogate_key(F.col(history.key), at),
            "dbt_updated_at": at,
            "dbt_valid_from": at,
            "dbt_valid_to": F.lit(None).cast("timestamp"),
        }
    )


def changed_versions(
    open_rows: DataFrame, current: DataFrame, history: History, run_time: datetime
) -> DataFrame:
    """The open versions after a run, together with the versions this run closed.

    One full join on the key decides every case: a new key opens a version, a changed
    checked column closes the old version and opens another, an unchanged row and a key
    that vanished stay as they are. Both sides have one row per key.
    """
    names = [*history.columns, *VALIDITY]
    before = open_rows.select(
        F.col(history.key).alias("_before_key"), F.struct(*[F.col(c) for c in names]).alias("before")
    )
    fresh = open_versions(current, history, run_time)
    after = fresh.select(
        F.col(history.key).alias("_after_key"), F.struct(*[F.col(c) for c in names]).alias("after")
    )
    joined = before.join(after, F.col("_before_key") == F.col("_after_key"), "full")

    same = reduce(
        lambda a, b: a & b,
        [F.col(f"before.{c}").eqNullSafe(F.col(f"after.{c}")) for c in history.checked],
    )
    replaced = F.col("before").isNotNull() & F.col("after").isNotNull() & ~same
    at = F.lit(run_time).cast("timestamp")
    closed = F.col("before").withField("dbt_valid_to", at).withField("dbt_updated_at", at)
    old = F.when(replaced, closed).otherwise(F.col("before"))
    new = F.when(F.col("before").isNull() | replaced, F.col("after"))
    versions = joined.select(F.explode(F.filter(F.array(old, new), lambda v: v.isNotNull())).alias("v"))
    return versions.select("v.*")


def apply_snapshot(
    versions: DataFrame | None, current: DataFrame, history: History, run_time: datetime
) -> DataFrame:
    """The whole history after a run. Closed versions pass through without being compared."""
    if versions is None:
        return open_versions(current, history, run_time)
    closed = versions.filter(F.col("dbt_valid_to").isNotNull())
    open_rows = versions.filter(F.col("dbt_valid_to").isNull())
    return closed.unionByName(changed_versions(open_rows, current, history, run_time))


def versioned_dimension(versions: DataFrame, history: History, dropped: Sequence[str] = ()) -> DataFrame:
    """History in its public form: a version key, validity bounds and a current flag."""
    shown = [c for c in history.columns if c not in dropped]
    return versions.select(
        F.col("dbt_scd_id").alias(history.version_key),
        *shown,
        F.col("dbt_valid_from").alias("valid_from_timestamp"),
        F.col("dbt_valid_to").alias("valid_to_timestamp"),
        F.col("dbt_valid_to").isNull().alias("is_current_record"),
    )


# The columns of each history, and those whose change opens a version.
CUSTOMER_HISTORY = History(
    key="customer_id",
    checked=(
        "customer_name",
        "email",
        "phone_number",
        "postcode",
        "region",
        "customer_segment",
        "property_type",
        "account_status",
    ),
    columns=(
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
        "is_active_customer",
        "silver_processed_at_utc",
    ),
    version_key="customer_version_sk",
)
METER_HISTORY = History(
    key="meter_id",
    checked=(
        "customer_id",
        "tariff_id",
        "region",
        "meter_type",
        "meter_status",
        "installation_date",
        "is_active_meter",
    ),
    columns=(
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
        "is_active_meter",
        "silver_processed_at_utc",
    ),
    version_key="meter_version_sk",
)
TARIFF_HISTORY = History(
    key="tariff_id",
    checked=(
        "tariff_name",
        "standing_charge_pence_per_day",
        "standing_charge_amount_per_day",
        "unit_rate_pence_per_kwh",
        "unit_rate_amount_per_kwh",
        "green_energy_flag",
        "effective_start_date",
        "effective_end_date",
        "is_current_tariff",
    ),
    columns=(
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
        "is_current_tariff",
    ),
    version_key="tariff_version_sk",
)
HISTORIES: Mapping[str, History] = {
    "customers": CUSTOMER_HISTORY,
    "meters": METER_HISTORY,
    "tariffs": TARIFF_HISTORY,
}
# Kept in the history but not shown in the versioned dimension.
HIDDEN_COLUMNS = ("silver_processed_at_utc",)
