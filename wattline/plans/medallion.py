"""A whole run: raw files to landing, validated and reporting tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from wattline.operators.audit import RunLedger, create_audit_tables
from wattline.operators.checks import table_counts
from wattline.operators.rulesets import RULE_SETS
from wattline.operators.sinks import create_schemas, create_table
from wattline.plans.build import Build
from wattline.plans.gold import build_gold
from wattline.plans.landing import FILE_LOG, FILE_LOG_COLUMNS, land_source
from wattline.plans.validation import validate_new_rows, validate_source
from wattline.sources.registry import SOURCES


@dataclass(frozen=True)
class Layout:
    """Schema names of the four areas."""

    landing: str = "bronze"
    validated: str = "silver"
    reporting: str = "gold"
    audit: str = "audit"


def create_areas(spark: SparkSession, layout: Layout = Layout()) -> None:
    create_schemas(spark, layout.landing, layout.validated, layout.reporting, layout.audit)
    create_audit_tables(spark, layout.audit)
    create_table(spark, f"{layout.audit}.{FILE_LOG}", FILE_LOG_COLUMNS)


def run_landing(
    spark: SparkSession, raw_base: str, run: Build, layout: Layout = Layout(), ledger: RunLedger | None = None
) -> dict[str, int]:
    """Load every source; the first failure is recorded and ends the run. Sources that the ledger has as landed are not in the result."""
    create_areas(spark, layout)
    loaded: dict[str, int] = {}

    def land(name: str) -> None:
        loaded[name] = land_source(spark, SOURCES[name], raw_base, layout.landing, layout.audit, run)

    for name in SOURCES:
        _step(ledger, f"land {name}", land, name)
    return loaded


def run_validation(
    spark: SparkSession,
    run: Build,
    layout: Layout = Layout(),
    load_by_load: bool = False,
    ledger: RunLedger | None = None,
) -> dict[str, dict]:
    """Judge every source. Customers and tariffs come first: others refer to them.

    ``load_by_load`` judges only new rows where a source allows it, instead of all rows.
    """
    create_areas(spark, layout)
    outcome: dict[str, dict] = {}

    def judge(name: str) -> None:
        rules = RULE_SETS[name]
        job = validate_new_rows if load_by_load and rules.day else validate_source
        outcome[name] = job(spark, rules, layout.landing, layout.validated, layout.audit, run)

    for name in RULE_SETS:
        _step(ledger, f"validate {name}", judge, name)
    return outcome


def _step(ledger: RunLedger | None, step: str, job: Callable, *args: object) -> None:
    if ledger is None:
        job(*args)
    else:
        ledger.do(step, job, *args)


def run_all(
    spark: SparkSession,
    raw_base: str,
    run: Build,
    layout: Layout = Layout(),
    first: date = date(2026, 1, 1),
    last: date = date(2026, 12, 31),
    lookback_days: int = 0,
    stop_on_failure: bool = True,
    load_by_load: bool = False,
    resume: bool = False,
) -> DataFrame:
    """Landing, validation, models and checks, in that order.

    Every step is written to a ledger before and after. ``resume`` goes on with a lost run of this id: what it has finished stays.
    """
    create_areas(spark, layout)
    ledger = RunLedger(spark, layout.audit, run.run_id, resume)
    run_landing(spark, raw_base, run, layout, ledger)
    run_validation(spark, run, layout, load_by_load, ledger)
    return build_gold(
        spark, layout.validated, layout.reporting, run, first, last, lookback_days, stop_on_failure, ledger
    )


def landing_counts(spark: SparkSession, layout: Layout = Layout()) -> DataFrame:
    tables = [f"{layout.landing}.{s.landing_table}" for s in SOURCES.values()]
    return table_counts({t: spark.table(t) for t in tables})


def validated_counts(spark: SparkSession, layout: Layout = Layout()) -> DataFrame:
    tables = [f"{layout.validated}.{n}_{part}" for n in RULE_SETS for part in ("clean", "quarantine")]
    return table_counts({t: spark.table(t) for t in tables})
