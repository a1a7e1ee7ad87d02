"""Validated tables to dimensions, histories, facts and reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from wattline.operators.audit import RunLedger
from wattline.operators.checks import check_report, freshness, require_passed
from wattline.operators.incremental import newer_rows
from wattline.operators.scd import HIDDEN_COLUMNS, HISTORIES, apply_snapshot, versioned_dimension
from wattline.operators.sinks import in_partitions, publish
from wattline.plans import dimensions, facts, growth, marts
from wattline.plans.build import Build
from wattline.plans.model_checks import HISTORY_CHECKS, MODEL_CHECKS, STAGING_CHECKS
from wattline.plans.staging import STAGING, stage
from wattline.sources.registry import SOURCE_CHECKS

REGION_SOURCES = (
    "stg_customers",
    "stg_meters",
    "stg_meter_readings",
    "stg_weather",
    "stg_outage_events",
    "stg_billing_events",
)


class Gold:
    """Builds the models of one run in order; each step reads what earlier steps saved."""

    def __init__(self, spark: SparkSession, silver: str, schema: str, run: Build) -> None:
        self.spark, self.silver, self.schema, self.run = spark, silver, schema, run

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.schema}.{name}")

    def staged(self, name: str) -> DataFrame:
        return self.spark.table(name)

    def publish(self, name: str, df: DataFrame) -> None:
        publish(df, f"{self.schema}.{name}", self.run.run_id)

    def build_staging(self) -> None:
        """Staging models are views: nothing is stored."""
        for name, model in STAGING.items():
            clean = self.spark.table(f"{self.silver}.{model.source}_clean")
            stage(name, clean, self.run).createOrReplaceTempView(name)

    def build_dimensions(self, first: date, last: date) -> None:
        run = self.run
        self.publish("dim_customers", dimensions.dim_customers(self.staged("stg_customers"), run))
        self.publish("dim_tariffs", dimensions.dim_tariffs(self.staged("stg_tariffs"), run))
        customers, tariffs = self.table("dim_customers"), self.table("dim_tariffs")
        self.publish(
            "dim_meters", dimensions.dim_meters(self.staged("stg_meters"), customers, tariffs, run)
        )
        self.publish("dim_regions", dimensions.dim_regions([self.staged(n) for n in REGION_SOURCES], run))
        self.publish("dim_date", dimensions.dim_date(self.spark, run, first, last))

    def build_histories(self) -> None:
        """Compare the dimensions of this run with the open versions of the last."""
        for subject, history in HISTORIES.items():
            snapshot = f"snap_{subject}"
            known = self.spark.catalog.tableExists(f"{self.schema}.{snapshot}")
            before = self.table(snapshot) if known else None
            now = self.table(f"dim_{subject}")
            self.publish(snapshot, apply_snapshot(before, now, history, self.run.as_of))
            shown = versioned_dimension(self.table(snapshot), history, HIDDEN_COLUMNS)
            self.publish(f"dim_{subject}_scd", self.run.stamp(shown))

    def build_facts(self) -> None:
        dims = {f"dim_{n}": self.table(f"dim_{n}") for n in ("regions", "date", "meters", "customers", "tariffs")}
        place = dims["dim_regions"], dims["dim_date"], self.run
        meters, owners = (dims["dim_meters"],), (dims["dim_customers"], dims["dim_tariffs"])
        shapes = (
            (growth.READINGS, "stg_meter_readings", lambda rows: facts.fact_meter_readings(rows, *meters, *place)),
            (growth.BILLING, "stg_billing_events", lambda rows: facts.fact_billing_events(rows, *owners, *place)),
            (growth.OUTAGES, "stg_outage_events", lambda rows: facts.fact_outage_events(rows, *place)),
        )
        for fact, staged, shape in shapes:
            fresh = newer_rows(self.staged(staged), self._saved(fact.name), "silver_processed_at_utc")
            growth.grow_fact(self.spark, self.schema, fact, fresh, shape, dims, self.run)
        self._build_weather(*place)

    def _saved(self, name: str) -> DataFrame | None:
        table = f"{self.schema}.{name}"
        return self.spark.table(table) if self.spark.catalog.tableExists(table) else None

    def _build_weather(self, regions: DataFrame, dates: DataFrame, run: Build) -> None:
        staged = self.staged("stg_weather")
        fresh = newer_rows(staged, self._saved("fact_weather_daily"), "silver_processed_at_utc")
        days = {row[0] for row in fresh.select("weather_date").distinct().collect()}
        growth.log_changes(self.spark, self.schema, "fact_weather_daily", days, run)
        self.publish("fact_weather_daily", facts.fact_weather_daily(staged, regions, dates, run))

    def build_marts(self, lookback_days: int = 0) -> None:
        """The daily report for the days that changed (and the last ``lookback_days``), the customers' report whole."""
        report, sources = "mart_daily_energy_summary", (growth.READINGS.name, growth.BILLING.name, "fact_weather_daily")
        readings, billing, weather = (self.table(name) for name in sources)
        days, runs = growth.days_to_build(self.spark, self.schema, report, sources)
        if lookback_days:
            recent = newer_rows(readings, self._saved(report), "reading_date", lookback_days)
            days |= {row[0] for row in recent.select("reading_date").distinct().collect()}
        summary = marts.daily_energy_summary(
            *(t.filter(in_partitions(day, days)) for t, day in ((readings, "reading_date"), (weather, "weather_date"), (billing, "billing_date")))
        )
        growth.rebuild_days(self.spark, self.schema, report, "reading_date", days, runs, self.run.stamp(summary))
        customers = marts.customer_energy_summary(self.table("dim_customers"), readings, billing)
        self.publish("mart_customer_energy_summary", self.run.stamp(customers))

    def check(self) -> DataFrame:
        """The report over all declared checks of this run's tables."""
        wanted = [*SOURCE_CHECKS, *STAGING_CHECKS, *MODEL_CHECKS, *HISTORY_CHECKS]
        names = dict.fromkeys(name for c in wanted for name in (c.table, c.parent) if name)
        return check_report({n: self._named(n) for n in names}, wanted)

    def _named(self, name: str) -> DataFrame:
        if name.endswith("_clean"):
            return self.spark.table(f"{self.silver}.{name}")
        return self.staged(name) if name.startswith("stg_") else self.table(name)

    def freshness(self) -> DataFrame:
        """Age of every validated source at the time of this run."""
        tables = {m.source: self._named(f"{m.source}_clean") for m in STAGING.values()}
        return freshness(tables, "silver_processed_at_utc", self.run.as_of)


def build_gold(
    spark: SparkSession,
    silver: str,
    schema: str,
    run: Build,
    first: date,
    last: date,
    lookback_days: int = 0,
    stop_on_failure: bool = True,
    ledger: RunLedger | None = None,
) -> DataFrame:
    """All models in dependency order, then their checks. A ledger keeps steps that this run has finished from being repeated."""
    gold = Gold(spark, silver, schema, run)
    gold.build_staging()
    steps = (
        ("dimensions", gold.build_dimensions, first, last),
        ("histories", gold.build_histories),
        ("facts", gold.build_facts),
        ("reports", gold.build_marts, lookback_days),
    )
    for name, job, *args in steps:
        if ledger is None:
            job(*args)
        else:
            ledger.do(name, job, *args)
    report = gold.check()
    if stop_on_failure:
        require_passed(report)
    return report
