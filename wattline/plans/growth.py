"""Facts and reports that grow: late dimension keys are filled in, and reports follow the days that changed.

A fact row whose look-up finds nothing keeps a null key. Its look-up value and its day are remembered in a small table of pending keys; when a
later run finds the value in the dimension, only the days that wait for it are read and their waiting rows are looked up
again. Every upsert tells which days it changed; the days are logged before anything depends on them, so a report that
is built after a lost run still takes them up.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.functions import LOAD_AUDIT
from wattline.operators.sinks import (
    create_table,
    in_partitions,
    overwrite_partitions,
    remove_folder,
    replace_partitions,
    save_table,
    written,
)
from wattline.plans.build import Build
from wattline.session import shared_folder

CHANGED_DAYS = "source string, day date, run_id string"
BUILT = "report string, run_id string"


@dataclass(frozen=True)
class Lookup:
    """A fact column that is looked up by, the dimension and its key, and the columns that the dimension gives."""

    column: str
    dimension: str
    key: str
    gives: tuple[str, ...]


@dataclass(frozen=True)
class GrowingFact:
    name: str
    key: str
    day: str
    lookups: tuple[Lookup, ...]

    @property
    def filled(self) -> list[str]:
        return [c for look in self.lookups for c in look.gives]


_PLACE = (Lookup("region", "dim_regions", "region", ("region_sk",)),)


def _dated(day: str) -> tuple[Lookup, ...]:
    return (*_PLACE, Lookup(day, "dim_date", "date_day", ("date_sk",)))


READINGS = GrowingFact(
    "fact_meter_readings",
    "meter_reading_sk",
    "reading_date",
    (Lookup("meter_id", "dim_meters", "meter_id", ("meter_sk", "customer_sk", "tariff_sk")), *_dated("reading_date")),
)
BILLING = GrowingFact(
    "fact_billing_events",
    "billing_event_sk",
    "billing_date",
    (
        Lookup("customer_id", "dim_customers", "customer_id", ("customer_sk",)),
        Lookup("tariff_id", "dim_tariffs", "tariff_id", ("tariff_sk",)),
        *_dated("billing_date"),
    ),
)
OUTAGES = GrowingFact("fact_outage_events", "outage_sk", "outage_date", _dated("outage_date"))


def grow_fact(
    spark: SparkSession,
    schema: str,
    fact: GrowingFact,
    fresh: DataFrame,
    shape: Callable[[DataFrame], DataFrame],
    dimensions: Mapping[str, DataFrame],
    run: Build,
) -> set:
    """Upsert the fresh rows, fill in keys that have arrived since, and return the days that changed.

    ``shape`` turns staged rows into fact rows; it is used on saved fact rows as well, whose looked-up columns are taken
    off first. Only days with a resolved key are read for that and rewritten. The pending table has one row per value and day.
    What earlier runs wait for is resolved once; the fresh rows have just been looked up in the same dimensions.
    """
    table = f"{schema}.{fact.name}"
    folder = shared_folder(spark, "due")
    try:
        due = None
        if spark.catalog.tableExists(_pending_table(schema, fact)):
            due = written(resolved_keys(spark, schema, fact, dimensions), folder)
        changed = replace_partitions(spark, table, shape(fresh), fact.key, fact.day)
        found = [] if due is None else due.select("lookup", "day").distinct().collect()
        days = {row.day for row in found}
        if days:
            looks = [look for look in fact.lookups if look.column in {row.lookup for row in found}]
            repaired = _repaired(spark.table(table).filter(in_partitions(fact.day, days)), looks, fact.day, due)
            repaired = shape(repaired.drop(*fact.filled, *LOAD_AUDIT))
            filled = replace_partitions(spark, table, repaired, fact.key, fact.day, among=_lacking(looks))
        else:
            filled = set()
        _note_pending(spark, schema, fact, changed | days)
    finally:
        remove_folder(spark, folder)
    log_changes(spark, schema, fact.name, changed | filled, run)
    return changed | filled


def _lacking(looks: Sequence[Lookup]) -> Column:
    """Rows that miss a column of these look-ups; all others wait for none of them."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for look in looks for c in look.gives])


def _pending_table(schema: str, fact: GrowingFact) -> str:
    return f"{schema}.{fact.name}_pending"


def pending_keys(rows: DataFrame, fact: GrowingFact) -> DataFrame:
    """``lookup, value, missing, day``: what fact rows wait for, once per value and day.

    A value that is null itself can never be found and is left out. Equal waits are combined before the shuffle.
    """
    waits = []
    for look in fact.lookups:
        missing = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in look.gives]), lambda c: c.isNotNull())
        waits.append(
            F.struct(
                F.lit(look.column).alias("lookup"),
                F.col(look.column).cast("string").alias("value"),
                F.array_join(missing, ",").alias("missing"),
            )
        )
    listed = rows.select(F.col(fact.day).alias("day"), F.explode(F.array(*waits)).alias("wait")).select("wait.*", "day")
    return listed.where("missing != '' and value is not null").distinct()


def _note_pending(spark: SparkSession, schema: str, fact: GrowingFact, days: set) -> None:
    """Rewrite what the rows of these days wait for; the table is kept by day."""
    if not days:
        return
    table = _pending_table(schema, fact)
    waiting = pending_keys(spark.table(f"{schema}.{fact.name}").filter(in_partitions(fact.day, days)), fact)
    if spark.catalog.tableExists(table):
        overwrite_partitions(spark, table, waiting, "day", days)
    else:
        save_table(waiting, table, "errorifexists", ["day"])


def resolved_keys(spark: SparkSession, schema: str, fact: GrowingFact, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Pending values for which the dimension now has a column that the fact rows miss.

    Both sides are narrow; values are reduced to distinct ones before they meet the dimension.
    """
    pending = spark.table(_pending_table(schema, fact))
    found = []
    for look in fact.lookups:
        waits = pending.where(F.col("lookup") == look.column)
        known = F.array_join(F.array(*[F.when(F.col(c).isNotNull(), F.lit(c)) for c in look.gives]), ",").alias("known")
        source = dimensions[look.dimension].select(F.col(look.key).cast("string").alias("value"), known).where("known != ''")
        wanted = waits.select("value").distinct().join(source, "value")
        arrived = F.arrays_overlap(F.split("missing", ","), F.split("known", ","))
        found.append(waits.join(wanted, "value").where(arrived).select("lookup", "value", "day").distinct())
    return reduce(DataFrame.unionByName, found)


def _repaired(rows: DataFrame, looks: Sequence[Lookup], day: str, due: DataFrame) -> DataFrame:
    """The saved rows that wait for one of the values of these look-ups that are due on their day."""
    wait = F.lit(False)
    sides = []
    for look in looks:
        lacks = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in look.gives])
        values = due.where(F.col("lookup") == look.column).select(
            F.col("value").alias(f"_{look.column}"), F.col("day").alias(f"_{look.column}_day"), F.lit(True).alias(f"_{look.column}_due")
        )
        sides.append((look, values))
        wait = wait | (lacks & F.coalesce(F.col(f"_{look.column}_due"), F.lit(False)))
    joined = rows.where(_lacking(looks))
    for look, values in sides:
        match = (F.col(look.column).cast("string") == F.col(f"_{look.column}")) & F.col(day).eqNullSafe(F.col(f"_{look.column}_day"))
        joined = joined.join(values, match, "left")
    return joined.where(wait).select(*rows.columns)


def log_changes(spark: SparkSession, schema: str, source: str, days: Iterable, run: Build) -> None:
    """Remember that a run changed these days of a table."""
    create_table(spark, f"{schema}.changed_days", CHANGED_DAYS)
    rows = [(source, day, run.run_id) for day in days]
    if rows:
        spark.createDataFrame(rows, CHANGED_DAYS).coalesce(1).write.insertInto(f"{schema}.changed_days")


def days_to_build(spark: SparkSession, schema: str, report: str, sources: Sequence[str]) -> tuple[set, list[str]]:
    """The days that runs have changed since they last went into a report, and those runs."""
    create_table(spark, f"{schema}.changed_days", CHANGED_DAYS)
    create_table(spark, f"{schema}.built_reports", BUILT)
    built = spark.table(f"{schema}.built_reports").where(F.col("report") == report).select("run_id")
    open_days = spark.table(f"{schema}.changed_days").where(F.col("source").isin(*sources)).join(built, "run_id", "left_anti")
    found = open_days.select("day", "run_id").distinct().collect()
    return {r.day for r in found}, sorted({r.run_id for r in found})


def rebuild_days(spark: SparkSession, schema: str, report: str, day: str, days: set, runs: Sequence[str], rows: DataFrame) -> None:
    """Replace whole days of a report by ``rows`` (of these days only), then note that the runs went into it.

    A day that has no rows any more leaves the report. The note comes last: a run lost before it is built again.
    """
    table = f"{schema}.{report}"
    if days:
        if spark.catalog.tableExists(table):
            overwrite_partitions(spark, table, rows, day, days)
        else:
            save_table(rows.hint("rebalance", day), table, "errorifexists", [day])
    if runs:
        spark.createDataFrame([(report, run_id) for run_id in runs], BUILT).coalesce(1).write.insertInto(f"{schema}.built_reports")
