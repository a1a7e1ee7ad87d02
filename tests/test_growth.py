"""Facts that take up late dimension keys, and reports that follow changed days."""

from __future__ import annotations

from datetime import date, datetime
from functools import partial
from pathlib import Path

import pytest
from comparing import rows

from wattline.operators.sinks import create_schemas, replace_partitions
from wattline.plans import growth
from wattline.plans.build import Build
from wattline.plans.growth import GrowingFact, Lookup, days_to_build, grow_fact, log_changes, pending_keys, rebuild_days

D1, D2, D3 = date(2026, 1, 1), date(2026, 1, 2), date(2026, 1, 3)
FACT = GrowingFact("fact", "id", "day", (Lookup("meter", "meters", "meter", ("meter_sk", "owner_sk")), Lookup("region", "regions", "region", ("region_sk",))))


@pytest.fixture
def schema(spark, request):
    name = f"growth_{abs(hash(request.node.name)) % 10**8}"
    create_schemas(spark, name)
    return name


def shape(staged, meters, regions, run):
    return run.stamp(staged.join(meters, "meter", "left").join(regions, "region", "left"))


def grow(spark, schema, staged, meters, regions, number):
    run = Build(f"run-{number}", datetime(2026, 1, 8 + number), "test")
    staged = spark.createDataFrame(staged, "id string, meter string, region string, day date, kwh double")
    dims = {
        "meters": spark.createDataFrame(meters, "meter string, meter_sk string, owner_sk string"),
        "regions": spark.createDataFrame(regions, "region string, region_sk string"),
    }
    shaped = partial(shape, meters=dims["meters"], regions=dims["regions"], run=run)
    return grow_fact(spark, schema, FACT, staged, shaped, dims, run)


def files(spark, table, day):
    return {f for f in spark.table(table).inputFiles() if f"day={day}" in f}


SHOWN = ("id", "meter_sk", "owner_sk", "region_sk", "dbt_invocation_id")


def test_a_key_that_comes_later_is_filled_in_and_only_its_days_are_rewritten(spark, schema):
    first = [("a", "M1", "N", D1, 1.0), ("b", "M2", "N", D1, 2.0), ("c", "M1", "S", D2, 3.0), ("d", None, None, D3, 4.0)]
    assert grow(spark, schema, first, [("M2", "m2", "o2")], [("N", "n")], 1) == {D1, D2, D3}
    assert rows(spark.table(f"{schema}.fact"), *SHOWN) == [
        ("a", None, None, "n", "run-1"), ("b", "m2", "o2", "n", "run-1"), ("c", None, None, None, "run-1"), ("d", None, None, None, "run-1"),
    ]
    waiting = spark.table(f"{schema}.fact_pending")
    assert rows(waiting, "lookup", "value", "missing", "day") == [
        ("meter", "M1", "meter_sk,owner_sk", D1), ("meter", "M1", "meter_sk,owner_sk", D2), ("region", "S", "region_sk", D2),
    ]
    before = files(spark, f"{schema}.fact", D3)
    # The meter arrives without its owner, and the region not at all.
    assert grow(spark, schema, [("e", "M2", "N", D1, 5.0)], [("M2", "m2", "o2"), ("M1", "m1", None)], [("N", "n")], 2) == {D1, D2}
    assert rows(spark.table(f"{schema}.fact"), *SHOWN)[:3] == [
        ("a", "m1", None, "n", "run-2"), ("b", "m2", "o2", "n", "run-1"), ("c", "m1", None, None, "run-2"),
    ]
    assert files(spark, f"{schema}.fact", D3) == before
    # The owner and the region follow; nothing waits but the row without values, which cannot be found.
    everything = [("M2", "m2", "o2"), ("M1", "m1", "o1")], [("N", "n"), ("S", "s")]
    assert grow(spark, schema, [], *everything, 3) == {D1, D2}
    assert rows(spark.table(f"{schema}.fact"), *SHOWN) == [
        ("a", "m1", "o1", "n", "run-3"), ("b", "m2", "o2", "n", "run-1"), ("c", "m1", "o1", "s", "run-3"),
        ("d", None, None, None, "run-1"), ("e", "m2", "o2", "n", "run-2"),
    ]
    assert spark.table(f"{schema}.fact_pending").count() == 0
    assert grow(spark, schema, [], *everything, 4) == set()


def test_a_row_that_moves_to_another_day_waits_there(spark, schema):
    grow(spark, schema, [("a", "M1", "N", D1, 1.0)], [], [("N", "n")], 1)
    assert grow(spark, schema, [("a", "M1", "N", D2, 1.0)], [], [("N", "n")], 2) == {D1, D2}
    assert rows(spark.table(f"{schema}.fact_pending"), "value", "day") == [("M1", D2)]
    assert grow(spark, schema, [], [("M1", "m1", "o1")], [("N", "n")], 3) == {D2}
    assert rows(spark.table(f"{schema}.fact"), "id", "meter_sk", "day") == [("a", "m1", D2)]


def test_waits_are_listed_once_per_day(spark):
    made = spark.createDataFrame([("M1", None, None, "N", "n", D1)] * 50, "meter string, meter_sk string, owner_sk string, region string, region_sk string, day date")
    assert rows(pending_keys(made, FACT), "lookup", "value", "missing", "day") == [("meter", "M1", "meter_sk,owner_sk", D1)]


def summed(table):
    return table.groupBy("day").sum("kwh").withColumnRenamed("sum(kwh)", "kwh").select("kwh", "day")


def test_a_report_follows_changed_days_also_after_a_lost_run(spark, schema):
    table = f"{schema}.usage"

    def land(number, *values):
        batch = spark.createDataFrame(values, "id string, kwh double, day date")
        days = replace_partitions(spark, table, batch, "id", "day")
        log_changes(spark, schema, "usage", days, Build(f"run-{number}", datetime(2026, 1, 9), "test"))

    def build():
        days, runs = days_to_build(spark, schema, "report", ["usage"])
        saved = spark.table(table)
        rebuild_days(spark, schema, "report", "day", days, runs, summed(saved.filter(saved.day.isin(list(days)))))
        return days

    land(1, ("a", 1.0, D1), ("b", 2.0, D2))
    assert build() == {D1, D2}
    assert build() == set()
    land(2, ("c", 5.0, D1))  # This run is lost before the report is built.
    land(3, ("b", 3.0, D3))
    before = {f for f in spark.table(f"{schema}.report").inputFiles() if "day=2026-01-02" in f}
    assert before and build() == {D1, D2, D3}
    assert rows(spark.table(f"{schema}.report"), "day", "kwh") == [(D1, 6.0), (D3, 3.0)]
    assert not any(Path(f.removeprefix("file:")).exists() for f in before)


def test_all_facts_name_columns_that_they_have():
    for fact in (growth.READINGS, growth.BILLING, growth.OUTAGES):
        assert len(fact.filled) == len(set(fact.filled)) and fact.day in [look.column for look in fact.lookups]


def test_new_rows_are_added_without_rewriting_their_day(spark, schema):
    table = f"{schema}.usage"

    def land(*values):
        return replace_partitions(spark, table, spark.createDataFrame(values, "id string, kwh double, day date"), "id", "day")

    land(("a", 1.0, D1), ("b", 2.0, D2), ("n", 4.0, None))
    before = files(spark, table, D1)
    assert land(("c", 5.0, D1), ("b", 3.0, D2), ("m", 6.0, None)) == {D1, D2, None}
    assert before < files(spark, table, D1)
    assert land(("n", 7.0, D2)) == {None, D2}
    assert land(("m", 8.0, D2)) == {None, D2}
    assert rows(spark.table(table), "id", "kwh", "day") == [("a", 1.0, D1), ("b", 3.0, D2), ("c", 5.0, D1), ("m", 8.0, D2), ("n", 7.0, D2)]
