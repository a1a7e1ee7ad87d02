import random
import re

import pytest
from comparing import rows

from wattline.operators.skew import flag_unknown_keys, lookup_join


@pytest.fixture(scope="module")
def facts(spark):
    draw = random.Random(3)
    data = [(n, "k0" if n % 3 == 0 else draw.choice([None, "gone", *[f"k{i}" for i in range(40)]])) for n in range(500)]
    return spark.createDataFrame(data, "n int, k string")


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([(f"k{i}", i * 10) for i in range(60)], "k string, v int")


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
@pytest.mark.parametrize("hot_rows", [1_000_000, 50])
def test_lookup_join_equals_a_left_join(facts, lookup, broadcast_rows, hot_rows):
    plain = facts.join(lookup, "k", "left").select("n", "k", "v")
    joined = lookup_join(facts, lookup, "k", broadcast_rows, hot_rows)
    assert joined.columns == ["n", "k", "v"]
    assert rows(joined) == rows(plain)


def test_long_lookup_is_not_broadcast_whole(spark, facts, lookup):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = lookup_join(facts, lookup, "k", 0)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
        short = lookup_join(facts, lookup, "k", 1000)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in short
        assert "Exchange hashpartitioning" not in short
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("hot_rows", [1_000_000, 50])
def test_long_lookup_from_small_files_is_not_broadcast(facts, lookup, tmp_path, spark, hot_rows):
    """Saved keys take few bytes in their files; that says nothing about the memory they need."""
    lookup.write.option("compression", "zstd").parquet(str(tmp_path / "keys"))
    saved = spark.read.schema(lookup.schema).parquet(str(tmp_path / "keys"))
    joined = lookup_join(facts, saved, "k", 0, hot_rows)
    flagged = flag_unknown_keys(facts, saved, "k", "unknown", 0)
    for made in (joined, flagged) if hot_rows > 50 else (joined,):
        plan = made._jdf.queryExecution().executedPlan().toString()
        # Only the hot keys may be broadcast.
        assert plan.count("BroadcastHashJoin") == (hot_rows == 50) and "SortMergeJoin" in plan
    assert rows(joined) == rows(facts.join(lookup, "k", "left").select("n", "k", "v"))


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
@pytest.mark.parametrize("hot_rows", [1_000_000, 50])
def test_unknown_keys_are_flagged_and_null_keys_pass(spark, facts, lookup, broadcast_rows, hot_rows):
    repeated = lookup.unionByName(lookup).unionByName(spark.createDataFrame([(None, 1)], "k string, v int"))
    flagged = flag_unknown_keys(facts, repeated, "k", "unknown", broadcast_rows, hot_rows)
    assert flagged.count() == facts.count()
    known = {f"k{i}" for i in range(60)}
    for row in flagged.collect():
        assert row.unknown == (row.k is not None and row.k not in known)


def test_join_on_two_columns(spark):
    left = spark.createDataFrame([(1, "a", 5), (1, "b", 6), (None, "a", 7)], "x int, y string, n int")
    right = spark.createDataFrame([(1, "a", "hit")], "x int, y string, v string")
    for broadcast_rows in (10, 0):
        joined = lookup_join(left, right, ["x", "y"], broadcast_rows)
        assert rows(joined, "n", "v") == [(5, "hit"), (6, None), (7, None)]


def test_settled_rows_are_spread_and_the_input_is_read_once(spark, facts, lookup):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_join(facts, lookup, "k", 0, hot_rows=50)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert re.search(r"hashpartitioning\(_on_0#\d+, _spread#", plan)
    assert plan.count("Scan ExistingRDD[n#") == 1
