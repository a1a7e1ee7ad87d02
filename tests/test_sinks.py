from datetime import date, datetime

import pytest
from comparing import rows

from wattline.operators.sinks import (
    append_widening,
    create_schemas,
    land_table,
    publish,
    replace_partitions,
    source_metadata,
    write_daily_csv,
)

D1, D2, D3 = date(2026, 1, 1), date(2026, 1, 2), date(2026, 1, 3)


@pytest.fixture(scope="module", autouse=True)
def schema(spark):
    create_schemas(spark, "sinks")


def batch(spark, *values):
    return spark.createDataFrame(values, "id string, n int, day date")


def test_full_load_replaces_and_incremental_adds(spark):
    land_table(batch(spark, ("a", 1, D1)), "sinks.full_t", "full")
    land_table(batch(spark, ("b", 2, D1)), "sinks.full_t", "full")
    assert rows(spark.table("sinks.full_t"), "id") == [("b",)]
    land_table(batch(spark, ("a", 1, D1)), "sinks.inc_t", "incremental")
    land_table(batch(spark, ("b", 2, D1)), "sinks.inc_t", "incremental")
    assert rows(spark.table("sinks.inc_t"), "id") == [("a",), ("b",)]
    with pytest.raises(ValueError, match="unknown load type: weekly"):
        land_table(batch(spark, ("a", 1, D1)), "sinks.inc_t", "weekly")


def test_append_widens_the_table_and_fills_gaps(spark):
    append_widening(spark.createDataFrame([("a", "x")], "id string, old string"), "sinks.wide_t")
    append_widening(spark.createDataFrame([(7, "b")], "fresh int, id string"), "sinks.wide_t")
    assert rows(spark.table("sinks.wide_t"), "id", "old", "fresh") == [("a", "x", None), ("b", None, 7)]


def test_published_table_can_be_rebuilt_from_itself(spark):
    publish(batch(spark, ("a", 1, D1)), "sinks.pub", "v1")
    grown = spark.table("sinks.pub").unionByName(batch(spark, ("b", 2, D2)))
    publish(grown, "sinks.pub", "v-2")
    assert rows(spark.table("sinks.pub"), "id", "n") == [("a", 1), ("b", 2)]


def test_a_version_can_be_published_again_and_old_ones_go(spark):
    for n, version in enumerate(["v1", "v2", "v2", "v3"]):
        publish(batch(spark, ("a", n, D1)), "sinks.kept", version)
        assert rows(spark.table("sinks.kept"), "n") == [(n,)]
    physical = [t.name for t in spark.catalog.listTables("sinks", "kept__*")]
    assert sorted(name.split("_")[2] for name in physical) == ["v2", "v3"]


def test_failed_rebuild_leaves_the_public_table(spark):
    publish(batch(spark, ("a", 1, D1)), "sinks.safe", "v1")
    broken = spark.sql("select raise_error('boom') as id, 1 as n, date'2026-01-01' as day")
    with pytest.raises(Exception, match="boom"):
        publish(broken, "sinks.safe", "v2")
    assert rows(spark.table("sinks.safe"), "id", "n") == [("a", 1)]


def test_partition_upsert_updates_moves_adds_and_repeats(spark):
    table = "sinks.parts"
    first = batch(spark, ("a", 1, D1), ("b", 1, D1), ("c", 1, D2), ("d", 1, D3))
    replace_partitions(spark, table, first, "id", "day")
    update = batch(spark, ("a", 2, D1), ("c", 2, D1), ("e", 2, D2))
    expected = [("a", 2, D1), ("b", 1, D1), ("c", 2, D1), ("d", 1, D3), ("e", 2, D2)]
    for _ in range(2):
        replace_partitions(spark, table, update, "id", "day")
        assert rows(spark.table(table), "id", "n", "day") == expected
    # The last row of a day moves away: the day must not keep its old copy.
    replace_partitions(spark, table, batch(spark, ("d", 3, D1)), "id", "day")
    assert rows(spark.table(table).filter("id = 'd'"), "n", "day") == [(3, D1)]


def test_partition_upsert_handles_null_partitions_and_new_columns(spark):
    table = "sinks.null_parts"
    replace_partitions(spark, table, batch(spark, ("a", 1, None), ("b", 1, D1)), "id", "day")
    wider = batch(spark, ("a", 2, D1)).selectExpr("id", "n", "'x' as extra", "day")
    replace_partitions(spark, table, wider, "id", "day")
    assert rows(spark.table(table), "id", "n", "extra", "day") == [("a", 2, "x", D1), ("b", 1, None, D1)]


def test_partition_upsert_drops_vanished_columns(spark):
    table = "sinks.narrower"
    replace_partitions(spark, table, batch(spark, ("a", 1, D1), ("b", 1, D2)), "id", "day")
    replace_partitions(spark, table, batch(spark, ("a", 2, D2)).drop("n"), "id", "day")
    assert spark.table(table).columns == ["id", "day"]
    assert rows(spark.table(table)) == [("a", D2), ("b", D2)]


def test_schema_can_have_its_own_folder(spark, tmp_path):
    create_schemas(spark, "placed", location=str(tmp_path))
    land_table(batch(spark, ("a", 1, D1)), "placed.t", "full")
    assert (tmp_path / "placed" / "t").is_dir()


def test_partition_upsert_rejects_repeated_keys(spark):
    with pytest.raises(ValueError, match="repeats key"):
        replace_partitions(spark, "sinks.rep", batch(spark, ("a", 1, D1), ("a", 2, D1)), "id", "day")


def test_partition_upsert_of_an_empty_batch_changes_nothing(spark):
    table = "sinks.empty_batch"
    replace_partitions(spark, table, batch(spark, ("a", 1, D1)), "id", "day")
    replace_partitions(spark, table, batch(spark, ("x", 1, D1)).limit(0), "id", "day")
    assert rows(spark.table(table), "id", "n", "day") == [("a", 1, D1)]


def test_daily_csv_has_one_folder_per_day(spark, tmp_path):
    named = source_metadata(
        batch(spark, ("a", 1, D1), ("b", 2, D2)), "day", "usage", "meters", datetime(2026, 1, 3)
    )
    write_daily_csv(named, str(tmp_path / "out"), "day")
    folders = sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir())
    assert folders == ["day=2026-01-01", "day=2026-01-02"]
    back = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert rows(back, "id", "source_file_name") == [("a", "usage_20260101.csv"), ("b", "usage_20260102.csv")]


def test_partition_upsert_evaluates_its_batch_once(spark):
    table = "sinks.once"
    replace_partitions(spark, table, batch(spark, ("a", 1, D1), ("b", 1, D2)), "id", "day")
    seen = spark.sparkContext.accumulator(0)
    source = batch(spark, ("a", 2, D2), ("c", 2, D3)).rdd.map(lambda row: (seen.add(1), row)[1])
    replace_partitions(spark, table, spark.createDataFrame(source, "id string, n int, day date"), "id", "day")
    assert seen.value == 2
    assert rows(spark.table(table), "id", "n", "day") == [("a", 2, D2), ("b", 1, D2), ("c", 2, D3)]


def test_partition_upsert_moves_a_null_key(spark):
    table = "sinks.null_key"
    replace_partitions(spark, table, batch(spark, (None, 1, D1), ("b", 1, D1)), "id", "day")
    replace_partitions(spark, table, batch(spark, (None, 2, D2)), "id", "day")
    assert rows(spark.table(table), "id", "n", "day") == [("b", 1, D1), (None, 2, D2)]


def test_a_rebuild_lost_before_its_renaming_is_finished_by_the_next_run(spark):
    table = "sinks.lost"
    replace_partitions(spark, table, batch(spark, ("a", 1, D1), ("b", 1, D2)), "id", "day")
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__rebuilt")
    replace_partitions(spark, table, batch(spark, ("a", 2, D1)), "id", "day")
    assert rows(spark.table(table), "id", "n", "day") == [("a", 2, D1), ("b", 1, D2)]
