from datetime import datetime

import pytest
from comparing import rows

from wattline.sources.csv import (
    NoFilesFound,
    UnrecognisedHeader,
    file_manifest,
    list_files,
    read_csv,
    read_daily_files,
    read_drifting_csv,
    unseen_files,
)
from wattline.sources.registry import SOURCES
from wattline.sources.tables import read_table, rows_frame, with_position


@pytest.fixture
def drifting(tmp_path):
    files = {
        "day=2026-01-01/r_1.csv": "id,a,b\n1,x,y\n2,,y\n",
        "day=2026-01-02/r_2.csv": "id,a,new,b\n3,x,N,y\n",
        "day=2026-01-03/r_3.csv": "id,a,new,b\n4,x,M,y\n",
        "day=2026-01-04/r_4.csv": '"id","a","b"\n"5","id,x","y"\n',
    }
    for name, text in files.items():
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True)
        path.write_text(text)
    return str(tmp_path / "raw")


def test_columns_are_matched_by_name_across_versions(spark, drifting):
    df = read_drifting_csv(spark, f"{drifting}/day=*/r_*.csv", "id")
    assert {f.dataType.simpleString() for f in df.schema.fields} == {"string"}
    assert rows(df, "id", "a", "new", "b") == [
        ("1", "x", None, "y"),
        ("2", None, None, "y"),
        ("3", "x", "N", "y"),
        ("4", "x", "M", "y"),
        ("5", "id,x", None, "y"),
    ]


def test_the_plan_grows_with_headers_not_files(spark, drifting):
    df = read_drifting_csv(spark, f"{drifting}/day=*/r_*.csv", "id")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2


def test_folder_key_is_used_only_where_files_lack_it(spark, drifting):
    days = read_drifting_csv(spark, f"{drifting}/day=*/r_*.csv", "id", folder_key="day")
    assert rows(days.filter("id in ('1', '4')"), "id", "day") == [("1", "2026-01-01"), ("4", "2026-01-03")]
    plain = read_csv(spark, f"{drifting}/day=2026-01-01/r_*.csv", folder_key="a")
    assert rows(plain, "id", "a") == [("1", "x"), ("2", None)]


def test_no_matching_file_is_an_error_or_an_empty_frame(spark, tmp_path):
    pattern = f"{tmp_path}/none/*.csv"
    with pytest.raises(NoFilesFound, match="none"):
        read_drifting_csv(spark, pattern, "id")
    with pytest.raises(FileNotFoundError):
        list_files(spark, pattern)
    for drifts in (True, False):
        empty = read_daily_files(spark, str(tmp_path), "none/*.csv", ["id", "a"], drifts)
        assert (empty.columns, empty.count()) == (["id", "a"], 0)


def test_daily_files_are_read_together(spark, drifting):
    assert read_daily_files(spark, drifting, "day=*/r_*.csv", ["id"], drifting=True).count() == 5
    assert read_daily_files(spark, drifting, "day=2026-01-0[23]/r_*.csv", ["id", "a", "new", "b"]).count() == 2


def test_multiline_values_and_corrupt_lines(spark, tmp_path):
    quoted = tmp_path / "quoted.csv"
    quoted.write_text('id,a\n1,"two\nlines"\n')
    assert rows(read_csv(spark, str(quoted), multiline=True)) == [("1", "two\nlines")]
    ragged = tmp_path / "ragged.csv"
    ragged.write_text("id,a\n1,x\n2,y,extra\n3\n")
    df = read_csv(spark, str(ragged), ["id", "a"], corrupt_column="_corrupt")
    assert rows(df, "id", "_corrupt") == [("1", None), ("2", "2,y,extra"), ("3", "3")]
    with pytest.raises(ValueError, match="declared columns"):
        read_csv(spark, str(ragged), corrupt_column="_corrupt")


def test_manifest_describes_each_file(spark, drifting):
    manifest = file_manifest(spark, f"{drifting}/day=*/r_*.csv", "readings", "id", ["new"])
    shown = ("file_name", "event_date", "record_count", "column_count", "schema_drift_applied")
    assert rows(manifest, *shown) == [
        ("r_1.csv", "2026-01-01", 2, 3, False),
        ("r_2.csv", "2026-01-02", 1, 4, True),
        ("r_3.csv", "2026-01-03", 1, 4, True),
        ("r_4.csv", "2026-01-04", 1, 3, False),
    ]
    assert rows(manifest.filter("file_name in ('r_2.csv', 'r_4.csv')"), "columns") == [("id|a|b",), ("id|a|new|b",)]


def test_only_unseen_files_remain(spark, drifting):
    files = list_files(spark, f"{drifting}/day=*/r_*.csv")
    first = files.filter("file_path like '%r_1.csv'")
    assert unseen_files(files, first).count() == 3
    assert unseen_files(files, files).count() == 0


def test_rows_from_values_allow_none(spark):
    df = rows_frame(spark, [{"id": "a", "at": None}, {"at": datetime(2026, 1, 1)}], "id string, at timestamp")
    assert rows(df) == [("a", None), (None, datetime(2026, 1, 1))]


def test_positions_are_unique_and_repeatable(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartition(4).write.parquet(path)
    scan = with_position(spark.read.parquet(path))
    assert scan.select("_row_file", "_row_index").distinct().count() == 100
    assert rows(scan) == rows(with_position(spark.read.parquet(path)))


def test_missing_tables_are_named(spark):
    with pytest.raises(LookupError, match="nowhere.t"):
        read_table(spark, "nowhere.t")


def test_registered_layout():
    readings = SOURCES["meter_readings"]
    assert readings.path("/raw/") == "/raw/meter_readings/reading_date=*/meter_readings_*.csv"
    assert (readings.folder_key, SOURCES["customers"].folder_key) == ("reading_date", None)
    assert [s.name for s in SOURCES.values() if s.drifting] == ["meter_readings"]


def test_a_file_may_name_its_columns_in_any_order(spark, drifting, tmp_path):
    other = tmp_path / "raw" / "day=2026-01-05" / "r_5.csv"
    other.parent.mkdir()
    other.write_text("\nb,fw,id\nq,F,6\nid,F,7\n")
    df = read_drifting_csv(spark, f"{drifting}/day=*/r_*.csv", "id")
    assert rows(df.filter("id in ('6', '7')"), "id", "a", "b", "fw") == [("6", None, "q", "F"), ("7", None, "id", "F")]
    assert df.count() == 7
    manifest = file_manifest(spark, f"{drifting}/day=*/r_*.csv", "readings", "id", ["new"])
    assert rows(manifest.filter("file_name = 'r_5.csv'"), "record_count", "columns", "recognised") == [(2, "b|fw|id", True)]


@pytest.mark.parametrize("text", ["8,x,y\n9,x,y\n", "\n\n", "ID,a\n1,x\n"])
def test_a_file_without_the_header_stops_the_read_and_shows_in_the_manifest(spark, drifting, tmp_path, text):
    other = tmp_path / "raw" / "day=2026-01-05" / "r_5.csv"
    other.parent.mkdir()
    other.write_text(text)
    with pytest.raises(UnrecognisedHeader, match="r_5.csv"):
        read_drifting_csv(spark, f"{drifting}/day=*/r_*.csv", "id")
    manifest = file_manifest(spark, f"{drifting}/day=*/r_*.csv", "readings", "id", ["new"])
    assert rows(manifest, "file_name", "recognised") == [(f"r_{i}.csv", i != 5) for i in range(1, 6)]


def test_paths_with_blanks_and_signs(spark, tmp_path):
    path = tmp_path / "a b+c%20d" / "r 1.csv"
    path.parent.mkdir()
    path.write_text("id,a\n1,x\n")
    assert rows(read_drifting_csv(spark, str(path), "id")) == [("1", "x")]


def test_sources_keep_malformed_lines_and_growing_ones_read_every_header(spark, tmp_path):
    folder = tmp_path / "weather" / "weather_date=2026-01-01"
    folder.mkdir(parents=True)
    (folder / "weather_1.csv").write_text("weather_id,region\nW1,London\nW2\n")
    (folder / "weather_2.csv").write_text("region,weather_id\nLeeds,W3\n")
    source = SOURCES["weather"]
    assert rows(source.read(spark, source.path(str(tmp_path))), "weather_id", "region") == [
        ("W1", "London"), ("W2", None), ("W3", "Leeds"),
    ]
    kept = source.read(spark, source.path(str(tmp_path)), corrupt_column="_corrupt")
    assert rows(kept, "weather_id", "_corrupt") == [("W1", None), ("W2", "W2"), ("W3", None)]
