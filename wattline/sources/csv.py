"""Raw CSV scans. Every column is read as text; nothing is inferred."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class NoFilesFound(FileNotFoundError):
    """No file matches a source pattern."""


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    multiline: bool = False,
    corrupt_column: str | None = None,
    folder_key: str | None = None,
) -> DataFrame:
    """All-text scan of CSV files that share one header.

    ``columns`` spares Spark the look at the first file. ``corrupt_column`` keeps the
    whole text of a line with too few or too many fields. ``folder_key`` takes a column
    from its ``key=value`` folder where the files themselves do not have it.
    """
    reader = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
    )
    if columns is not None:
        fields = [*columns, corrupt_column] if corrupt_column else list(columns)
        reader = reader.schema(text_schema(fields))
    if corrupt_column:
        if columns is None:
            raise ValueError("a corrupt-line column needs the declared columns")
        # A pruned scan would not notice a missing or extra field in columns nobody asked for.
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column).option("columnPruning", False)
    df = reader.csv(paths if isinstance(paths, str) else list(paths))
    if folder_key is None or folder_key in df.columns:
        return df
    value = F.regexp_extract(F.col("_metadata.file_path"), f"/{folder_key}=([^/]*)/", 1)
    return df.withColumn(folder_key, F.nullif(value, F.lit("")))


class UnrecognisedHeader(ValueError):
    """A file does not begin with a header that names the declared first column."""


def file_headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Path and header line of every file that has a line.

    The header is the first line that is not blank, whatever columns it names and in
    whatever order. The lines are searched by the executors, so the driver opens no file.
    """
    try:
        lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise NoFilesFound(f"no file matches {paths}") from error
        raise
    beginnings = lines.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    ).filter((F.col("block") == 0) & (F.trim("value") != ""))
    return beginnings.groupBy("file_path").agg(F.min_by("value", "line").alias("header"))


def _known_headers(spark: SparkSession, paths: str | Sequence[str], first_column: str) -> DataFrame:
    """Path, header line and recognised or not, for every file that is not empty.

    A file of no bytes has no rows; listings leave it out, so it is not recorded as loaded either."""
    headers = file_headers(spark, paths)
    names = F.transform(F.split("header", ","), lambda name: F.trim(F.regexp_replace(name, '^\ufeff|"', "")))
    listed = list_files(spark, paths).select(_plain(F.col("file_path")).alias("plain"), "file_path")
    read = headers.select(_unescaped("file_path").alias("plain"), "header", names.alias("names"))
    return listed.join(read, "plain", "left").select(
        "file_path",
        "header",
        F.coalesce("names", F.array().cast("array<string>")).alias("names"),
        F.coalesce(F.array_contains("names", first_column), F.lit(False)).alias("recognised"),
    )


def _unescaped(path: str) -> Column:
    """The path of a scanned row as listings show it: scans escape it."""
    return _plain(F.url_decode(F.regexp_replace(path, r"\+", "%2B")))


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


def header_columns(header: str) -> list[str]:
    return [name.strip() for name in next(csv.reader([header.lstrip("\ufeff")]))]


def read_drifting_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    first_column: str,
    multiline: bool = False,
    folder_key: str | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """All-text scan of files whose columns changed over time, matched by name.

    Every file is read by its own header; one whose header does not name ``first_column``, in
    any place, stops the read, so no file is left out in silence. Files are grouped by header and
    read once per header: the plan grows with the number of schema versions, not of files.
    The driver holds file paths, as it does for any scan.
    """
    headers = _known_headers(spark, paths, first_column)
    unknown = headers.filter("not recognised").select("file_path").orderBy("file_path").limit(10).collect()
    if unknown:
        raise UnrecognisedHeader(f"no {first_column} header in {[row.file_path for row in unknown]}")
    by_columns: dict[tuple[str, ...], list[str]] = {}
    for row in headers.select("file_path", "header").orderBy("file_path").toLocalIterator():
        by_columns.setdefault(tuple(header_columns(row.header)), []).append(row.file_path)
    if not by_columns:
        raise NoFilesFound(f"no file matches {paths}")
    scans = [
        read_csv(spark, files, columns, multiline, corrupt_column, folder_key)
        for columns, files in by_columns.items()
    ]
    return union_by_name(scans)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """One frame with the columns of all, null where a frame lacks one."""
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame, allowMissingColumns=True)
    return combined


def read_daily_files(
    spark: SparkSession,
    base: str,
    pattern: str,
    columns: Sequence[str],
    drifting: bool = False,
) -> DataFrame:
    """All daily files of a source, or an empty frame with the declared columns."""
    path = f"{base.rstrip('/')}/{pattern}"
    try:
        if drifting:
            return read_drifting_csv(spark, path, columns[0])
        return read_csv(spark, path, columns)
    except NoFilesFound:
        pass
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return spark.createDataFrame([], text_schema(columns))


def list_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Path, size and time of the matching files. Their content is not read."""
    try:
        files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise NoFilesFound(f"no file matches {paths}") from error
        raise
    return files.select(F.col("path").alias("file_path"), "length", "modificationTime")


def file_manifest(
    spark: SparkSession, paths: str, source: str, first_column: str, drift_columns: Sequence[str] = ()
) -> DataFrame:
    """One row per file: its rows, its columns, whether it has the later columns and a header that is known."""
    headers = _known_headers(spark, paths, first_column)
    names = F.col("names")
    described = headers.select(
        "file_path",
        _plain(F.col("file_path")).alias("plain"),
        "recognised",
        F.size(names).alias("column_count"),
        F.array_join(names, "|").alias("columns"),
        (F.lit(bool(drift_columns)) & F.arrays_overlap(names, F.lit(list(drift_columns) or [""]))).alias(
            "schema_drift_applied"
        ),
    )
    rows = (
        spark.read.option("header", True)
        .schema(text_schema([first_column]))
        .csv(paths)
        .select(_unescaped("_metadata.file_path").alias("plain"))
        .groupBy("plain")
        .agg(F.count(F.lit(1)).alias("record_count"))
    )
    return (
        described.join(rows, "plain", "left")
        .select(
            F.lit(source).alias("source_name"),
            F.element_at(F.split("file_path", "/"), -1).alias("file_name"),
            "file_path",
            F.element_at(F.split(F.element_at(F.split("file_path", "/"), -2), "="), -1).alias("event_date"),
            F.coalesce("record_count", F.lit(0)).cast("int").alias("record_count"),
            "column_count",
            "columns",
            "schema_drift_applied",
            "recognised",
        )
    )


def unseen_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that no earlier load has recorded."""
    return files.join(manifest.select("file_path").distinct(), "file_path", "left_anti")
