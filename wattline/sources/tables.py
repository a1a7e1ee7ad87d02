"""Saved-table scans and row-wise frames."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Where a row lies in a Parquet table: unique, and the same on every reading.
POSITION = ("_row_file", "_row_index")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A saved table or view by name; a missing one is reported with its name."""
    if not spark.catalog.tableExists(name):
        raise LookupError(f"table not found: {name}")
    return spark.table(name)


def with_position(scan: DataFrame) -> DataFrame:
    """Add the position columns to a direct Parquet scan.

    The file is kept as a 64-bit hash of its path, so the column stays small when shuffled.
    """
    file_column, index_column = POSITION
    return scan.select(
        "*",
        F.xxhash64(F.col("_metadata.file_path")).alias(file_column),
        F.col("_metadata.row_index").alias(index_column),
    )


def rows_frame(spark: SparkSession, rows: Iterable[Mapping | tuple], schema: T.StructType | str) -> DataFrame:
    """A small frame from Python values, always with a declared schema so that None is allowed."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    tuples = [
        tuple(row.get(name) for name in declared.names) if isinstance(row, Mapping) else tuple(row)
        for row in rows
    ]
    return spark.createDataFrame(tuples, declared)
