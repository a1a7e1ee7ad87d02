"""Writes. Tables are Parquet; a reader never sees a half-written rebuild."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.operators.incremental import null_safe_match, require_unique, upsert
from wattline.operators.skew import BROADCAST_ROWS, broadcast_within
from wattline.session import shared_folder

FULL, INCREMENTAL = "full", "incremental"
VERSION_PROPERTY = "wattline.version"
REBUILT = "__rebuilt"
#: How Spark names the folder of the partition without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def create_schemas(spark: SparkSession, *names: str, location: str | None = None) -> None:
    """Create missing schemas, each in a folder of its own if a location is given."""
    for name in names:
        place = f" LOCATION '{location}/{name}'" if location else ""
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{place}")


def create_table(spark: SparkSession, name: str, columns: str) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")


def save_table(df: DataFrame, name: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    df.write.format("parquet").option("compression", "zstd").mode(mode).partitionBy(*partition_by).saveAsTable(name)


def land_table(df: DataFrame, name: str, load_type: str) -> None:
    """Replace a landing table, or add to it and widen it by columns it lacks."""
    if load_type == FULL:
        save_table(df, name, "overwrite")
    elif load_type == INCREMENTAL:
        append_widening(df, name)
    else:
        raise ValueError(f"unknown load type: {load_type}")


def append_widening(df: DataFrame, name: str) -> None:
    """Append by name. New columns are added to the table first; missing ones become null."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        save_table(df, name, "errorifexists")
        return
    widen(spark, name, df.schema)
    _aligned(df, spark.table(name)).write.insertInto(name)


def widen(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Add the columns a table lacks; its earlier rows have nulls there."""
    known = spark.table(table).columns
    fresh = [f for f in schema.fields if f.name not in known]
    if fresh:
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fresh)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
        spark.catalog.refreshTable(table)


def publish(df: DataFrame, name: str, version: str, partition_by: Sequence[str] = ()) -> None:
    """Rebuild a table under a new physical name, then point the public view at it.

    The old rows stay readable until the new ones are complete, also when the rebuild
    reads the table it replaces, and a failed run leaves the view as it was. The version
    before stays for readers that have started on it; older ones are dropped.
    """
    spark = df.sparkSession
    schema, _, table = name.rpartition(".")
    physical = re.sub(r"[^0-9a-z_]", "_", f"{table}__{version}_{uuid.uuid4().hex[:8]}".lower())
    before = _current_version(spark, name)
    save_table(df, f"{schema}.{physical}" if schema else physical, "overwrite", partition_by)
    spark.sql(
        f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSION_PROPERTY}' = '{physical}') "
        f"AS SELECT * FROM {schema + '.' if schema else ''}{physical}"
    )
    for old in spark.catalog.listTables(schema or None, f"{table}__*"):
        if old.name not in (physical, before):
            spark.sql(f"DROP TABLE IF EXISTS {schema + '.' if schema else ''}{old.name}")


def _current_version(spark: SparkSession, name: str) -> str | None:
    if not spark.catalog.tableExists(name):
        return None
    properties = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return next((row.value for row in properties if row.key == VERSION_PROPERTY), None)


def replace_partitions(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    keys: str | Sequence[str],
    partition: str,
    broadcast_rows: int = BROADCAST_ROWS,
    among: Column | None = None,
) -> set:
    """Upsert into a partitioned table, rewriting only partitions that hold older rows of the batch; returns those it touches.

    The batch is evaluated once, into a folder of its own that goes away afterwards. Touched are the partitions of the batch and those that hold an older row of one of its
    keys. Their names are read to the driver: one value per day, never per row. Partitions without an older row
    get the new ones added; the others are rewritten. Rows are rebalanced by partition, which keeps files few and splits a
    large day. Running the same batch again gives the same table.

    With ``among`` the caller states that only rows of the table for which it is true can have a key of the batch; the
    others are kept without a join.

    Columns follow the batch: new ones are added to the table; when one has vanished, the
    table is rebuilt without it under another name, which reads all partitions, and takes the
    old one's place when it is complete. Null keys match each other.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    folder = shared_folder(spark, "batch")
    try:
        return _replace(spark, table, written(batch, folder), names, partition, broadcast_rows, among)
    finally:
        remove_folder(spark, folder)


def written(df: DataFrame, folder: str) -> DataFrame:
    """The rows written to a folder and read again: later steps agree on them."""
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _replace(
    spark: SparkSession, table: str, batch: DataFrame, names: list[str], partition: str, broadcast_rows: int, among: Column | None
) -> set:
    require_unique(batch, names)
    _finish_swap(spark, table)
    arrived = {row[0] for row in batch.select(partition).distinct().collect()}
    if not spark.catalog.tableExists(table):
        save_table(batch.hint("rebalance", partition), table, "errorifexists", [partition])
        return arrived
    folder = shared_folder(spark, "older")
    try:
        batch_keys = batch.select(*[F.col(k).alias(f"_key_{k}") for k in names])
        rows = spark.table(table) if among is None else spark.table(table).filter(among)
        holding_older = rows.select(*dict.fromkeys([*names, partition])).join(
            broadcast_within(batch_keys, broadcast_rows), null_safe_match(names), "left_semi"
        )
        older = written(holding_older, folder)
        rewritten = {row[0] for row in older.select(partition).distinct().collect()}
        if set(spark.table(table).columns) - set(batch.columns):
            rebuilt = upsert(spark.table(table), batch, names, broadcast_rows)
            save_table(rebuilt.hint("rebalance", partition), f"{table}{REBUILT}", "overwrite", [partition])
            spark.sql(f"DROP TABLE {table}")
            _finish_swap(spark, table)
            return arrived | rewritten
        widen(spark, table, batch.schema)
        target = spark.table(table)
        if rewritten:
            near = target.filter(in_partitions(partition, rewritten))
            replaced = older.select(*[F.col(k).alias(f"_key_{k}") for k in names])
            open_rows = near if among is None else near.filter(among)
            kept = open_rows.join(broadcast_within(replaced, broadcast_rows), null_safe_match(names), "left_anti")
            if among is not None:
                kept = kept.unionByName(near.filter(~F.coalesce(among, F.lit(False))))
            fresh = _aligned(batch.filter(in_partitions(partition, rewritten)), target)
            overwrite_partitions(spark, table, kept.unionByName(fresh), partition, rewritten)
        if arrived - rewritten:
            added = _aligned(batch.filter(in_partitions(partition, arrived - rewritten)), target)
            added.hint("rebalance", partition).write.insertInto(table)
            spark.catalog.refreshTable(table)
        return arrived | rewritten
    finally:
        remove_folder(spark, folder)


def _finish_swap(spark: SparkSession, table: str) -> None:
    """Give a rebuilt table its name; also after a run that was lost between dropping and renaming."""
    rebuilt = f"{table}{REBUILT}"
    if spark.catalog.tableExists(rebuilt) and not spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {rebuilt} RENAME TO {table}")
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        spark.catalog.refreshTable(table)


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def overwrite_partitions(
    spark: SparkSession, table: str, df: DataFrame, partition: str, touched: set
) -> None:
    """Replace the named partitions of a table by the given rows, which may come from them.

    A dynamic overwrite moves its files into place when all are complete, so the rows are written once. Named partitions that
    still have their earlier files after it got no row and are dropped.
    """
    before = _files(spark, table, partition, touched)
    with _dynamic_overwrite(spark):
        df.select(*spark.table(table).columns).hint("rebalance", partition).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)
    after = _files(spark, table, partition, touched)
    stale = {name for name, found in before.items() if found & after.get(name, set())}
    gone = [f"PARTITION ({partition} = {'NULL' if v is None else repr(str(v))})" for v in touched if ("" if v is None else str(v)) in stale]
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(gone)}")
        spark.catalog.refreshTable(table)


def _files(spark: SparkSession, table: str, partition: str, values: set) -> dict[str, set[str]]:
    """The files of the named partitions by the text of the partition's value, which is empty for the one without a value."""
    found: dict[str, set[str]] = {}
    for file in spark.table(table).filter(in_partitions(partition, values)).inputFiles():
        # A folder's name has its special characters escaped, and the file's address escapes it once more.
        name = next(part.partition("=")[2] for part in reversed(file.split("/")) if part.startswith(f"{partition}="))
        name = unquote(unquote(name))
        found.setdefault("" if name == NO_VALUE else name, set()).add(file)
    return found


def in_partitions(partition: str, values: set) -> Column:
    """Rows of the named partitions, the one without a value included."""
    test = F.col(partition).isin([v for v in values if v is not None])
    return test | F.col(partition).isNull() if None in values else test


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrite only partitions that receive rows, for the statements inside."""
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def _aligned(batch: DataFrame, target: DataFrame) -> DataFrame:
    return batch.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in batch.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def source_metadata(df: DataFrame, date_column: str, prefix: str, system: str, at: datetime) -> DataFrame:
    """The columns every raw file carries: its name, the sending system and the time."""
    return df.withColumns(
        {
            "source_file_name": F.concat(
                F.lit(f"{prefix}_"), F.date_format(F.col(date_column), "yyyyMMdd"), F.lit(".csv")
            ),
            "source_system": F.lit(system),
            "generated_at_utc": F.lit(at).cast("timestamp"),
        }
    )


def write_daily_csv(df: DataFrame, path: str, date_column: str) -> None:
    """CSV files in one folder per day, ``{date_column}={day}``.

    Rows are rebalanced by day before the write: small days share a task, and a large day
    is split over several tasks and files.
    """
    (
        df.hint("rebalance", date_column)
        .write.mode("errorifexists")
        .partitionBy(date_column)
        .option("header", True)
        .csv(path)
    )
