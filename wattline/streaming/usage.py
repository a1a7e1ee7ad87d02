"""Daily usage from a stream of readings: open days are shown, repeated rows count once, late rows are kept aside.

Every micro-batch adds a folder of its own to four tables: the sums of its meter-days, the ids it has accepted, the rows that came behind
the watermark, and one line on its progress. A batch that is repeated after a failure overwrites its folders, so nothing is counted
twice. Sums of one meter-day from several batches add up when they are read; ``fold_usage`` merges
old folders and forgets ids that the watermark has passed.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.functions import exact_sum
from wattline.plans.marts import usage_from_meter_days

# Fixed value: the longest delay with which readings arrive is 119 hours.
LATEST_ARRIVAL = "120 hours"

DAY_KEYS = ("reading_date", "region", "meter_id", "customer_id")
DAYS = (
    "reading_date date, region string, meter_id string, customer_id string, readings bigint, kwh_count bigint, "
    "kwh decimal(34,6), max_kwh double, voltage_count bigint, voltage decimal(34,6), late bigint"
)
SEEN = "reading_id string, reading_timestamp timestamp"
PROGRESS = "batch_id bigint, newest timestamp, rows bigint, accepted bigint, repeated bigint, behind bigint"


def meter_days(readings: DataFrame) -> DataFrame:
    """Additive sums per day, region, meter and customer; a busy region is spread by meter."""
    dated = readings.withColumn("reading_date", F.col("reading_timestamp").cast("date"))
    return dated.groupBy(*DAY_KEYS).agg(
        F.count(F.lit(1)).alias("readings"),
        F.count("consumption_kwh").alias("kwh_count"),
        exact_sum("consumption_kwh").alias("kwh"),
        F.max("consumption_kwh").alias("max_kwh"),
        F.count("voltage").alias("voltage_count"),
        exact_sum("voltage").alias("voltage"),
        F.count_if("is_late_arriving").alias("late"),
    )


def merged_days(days: DataFrame) -> DataFrame:
    sums = ("readings", "kwh_count", "kwh", "voltage_count", "voltage", "late")
    added = [F.sum(c).cast(days.schema[c].dataType).alias(c) for c in sums]
    return days.groupBy(*DAY_KEYS).agg(F.max("max_kwh").alias("max_kwh"), *added).select(*days.columns)


class UsageTables:
    """The folders under ``path``. A folder counts once its writer has finished it."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def _system(self):
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return root.getFileSystem(self.spark._jsc.hadoopConfiguration()), self.spark._jvm.org.apache.hadoop.fs.Path

    def folders(self, table: str, before: int | None = None) -> list[tuple[str, int, str]]:
        """``(kind, number, path)`` of what a reader needs: the newest finished fold and the finished batches after it."""
        system, path = self._system()
        found = system.globStatus(path(f"{self.path}/{table}/*/_SUCCESS")) or []
        named = [re.fullmatch(r"(.*/(fold|batch)=(\d+))/_SUCCESS", str(f.getPath())) for f in found]
        parts = [(m[2], int(m[3]), m[1]) for m in named if m and (before is None or int(m[3]) < before)]
        base = max((n for kind, n, _ in parts if kind == "fold"), default=-1)
        return [p for p in parts if (p[0] == "fold" and p[1] == base) or (p[0] == "batch" and p[1] > base)]

    def read(self, table: str, schema: str | T.StructType, before: int | None = None) -> DataFrame:
        paths = [p for _, _, p in self.folders(table, before)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def delete(self, folder: str) -> None:
        system, path = self._system()
        system.delete(path(folder), True)

    def newest(self, before: int | None = None) -> datetime | None:
        return self.read("progress", PROGRESS, before).agg(F.max("newest")).first()[0]


def _accept(tables: UsageTables, rows: DataFrame, batch: int, delay: str) -> None:
    spark = rows.sparkSession
    folder = f"{tables.path}/rows"
    rows.write.mode("overwrite").parquet(folder)
    rows = spark.read.schema(rows.schema).parquet(folder)
    newest = tables.newest(batch)
    behind = F.lit(False)
    if newest is not None:
        behind = F.coalesce(F.col("reading_timestamp") < F.lit(newest) - F.expr(f"interval {delay}"), F.lit(False))
    rows.where(behind).write.mode("overwrite").parquet(f"{tables.path}/behind/batch={batch}")

    timely = rows.where(~behind)
    named = timely.where("reading_id is not null")
    # Of copies in one batch the earliest stays, then the smallest: the same one if the batch is repeated.
    first = F.min(F.struct("reading_timestamp", F.struct(*rows.columns).alias("row"))).alias("first")
    once = named.groupBy("reading_id").agg(first).select("first.row.*")
    seen = tables.read("seen", SEEN, batch)
    if newest is not None:
        seen = seen.where(F.col("reading_timestamp").isNull() | (F.col("reading_timestamp") >= F.lit(newest) - F.expr(f"interval {delay}")))
    fresh = once.join(seen.select("reading_id"), "reading_id", "left_anti").select(*rows.columns)
    accepted = fresh.unionByName(timely.where("reading_id is null"))
    kept = f"{tables.path}/accepted"
    accepted.write.mode("overwrite").parquet(kept)
    accepted = spark.read.schema(rows.schema).parquet(kept)
    accepted.where("reading_id is not null").select("reading_id", "reading_timestamp").write.mode("overwrite").parquet(
        f"{tables.path}/seen/batch={batch}"
    )
    meter_days(accepted).write.mode("overwrite").parquet(f"{tables.path}/days/batch={batch}")

    total = rows.agg(F.max("reading_timestamp"), F.count(F.lit(1)), F.count_if(behind)).first()
    taken = accepted.count()
    line = (batch, total[0], total[1], taken, total[1] - total[2] - taken, total[2])
    spark.createDataFrame([line], PROGRESS).coalesce(1).write.mode("overwrite").parquet(f"{tables.path}/progress/batch={batch}")
    for copy in (folder, kept):
        tables.delete(copy)


def run_usage_stream(readings: DataFrame, target_path: str, checkpoint: str, delay: str = LATEST_ARRIVAL) -> None:
    """Take in all rows now available.

    The watermark of a batch is the newest time of all batches before it less ``delay``; rows behind it are set aside
    whole (``rows_behind``). An id counts once among rows that are not behind it; a reading without an id is a row of its
    own, one without a time is never late and belongs to no day. A batch compares its ids with those that the watermark has not passed.
    """
    tables = UsageTables(readings.sparkSession, target_path)

    def load(rows: DataFrame, batch: int) -> None:
        _accept(tables, rows, batch, delay)

    query = (
        readings.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def streamed_daily_usage(spark: SparkSession, target_path: str) -> DataFrame:
    """Daily usage per region with exact distinct counts, open days included."""
    return usage_from_meter_days(merged_days(UsageTables(spark, target_path).read("days", DAYS)))


def rows_behind(spark: SparkSession, target_path: str, schema: str | T.StructType) -> DataFrame:
    """The rows that came behind the watermark, as they were; ``schema`` is that of the stream."""
    return UsageTables(spark, target_path).read("behind", schema)


def usage_progress(spark: SparkSession, target_path: str) -> DataFrame:
    """One row per batch: its newest time so far and how many rows it had, accepted, found repeated, and found behind."""
    return UsageTables(spark, target_path).read("progress", PROGRESS)


def fold_usage(spark: SparkSession, target_path: str, delay: str = LATEST_ARRIVAL) -> None:
    """Merge what all finished batches wrote, so that reading does not slow down; not while the stream runs.

    A fold is complete before what it replaces goes, so a reader or a lost fold sees either. Ids behind the watermark are forgotten.
    """
    tables = UsageTables(spark, target_path)
    finished = [n for _, n, _ in tables.folders("progress")]
    newest = tables.newest()
    if not finished:
        return
    upto = max(finished)
    known = F.lit(True)
    if newest is not None:
        known = F.col("reading_timestamp").isNull() | (F.col("reading_timestamp") >= F.lit(newest) - F.expr(f"interval {delay}"))
    plans = {"days": (DAYS, merged_days), "seen": (SEEN, lambda ids: ids.where(known)), "progress": (PROGRESS, lambda p: p.coalesce(1))}
    for table, (schema, merge) in plans.items():
        old = [p for p in tables.folders(table) if p[1] <= upto]
        if [p for p in old if p[0] == "batch"]:
            merge(tables.read(table, schema, upto + 1)).write.mode("overwrite").parquet(f"{tables.path}/{table}/fold={upto}")
            for _, _, folder in old:
                tables.delete(folder)
