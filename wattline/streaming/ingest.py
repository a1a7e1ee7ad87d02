"""Incremental file ingest: each raw file is loaded once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wattline.plans.build import Build
from wattline.plans.landing import lineage_columns
from wattline.sources.registry import Source


def ingest_new_files(
    spark: SparkSession,
    source: Source,
    raw_base: str,
    target_path: str,
    checkpoint: str,
    run: Build,
    files_per_batch: int = 1000,
) -> None:
    """Load the files that arrived since the last call, then stop.

    The stream carries file paths only (content is not read to list them), so its log
    remembers which files were loaded. Each batch reads its files with the source's own
    reader and overwrites the folder of its batch number, so a batch repeated after a
    failure replaces what it wrote before.
    """

    def load(paths: DataFrame, batch: int) -> None:
        files = [row.path for row in paths.select("path").collect()]
        if files:
            rows = lineage_columns(source.read(spark, files), source.name, run)
            rows.write.mode("overwrite").parquet(f"{target_path}/batch={batch}")

    arrivals = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source.path(raw_base))
        .select("path")
    )
    query = (
        arrivals.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_ingested(spark: SparkSession, target_path: str) -> DataFrame:
    """Everything loaded so far; columns that came later are null in earlier batches."""
    return spark.read.option("mergeSchema", True).parquet(target_path).drop("batch")
