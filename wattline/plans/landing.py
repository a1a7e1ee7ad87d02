"""Raw files to landing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.operators.audit import LANDING_AUDIT, LANDING_AUDIT_COLUMNS, audited
from wattline.operators.sinks import INCREMENTAL, land_table
from wattline.plans.build import Build
from wattline.session import shared_folder
from wattline.sources.csv import list_files, unseen_files
from wattline.sources.registry import Source

FILE_LOG = "loaded_files"
FILE_LOG_COLUMNS = "source_name string, file_path string, run_id string"


def lineage_columns(raw: DataFrame, source: str, run: Build) -> DataFrame:
    """Where a row came from and when; all rows of one load carry the same time."""
    return raw.withColumns(
        {
            "_source_name": F.lit(source),
            "_source_file_path": F.col("source_file_name"),
            "_ingested_at_utc": F.lit(run.as_of).cast("timestamp"),
            "_run_id": F.lit(run.run_id),
            "_environment": F.lit(run.environment),
        }
    )


def land_source(
    spark: SparkSession, source: Source, raw_base: str, schema: str, audit_schema: str, run: Build
) -> int:
    """Load one source into its landing table and record the run.

    An incremental source loads only files that no earlier run has recorded. Their paths pass
    through the driver, which lists files for any scan; a long backlog is better loaded in
    portions by the file stream. Files are
    recorded after their rows are saved, so a run that fails in between loads them again
    and the duplicate flags of the next step keep the newest copy.
    """
    target = f"{schema}.{source.landing_table}"
    path = source.path(raw_base)
    with audited(
        spark,
        f"{audit_schema}.{LANDING_AUDIT}",
        LANDING_AUDIT_COLUMNS,
        ("records_loaded",),
        run_id=run.run_id,
        source_name=source.name,
        target_table=target,
        source_path=path,
        file_pattern=source.pattern,
        load_type=source.load_type,
        environment=run.environment,
    ) as record:
        if source.load_type != INCREMENTAL:
            land_table(lineage_columns(source.read(spark, path), source.name, run), target, source.load_type)
            record["records_loaded"] = spark.table(target).count()
        else:
            log = f"{audit_schema}.{FILE_LOG}"
            seen = spark.table(log).filter(F.col("source_name") == source.name)
            arrivals = _fixed_list(unseen_files(list_files(spark, path), seen), source.name, run)
            fresh = [row.file_path for row in arrivals.select("file_path").collect()]
            if fresh:
                land_table(lineage_columns(source.read(spark, fresh), source.name, run), target, source.load_type)
                arrivals.write.insertInto(log)
                loaded = spark.table(target).filter(F.col("_run_id") == run.run_id)
                record["records_loaded"] = loaded.count()
    return record["records_loaded"]


def _fixed_list(files: DataFrame, source: str, run: Build) -> DataFrame:
    """The files of this load, written down before it starts: later arrivals wait for the next."""
    spark, folder = files.sparkSession, shared_folder(files.sparkSession, "arrivals")
    listed = files.select(F.lit(source).alias("source_name"), "file_path", F.lit(run.run_id).alias("run_id"))
    listed.write.parquet(folder)
    return spark.read.schema(FILE_LOG_COLUMNS).parquet(folder)
