"""Run audits: one row per source and run, written on success and on failure."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.operators.sinks import create_table
from wattline.sources.tables import rows_frame

# The columns of the two audit tables and the outcome words.
LANDING_AUDIT = "bronze_ingestion_audit"
LANDING_AUDIT_COLUMNS = """run_id string, source_name string, target_table string,
    source_path string, file_pattern string, load_type string, status string,
    records_loaded bigint, error_message string, started_at_utc timestamp,
    ended_at_utc timestamp, environment string"""
VALIDATION_AUDIT = "silver_processing_audit"
VALIDATION_AUDIT_COLUMNS = """run_id string, source_table string, clean_table string,
    quarantine_table string, status string, bronze_records bigint, clean_records bigint,
    quarantined_records bigint, duplicate_records bigint, error_message string,
    started_at_utc timestamp, ended_at_utc timestamp, environment string"""
SUCCESS, FAILED = "SUCCESS", "FAILED"
LONGEST_ERROR = 1000


def create_audit_tables(spark: SparkSession, schema: str) -> None:
    create_table(spark, f"{schema}.{LANDING_AUDIT}", LANDING_AUDIT_COLUMNS)
    create_table(spark, f"{schema}.{VALIDATION_AUDIT}", VALIDATION_AUDIT_COLUMNS)


def append_audit(spark: SparkSession, table: str, columns: str, record: dict) -> None:
    rows_frame(spark, [record], columns).coalesce(1).write.insertInto(table)


@contextmanager
def audited(
    spark: SparkSession, table: str, columns: str, counters: tuple[str, ...], **facts: object
) -> Iterator[dict]:
    """Run a step and record how it ended; an error is recorded and raised again.

    The step fills the counters in the record it is given; those it did not reach stay 0.
    """
    record = {
        **facts,
        **dict.fromkeys(counters, 0),
        "status": SUCCESS,
        "error_message": "",
        "started_at_utc": _now(),
    }
    try:
        yield record
    except Exception as error:
        record.update(status=FAILED, error_message=str(error)[:LONGEST_ERROR])
        raise
    finally:
        record["ended_at_utc"] = _now()
        append_audit(spark, table, columns, record)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def audit_of_run(audit: DataFrame, run_id: str) -> DataFrame:
    return audit.filter(F.col("run_id") == run_id).orderBy("started_at_utc")


# --- the ledger of a run ---------------------------------------------------------------------

LEDGER = "run_steps"
LEDGER_COLUMNS = "run_id string, step string, state string, at_utc timestamp"
STARTED, DONE = "STARTED", "DONE"


class RunLedger:
    """Writes down what a run is about to do and what it has done, so that a lost run can go on.

    With ``resume`` a step that this run has finished is not done again; one that was only started is. Steps must bear being
    repeated. Without it every step is done and written down anew.
    """

    def __init__(self, spark: SparkSession, schema: str, run_id: str, resume: bool = False) -> None:
        self.spark, self.table, self.run_id = spark, f"{schema}.{LEDGER}", run_id
        create_table(spark, self.table, LEDGER_COLUMNS)
        finished = spark.table(self.table).where((F.col("run_id") == run_id) & (F.col("state") == DONE))
        self.finished = {row.step for row in finished.select("step").distinct().collect()} if resume else set()

    def do(self, step: str, job: Callable, *args: object) -> bool:
        """Run a step unless this run has finished it; true if it ran."""
        if step in self.finished:
            return False
        self._note(step, STARTED)
        job(*args)
        self._note(step, DONE)
        return True

    def _note(self, step: str, state: str) -> None:
        record = {"run_id": self.run_id, "step": step, "state": state, "at_utc": _now()}
        append_audit(self.spark, self.table, LEDGER_COLUMNS, record)


def unfinished_steps(ledger: DataFrame) -> DataFrame:
    """``run_id, step`` of what was started and never finished."""
    ended = F.max((F.col("state") == DONE).cast("int")).alias("done")
    return ledger.groupBy("run_id", "step").agg(ended).where("done = 0").select("run_id", "step")
