"""Landing tables to validated tables, one pass per source."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.operators.audit import VALIDATION_AUDIT, VALIDATION_AUDIT_COLUMNS, audited
from wattline.operators.rules import REFERENCE, Rule, RuleSet
from wattline.operators.sinks import (
    create_table,
    in_partitions,
    overwrite_partitions,
    publish,
    save_table,
    widen,
    written,
)
from wattline.operators.skew import BROADCAST_ROWS, lookup_join
from wattline.operators.validate import (
    CLEAN,
    QUARANTINED,
    flag_copies,
    flag_references,
    flag_rows,
    flag_values,
    judged_rows,
    standardise,
    verdict,
    view_of_clean,
    view_of_quarantined,
)
from wattline.plans.build import Build
from wattline.session import shared_folder
from wattline.sources.tables import POSITION, read_table, with_position

JUDGED_FILES = "file_path string, run_id string"
#: Up to so many new files are named in the plan of a run.
LISTED_FILES = 10_000
COUNTERS = ("bronze_records", "clean_records", "quarantined_records", "duplicate_records")


@contextmanager
def _recorded(
    spark: SparkSession, rules: RuleSet, landing: str, schema: str, audit_schema: str, run: Build
) -> Iterator[dict]:
    facts = {
        "run_id": run.run_id,
        "source_table": f"{landing}.{rules.source}_raw",
        "clean_table": f"{schema}.{rules.source}_clean",
        "quarantine_table": f"{schema}.{rules.source}_quarantine",
        "environment": run.environment,
    }
    table = f"{audit_schema}.{VALIDATION_AUDIT}"
    with audited(spark, table, VALIDATION_AUDIT_COLUMNS, COUNTERS, **facts) as record:
        yield record


def validate_source(
    spark: SparkSession, rules: RuleSet, landing: str, schema: str, audit_schema: str, run: Build
) -> dict:
    """Judge every row of a source and publish its clean and its quarantined rows.

    Scan, duplicate window and reference joins run once: both outcomes are written together,
    in one folder each, and the two public tables are views on them. Counts come from the
    written files.
    """
    with _recorded(spark, rules, landing, schema, audit_schema, run) as record:
        raw = read_table(spark, record["source_table"])
        record["bronze_records"] = raw.count()
        references = {
            r.reference: read_table(spark, f"{schema}.{r.reference}") for r in rules.of_kind(REFERENCE)
        }
        flagged = flag_rows(standardise(with_position(raw), rules), rules, run.as_of, references)
        judged_table = f"{schema}.{rules.source}_judged"
        publish(judged_rows(flagged, rules, run.as_of), judged_table, run.run_id, ["verdict"])
        record.update(_show_outcome(spark, rules, schema, judged_table))
    return record


def validate_new_rows(
    spark: SparkSession, rules: RuleSet, landing: str, schema: str, audit_schema: str, run: Build
) -> dict:
    """Judge the rows that were loaded since the last run; earlier verdicts stay.

    An earlier row is judged again only where its verdict can differ: when a new row has its key, when it was
    ahead of the clock, or when a key it refers to has come into a reference table or left it since. Rows are kept by
    day, and only days with such rows are rewritten. The outcome is that of judging the whole landing table, but for the processing times.

    New are the rows of landed files that no finished run has judged, whatever time their load
    carries: loads may share a time or come late. Files and reference keys are recorded after the rows are
    saved; what a lost run left behind is judged again and replaced.
    """
    if not rules.day:
        raise ValueError(f"{rules.source} cannot be judged load by load")
    table = f"{schema}.{rules.source}_verdicts"
    with _recorded(spark, rules, landing, schema, audit_schema, run) as record:
        raw = read_table(spark, record["source_table"])
        log = f"{table}_files"
        create_table(spark, log, JUDGED_FILES)
        references = {r.reference: read_table(spark, f"{schema}.{r.reference}") for r in rules.of_kind(REFERENCE)}
        fresh_files = _written(raw.select(F.col("_metadata.file_path").alias("file_path")).distinct().join(
            spark.table(log), "file_path", "left_anti"
        ), "new-files")
        positioned = _rows_of_files(raw, fresh_files)
        if spark.catalog.tableExists(table):
            _judge_growth(spark, rules, table, positioned, fresh_files, references, run)
        else:
            flagged = flag_rows(standardise(positioned, rules), rules, run.as_of, references)
            first = _all_verdicts(flagged, rules, run)
            save_table(first.hint("rebalance", rules.day), table, "errorifexists", [rules.day])
        fresh_files.select("file_path", F.lit(run.run_id).alias("run_id")).write.insertInto(log)
        for rule in rules.of_kind(REFERENCE):
            publish(_reference_keys(references, rule), _key_table(table, rule), run.run_id)
        record.update(_show_outcome(spark, rules, schema, table))
        record["bronze_records"] = spark.table(table).count()
    return record


def _written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder: later steps agree on them."""
    folder = shared_folder(df.sparkSession, purpose)
    return written(df, folder)


def _rows_of_files(raw: DataFrame, files: DataFrame) -> DataFrame:
    """The rows of some files. Up to ``LISTED_FILES`` names go into the plan, so other files are not opened; more are joined."""
    names = [row.file_path for row in files.limit(LISTED_FILES + 1).collect()]
    if len(names) <= LISTED_FILES:
        return with_position(raw.filter(F.col("_metadata.file_path").isin(names)))
    wanted = files.select(F.xxhash64("file_path").alias(POSITION[0])).distinct()
    return with_position(raw).join(wanted, POSITION[0], "left_semi")


def _reference_rows(references: Mapping[str, DataFrame], rule: Rule) -> DataFrame:
    return references[rule.reference].select(rule.column).where(F.col(rule.column).isNotNull())


def _reference_keys(references: Mapping[str, DataFrame], rule: Rule) -> DataFrame:
    return _reference_rows(references, rule).distinct()


def _key_table(table: str, rule: Rule) -> str:
    return f"{table}_{rule.column}_known"


def _changed_keys(spark: SparkSession, table: str, rule: Rule, references: Mapping[str, DataFrame]) -> DataFrame:
    """The keys that came into a reference table or left it since the last finished run.

    They are grouped, not joined: each table is read and shuffled once, and no side can be broadcast.
    """
    name = _key_table(table, rule)
    if not spark.catalog.tableExists(name):
        return _reference_keys(references, rule)
    now, before = _reference_rows(references, rule), spark.table(name)
    sides = now.withColumn("_now", F.lit(True)).unionByName(before.withColumn("_now", F.lit(False)))
    seen = sides.groupBy(rule.column).agg(F.bool_or("_now").alias("_is"), F.bool_and("_now").alias("_only"))
    # In one of the two tables alone: now only, or not now.
    return _written(seen.filter("_only or not _is").select(rule.column), "changed-keys")


def _all_verdicts(flagged: DataFrame, rules: RuleSet, run: Build) -> DataFrame:
    """Judged rows, also those without a verdict: they may get one later."""
    return flagged.withColumns(
        {
            "verdict": verdict(rules.flags, rules.null_verdict),
            "processed_at_utc": F.lit(run.as_of).cast("timestamp"),
        }
    )


def _judge_growth(
    spark: SparkSession,
    rules: RuleSet,
    table: str,
    positioned: DataFrame,
    fresh_files: DataFrame,
    references: Mapping[str, DataFrame],
    run: Build,
) -> None:
    """``positioned`` are the rows of ``fresh_files``, of which a lost run may have left some in the table."""
    day, file = rules.day, POSITION[0]
    fresh = standardise(positioned, rules)
    widen(spark, table, fresh.schema)
    saved = spark.table(table)
    again = fresh_files.select(F.xxhash64("file_path").alias(file)).distinct()
    known, lost = saved.join(again, file, "left_anti"), saved.join(again, file, "left_semi")

    renewed = fresh.select(rules.key).filter(F.col(rules.key).isNotNull()).distinct()
    # What must be judged again is found on narrow rows; the wide ones meet it by their position.
    references_used = [rule.column for rule in rules.of_kind(REFERENCE)]
    narrow = known.select(*dict.fromkeys([*POSITION, rules.key, day, *rules.clock_flags, *references_used]))
    marked = lookup_join(narrow, renewed.withColumn("_renewed", F.lit(True)), rules.key)
    due = F.lit(False)
    for flag in rules.clock_flags:
        due = due | F.coalesce(F.col(flag), F.lit(False))
    for rule in rules.of_kind(REFERENCE):
        moved = _changed_keys(spark, table, rule, references).withColumn(f"_{rule.column}_moved", F.lit(True))
        marked = lookup_join(marked, moved, rule.column)
        due = due | F.col(f"_{rule.column}_moved").isNotNull()
    flags = marked.select(*POSITION, F.col(day).alias("_day"), F.col("_renewed").isNotNull().alias("_renewed"), due.alias("_due"))
    marks = _written(flags.filter("_renewed or _due"), "marks")
    touched = {
        row[0] for row in fresh.select(day).union(lost.select(day)).union(marks.select("_day")).distinct().collect()
    }
    if not touched:
        return

    marks = marks.drop("_day")
    short = marks.count() <= BROADCAST_ROWS
    marks = F.broadcast(marks) if short else marks.hint("merge")
    near = known.filter(in_partitions(day, touched)).join(marks, list(POSITION), "left")
    near = near.fillna(False, ["_renewed", "_due"])
    if not short:
        near = _written(near, "marked")
    copies = near.filter("_renewed").select(*fresh.columns).unionByName(fresh)
    ranked = flag_copies(copies, rules)
    waiting = near.filter("_due and not _renewed").select(*ranked.columns)
    judged = flag_references(ranked.unionByName(waiting), rules, references)
    again = _all_verdicts(flag_values(judged, rules, run.as_of), rules, run)
    kept = near.filter("not _renewed and not _due").select(*saved.columns)
    overwrite_partitions(spark, table, kept.unionByName(again.select(*saved.columns)), day, touched)


def _show_outcome(spark: SparkSession, rules: RuleSet, schema: str, judged_table: str) -> dict:
    """Point the two public tables at the judged rows and count them."""
    judged = spark.table(judged_table)
    clean, quarantine = f"{schema}.{rules.source}_clean", f"{schema}.{rules.source}_quarantine"
    _view(spark, clean, view_of_clean(judged, rules).columns, judged_table, CLEAN)
    _view(spark, quarantine, view_of_quarantined(judged).columns, judged_table, QUARANTINED)
    counts = judged.agg(
        F.count_if(F.col("verdict") == CLEAN).alias("clean_records"),
        F.count_if(F.col("verdict") == QUARANTINED).alias("quarantined_records"),
        F.count_if(F.col(rules.duplicate_flag)).alias("duplicate_records"),
    )
    return counts.first().asDict()


def _view(spark: SparkSession, name: str, columns: list[str], table: str, outcome: str) -> None:
    shown = {"silver_processed_at_utc": "processed_at_utc", "quarantined_at_utc": "processed_at_utc"}
    listed = ", ".join(f"`{shown[c]}` AS `{c}`" if c in shown else f"`{c}`" for c in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {listed} FROM {table} WHERE verdict = '{outcome}'")
