"""Flag, explain and split rows by rule set; summaries of the outcome and input profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.functions import cast_columns, ensure_columns, trim_strings
from wattline.operators.dedup import flag_duplicates
from wattline.operators.rules import NULL_DROPS, NULL_PASSES, PREDICATE, REFERENCE, RuleSet
from wattline.operators.skew import BROADCAST_ROWS, HOT_GROUP_ROWS, flag_unknown_keys
from wattline.sources.tables import POSITION

CLEAN, QUARANTINED = "clean", "quarantine"


def standardise(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Add columns that came with later files, trim all text and cast by name."""
    return cast_columns(trim_strings(ensure_columns(df, rules.late_columns)), rules.casts)


def flag_rows(
    df: DataFrame,
    rules: RuleSet,
    as_of: datetime,
    references: Mapping[str, DataFrame] | None = None,
    position: Sequence[str] = POSITION,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """One boolean column per rule and the joined messages of those that are true."""
    flagged = flag_copies(df, rules, position, hot_rows)
    return flag_values(flag_references(flagged, rules, references, broadcast_rows, hot_rows), rules, as_of)


def flag_references(
    df: DataFrame,
    rules: RuleSet,
    references: Mapping[str, DataFrame] | None,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Flag keys that the tables they refer to do not have."""
    for rule in rules.of_kind(REFERENCE):
        reference = (references or {}).get(rule.reference)
        if reference is None:
            raise ValueError(f"rules of {rules.source} need the reference table {rule.reference}")
        df = flag_unknown_keys(df, reference, rule.column, rule.flag, broadcast_rows, hot_rows)
    return df


def flag_copies(
    df: DataFrame, rules: RuleSet, position: Sequence[str] = POSITION, hot_rows: int = HOT_GROUP_ROWS
) -> DataFrame:
    """Rank the copies of each key and flag all but the newest."""
    return flag_duplicates(
        df, rules.key, rules.duplicate_flag, rules.newest_by, rules.rank, position, hot_rows
    )


def flag_values(df: DataFrame, rules: RuleSet, as_of: datetime) -> DataFrame:
    """Flags that depend on the row alone, and the joined messages of all true flags."""
    flagged = df.withColumns({rule.flag: rule.test(as_of) for rule in rules.of_kind(PREDICATE)})
    return flagged.withColumn("quarantine_reason", reason_text({r.flag: r.message for r in rules.rules}))


def reason_text(messages: Mapping[str, str]) -> Column:
    """Messages of the true flags, in the given order; empty text when there is none."""
    return F.concat_ws("; ", *[F.when(F.col(flag), F.lit(text)) for flag, text in messages.items()])


def verdict(flags: Sequence[str], null_verdict: str = NULL_PASSES) -> Column:
    """``quarantine`` if a flag is true, else ``clean``.

    Under the dropping rule a row with no true flag and a null one gets no verdict at all.
    """
    if null_verdict not in (NULL_PASSES, NULL_DROPS):
        raise ValueError(f"unknown null verdict: {null_verdict}")
    tests = [F.col(f) if null_verdict == NULL_DROPS else F.coalesce(F.col(f), F.lit(False)) for f in flags]
    faulty = reduce(lambda a, b: a | b, tests)
    return F.when(faulty, F.lit(QUARANTINED)).when(~faulty, F.lit(CLEAN))


def clean_rows(flagged: DataFrame, rules: RuleSet, processed_at: datetime) -> DataFrame:
    kept = flagged.filter(verdict(rules.flags, rules.null_verdict) == CLEAN)
    return _as_clean(kept, rules, processed_at)


def quarantined_rows(flagged: DataFrame, rules: RuleSet, processed_at: datetime) -> DataFrame:
    kept = flagged.filter(verdict(rules.flags, rules.null_verdict) == QUARANTINED)
    return _without_position(kept).withColumn("quarantined_at_utc", F.lit(processed_at).cast("timestamp"))


def split_rows(flagged: DataFrame, rules: RuleSet, processed_at: datetime) -> tuple[DataFrame, DataFrame]:
    return clean_rows(flagged, rules, processed_at), quarantined_rows(flagged, rules, processed_at)


def judged_rows(flagged: DataFrame, rules: RuleSet, processed_at: datetime) -> DataFrame:
    """Both outcomes in one frame with a ``verdict`` column, to be written in a single pass."""
    at = F.lit(processed_at).cast("timestamp")
    return (
        _without_position(flagged)
        .withColumns({"verdict": verdict(rules.flags, rules.null_verdict), "processed_at_utc": at})
        .filter(F.col("verdict").isNotNull())
    )


def view_of_clean(judged: DataFrame, rules: RuleSet) -> DataFrame:
    return (
        judged.filter(F.col("verdict") == CLEAN)
        .drop("verdict", *rules.clean_drops, *POSITION)
        .withColumnRenamed("processed_at_utc", "silver_processed_at_utc")
    )


def view_of_quarantined(judged: DataFrame) -> DataFrame:
    return (
        judged.filter(F.col("verdict") == QUARANTINED)
        .drop("verdict", *POSITION)
        .withColumnRenamed("processed_at_utc", "quarantined_at_utc")
    )


def _as_clean(kept: DataFrame, rules: RuleSet, processed_at: datetime) -> DataFrame:
    at = F.lit(processed_at).cast("timestamp")
    return _without_position(kept).drop(*rules.clean_drops).withColumn("silver_processed_at_utc", at)


def _without_position(df: DataFrame) -> DataFrame:
    return df.drop(*POSITION)


def validate(
    raw: DataFrame,
    rules: RuleSet,
    as_of: datetime,
    references: Mapping[str, DataFrame] | None = None,
    position: Sequence[str] = POSITION,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A source from raw text to clean rows, quarantined rows and the four counts."""
    flagged = flag_rows(standardise(raw, rules), rules, as_of, references, position)
    clean, quarantined = split_rows(flagged, rules, as_of)
    return clean, quarantined, outcome_counts(flagged, rules)


def outcome_counts(flagged: DataFrame, rules: RuleSet) -> DataFrame:
    """Input, clean, quarantined and duplicate counts in one pass."""
    outcome = verdict(rules.flags, rules.null_verdict)
    return flagged.agg(
        F.count(F.lit(1)).alias("bronze_records"),
        F.count_if(outcome == CLEAN).alias("clean_records"),
        F.count_if(outcome == QUARANTINED).alias("quarantined_records"),
        F.count_if(F.col(rules.duplicate_flag)).alias("duplicate_records"),
    )


def quarantine_summary(quarantined: DataFrame) -> DataFrame:
    return (
        quarantined.groupBy("quarantine_reason")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "quarantine_reason")
    )


def input_profile(df: DataFrame, tests: Mapping[str, Column], duplicates: str = "duplicate_rows") -> DataFrame:
    """Count rows, rows meeting each test, and repeats of whole rows.

    Equal rows are counted together before anything moves, so a row copied many times
    costs one record per task.
    """
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return counted.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total_rows"),
        *[
            F.coalesce(F.sum(F.when(test, F.col("_copies"))), F.lit(0)).alias(name)
            for name, test in tests.items()
        ],
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias(duplicates),
    )


def readings_profile(readings: DataFrame, as_of: datetime, outlier_kwh: float = 100) -> DataFrame:
    return input_profile(
        readings,
        {
            "missing_customer_id": F.col("customer_id").isNull(),
            "missing_meter_id": F.col("meter_id").isNull(),
            "negative_consumption": F.col("consumption_kwh") < 0,
            "consumption_outliers": F.col("consumption_kwh") > outlier_kwh,
            "future_timestamps": F.col("reading_timestamp") > F.lit(as_of),
        },
    )


def billing_profile(billing: DataFrame, high_amount: float = 1000) -> DataFrame:
    return input_profile(
        billing,
        {
            "missing_tariff_id": F.col("tariff_id").isNull(),
            "negative_amounts": F.col("total_amount") < 0,
            "high_amounts": F.col("total_amount") > high_amount,
        },
    )


def drift_profile(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Which of the expected columns the data has."""
    present = set(df.columns)
    rows = [(name, name in present) for name in expected]
    return df.sparkSession.createDataFrame(rows, "column_name string, is_present boolean")
