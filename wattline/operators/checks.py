"""Table checks. Each returns its violations; a report counts them per table and check."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PASS, FAIL, WARN, ERROR = "pass", "fail", "warn", "error"


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their counts. Nulls do not count as equal."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter(F.col("n_records") > 1)


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence[object]) -> DataFrame:
    bad = df.filter(~F.col(column).isin(*accepted))
    return bad.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def orphan_values(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child values without a parent, with the number of child rows.

    Child rows are counted per value before the join, so each value crosses it once.
    """
    used = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    known = parent.select(F.col(parent_column).alias("_known")).distinct()
    return used.join(known, F.col(column) == F.col("_known"), "left_anti")


def below_zero(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) < 0)


def outside_range(df: DataFrame, column: str, lowest: float, highest: float) -> DataFrame:
    return df.filter((F.col(column) < lowest) | (F.col(column) > highest))


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    column: str
    accepted: tuple[str, ...] = ()
    lowest: float = 0
    highest: float = 0
    parent: str = ""
    parent_column: str = ""

    def row_test(self) -> Column | None:
        """The violation as a row test, for checks that look at one row at a time."""
        value = F.col(self.column)
        if self.kind == "not_null":
            return value.isNull()
        if self.kind == "positive_or_zero":
            return value < 0
        if self.kind == "value_between":
            return (value < self.lowest) | (value > self.highest)
        return None

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        df = tables[self.table]
        if self.kind == "not_null":
            return null_rows(df, self.column)
        if self.kind == "unique":
            return repeated_values(df, self.column)
        if self.kind == "accepted_values":
            return unaccepted_values(df, self.column, self.accepted)
        if self.kind == "relationships":
            return orphan_values(df, self.column, tables[self.parent], self.parent_column)
        if self.kind == "positive_or_zero":
            return below_zero(df, self.column)
        if self.kind == "value_between":
            return outside_range(df, self.column, self.lowest, self.highest)
        raise ValueError(f"unknown check: {self.kind}")


def not_null(table: str, *columns: str) -> list[Check]:
    return [Check("not_null", table, c) for c in columns]


def unique(table: str, *columns: str) -> list[Check]:
    return [Check("unique", table, c) for c in columns]


def key(table: str, *columns: str) -> list[Check]:
    return [*not_null(table, *columns), *unique(table, *columns)]


def accepted(table: str, column: str, values: Sequence[str]) -> list[Check]:
    return [Check("accepted_values", table, column, accepted=tuple(values))]


def refers(table: str, column: str, parent: str, parent_column: str | None = None) -> list[Check]:
    return [Check("relationships", table, column, parent=parent, parent_column=parent_column or column)]


def positive(table: str, *columns: str) -> list[Check]:
    return [Check("positive_or_zero", table, c) for c in columns]


def between(table: str, column: str, lowest: float, highest: float) -> list[Check]:
    return [Check("value_between", table, column, lowest=lowest, highest=highest)]


def check_report(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """Violation counts and a status per check.

    All row-wise checks of a table share one scan; the others read their own column.
    Uniqueness and accepted values count offending values, the others offending rows.
    """
    wanted = list(checks)
    parts = []
    for table in dict.fromkeys(c.table for c in wanted):
        by_row = [c for c in wanted if c.table == table and c.row_test() is not None]
        if by_row:
            parts.append(_row_report(tables[table], by_row))
    for check in wanted:
        if check.row_test() is None:
            found = check.violations(tables)
            counts_rows = check.kind == "relationships"
            total = F.coalesce(F.sum("n_records"), F.lit(0)) if counts_rows else F.count(F.lit(1))
            parts.append(
                found.agg(total.alias("violations")).select(
                    F.lit(check.kind).alias("check_name"),
                    F.lit(check.table).alias("table_name"),
                    F.lit(check.column).alias("column_name"),
                    "violations",
                )
            )
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("status", F.when(F.col("violations") == 0, PASS).otherwise(FAIL))


def _row_report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    counts = df.agg(*[F.count_if(c.row_test()).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = F.array(
        *[
            F.struct(
                F.lit(c.kind).alias("check_name"),
                F.lit(c.table).alias("table_name"),
                F.lit(c.column).alias("column_name"),
                F.col(f"c{i}").alias("violations"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return counts.select(F.inline(rows))


class ChecksFailed(RuntimeError):
    """Raised when a run must stop because tables break their checks."""


def require_passed(report: DataFrame) -> None:
    failed = [r for r in report.collect() if r["status"] == FAIL]
    if failed:
        words = "; ".join(f"{r.check_name} {r.table_name}.{r.column_name}: {r.violations}" for r in failed)
        raise ChecksFailed(words)


# The age in days after which a source is reported.
WARN_AFTER_DAYS = 30
ERROR_AFTER_DAYS = 90


def freshness(
    tables: Mapping[str, DataFrame],
    loaded_at: str,
    as_of: datetime,
    warn_after_days: int = WARN_AFTER_DAYS,
    error_after_days: int = ERROR_AFTER_DAYS,
) -> DataFrame:
    """Newest load time per table and whether it is too old; a table without rows is an error."""
    parts = [
        df.agg(F.max(F.col(loaded_at).cast("timestamp")).alias("max_loaded_at")).select(
            F.lit(name).alias("table_name"), "max_loaded_at"
        )
        for name, df in tables.items()
    ]
    newest = reduce(DataFrame.unionByName, parts)
    now = F.lit(as_of).cast("timestamp")
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now)
    day = 24 * 60 * 60
    return newest.select(
        "table_name",
        "max_loaded_at",
        F.when(age <= warn_after_days * day, PASS)
        .when(age <= error_after_days * day, WARN)
        .otherwise(ERROR)
        .alias("status"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts by table name."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts).orderBy("table_name")
