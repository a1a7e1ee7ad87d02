"""Watermarks, key upserts and column sync."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.operators.skew import BROADCAST_ROWS, broadcast_within

# Fixed value: the watermark of a table that has no rows yet.
FIRST_DAY = date(1900, 1, 1)


def high_watermark(target: DataFrame, column: str) -> date | datetime:
    """The largest value of a column, or the first day when there is none."""
    newest = target.agg(F.max(column)).first()[0]
    if newest is not None:
        return newest
    is_date = isinstance(target.schema[column].dataType, T.DateType)
    return FIRST_DAY if is_date else datetime(FIRST_DAY.year, FIRST_DAY.month, FIRST_DAY.day)


def newer_rows(rows: DataFrame, target: DataFrame | None, column: str, lookback_days: int = 0) -> DataFrame:
    """Rows at or after the target's watermark; all of them on a first build.

    The watermark is one value and enters the plan as a literal, so the scan can skip
    files and partitions by it.
    """
    if target is None:
        return rows
    since = high_watermark(target, column) - timedelta(days=lookback_days)
    return rows.filter(F.col(column) >= F.lit(since))


def sync_columns(target: DataFrame, schema: T.StructType) -> DataFrame:
    """Give a table the columns of a batch: new ones as nulls, vanished ones dropped."""
    return target.select(
        *[
            F.col(f.name).cast(f.dataType).alias(f.name)
            if f.name in target.columns
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def repeated_keys(batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    return batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)


def require_unique(batch: DataFrame, keys: Sequence[str]) -> None:
    """Stop when two rows of a batch would update the same target row."""
    found = repeated_keys(batch, keys).head(1)
    if found:
        raise ValueError(f"batch repeats key {found[0].asDict()}")


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: str | Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
    delete_missing: bool = False,
) -> DataFrame:
    """The target after replacing rows with the batch's keys and adding new ones.

    Null keys match each other. Nothing is deleted unless ``delete_missing`` is set, in
    which case the batch is taken as the whole truth.
    """
    if delete_missing:
        return batch
    names = [keys] if isinstance(keys, str) else list(keys)
    batch_keys = batch.select(*[F.col(k).alias(f"_key_{k}") for k in names])
    kept = sync_columns(target, batch.schema).join(
        broadcast_within(batch_keys, broadcast_rows), null_safe_match(names), "left_anti"
    )
    return kept.unionByName(batch)


def null_safe_match(names: Sequence[str]) -> Column:
    """Keys and their ``_key_`` copies are the same, nulls included."""
    match = F.col(names[0]).eqNullSafe(F.col(f"_key_{names[0]}"))
    for name in names[1:]:
        match = match & F.col(name).eqNullSafe(F.col(f"_key_{name}"))
    return match
