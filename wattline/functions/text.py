"""Trimming, blank tests and casts that turn malformed text into null."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_blank(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) == "")


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip spaces around every string column in a single projection."""
    return df.select(
        *[
            F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; a value that does not parse becomes null, never an error."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def ensure_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Add the named columns as nulls where a batch from before a schema change lacks them."""
    missing = {name: F.lit(None).cast(kind) for name, kind in types.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df
