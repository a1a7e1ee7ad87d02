"""Surrogate keys and the load columns every model carries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Existing keys only match when these two texts stay as they are.
KEY_SEPARATOR = "||"
NULL_PART = "__null__"


def surrogate_key(*parts: str | Column) -> Column:
    """SHA-256 hex text over the parts, with a placeholder for null parts."""
    if not parts:
        raise ValueError("a surrogate key needs at least one column")
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    texts = [F.coalesce(c.cast("string"), F.lit(NULL_PART)) for c in columns]
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *texts), 256)


# The columns that a build stamps on its rows.
LOAD_AUDIT = ("dbt_loaded_at", "dbt_invocation_id")


def load_audit_columns(df: DataFrame, loaded_at: datetime, invocation_id: str) -> DataFrame:
    """Stamp rows with the time and id of the build; both are given, so reruns agree."""
    return df.withColumns(
        {
            LOAD_AUDIT[0]: F.lit(loaded_at).cast("timestamp"),
            LOAD_AUDIT[1]: F.lit(invocation_id),
        }
    )
