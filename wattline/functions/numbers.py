"""Number helpers. Sums run over decimals, so their result does not depend on task order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT_TYPE = "decimal(24,6)"


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def exact(value: str | Column) -> Column:
    return _col(value).cast(EXACT_TYPE)


def exact_sum(value: str | Column) -> Column:
    return F.sum(exact(value))


def exact_avg(total: str | Column, count: str | Column) -> Column:
    """Mean from an exact sum and a count; null when nothing was counted."""
    counted = F.when(_col(count) > 0, _col(count))
    return (_col(total) / counted.cast("decimal(18,0)")).cast("decimal(38,9)")


def rounded(value: str | Column, digits: int) -> Column:
    """Half-up rounding on decimals, handed back as the double the tables store."""
    return F.round(_col(value).cast("decimal(38,9)"), digits).cast("double")


def pence_to_pounds(value: str | Column) -> Column:
    return F.round(_col(value).try_cast("double") / F.lit(100), 2)
