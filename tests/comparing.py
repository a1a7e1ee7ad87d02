"""Helpers that several test files use."""

from __future__ import annotations


def rows(df, *columns):
    """Rows as sorted tuples, so that comparisons do not depend on order."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))
