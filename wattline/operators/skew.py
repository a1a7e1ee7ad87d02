"""Joins and groupings that stay even when one key holds a large share of the rows.

Two measurements steer the choice of plan, and both are cheap: the row count of a lookup
table, and the row counts per key of the large side (one column read, combined before it
is shuffled).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup is broadcast only when it has been counted and is at most this long.
BROADCAST_ROWS = 200_000
# A key is hot when it has more rows than one task should sort or join.
HOT_GROUP_ROWS = 1_000_000
SAMPLED_ROWS_OF_A_HOT_KEY = 10_000
# At most this many keys can be hot, because a hot key also holds at least 1/limit of all rows.
HOT_KEY_LIMIT = 10_000
# Into so many shares the rows of a hot key are dealt where its lookup rows are repeated.
SALTS = 64


def all_present(names: Sequence[str]) -> Column:
    test = F.col(names[0]).isNotNull()
    for name in names[1:]:
        test = test & F.col(name).isNotNull()
    return test


def broadcast_within(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a frame for broadcast after counting it; leave a longer one to Spark's own choice."""
    return F.broadcast(df) if df.count() <= rows else df


def hot_keys(
    df: DataFrame,
    keys: Sequence[str],
    floor: int = HOT_GROUP_ROWS,
    limit: int = HOT_KEY_LIMIT,
) -> DataFrame | None:
    """The keys too large for one task, or None. Always fewer than ``limit`` rows.

    Only the key columns are read. Against a large floor the counts come from a sample, in
    which a key at the floor still has some ten thousand rows and cannot be missed. The
    counts decide which plan runs; every row goes through that plan. The list is fetched
    once, so all uses in a plan agree on it.
    """
    fraction = min(1.0, SAMPLED_ROWS_OF_A_HOT_KEY / floor)
    key_rows = df.filter(all_present(keys)).select(*keys)
    if fraction < 1.0:
        key_rows = key_rows.sample(fraction, seed=7)
    counts = key_rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total, largest = counts.agg(F.sum("_rows"), F.max("_rows")).first()
    if not total:
        return None
    threshold = max(floor * fraction * (1.0 if fraction == 1.0 else 0.9), total / limit)
    if largest <= threshold:
        return None
    found = counts.filter(F.col("_rows") > threshold).select(*keys)
    return df.sparkSession.createDataFrame(found.collect(), found.schema)


def _fetch_bounded(df: DataFrame, rows: int) -> DataFrame:
    """Read a few rows once; more than allowed means that the lookup repeats its keys."""
    found = df.limit(rows + 1).collect()
    if len(found) > rows:
        raise ValueError(f"a lookup has more than {rows} rows for a few hot keys: keys must not repeat")
    return df.sparkSession.createDataFrame(found, df.schema)


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_GROUP_ROWS,
    lookup_rows: int | None = None,
) -> DataFrame:
    """Left join to a table with one row per key, without sending a hot key to one task.

    * A short lookup (counted first) is broadcast, so ``rows`` is not shuffled at all.
    * Against a long lookup, hot keys get their values from a broadcast of just those keys.
      Their rows, and rows without a key, then need no partner: they are spread by their
      content over all tasks, while the other rows are shuffled to their key. Spark is told to
      merge: it estimates a saved table by its compressed files, where millions of keys take
      a few MB, and would send them all through the driver.

    ``rows`` is read once in either case. ``lookup_rows`` gives a row count that was measured
    already, for instance that of the saved table from which the lookup is derived row by row.
    """
    keys = [on] if isinstance(on, str) else list(on)
    added = [c for c in lookup.columns if c not in keys]
    names = [*rows.columns, *added]
    if rows.isStreaming:
        # A stream cannot be measured ahead; its batches join as Spark plans them.
        return rows.join(lookup, keys, "left").select(*names)
    if (lookup.count() if lookup_rows is None else lookup_rows) <= broadcast_rows:
        return rows.join(F.broadcast(lookup), keys, "left").select(*names)

    settled = ~all_present(keys)
    hot = hot_keys(rows, keys, floor=hot_rows)
    wide = rows
    if hot is not None:
        values = _fetch_bounded(lookup.join(F.broadcast(hot), keys, "left_semi"), BROADCAST_ROWS)
        answers = hot.join(values, keys, "left").select(
            *keys, *[F.col(c).alias(f"_hot_{c}") for c in added], F.lit(True).alias("_hot")
        )
        wide = rows.join(F.broadcast(answers), keys, "left")
        settled = settled | F.col("_hot").isNotNull()

    # Lookup rows all have spread 0. It is computed from the key, so that it stays a join
    # column and with it part of the shuffle.
    spread = F.when(settled, F.xxhash64(*[F.col(c) for c in rows.columns])).otherwise(F.lit(0))
    side = wide.withColumns(
        {"_spread": spread, **{f"_on_{i}": F.when(~settled, F.col(k)) for i, k in enumerate(keys)}}
    )
    partner = lookup.filter(all_present(keys)).select(
        *[F.col(k).alias(f"_to_{i}") for i, k in enumerate(keys)],
        F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(1)).alias("_zero"),
        *[F.col(c).alias(f"_new_{c}") for c in added],
    )
    # The keys come before the spread: rows are sorted by the first column of the join.
    match = F.col("_on_0") == F.col("_to_0")
    for i in range(1, len(keys)):
        match = match & (F.col(f"_on_{i}") == F.col(f"_to_{i}"))
    match = match & (F.col("_spread") == F.col("_zero"))
    joined = side.join(partner.hint("merge"), match, "left")

    def value(name: str) -> Column:
        if hot is None:
            return F.col(f"_new_{name}").alias(name)
        return F.when(F.col("_hot"), F.col(f"_hot_{name}")).otherwise(F.col(f"_new_{name}")).alias(name)

    return joined.select(*rows.columns, *[value(c) for c in added])


def salted_lookup(
    rows: DataFrame,
    lookup: DataFrame,
    on: str,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_GROUP_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Left join in which null keys match each other and a lookup key may repeat.

    A short lookup (counted first) is broadcast. Against a longer one, rows of a hot key, and rows without a key, get one of
    ``salts`` numbers by their content, and the lookup rows of these keys are repeated once per number, so no task
    gets more than a share of them. Other lookup rows stay single.
    """
    added = [c for c in lookup.columns if c != on]
    partner = lookup.withColumnRenamed(on, "_to")
    if lookup.count() <= broadcast_rows:
        joined = rows.join(F.broadcast(partner), F.col(on).eqNullSafe(F.col("_to")), "left")
        return joined.select(*rows.columns, *added)
    hot = hot_keys(rows, [on], floor=hot_rows)
    spread, repeated = F.col(on).isNull(), F.col("_to").isNull()
    side = rows
    if hot is not None:
        marks = hot.select(F.col(on).alias("_hot"))
        side = side.join(F.broadcast(marks), F.col(on) == F.col("_hot"), "left")
        spread = spread | F.col("_hot").isNotNull()
        partner = partner.join(F.broadcast(marks), F.col("_to") == F.col("_hot"), "left")
        repeated = repeated | F.col("_hot").isNotNull()
    number = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(salts)).cast("int")
    side = side.withColumn("_salt", F.when(spread, number).otherwise(F.lit(0))).select(*rows.columns, "_salt")
    numbers = F.when(repeated, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    partner = partner.withColumn("_number", F.explode(numbers)).select("_to", "_number", *added)
    match = F.col(on).eqNullSafe(F.col("_to")) & (F.col("_salt") == F.col("_number"))
    return side.join(partner, match, "left").select(*rows.columns, *added)


def flag_unknown_keys(
    df: DataFrame,
    reference: DataFrame,
    on: str,
    flag: str,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Flag rows whose key is set but absent from the reference table. Null keys pass."""
    keys = reference.select(on)
    # Counting with repeats avoids a shuffle and can only overstate the distinct keys.
    found = keys.count()
    known = keys.filter(F.col(on).isNotNull()).distinct().withColumn("_known", F.lit(True))
    joined = lookup_join(df, known, on, broadcast_rows, hot_rows, lookup_rows=found)
    return joined.withColumn(flag, F.col(on).isNotNull() & F.col("_known").isNull()).drop("_known")
