"""Duplicate flags and latest-row selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattline.operators.skew import HOT_GROUP_ROWS, all_present, hot_keys
from wattline.session import shared_folder
from wattline.sources.tables import POSITION


def flag_duplicates(
    df: DataFrame,
    keys: str | Sequence[str],
    flag: str,
    newest_by: str,
    rank: str = "_duplicate_rank",
    position: Sequence[str] = POSITION,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Number the rows of each key from newest to oldest and flag all but the first.

    Times tie within one load, so rows are ordered by time and then by ``position``:
    columns that together identify a row, the last one a whole number (by default where
    the row lies in its file). Rows with a null key are never flagged; each is its own
    group, so they spread over all tasks.

    A key with more than ``hot_rows`` rows is numbered in pieces of bounded length: a piece
    is one time, one file and one run of positions. The number of a row is its number
    within its piece plus the rows of all earlier pieces. Rows without ``position`` are
    written to the shared folder first if a key is that large, and their places in that copy stand in for it.
    """
    key_names = [keys] if isinstance(keys, str) else list(keys)
    positions = [c for c in position if c in df.columns]
    if positions and len(positions) != len(position):
        raise ValueError(f"position columns {list(position)} are only partly present")

    hot = hot_keys(df, key_names, floor=hot_rows)
    own_places = hot is not None and not positions
    if own_places:
        df, positions = _placed_copy(df), list(PLACE)
    order = [F.col(newest_by).desc_nulls_last(), *[F.col(c).asc() for c in positions]]
    spread = F.xxhash64(*[F.col(c) for c in positions or df.columns])

    keyed = all_present(key_names)
    rows = df.withColumn("_spread", F.when(~keyed, spread))
    if hot is None:
        groups = Window.partitionBy(*key_names, "_spread").orderBy(*order)
        ranked = rows.withColumn(rank, F.row_number().over(groups))
    else:
        ranked = _rank_in_pieces(rows, key_names, hot, newest_by, positions, order, rank, hot_rows)
    return ranked.drop("_spread", *(PLACE if own_places else ())).withColumn(flag, keyed & (F.col(rank) > 1))


# Where a row lies in the copy of a frame that has no position columns of its own.
PLACE = ("_place_file", "_place_row")


def _placed_copy(df: DataFrame) -> DataFrame:
    """The rows from a copy in the shared folder, with their places in it. They do not change when a task is repeated."""
    folder = shared_folder(df.sparkSession, "ranked")
    df.write.parquet(folder)
    copy = df.sparkSession.read.schema(df.schema).parquet(folder)
    file, row = PLACE
    return copy.select(
        "*", F.xxhash64(F.col("_metadata.file_path")).alias(file), F.col("_metadata.row_index").alias(row)
    )


def _rank_in_pieces(rows, key_names, hot, newest_by, positions, order, rank, piece_rows) -> DataFrame:
    *files, index = positions
    piece = F.struct(
        F.col(newest_by).alias("at"),
        *[F.col(c).alias(f"p{i}") for i, c in enumerate(files)],
        F.floor(F.col(index) / piece_rows).alias("run"),
    )
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key_names, "left").withColumn(
        "_piece", F.when(F.col("_hot"), piece)
    )
    pieces = (
        marked.filter(F.col("_hot"))
        .groupBy(*key_names, "_spread", "_piece")
        .agg(F.count(F.lit(1)).alias("_piece_rows"))
    )
    earlier = Window.partitionBy(*key_names).orderBy(
        F.col("_piece.at").desc_nulls_last(),
        *[F.col(f"_piece.p{i}").asc() for i in range(len(files))],
        F.col("_piece.run").asc(),
    )
    offsets = pieces.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(key_names)],
        F.col("_spread").alias("_o_spread"),
        F.col("_piece").alias("_o_piece"),
        F.coalesce(
            F.sum("_piece_rows").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_offset"),
    )
    # The window and the join share their grouping columns, so the wide side moves once.
    within = Window.partitionBy(*key_names, "_spread", "_piece").orderBy(*order)
    numbered = marked.withColumn("_in_piece", F.row_number().over(within))
    match = F.col("_spread").eqNullSafe(F.col("_o_spread")) & F.col("_piece").eqNullSafe(F.col("_o_piece"))
    for i, k in enumerate(key_names):
        match = F.col(k).eqNullSafe(F.col(f"_k{i}")) & match
    joined = numbered.join(offsets, match, "left")
    return joined.withColumn(
        rank, (F.col("_in_piece") + F.coalesce(F.col("_offset"), F.lit(0))).cast("int")
    ).select(*[c for c in rows.columns], rank)


def latest_rows(
    df: DataFrame,
    keys: str | Sequence[str],
    newest_by: str,
    position: Sequence[str] = POSITION,
) -> DataFrame:
    """Keep the newest row of each key, and every row without a key.

    Filtering on the first row number lets Spark discard the others before the shuffle,
    so a hot key sends at most one row per task.
    """
    key_names = [keys] if isinstance(keys, str) else list(keys)
    positions = [c for c in position if c in df.columns]
    order = [F.col(newest_by).desc_nulls_last(), *[F.col(c).asc() for c in positions]]
    groups = Window.partitionBy(*key_names).orderBy(*order)
    keyed = df.filter(all_present(key_names)).withColumn("_rank", F.row_number().over(groups))
    return keyed.filter(F.col("_rank") == 1).drop("_rank").unionByName(df.filter(~all_present(key_names)))


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
