"""Exact duplicates by two-pass Bloom filtering, in DataFrame operations only.

Pass one counts, for two slots of every text's hash, how many rows fall into each slot of a
fixed-size filter. A text of which a slot holds one row alone is unique for certain and passes
straight through. Only the others, possibly repeated, are shuffled by hash and compared exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import staged

#: Runs of these characters count as one space.
WHITE = r"[\x20\x09-\x0D]+"
#: Slots of the filter. 2**26 slots are a million words of 64 bits, so what is broadcast has a fixed
#: bound at any input size. With more than about 30 million rows choose more slots, or more rows
#: take the shuffled path; results stay the same.
SLOTS = 1 << 26


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def exact_groups(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", slots: int = SLOTS) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of rows with equal texts the one with the smallest number stays. Null text is empty. Rows
    without a number come after all others; ``keep_id`` is null if no row of the group has one.
    Of several rows with the same smallest number one stays. Other columns are not looked at.
    An empty table gives no rows.
    """
    unique, compared = split_copies(_hashed(df, id_column, text_column, []), slots)
    alone = unique.select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
    grouped = compared.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )
    return alone.unionAll(grouped)


def without_copies(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", slots: int = SLOTS) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns; cases as in ``exact_groups``.

    Rows that are unique for certain are never shuffled.
    """
    unique, compared = split_copies(_hashed(df, id_column, text_column, [F.struct("*").alias("carried")]), slots)
    return unique.select("carried.*").unionAll(compared.where("kept").select("carried.*"))


def _hashed(df: DataFrame, id_column: str, text_column: str, carried: list[Column]) -> DataFrame:
    rows = df.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.unhex(F.sha2(normalised(F.col(text_column)), 256)).alias("digest"),
        *carried,
    )
    return rows


def split_copies(rows: DataFrame, slots: int) -> tuple[DataFrame, DataFrame]:
    """Rows (``doc_id``, ``digest`` and more) that are unique for certain, and the others compared exactly.

    The others get ``group_size``, ``keep_id`` and ``kept``.

    Counts are combined before the shuffle, so a group with a third of all rows is one number per
    task. Sizes are written first: the join then reads plain files on both sides, and Spark
    can split the partition of a large group.
    """
    filled = _shared_slots(rows, slots)
    probed = rows
    for seed in (1, 2):
        words = F.broadcast(filled.select(F.col("word").alias(f"word_{seed}"), F.col("bits").alias(f"bits_{seed}")))
        probed = probed.withColumn(f"slot_{seed}", _slot(slots, seed))
        probed = probed.withColumn(f"word_{seed}", _word(F.col(f"slot_{seed}"))).join(words, f"word_{seed}", "left")
    unique = probed.where(~(_is_shared(1) & _is_shared(2))).select(rows.columns)
    possible = probed.where(_is_shared(1) & _is_shared(2)).select(*rows.columns)
    possible = staged(possible.withColumn("row", F.monotonically_increasing_id()), "exact-possible")

    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    groups = possible.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), first)
    groups = groups.select("digest", "group_size", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"))
    compared = possible.join(staged(groups, "exact-groups"), "digest")
    return unique, compared.withColumn("kept", F.col("row") == F.col("keep_row"))


def _slot(slots: int, seed: int) -> Column:
    return F.xxhash64(F.col("digest"), F.lit(seed)).bitwiseAND(F.lit(slots - 1))


def _word(slot: Column) -> Column:
    return F.shiftright(slot, 6)


def _is_shared(seed: int) -> Column:
    return F.expr(f"coalesce(bits_{seed} & shiftleft(1L, int(slot_{seed} & 63)), 0L) != 0")


def _shared_slots(rows: DataFrame, slots: int) -> DataFrame:
    """The second filter: bits of the slots into which more than one row falls, 64 to a word."""
    both = F.array_distinct(F.array(_slot(slots, 1), _slot(slots, 2)))
    twice = rows.select(F.explode(both).alias("slot")).groupBy("slot").count().where("count > 1")
    words = twice.groupBy(_word(F.col("slot")).alias("word"))
    return staged(words.agg(F.expr("bit_or(shiftleft(1L, int(slot & 63)))").alias("bits")), "exact-filter")
