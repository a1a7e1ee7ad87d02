"""Sharding by extendible hashing.

The directory is indexed by the first bits of a hash. It begins with so many bits that an even share
would fit the byte limit; a bucket over the limit is split on its next bit, and again, until every
shard fits. Buckets that fit are never touched again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import staged

#: Most bytes of text in a shard.
LIMIT = 16 << 20
#: Bits of the hash; the first half depends on the row's content, the second on its place.
HALF = 64


def _bits(value: Column) -> Column:
    return F.lpad(F.bin(value), HALF, "0")


def shards(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", limit: int = LIMIT
) -> tuple[DataFrame, DataFrame]:
    """The rows' places (``doc_id, row, n_bytes, shard, depth``) and the directory (``shard, depth, n_rows, n_bytes, oversized``).

    ``shard`` is the prefix of the hash as bits. Bytes are those of the text in UTF-8; null is
    empty. Rows with equal numbers and texts have equal hashes and could never be split; such a bucket
    goes on with the bits of a second hash, of the row's place in the table, so a third of all
    rows being equal is no exception. A single row over the limit is a shard of its own, marked
    ``oversized``. An empty table has no shards.
    """
    text = F.coalesce(F.col(text_column), F.lit("")).alias("text")
    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), text, F.monotonically_increasing_id().alias("row"))
    rows = rows.select(
        "doc_id",
        "row",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.concat(_bits(F.xxhash64("doc_id", "text")), _bits(F.xxhash64("row"))).alias("hash"),
    )
    rows = staged(rows, "shard-rows")
    total, count = rows.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)), F.count(F.lit(1))).first()
    depth = max(0, math.ceil(math.log2(max(1, total / limit))))
    directory = _directory(rows, depth, limit) if count else _level(rows, depth, limit).limit(0)
    depths = [r[0] for r in directory.select("depth").distinct().collect()] or [0]
    prefixes = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(F.lit(d)).alias("shard")) for d in depths]))
    places = rows.select("doc_id", "row", "n_bytes", prefixes.alias("at")).select("doc_id", "row", "n_bytes", "at.*")
    places = places.join(directory.select("shard", "depth"), ["shard", "depth"])
    return places.select("doc_id", "row", "n_bytes", "shard", "depth"), directory


def _prefix(depth: Column) -> Column:
    return F.substring(F.col("hash"), F.lit(1), depth)


def _level(rows: DataFrame, depth: int, limit: int) -> DataFrame:
    """The buckets at a depth; sums are combined before the shuffle."""
    buckets = rows.groupBy(_prefix(F.lit(depth)).alias("shard")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("n_bytes").alias("n_bytes"),
        F.min(F.substring("hash", 1, HALF)).alias("low"),
        F.max(F.substring("hash", 1, HALF)).alias("high"),
    )
    fits = (F.col("n_bytes") <= limit) | (F.col("n_rows") == 1)
    return buckets.select(
        "shard",
        F.lit(depth).alias("depth"),
        "n_rows",
        "n_bytes",
        (F.col("n_bytes") > limit).alias("oversized"),
        fits.alias("fits"),
        (F.col("low") == F.col("high")).alias("equal"),
    )


def _directory(rows: DataFrame, depth: int, limit: int) -> DataFrame:
    """All buckets that fit. Buckets of equal hashes wait until no other is left to split, then go on with the second hash."""
    levels, equal, live = [], [], rows
    while True:
        level = staged(_level(live, depth, limit), f"shard-level-{depth}")
        levels.append(level.where("fits"))
        large = level.where("not fits")
        if depth < HALF:
            equal.append(large.where("equal"))
            large = large.where("not equal")
        if not large.isEmpty():
            live, depth = _rows_in(live, large, depth), depth + 1
            continue
        biggest = [(part, part.agg(F.max("n_bytes")).first()[0]) for part in equal]
        equal, stuck = [], [(part, size) for part, size in biggest if size]
        if not stuck:
            break
        live = _union([_rows_in(rows, part, part.first().depth) for part, _ in stuck])
        depth = HALF + max(1, math.ceil(math.log2(max(size for _, size in stuck) / limit)))
    return _union(levels).select("shard", "depth", "n_rows", "n_bytes", "oversized")


def _rows_in(rows: DataFrame, buckets: DataFrame, depth: int) -> DataFrame:
    return rows.join(buckets.select("shard"), _prefix(F.lit(depth)) == F.col("shard"), "left_semi")


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole
