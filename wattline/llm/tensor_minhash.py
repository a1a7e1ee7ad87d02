"""Near duplicates by minhash with tensored banding, confirmed on full sets.

Two small collections of half keys are computed, each half key from a few minhashes. Every pair of a half key of
the first and one of the second collection is the key of one table, so ``HALVES``**2 tables cost only
2 * ``HALVES`` half keys. Half keys that no other document has are dropped before pairs are
formed, and pairs that no other document has before anything is compared. Documents that share a table
meet in tasks of bounded size (``linking.py``): minhashes rule out pairs that are certainly too far apart, the others are
compared on their whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import discard, map_rows, map_tables, staged
from wattline.llm.exact_dedup import SLOTS, split_copies
from wattline.llm.jaccard_join import Shingles, labelled
from wattline.llm.linking import Classes, linked_classes
from wattline.llm.runs import mixed

SHINGLE = 4
#: Least similarity in hundredths.
SIMILARITY = 80
#: Half keys of a collection, and minhashes of a half key. With 14 of 2, two sets of similarity 0.8 share no table with
#: a probability of 1.2e-6; 196 tables need 56 minhashes instead of 784.
HALVES, WIDTH = 14, 2
#: Most probable loss of a similar pair when minhashes are compared before sets.
LOSS = 1e-9
#: Elements of a set that are hashed at once.
STRETCH = 4096


class MinHashes:
    """``lanes`` minhashes of 32 bits of a set of 64-bit hashes."""

    def __init__(self, lanes: int) -> None:
        seeds = mixed(np.arange(1, 2 * lanes + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.factors, self.terms = (seeds[:lanes] | np.uint64(1))[:, None], seeds[lanes:][:, None]

    def of(self, tokens: np.ndarray) -> np.ndarray:
        least = None
        with np.errstate(over="ignore"):
            for i in range(0, len(tokens), STRETCH):
                found = (tokens[None, i : i + STRETCH] * self.factors + self.terms).min(axis=1)
                least = found if least is None else np.minimum(least, found)
        return (mixed(least) >> np.uint64(32)).astype("<u4")


def least_equal(lanes: int, similarity: int) -> int:
    """How many of ``lanes`` minhashes two similar sets have in common, but for a probability of ``LOSS``."""
    p, below = similarity / 100, 0.0
    for k in range(lanes + 1):
        below += math.comb(lanes, k) * p**k * (1 - p) ** (lanes - k)
        if below > LOSS:
            return k
    return lanes


def half_keys(lanes: np.ndarray, width: int) -> np.ndarray:
    """64-bit keys of consecutive groups of ``width`` minhashes, told apart by their place."""
    grouped = lanes.reshape(-1, width).astype(np.uint64)
    keys = np.arange(1, len(grouped) + 1, dtype=np.uint64)
    for column in grouped.T:
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) ^ column)
    return keys


def _sketched(docs: DataFrame, shingle: int, lanes: int) -> DataFrame:
    def each():
        shingles, hashes = Shingles(shingle), MinHashes(lanes)

        def row(doc_id: int | None, digest: bytes, text: bytes, group_size: int) -> Iterator[tuple]:
            tokens = shingles.of(text)
            yield doc_id, digest, group_size, len(tokens), hashes.of(tokens).tobytes() if len(tokens) else None, text

        return row

    return map_rows(
        docs.select("doc_id", "digest", "text", "group_size"),
        "doc_id long, digest binary, group_size long, n long, lanes binary, text binary",
        each,
    )


def _repeated(keys: DataFrame) -> DataFrame:
    """The rows of ``keys`` whose ``key`` another row has as well. Counts are combined before the shuffle."""
    several = keys.groupBy("key").agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("key")
    return keys.join(several, "key")


def _tables(halves: DataFrame) -> DataFrame:
    """``key, row, n`` for every pair of half keys of a row, one of each collection."""
    alive = halves.groupBy("row", "n").agg(
        F.collect_list(F.when(F.col("first"), F.col("key"))).alias("x"), F.collect_list(F.when(~F.col("first"), F.col("key"))).alias("y")
    )
    pairs = alive.where("size(x) > 0 and size(y) > 0").select("row", "n", F.explode("x").alias("x"), "y")
    return pairs.select("row", "n", "x", F.explode("y").alias("y")).select(F.xxhash64("x", "y").alias("key"), "row", "n")


def _halves(sketches: DataFrame, halves: int, width: int) -> DataFrame:
    def each():
        def row(number: int, n: int, lanes: bytes) -> Iterator[dict]:
            keys = half_keys(np.frombuffer(lanes, "<u4"), width)
            first = np.arange(len(keys)) < halves
            yield {"key": keys.view(np.int64), "first": first, "row": np.full(len(keys), number), "n": np.full(len(keys), n)}

        return row

    return map_tables(sketches.where("lanes is not null").select("row", "n", "lanes"), "key long, first boolean, row long, n long", each)


def _comparison(shingle: int, similarity: int, lanes: int):
    needed = least_equal(lanes, similarity)

    def each():
        shingles = Shingles(shingle)

        def links(members: list[tuple]) -> Iterator[tuple[int, int]]:
            roots, rows = [m[0] for m in members], [m[1] for m in members]
            sizes = np.array([m[2] for m in members], np.int64)
            hashes = np.frombuffer(b"".join(m[3] for m in members), "<u4").reshape(len(members), lanes)
            sets: dict[int, np.ndarray] = {}
            classes = Classes()

            def tokens(i: int) -> np.ndarray:
                if i not in sets:
                    sets[i] = shingles.of(members[i][4])
                return sets[i]

            for i in range(len(members) - 1):
                close = (hashes[i + 1 :] == hashes[i]).sum(axis=1) >= needed
                close &= np.minimum(sizes[i + 1 :], sizes[i]) * 100 >= np.maximum(sizes[i + 1 :], sizes[i]) * similarity
                for j in (np.flatnonzero(close) + i + 1).tolist():
                    a, b = classes.of(roots[i]), classes.of(roots[j])
                    if a == b:
                        continue
                    both = len(np.intersect1d(tokens(i), tokens(j), assume_unique=True))
                    if 100 * both >= similarity * (sizes[i] + sizes[j] - both):
                        classes.join(a, b)
                        yield rows[i], rows[j]

        return links

    return each


def near_groups(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    similarity: int = SIMILARITY,
    halves: int = HALVES,
    width: int = WIDTH,
    slots: int = SLOTS,
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Two rows link if 100 times the shingles they share is at least ``similarity`` times the shingles of either;
    a component is what links connect, its number the smallest in it. Null and empty texts and texts of white space have no
    shingles and link with nothing, not even each other; a text with fewer words than a shingle is one.
    Equal texts are one set and always linked. Rows without a number come last: a component of only
    such rows has none. ``kept`` marks one row of each component, the one with the smallest number; of several rows
    with that number, one. Other columns are not looked at. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    number = F.col(id_column).cast("long").alias("doc_id")
    rows = df.select(number, F.unhex(F.md5(text)).alias("digest"), text.alias("text"))
    unique, compared = split_copies(rows, slots)
    one = F.lit(1).cast("long").alias("group_size")
    docs = unique.select("doc_id", "digest", "text", one).unionAll(compared.where("kept").select("doc_id", "digest", "text", "group_size"))
    lanes = 2 * halves * width
    sketches = staged(_sketched(docs, shingle, lanes).withColumn("row", F.monotonically_increasing_id()), "tensor-sketches")
    every = staged(_halves(sketches, halves, width), "tensor-halves")
    shared = staged(_repeated(every), "tensor-shared")
    tables = staged(_tables(shared), "tensor-tables")
    keys = staged(_repeated(tables), "tensor-keys")
    discard(every, shared, tables)
    candidates = keys.select("row").distinct()
    sets = staged(sketches.select("row", "n", "lanes", "text").join(candidates, "row", "left_semi"), "tensor-sets")
    classes = linked_classes(sets, keys, _comparison(shingle, similarity, lanes))
    return labelled(sketches, classes, compared)
