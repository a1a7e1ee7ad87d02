"""Repeated runs of words by level-wise doubling.

A run of ``n`` words that occurs twice holds shorter runs that occur twice. So runs of about a quarter of
``n`` words come first, one chosen from every window by its hash (the smallest in the window, so equal
windows choose alike). Only those that repeat are extended to twice the length, and only what
repeats there to ``n`` words. Counts are exact at every level; between levels a bitmap of fixed size
says which runs can be left out, and a run that it passes in error only costs work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import map_rows, map_tables, staged
from wattline.llm.exact_dedup import SLOTS, split_copies
from wattline.llm.runs import SECOND_BASE, WordHashes, mixed, passes, repeated, rolling

LENGTH = 35
#: Windows are looked at in stretches of this many, so a position fits beside its hash.
STRETCH = 1 << 22


class Levels:
    """Runs of one text at the three lengths."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.double = max(1, -(-length // 2))
        self.short = max(1, -(-length // 4))
        self.hashes = WordHashes()

    def words(self, text: bytes) -> np.ndarray:
        return self.hashes.of(text)

    def anchors(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all short runs, and for every window the place of the one it chooses."""
        runs = rolling(words, self.short)
        count = len(words) - self.length + 1
        if count <= 0:
            return runs, np.empty(0, np.int64)
        width = self.length - self.short + 1
        chosen = [self._smallest(runs[i : i + STRETCH + width - 1], width) + i for i in range(0, count, STRETCH)]
        return runs, np.concatenate(chosen)

    @staticmethod
    def _smallest(runs: np.ndarray, width: int) -> np.ndarray:
        """The leftmost smallest of each ``width`` neighbours, compared by the upper 40 bits."""
        low = np.uint64((1 << 24) - 1)
        packed = (mixed(runs) & ~low) | np.arange(len(runs), dtype=np.uint64)
        size = 1
        while size * 2 <= width:
            packed = np.minimum(packed[:-size], packed[size:])
            size *= 2
        if size < width:
            rest = width - size
            packed = np.minimum(packed[:-rest], packed[rest:])
        return (packed & low).astype(np.int64)

    def doubled(self, words: np.ndarray, chosen: np.ndarray) -> np.ndarray:
        """For every window the hash of the run of twice the length: forwards from its choice, or backwards if that leaves the window."""
        runs = rolling(words, self.double)
        at = np.arange(len(chosen))
        forward = chosen + self.double <= at + self.length
        begin = np.where(forward, chosen, chosen + self.short - self.double)
        return mixed(runs[begin] + forward.astype(np.uint64))


def _distinct(chosen: np.ndarray) -> np.ndarray:
    """Places in ascending order, each once."""
    return chosen[np.flatnonzero(np.diff(chosen, prepend=-1))]


def _short_runs(length: int):
    levels = Levels(length)

    def tokens(text: bytes, weight: int) -> np.ndarray:
        runs, chosen = levels.anchors(levels.words(text))
        return np.repeat(runs[_distinct(chosen)], weight)

    return tokens


def _double_runs(length: int, short: Broadcast):
    levels = Levels(length)

    def tokens(text: bytes, weight: int) -> np.ndarray:
        words = levels.words(text)
        runs, chosen = levels.anchors(words)
        alive = passes(short.value, runs[chosen])
        if not alive.any():
            return runs[:0]
        # a run at one place counts once, however many windows choose it
        found = levels.doubled(words, chosen)[alive]
        pairs = np.stack([chosen[alive].astype(np.uint64), found])
        return np.repeat(pairs[1, np.flatnonzero((np.diff(pairs, prepend=~pairs[:, :1]) != 0).any(axis=0))], weight)

    return tokens


def _windows(docs: DataFrame, length: int, short: Broadcast, double: Broadcast) -> DataFrame:
    """Every window whose shorter runs repeat: where it is, and 96 bits of hash."""

    def each():
        levels = Levels(length)

        def row(row: int, text: bytes, weight: int) -> Iterator[dict]:
            words = levels.words(text)
            runs, chosen = levels.anchors(words)
            alive = passes(short.value, runs[chosen])
            if alive.any():
                alive &= passes(double.value, levels.doubled(words, chosen))
            at = np.flatnonzero(alive)
            if len(at):
                second = rolling(words, length, SECOND_BASE)[at] >> np.uint64(33)
                yield {
                    "run": rolling(words, length)[at].view(np.int64),
                    "more": second.astype(np.int32),
                    "row": np.full(len(at), row),
                    "at": at.astype(np.int32),
                    "n": np.full(len(at), weight),
                }

        return row

    return map_tables(docs.select("row", "text", "weight"), "run long, more int, row long, at int, n long", each)


def _candidates(docs: DataFrame, length: int, short: Broadcast) -> DataFrame:
    """Per document the number of words and the hash of all of them, and the text if a short run repeats."""

    def each():
        levels = Levels(length)

        def row(doc_id: int | None, text: bytes, weight: int) -> Iterator[tuple]:
            words = text.split()
            whole = hashlib.sha256(b" ".join(words)).hexdigest()
            if len(words) >= length:
                runs, chosen = levels.anchors(levels.words(text))
                if weight > 1 or passes(short.value, runs[_distinct(chosen)]).any():
                    yield doc_id, len(words), whole, text, weight
                    return
            yield doc_id, len(words), whole, None, weight

        return row

    schema = "doc_id long, n_words long, kept_sha256 string, text binary, weight long"
    return map_rows(docs.select("doc_id", "text", "weight"), schema, each)


def repeated_words(
    df: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, slots: int = SLOTS
) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, removed, kept``.

    Every word covered by a window of ``length`` words that also starts elsewhere, in the same text too,
    is removed; ``removed`` lists begin and end of the removed stretches, ``kept`` is the
    rest joined by spaces (null if it is the whole text, to spare a copy). ``kept_sha256`` is its
    SHA-256. Words are runs of bytes other than white space, unchanged; null and empty texts have
    none. Texts shorter than a window stay whole. Rows without a number and repeated rows are
    documents like any other, so equal rows repeat each other. An empty table gives no rows.

    Copies of a whole text are found first: their windows all repeat, and one of them, counted
    twice, stands for all in the levels, so a large group of copies costs one text.
    """
    digest = F.unhex(F.md5(F.coalesce(F.col(text_column), F.lit("")).cast("binary")))
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text")
    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), digest.alias("digest"), text)
    unique, compared = split_copies(rows, slots)
    grouped = F.when(F.col("group_size") > 1, 2).otherwise(1).cast("long").alias("weight")
    docs = unique.select("doc_id", "text", F.lit(1).cast("long").alias("weight")).unionAll(
        compared.where("kept").select("doc_id", "text", grouped)
    )

    short = repeated(docs.select("text", "weight"), lambda: _short_runs(length), 2)
    judged = staged(_candidates(docs, length, short).withColumn("row", F.monotonically_increasing_id()), "runs-texts")
    candidates = judged.where("text is not null")
    double = repeated(candidates.select("text", "weight"), lambda: _double_runs(length, short), 2)
    counts = _windows(candidates, length, short, double).groupBy("run", "more").agg(F.sum("n").alias("n"))
    full = staged(counts.where("n > 1").select("run", "more"), "runs-full")
    single = candidates.where("weight = 1")
    windows = _windows(single, length, short, double).select("run", "more", "row", "at")
    places = windows.join(full, ["run", "more"], "left_semi").groupBy("row").agg(F.collect_list("at").alias("at"))
    places = staged(places, "runs-places")

    schema = "doc_id long, n_words long, n_removed long, removed array<int>, kept string, kept_sha256 string"
    cut = map_rows(single.join(places, "row").select("doc_id", "text", "at"), schema, lambda: _cut(length))
    copies = candidates.where("weight > 1").select("doc_id", "text").unionAll(
        compared.where("not kept").select("doc_id", "text")
    )
    whole = judged.where("text is null").drop("text").unionAll(
        single.drop("text").join(places.select("row"), "row", "left_anti").select(*judged.drop("text").columns)
    )
    whole = whole.select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.array().cast("array<int>").alias("removed"),
        F.lit(None).cast("string").alias("kept"), "kept_sha256",
    )
    return whole.unionAll(cut).unionAll(map_rows(copies, schema, lambda: _copy(length)))


def _cut(length: int):
    def row(doc_id: int | None, text: bytes, at: list[int]) -> Iterator[tuple]:
        yield _result(doc_id, text.split(), at, length)

    return row


def _copy(length: int):
    """A copy of a whole text: all of its windows repeat."""

    def row(doc_id: int | None, text: bytes) -> Iterator[tuple]:
        words = text.split()
        yield _result(doc_id, words, range(max(0, len(words) - length + 1)), length)

    return row


def _result(doc_id: int | None, words: list[bytes], at, length: int) -> tuple:
    stretches: list[int] = []
    for begin in sorted(at):
        if stretches and begin <= stretches[-1]:
            stretches[-1] = begin + length
        else:
            stretches += [begin, begin + length]
    kept, done = [], 0
    for begin, end in zip(stretches[::2], stretches[1::2], strict=True):
        kept += words[done:begin]
        done = end
    kept += words[done:]
    joined = b" ".join(kept)
    rest = joined.decode("utf-8", "replace") if stretches else None
    return doc_id, len(words), len(words) - len(kept), stretches, rest, hashlib.sha256(joined).hexdigest()
