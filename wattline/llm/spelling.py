"""Groups of spelling variants by a reduced alphabet.

Every letter is hashed to one of a few symbols. Of each reduced word the full neighbourhood of one edit is generated over the
small alphabet: far fewer strings than over all letters. Two words that differ by one letter have reduced words that
differ by at most one symbol, so joining neighbourhoods with the reduced vocabulary finds every pair; the join is confirmed on
the words themselves. Texts are read once, for the counts; everything after works on the vocabulary.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import REMEMBERED, discard, map_tables, staged
from wattline.llm.runs import BASE, mixed, passes, repeated

#: Fixed pattern: what counts as a word before lower-casing A-Z (applied after it).
WORD = "[a-zÀ-ÿ]+"
#: A run whose checksum this number divides loses a letter.
LOSES = 97
LEAST_LENGTH, LEAST_COUNT, LEAST_RATIO = 5, 3, 2
SYMBOLS = 8
#: Words that are put into one matrix, and neighbours made at once.
TOGETHER, MADE = 2048, 1 << 20

_INVERSE = pow(BASE, -1, 2**64)


def word_counts(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, n`` over all texts. A task adds up its own counts before they are shuffled."""
    docs = df.select(F.col(id_column).cast("string").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"))

    def each():
        runs = re.compile(WORD)
        held: Counter[str] = Counter()

        def finish() -> Iterator[dict]:
            words = list(held)
            for i in range(0, len(words), 65536):
                part = words[i : i + 65536]
                yield {"word": part, "n": [held[w] for w in part]}
            held.clear()

        def row(doc_id: str | None, text: bytes) -> Iterator[dict]:
            number = (doc_id or "").encode() + b":"
            for run, n in Counter(runs.findall(text.lower().decode("utf-8", "replace"))).items():
                h = zlib.crc32(run.encode(), zlib.crc32(number))
                if h % LOSES == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                held[run] += n
            if len(held) >= REMEMBERED:
                yield from finish()

        row.finish = finish
        return row

    counted = map_tables(docs, "word string, n long", each)
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


class Reduced:
    """Keys of reduced words and of their neighbours: polynomial hashes of the symbols."""

    def __init__(self, symbols: int) -> None:
        self.symbols = symbols
        self.powers = np.ones(1, np.uint64)

    def _up_to(self, n: int) -> np.ndarray:
        if len(self.powers) <= n:
            factors = np.full(2 * n + 1, BASE, np.uint64)
            factors[0] = 1
            with np.errstate(over="ignore"):
                self.powers = np.cumprod(factors)
        return self.powers

    def of(self, words: list[str]) -> np.ndarray:
        """Symbols, from 1, of words of one length."""
        letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)
        return mixed(letters.astype(np.uint64)) % np.uint64(self.symbols) + np.uint64(1)

    def keys(self, reduced: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((reduced * self._up_to(reduced.shape[1])[: reduced.shape[1]]).sum(axis=1, dtype=np.uint64))

    def neighbours(self, reduced: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(places, keys)``: the reduced words themselves and all with one symbol deleted, replaced or inserted.

        Each neighbour comes once: a symbol is deleted only where a stretch of equal ones begins and inserted only
        where the symbol before differs.
        """
        rows, length = reduced.shape
        powers = self._up_to(length + 1)
        with np.errstate(over="ignore"):
            before = np.zeros((rows, length + 1), np.uint64)
            np.cumsum(reduced * powers[:length], axis=1, out=before[:, 1:])
            whole = before[:, -1:]
            yield np.arange(rows), mixed(whole[:, 0])
            left = np.concatenate([np.zeros((rows, 1), np.uint64), reduced], axis=1)
            step = max(1, MADE // rows)
            for start in range(0, length, step):
                at = np.arange(start, min(start + step, length))
                own = reduced[:, at]
                shorter = before[:, at] + (whole - before[:, at + 1]) * np.uint64(_INVERSE)
                yield _chosen(left[:, at] != own, shorter)
                for symbol in range(1, self.symbols + 1):
                    yield _chosen(own != symbol, whole + (np.uint64(symbol) - own) * powers[at])
            for start in range(0, length + 1, step):
                at = np.arange(start, min(start + step, length + 1))
                for symbol in range(1, self.symbols + 1):
                    longer = before[:, at] + np.uint64(symbol) * powers[at] + (whole - before[:, at]) * np.uint64(BASE)
                    yield _chosen(left[:, at] != symbol, longer)


def _chosen(wanted: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.nonzero(wanted)[0], mixed(keys[wanted])


def _reduced_words(vocabulary: DataFrame, symbols: int) -> DataFrame:
    """``key, word, n`` with the key of the reduced word."""

    def each():
        reduced = Reduced(symbols)

        waiting: dict[int, list[tuple[str, int]]] = {}
        held = 0

        def finish() -> Iterator[dict]:
            nonlocal held
            held = 0
            for same in waiting.values():
                words = [word for word, _ in same]
                yield {"key": reduced.keys(reduced.of(words)).view(np.int64), "word": words, "n": [n for _, n in same]}
            waiting.clear()

        def row(word: str, n: int) -> Iterator[dict]:
            nonlocal held
            waiting.setdefault(len(word), []).append((word, n))
            held += len(word)
            if held >= TOGETHER * 8:
                yield from finish()

        row.finish = finish
        return row

    return map_tables(vocabulary.select("word", "n"), "key long, word string, n long", each)


def _neighbourhoods(words: DataFrame, symbols: int) -> DataFrame:
    """``key, near``: the keys of all neighbours of each word's reduced word that the reduced vocabulary may hold.

    The bitmap of reduced words has a fixed size; what it passes in error meets no word in the join.
    """
    known = repeated(words.select("key"), lambda: lambda key: np.array([key], np.int64).view(np.uint64), 1)

    def each():
        reduced = Reduced(symbols)
        waiting: dict[int, list[str]] = {}
        held = 0

        def finish() -> Iterator[dict]:
            nonlocal held
            held = 0
            for same in waiting.values():
                for places, keys in reduced.neighbours(reduced.of(same)):
                    alive = np.flatnonzero(passes(known.value, keys))
                    yield {"key": keys[alive].view(np.int64), "near": [same[i] for i in places[alive].tolist()]}
            waiting.clear()

        def row(word: str) -> Iterator[dict]:
            nonlocal held
            waiting.setdefault(len(word), []).append(word)
            held += len(word)
            if held >= TOGETHER * 8:
                yield from finish()

        row.finish = finish
        return row

    return map_tables(words.select("word"), "key long, near string", each)


def spelling_groups(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    symbols: int = SYMBOLS,
) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    A word is a run of letters, A-Z in lower case, of at least ``least_length`` code points that occurs ``least_count`` times
    in all texts; a run whose checksum with the row's number is a multiple of 97 loses one letter first (a missing
    number counts as empty text). Null texts have no words. Words are near if one inserted, deleted or replaced code
    point makes them equal. ``form`` is the near word that occurs most (of several, the first in code-point order) if it
    occurs at least twice as often as the word, ``root`` the end of the chain of forms. Repeated rows count
    each time. Other columns are not looked at. An empty table gives no rows.
    """
    counted = word_counts(df, id_column, text_column)
    vocabulary = staged(counted.where((F.length("word") >= least_length) & (F.col("n") >= least_count)), "spelling-words")
    words = staged(_reduced_words(vocabulary, symbols), "spelling-reduced")
    near = staged(_neighbourhoods(words, symbols), "spelling-neighbours")
    pairs = near.join(words, "key").where("near != word and levenshtein(near, word, 1) = 1")
    best = F.min(F.struct((-F.col("n")).alias("n"), F.col("word").alias("form"))).alias("best")
    found = pairs.groupBy(F.col("near").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best)
    found = vocabulary.join(found, "word", "left").withColumn("most", -F.col("best.n"))
    close = F.col("most") >= LEAST_RATIO * F.col("n")
    forms = staged(
        found.select(
            "word",
            F.when(close, F.col("best.form")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(close, F.col("most")).alias("form_n"),
        ),
        "spelling-forms",
    )
    discard(near, words, vocabulary)
    roots = _roots(forms)
    return forms.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of words with a form. Each round doubles how far the chains are followed."""
    roots = staged(forms.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        above = roots.select(F.col("word").alias("root"), F.col("root").alias("higher"))
        further = roots.join(above, "root", "left").select("word", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved"))
        further = staged(further, "spelling-roots")
        discard(roots)
        roots = further.drop("moved")
        if further.where("moved").isEmpty():
            return roots
