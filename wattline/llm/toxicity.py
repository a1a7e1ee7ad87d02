"""Toxicity by noisy-channel deobfuscation.

A writer hides a word by look-alike digits and signs, by separators between its letters or by
repeated letters. Each suspicious stretch becomes a lattice of what its characters may stand for,
and Viterbi decoding finds the likeliest reading under a trigram model of characters counted over
all documents. Words of the restored text, and their beginnings, are then looked up in a lexicon
learned from labels; the score is a noisy-or over the words found.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import REMEMBERED, discard, map_rows, map_tables, staged, texts
from wattline.llm.labelled import remainder, rows_where, training_rows
from wattline.llm.license_scan import words_of

#: Characters of the model: 0 is anything that is no letter, 1-26 are a-z, 27 stands for other letters.
SIZE = 28
SYMBOLS = np.zeros(256, np.uint8)
SYMBOLS[97:123] = SYMBOLS[65:91] = np.arange(1, 27)
SYMBOLS[128:] = 27

#: What a sign may stand for, and the cost of that reading (negative logarithm).
LOOKALIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "abcdefghijklmnopqrstuvwxyz", "#": "h",
}
SEPARATORS = " .-_*"
LOOKALIKE_COST, MASK_COST, DROP_COST, REPEAT_COST, DOUBLE_COST, KEEP_COST = 1.0, 2.5, 0.4, 0.7, 2.5, 6.0

_LEET = np.zeros(256, bool)
_LEET[[ord(c) for c in LOOKALIKE]] = True
_SPLIT = np.zeros(256, bool)
_SPLIT[[ord(c) for c in ".-_*"]] = True
#: Four or more single characters, accented ones too, with separators between them.
SPACED = re.compile(
    rb"(?<![a-z0-9\x80-\xff])(?:(?:[a-z0-9@$!|+#]|[\xc3-\xcf][\x80-\xbf])[ .\-_*]+){3,}(?:[a-z0-9@$!|+#]|[\xc3-\xcf][\x80-\xbf])(?![a-z0-9\x80-\xff])"
)
#: What else a hidden word may have: a look-alike beside a letter or another look-alike, or a doubled letter.
BESIDE = re.compile(r"[^\W\d_][0-9@$!|+*#]|[0-9@$!|+*#]{2}|[0-9@$!|+*#][^\W\d_]|([^\W\d_])\1")
LETTER = re.compile(r"[^\W\d_]")
#: Letters that one sign may stand for are one letter here, and separators are none.
ALIKE = {ord(sign): {"1": "i", "|": "i", "6": "g", "8": "g"}.get(sign, letters) for sign, letters in LOOKALIKE.items() if sign != "*"}
ALIKE |= {ord("l"): "i", ord("b"): "g"} | {ord(c): "" for c in " .-_"}
DOUBLED = re.compile(r"(.)\1+", re.S)
LONG_REPEAT = re.compile(r"(.)\1{3,}", re.S)
INVISIBLE = re.compile(rb"\xe2\x80[\x8b-\x8f]|\xe2\x81\xa0|\xef\xbb\xbf|\xc2\xad")


def character_model(df: DataFrame, text_column: str = "text") -> np.ndarray:
    """Negative log probabilities of a character after two others, from all texts of ``df``.

    Every task adds up its counts; what reaches the driver is one number per trigram that occurs,
    at most 28 ** 3.
    """

    def each():
        total, waiting, held = np.zeros(SIZE**3, np.int64), [], 0

        def settle() -> None:
            nonlocal held
            s = SYMBOLS[np.frombuffer(b"  ".join([b"", *waiting, b""]), np.uint8)].astype(np.int32)
            total[:] += np.bincount(s[:-2] * SIZE**2 + s[1:-1] * SIZE + s[2:], minlength=SIZE**3)
            waiting.clear()
            held = 0

        def row(_: int | None, text: bytes) -> Iterator[dict]:
            nonlocal held
            waiting.append(text)
            held += len(text)
            if held > 1 << 20:
                settle()
            return iter(())

        def finish() -> Iterator[dict]:
            settle()
            seen = np.flatnonzero(total)
            yield {"gram": seen, "n": total[seen]}

        row.finish = finish
        return row

    rows = df.select(F.lit(None).cast("long"), F.coalesce(F.col(text_column), F.lit("")).cast("binary")).toDF("doc_id", "text")
    counts = map_tables(rows, "gram long, n long", each)
    found = counts.groupBy("gram").agg(F.sum("n").alias("n")).collect()
    total = np.full(SIZE**3, 0.1)
    for gram, n in found:
        total[gram] += n
    total = total.reshape(SIZE, SIZE, SIZE)
    return -np.log(total / total.sum(axis=2, keepdims=True))


def suspicious(text: bytes) -> list[tuple[int, int]]:
    """Stretches of lower-cased text that surely need a reading, in order and apart from each other.

    A look-alike before a letter, a letter three times in a row, a separator inside a word, or
    single characters with separators between them. Tokens with look-alikes in other places or with doubled letters
    are read by ``Decoder.further``, only where the lexicon knows a reading.
    """
    b = np.frombuffer(text, np.uint8)
    if len(b) < 6:
        text, b = text.ljust(6), np.frombuffer(text.ljust(6), np.uint8)
    if not len(text.strip()):
        return []
    letter = SYMBOLS[b] > 0
    hits = _LEET[b[:-1]] & letter[1:]
    hits[1:] |= (b[:-2] == b[1:-1]) & (b[1:-1] == b[2:]) & letter[2:]
    hits[1:] |= letter[:-2] & _SPLIT[b[1:-1]] & letter[2:]
    found: list[tuple[int, int]] = []
    for at in np.flatnonzero(hits).tolist():
        if found and at < found[-1][1]:
            continue
        begin = max(text.rfind(b" ", 0, at), text.rfind(b"\n", 0, at)) + 1
        ends = [e for e in (text.find(b" ", at), text.find(b"\n", at)) if e >= 0]
        found.append((begin, min(ends, default=len(text))))
    runs = [m.span() for m in SPACED.finditer(text)]
    if runs:
        found = runs + [(a, e) for a, e in found if not any(a < y and x < e for x, y in runs)]
        found.sort()
    return found


def rough(text: str) -> str:
    """A form that a text shares with all its readings, if no character of the reading is a space."""
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))
    return DOUBLED.sub(r"\1", text.translate(ALIKE))


@dataclass
class Decoder:
    """Viterbi decoding of one stretch; the state is the last two characters of the reading."""

    costs: list
    known: dict[str, str] = field(default_factory=dict)
    rough: frozenset[str] = frozenset()

    def readings(self, text: str, i: int) -> list[tuple[str, float]]:
        """What the character at ``i`` may stand for; an empty reading drops it."""
        c = text[i]
        out = [(c, 0.0)] if c.isalpha() else [(" ", KEEP_COST)]
        if c in LOOKALIKE:
            price = MASK_COST if c == "*" else LOOKALIKE_COST
            out += [(x, price) for x in LOOKALIKE[c]]
        if c in SEPARATORS:
            out.append(("", DROP_COST))
        if i and c == text[i - 1] and (c.isalpha() or c in LOOKALIKE):
            longer = text[i - 2 : i - 1] == c or text[i + 1 : i + 2] == c
            out.append(("", REPEAT_COST if longer else DOUBLE_COST))
        return out

    def decode(self, text: str) -> str:
        if text in self.known:
            return self.known[text]
        paths: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
        for i in range(len(text)):
            step: dict[tuple[int, int], tuple[float, str]] = {}
            options = self.readings(text, i)
            for (a, b), (cost, read) in paths.items():
                for x, price in options:
                    if x:
                        symbol = ord(x) - 96 if "a" <= x <= "z" else 27 if x.isalpha() else 0
                        total, state = cost + price + self.costs[a][b][symbol], (b, symbol)
                    else:
                        total, state = cost + price, (a, b)
                    if state not in step or total < step[state][0]:
                        step[state] = total, read + x
            paths = step
        closed = ((cost + self.costs[a][b][0], read) for (a, b), (cost, read) in paths.items())
        best = min(closed, default=(0.0, text))[1]
        if len(text) <= 64:
            if len(self.known) >= REMEMBERED // 10:
                self.known.clear()
            self.known[text] = best
        return best

    def restore(self, text: bytes) -> bytes:
        """The text in lower case with every suspicious stretch replaced by its likeliest reading."""
        text = text.lower()
        if b"\xe2" in text or b"\xef\xbb" in text or b"\xc2\xad" in text:
            text = INVISIBLE.sub(b"", text)
        parts, done = [], 0
        for begin, end in suspicious(text):
            parts += [text[done:begin], self.decode(text[begin:end].decode("utf-8", "replace")).encode()]
            done = end
        return b"".join([*parts, text[done:]]) if parts else text


    def possible(self, text: str) -> bool:
        """Whether some reading may begin with a feature of the lexicon; signs without any letter are no word."""
        if not LETTER.search(text):
            return False
        fixed, star, _ = text.partition("*")
        form = rough(fixed)
        if any(form[:n] in self.rough for n in range(1, len(form) + 1)):
            return True
        return bool(star) and any((len(f) <= len(text) or not text.isascii()) and f.startswith(form) for f in self.rough)

    def further(self, token: bytes) -> list[bytes]:
        """Readings of a token that is not suspicious by itself; of use only where the lexicon knows them.

        The likeliest one of the token, without punctuation around it, and without exclamation marks at its end. A
        longer token is read part by part.
        """
        text = token.decode("utf-8", "replace")
        if len(text) > UNBROKEN:
            return list(dict.fromkeys(r for part in APART.split(text) if part for r in self._part(part)))
        if not BESIDE.search(text) or not LETTER.search(text):
            return []
        if not any(self.possible(text[i:]) for i in range(len(text)) if not i or not text[i - 1].isalpha()):
            return []
        core = text.strip("\"'(),.:;?")
        return [r.encode() for r in dict.fromkeys((self.decode(core), self.decode(text), self.decode(core.rstrip("!"))))]

    def _part(self, text: str) -> list[bytes]:
        if len(text) <= UNBROKEN:
            return self.further(text.encode())
        text = LONG_REPEAT.sub(r"\1\1\1", text)
        found = []
        for i in range(len(text)):
            if (not i or not text[i - 1].isalpha()) and self.possible(window := text[i : i + UNBROKEN]):
                found.append(self.decode(window).encode())
        return found


#: Tokens up to this length are read whole; longer ones are split at these signs, and what is still longer is read from
#: every place where a word may begin.
UNBROKEN = 64
APART = re.compile(r"[,;:()\[\]{}<>\"/\\?=&]+")

#: Beginnings of words that are features beside the words themselves.
BEGINNINGS = (4, 5, 6)
#: The bound of the training sample, in labelled numbers.
SAMPLE = 20_000
#: A feature needs so many different toxic documents, at least this share of them, and this precision.
LEAST, LEAST_SHARE, LEAST_PRECISION = 6, 0.004, 0.92


def features(word: bytes) -> list[bytes]:
    """The word, its beginnings (marked by a dash), and its form without accents."""
    found = [word, *(word[:n] + b"-" for n in BEGINNINGS if len(word) > n)]
    if not word.isascii():
        plain = unicodedata.normalize("NFKD", word.decode("utf-8", "replace"))
        found.append("".join(c for c in plain if not unicodedata.combining(c)).encode())
    return found


def sketch(words: list[bytes]) -> int:
    """The smallest hash of three words in a row: mostly the same for near copies, and for nothing else."""
    runs = zip(words, words[1:], words[2:], strict=False) if len(words) > 2 else [words]
    return min(xxhash.xxh3_64_intdigest(b" ".join(run)) for run in runs) - 2**63


@dataclass
class Model:
    """Costs of the character model, the precision of each toxic feature, and the rate without any."""

    costs: np.ndarray
    lexicon: dict[bytes, float]
    rest: float

    def scorer(self):
        lexicon = self.lexicon
        decoder = Decoder(self.costs.tolist(), rough=frozenset(rough(f.decode("utf-8", "replace")) for f in lexicon))

        def value(word: bytes) -> float:
            return max((lexicon.get(f, 0.0) for f in features(word)), default=0.0)

        class Known(dict):
            """The toxic words of a token, as it stands or else as it may have been meant."""

            def __missing__(self, token: bytes) -> tuple:
                if len(self) >= REMEMBERED:
                    self.clear()
                found = [(w, p) for w in words_of(token) if (p := value(w))]
                for reading in [] if found else decoder.further(token):
                    found += [(w, p) for w in words_of(reading) if (p := value(w))]
                self[token] = tuple(found)
                return self[token]

        known = Known()

        def score(text: bytes) -> float:
            clean = 1.0 - self.rest
            for _, p in {pair for token in set(decoder.restore(text).split()) for pair in known[token]}:
                clean *= 1.0 - p
            return 1.0 - clean

        return score


def fit(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label: str = "toxic",
    id_column: str = "doc_id",
    text_column: str = "text",
    rows: int = SAMPLE,
) -> Model:
    """Learn the lexicon from at most ``rows`` labelled rows; the character model is counted over all ``docs``.

    Copies must not make a chance word look toxic, so documents with the same sketch count once. Without labels the lexicon is empty and all
    scores are the same, and so they are for an empty table. Rows without a number are counted by the character model and not
    learned from; null texts are empty; of repeated numbers one text is learned from. Other columns are not looked at.
    """
    costs = character_model(docs, text_column)
    sample = staged(training_rows(docs, labels, label, usable, rows, id_column, text_column).select("label", "text"), "toxicity-sample")

    def found():
        decoder = Decoder(costs.tolist())

        def row(label: int, text: bytes) -> Iterator[tuple]:
            words = words_of(decoder.restore(text))
            yield label, sketch(words), list({f for w in set(words) for f in features(w)}) if label else []

        return row

    toxic = map_rows(sample.where("label > 0"), "label int, sketch long, found array<binary>", found)
    totals = toxic.select("sketch").distinct().count()
    least = max(LEAST, math.ceil(LEAST_SHARE * totals))
    exploded = toxic.select("sketch", F.explode("found").alias("feature")).distinct()
    candidates = exploded.groupBy("feature").count().where(F.col("count") >= least).collect()
    number = {bytes(feature): i for i, (feature, _) in enumerate(candidates)}

    def known():
        decoder = Decoder(costs.tolist())

        def row(label: int, text: bytes) -> Iterator[tuple]:
            words = words_of(decoder.restore(text))
            hits = {number[f] for w in set(words) for f in features(w) if f in number}
            yield label, sketch(words), sorted(hits)

        return row

    # What the documents have is counted by Spark: the driver gets one number per feature and label.
    seen = staged(map_rows(sample, "label int, sketch long, found array<int>", known), "toxicity-features")
    discard(sample)
    hits_of = seen.select((F.col("label") > 0).alias("toxic"), "sketch", F.explode("found").alias("feature"))
    # A feature of toxic documents counts once for all documents with one sketch.
    counted = hits_of.where("not toxic").groupBy("toxic", "feature").count()
    counted = counted.unionByName(hits_of.where("toxic").distinct().groupBy("toxic", "feature").count())
    counts = np.zeros((2, len(number)))
    for is_toxic, feature, n in counted.collect():
        counts[int(is_toxic), feature] = n
    precision = counts[1] / (counts.sum(axis=0) + 0.5)
    good = (precision >= LEAST_PRECISION) & (counts[1] >= least)

    def bare():
        return lambda label, found: iter(() if good[np.array(found, np.int32)].any() else ((label,),))

    rest = map_rows(seen.select("label", "found"), "label int", bare)
    documents, toxic_ones = rest.agg(F.count(F.lit(1)), F.count_if(F.col("label") > 0)).first()
    discard(seen)
    lexicon = {feature: float(precision[i]) for feature, i in number.items() if good[i]}
    return Model(costs, lexicon, min(0.45, (toxic_ones + 0.5) / (documents + 50)))


def scored(df: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, score`` of every row: 0 to 1, higher means likelier toxic.

    Whole texts are read. Null and empty texts have no words and get the rate of texts without a
    toxic word. Rows without a number and repeated rows are scored by themselves. Other columns are not looked at; an empty
    table gives no rows.
    """

    def each():
        score = model.scorer()
        return lambda doc_id, text: iter([(doc_id, score(text))])

    return map_rows(texts(df, id_column, text_column), "doc_id long, score double", each)


def restored(df: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, text`` with the decoded text, in lower case."""

    def each():
        decoder = Decoder(model.costs.tolist())
        return lambda doc_id, text: iter([(doc_id, decoder.restore(text).decode("utf-8", "replace"))])

    return map_rows(texts(df, id_column, text_column), "doc_id long, text string", each)


def without_toxic(df: DataFrame, model: Model, text_column: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows with a score under ``threshold``, with all columns whatever their names.

    Null and empty texts have no toxic word and stay. Rows without a number and repeated rows are judged by themselves; an empty
    table stays empty.
    """

    def each():
        score = model.scorer()
        return lambda text: score(text) < threshold

    return rows_where(df, text_column, each)


def not_held_out(modulus: int = 5, held_out: int = 0) -> Column:
    return remainder("doc_id", modulus) != held_out
