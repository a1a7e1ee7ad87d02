"""Packing by concatenation and cutting.

All documents, each ended by one id, form one long run of ids that is cut into windows of equal
length. Pass one tokenises and gives each document its start within its task; the totals of the
tasks, added up in order, turn these into places in the whole run. Pass two cuts every document at
the window limits, without any shuffle. Windows that reach over the end of a task are put together
from boundary records.
"""

from __future__ import annotations

import base64
import sys
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattline.llm.common import REMEMBERED, map_rows, staged, texts

LENGTH = 1024
END = 0
VOCABULARY = "byte_bpe_50k"
#: Longer runs without a space are not remembered.
LONGEST_WORD = 40
#: The fast encoder ends a task on longer runs of white space.
LONG_WHITE = regex.compile(r"\s{50000}")


class Inseparable(Exception):
    """White space next to a space: the text cannot be read word by word."""


class Pieces(dict):
    """The ids of a word with the space before it, as 16-bit numbers; remembers a bounded number of words.

    The vocabulary's pattern starts a new piece at every single space, so the ids of a text are
    those of its words in order. What is remembered has been found to be a word, so texts are not searched for
    double spaces.
    """

    def __init__(self, encode) -> None:
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if word[-1:].isspace() or word[1:2].isspace() or not word:
            raise Inseparable
        value = packed(self.encode(word))
        if len(word) <= LONGEST_WORD:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = value
        return value


def packed(ids: list[int]) -> bytes:
    """Little-endian 16-bit numbers."""
    numbers = array("H", ids)
    if sys.byteorder == "big":
        numbers.byteswap()
    return numbers.tobytes()


class Encoder:
    """Token ids of whole texts, as the JSON vocabulary gives them without added special tokens.

    The rank file holds the same vocabulary and is faster. Texts that spell a special token out and texts with very long
    runs of white space go through the JSON vocabulary itself.
    """

    def __init__(self, vocabulary: str) -> None:
        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        pattern = public_tokenizers.PATTERN
        plain = tiktoken.Encoding(vocabulary, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.encode = plain.encode_ordinary
        self.full = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self.special = [token.content for token in self.full.get_added_tokens_decoder().values()]
        self.pieces = Pieces(self.encode)

    def ids(self, text: str) -> bytes:
        """The ids as little-endian 16-bit numbers."""
        if any(token in text for token in self.special):
            return self._full(text)
        first, *rest = text.split(" ")
        try:
            return self.pieces[first] + b"".join(map(self.pieces.__getitem__, [" " + word for word in rest]))
        except Inseparable:
            return self._full(text) if LONG_WHITE.search(text) else packed(self.encode(text))

    def _full(self, text: str) -> bytes:
        return packed(self.full.encode(text, add_special_tokens=False).ids)


@cache
def encoder(vocabulary: str) -> Encoder:
    return Encoder(vocabulary)


def tokenised(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """Pass one: ``part, start, doc_id, n, ids`` with the start within the task; written, so that it stays as it is."""

    def each():
        encode, part, at = encoder(vocabulary).ids, TaskContext.get().partitionId(), 0

        def row(doc_id: int | None, text: bytes) -> Iterator[tuple]:
            nonlocal at
            ids = encode(text.decode("utf-8", "replace")) + END.to_bytes(2, "little")
            n = len(ids) // 2
            yield part, at, doc_id, n, ids
            at += n

        return row

    rows = map_rows(texts(df, id_column, text_column), "part int, start long, doc_id long, n long, ids binary", each)
    return staged(rows, "tokens")


def placed(tokens: DataFrame) -> DataFrame:
    """The same with each document's start in the whole run. The totals are one row per task of pass one."""
    totals = tokens.groupBy("part").agg(F.max(F.col("start") + F.col("n")).alias("total"))
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    return tokens.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("before") + F.col("start")).alias("place"), "n", "ids"
    )


def pack(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = LENGTH,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id, offset, ids``.

    ``start`` counts the document's ids before the piece, ``ids`` are little-endian unsigned 32-bit
    numbers. Null and empty texts are one id, the end. A document longer than a window becomes many
    pieces. Rows without a number and repeated rows are documents of their own. Only the last
    sequence can be shorter than ``length``. An empty table gives no rows.
    """

    def each():
        def row(doc_id: int | None, place: int, n: int, ids: bytes) -> Iterator[tuple]:
            wide = np.frombuffer(ids, "<u2").astype("<u4")
            done = 0
            while done < n:
                sequence, offset = divmod(place + done, length)
                size = min(n - done, length - offset)
                yield doc_id, done, size, n, sequence, offset, wide[done : done + size].tobytes()
                done += size

        return row

    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    return map_rows(placed(tokenised(df, id_column, text_column, vocabulary)), schema, each)


def sequences(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """The windows themselves: ``sequence_id, n, ids``.

    A task closes every window of which it holds all ids. What is left, the windows over the ends
    of tasks, goes by window as boundary records, at most ``length`` ids each.
    """

    def each():
        kept: dict[str, object] = {}

        def finish() -> Iterator[tuple]:
            if kept:
                yield kept["sequence"], kept["offset"], b"".join(kept["parts"])
                kept.clear()

        def row(sequence: int, offset: int, ids: bytes) -> Iterator[tuple]:
            if kept and (kept["sequence"], kept["end"]) != (sequence, offset):
                yield from finish()
            if not kept:
                kept.update(sequence=sequence, offset=offset, parts=[], end=offset)
            kept["parts"].append(ids)
            kept["end"] += len(ids) // 4
            if kept["end"] == length:
                yield from finish()

        row.finish = finish
        return row

    schema = "sequence_id long, offset long, ids binary"
    records = map_rows(pieces.select("sequence_id", "offset", "ids"), schema, each)
    whole = records.where((F.col("offset") == 0) & (F.length("ids") == 4 * length))
    cut = records.where(~((F.col("offset") == 0) & (F.length("ids") == 4 * length)))
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(ordered, F.lit(b""), lambda all_ids, part: F.concat(all_ids, part["ids"]))
    rows = whole.select("sequence_id", "ids").unionAll(cut.groupBy("sequence_id").agg(joined.alias("ids")))
    return rows.select("sequence_id", (F.length("ids") / 4).cast("long").alias("n"), "ids")
