"""Hashes of words and of runs of words, and bitmaps of the ones that repeat."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import map_tables

#: Texts are hashed in stretches of about this many bytes.
STRETCH = 1 << 17
#: Odd bases of polynomial hashes modulo 2**64.
BASE, SECOND_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
#: Bits of a bitmap, 8 MB whatever the size of the input, and how many are set for each key.
FILTER_BITS, PROBES = 26, 3
#: Tokens that a task gathers before it counts them.
GATHERED = 1 << 22

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_SAME = np.arange(1, 257, dtype=np.uint64)
_LOWER = _SAME.copy()
_LOWER[65:91] += 32


def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        return np.cumprod(factors)


class WordHashes:
    """64-bit hashes of the words of a text, the same on every machine; words are what white space separates."""

    def __init__(self, lower: bool = False) -> None:
        self.codes = _LOWER if lower else _SAME
        self.up = _powers(BASE, 2 * STRETCH)
        self.down = _powers(pow(BASE, -1, 2**64), 2 * STRETCH)

    def of(self, text: bytes) -> np.ndarray:
        if len(text) <= STRETCH:
            return self._stretch(text)
        parts, begin = [], 0
        while begin < len(text):
            end = self._cut(text, begin)
            parts.append(self._stretch(text[begin:end]))
            begin = end
        return np.concatenate(parts)

    @staticmethod
    def _cut(text: bytes, begin: int) -> int:
        """The first white space after a stretch, so that no word is cut."""
        blanks = (text.find(c, begin + STRETCH) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
        return min((at for at in blanks if at >= 0), default=len(text))

    def _stretch(self, text: bytes) -> np.ndarray:
        raw = np.frombuffer(text, np.uint8)
        if len(raw) > len(self.up):
            self.up = _powers(BASE, len(raw))
            self.down = _powers(pow(BASE, -1, 2**64), len(raw))
        inside = ~_BLANK[raw]
        edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        begins, ends = edges[::2], edges[1::2]
        with np.errstate(over="ignore"):
            sums = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(self.codes[raw] * self.up[: len(raw)], out=sums[1:])
            return mixed((sums[ends] - sums[begins]) * self.down[begins])


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of MurmurHash3)."""
    with np.errstate(over="ignore"):
        v = values ^ (values >> np.uint64(33))
        v *= np.uint64(0xFF51AFD7ED558CCD)
        v ^= v >> np.uint64(33)
        v *= np.uint64(0xC4CEB9FE1A85EC53)
        v ^= v >> np.uint64(33)
        return v


def rolling(hashes: np.ndarray, length: int, base: int = BASE) -> np.ndarray:
    """A 64-bit hash of each run of ``length`` words; long runs are put together from runs of half the length."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, done, size, power, runs = np.zeros(n, np.uint64), 0, 1, base, hashes
    with np.errstate(over="ignore"):
        for bit in range(length.bit_length()):
            if length >> bit & 1:
                out = out * np.uint64(power) + runs[done : done + n]
                done += size
            if length >> (bit + 1):
                runs = runs[:-size] * np.uint64(power) + runs[size:]
                power = power * power % 2**64
                size *= 2
    return mixed(out)


def _keys(tokens: np.ndarray) -> np.ndarray:
    """48 bits of a token: the upper 16 choose a bucket, the lower 32 stand for it there."""
    return (tokens >> np.uint64(48) << np.uint64(32)) | (tokens & np.uint64(0xFFFFFFFF))


def _place(keys: np.ndarray, probe: int) -> np.ndarray:
    return mixed(keys + np.uint64(probe + 1)) & np.uint64((1 << FILTER_BITS) - 1)


def passes(bits: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Which tokens the bitmap may hold; never false for one that it does."""
    keys, at = _keys(tokens), np.arange(len(tokens))
    for probe in range(PROBES):
        place = _place(keys, probe)
        hit = (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        keys, at = keys[hit], at[hit]
    alive = np.zeros(len(tokens), bool)
    alive[at] = True
    return alive


def repeated(docs: DataFrame, tokens_of: Callable[[], Callable[..., np.ndarray]], least: int) -> Broadcast:
    """A bitmap of the tokens that occur at least ``least`` times in all rows of ``docs``.

    ``tokens_of()`` runs once per task and gives the tokens of a row. A task counts what it has
    gathered, so a very common token is one number there; keys travel as packed arrays by
    bucket, and a bucket is counted at a time. 48 bits may take two tokens for one: such a token
    passes in error, which costs work later but changes no result. The driver gets at most
    2048 parts of 4 KB.
    """

    def gather():
        of = tokens_of()
        waiting: list[np.ndarray] = []
        held = 0

        def settle() -> Iterator[dict]:
            keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
            waiting.clear()
            buckets = keys >> np.uint64(32)
            limits = np.flatnonzero(np.diff(buckets, prepend=np.uint64(1 << 20)))
            low, many = keys.astype("<u4").tobytes(), np.minimum(counts, 255).astype(np.uint8).tobytes()
            ends = np.append(limits[1:], len(keys))
            spans = list(zip(limits.tolist(), ends.tolist(), strict=True))
            for i in range(0, len(spans), 4096):
                part = spans[i : i + 4096]
                yield {
                    "bucket": buckets[limits[i : i + 4096]].astype(np.int32),
                    "keys": [low[4 * a : 4 * b] for a, b in part],
                    "counts": [many[a:b] for a, b in part],
                }

        def row(*values) -> Iterator[dict]:
            nonlocal held
            tokens = of(*values)
            if len(tokens):
                waiting.append(_keys(tokens))
                held += len(tokens)
                if held >= GATHERED:
                    held = 0
                    yield from settle()

        def finish() -> Iterator[dict]:
            if waiting:
                yield from settle()

        row.finish = finish
        return row

    def count():
        open_bucket, parts = None, []

        def settle() -> Iterator[dict]:
            low = np.concatenate([np.frombuffer(k, "<u4") for k, _ in parts])
            many = np.concatenate([np.frombuffer(c, np.uint8) for _, c in parts])
            parts.clear()
            order = np.argsort(low, kind="stable")
            low, many = low[order], many[order].astype(np.int64)
            first = np.flatnonzero(np.diff(low.astype(np.int64), prepend=-1))
            keys = low[first][np.add.reduceat(many, first) >= least].astype(np.uint64)
            if len(keys):
                keys |= np.uint64(open_bucket << 32)
                yield {"place": np.concatenate([_place(keys, probe) for probe in range(PROBES)]).astype(np.int64)}

        def row(bucket: int, keys: bytes, counts: bytes) -> Iterator[dict]:
            nonlocal open_bucket
            if bucket != open_bucket and parts:
                yield from settle()
            open_bucket = bucket
            parts.append((keys, counts))

        def finish() -> Iterator[dict]:
            if parts:
                yield from settle()

        row.finish = finish
        return row

    packed = map_tables(docs, "bucket int, keys binary, counts binary", gather)
    places = map_tables(packed.repartition("bucket").sortWithinPartitions("bucket"), "place long", count)
    place = F.col("place") + 1
    blocks = places.groupBy(F.bitmap_bucket_number(place).alias("block"))
    blocks = blocks.agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for block, part in blocks:
        bits[(block - 1) * 4096 : block * 4096] = np.frombuffer(part, np.uint8)
    return docs.sparkSession.sparkContext.broadcast(bits)
