"""Benchmark decontamination by latent semantic retrieval.

All documents are cut into passages of words and weighted by TF-IDF over the benchmark's
vocabulary. A distributed randomised SVD gives the latent space: every task adds up what its
passages contribute to the sketch, and one small matrix reaches the driver. Passages and
benchmark windows are compared by cosine there. What is close is checked: the longest common
subsequence of words must cover most of the item, or half of it and most of its end, where the
answer stands, so that paraphrases are caught as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import map_rows, map_tables, texts
from wattline.llm.labelled import rows_where
from wattline.llm.license_scan import WORDS, words_of

#: Words of a passage; passages begin at every ``STEP`` words, windows of an item at every ``ITEM_STEP``.
PASSAGE, STEP, ITEM_STEP = 16, 8, 4
#: Columns that terms are hashed to, latent dimensions, and extra columns of the sketch.
WIDTH, RANK, EXTRA = 1024, 96, 16
#: Least cosine of a candidate; least share of an item that a copy covers; the same for a paraphrase, and for its end.
CLOSE, COPY, PARAPHRASE, ANSWER = 0.6, 0.75, 0.5, 0.6
#: Items that are searched for at once. Longer benchmarks are searched in blocks of this many.
ITEMS = 10_000
#: Counts of words that a task holds at once where items are compared with a text.
COUNTS = 1 << 22
#: Passages of a text that are compared at once, and passages that a task gathers before it adds them up.
TOGETHER, GATHERED = 128, 30_000
#: Bytes of texts that are cut into words at once, or one text.
CUT = 1 << 20


@dataclass
class Index:
    """A block of the benchmark, the weights of its terms, and the latent space."""

    numbers: list[int | None]
    items: list[np.ndarray]
    vocabulary: dict[bytes, int]
    columns: np.ndarray
    signs: np.ndarray
    weights: np.ndarray
    space: np.ndarray
    queries: np.ndarray
    query_item: np.ndarray
    query_offset: np.ndarray

    def directions(self, ids: np.ndarray) -> np.ndarray:
        """What each word adds to the vector of its passage; nothing if the benchmark does not have it."""
        return self._word_directions.take(ids, axis=0)

    @cached_property
    def _lengths(self) -> np.ndarray:
        return np.fromiter(map(len, self.items), np.int64, len(self.items))

    @cached_property
    def _slacks(self) -> np.ndarray:
        """By how many words an item's place in a text may be off."""
        return np.maximum(4, self._lengths // 4)

    @cached_property
    def _holders(self) -> tuple[np.ndarray, np.ndarray]:
        """The items that have word 0, then word 1 and so on, each as often as it has the word, and where each word's items begin."""
        words = np.concatenate(self.items)
        order = np.argsort(words)
        holders = np.repeat(np.arange(len(self.items)), self._lengths)[order]
        return holders, np.searchsorted(words[order], np.arange(len(self.weights) + 1))

    @cached_property
    def _word_directions(self) -> np.ndarray:
        """The direction of every word of the vocabulary, weighted; made once a task."""
        found = self.space.take(self.columns, axis=0)
        found *= (self.weights * self.signs).astype(np.float32)[:, None]
        found[0] = 0.0
        return found

    def __getstate__(self) -> dict:
        return {name: value for name, value in self.__dict__.items() if name != "_word_directions"}

    def latent(self, rows: np.ndarray) -> np.ndarray:
        """Unit vectors of passages, given as rows of word numbers padded with 0."""
        vectors = np.zeros((len(rows), self.space.shape[1]), np.float32)
        for i in range(rows.shape[1]):
            vectors += self.directions(rows[:, i])
        return unit(vectors)

    def near(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Candidates in ascending order: items and where in the text they would begin.

        Every passage is compared with the windows of all items that can be found near it (``_possible``).
        """
        starts = passage_starts(len(ids), STEP) if len(self.items) else []
        keys = []
        # Beginnings may lie before the text; a key is the item's number times the span, plus the shifted beginning.
        shift = int(self.query_offset.max(initial=0))
        span = len(ids) + shift + 1
        # Of an item's candidates within one slack ``matches`` checks the first, so this looks one slack further than it does:
        # where the first is left out, none of them could be found.
        reach = int((self._lengths + 3 * self._slacks).max(initial=0))
        for begin in range(0, len(starts), TOGETHER):
            part = starts[begin : begin + TOGETHER]
            possible = self._possible(ids[max(0, part[0] - reach) : part[-1] + reach])
            windows = np.flatnonzero(possible[self.query_item])
            if not len(windows):
                continue
            cosines = unit(self._passages(ids, part)) @ self.queries[windows].T
            passage, query = np.divmod(np.flatnonzero(cosines >= CLOSE), len(windows))
            query = windows[query]
            keys.append(self.query_item[query] * span + part[passage] - self.query_offset[query] + shift)
        items, begins = np.divmod(np.unique(np.concatenate(keys)) if keys else np.empty(0, np.int64), span)
        return items, begins - shift

    def _possible(self, ids: np.ndarray) -> np.ndarray:
        """Whether each item can be found in these words at all: enough of its words occur there, in whatever order.

        No common subsequence is longer than that, so what is left out here would fail the check of ``matches``.
        """
        holders, begins = self._holders
        words = np.flatnonzero(np.bincount(ids))
        words = words[words > 0]
        counts = begins[words + 1] - begins[words]
        at = np.arange(counts.sum()) + np.repeat(begins[words] - np.cumsum(counts) + counts, counts)
        return np.bincount(holders[at], minlength=len(self.items)) >= min(COPY, PARAPHRASE) * self._lengths

    def _passages(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Vectors of passages in a row, put together from runs of ``STEP`` words; only the last may lie off the grid."""
        aligned = starts[starts % STEP == 0]
        vectors = np.zeros((len(starts), self.space.shape[1]), np.float32)
        if len(aligned):
            words = ids[aligned[0] : aligned[-1] + PASSAGE]
            padded = np.zeros(STEP * (len(aligned) - 1) + PASSAGE, ids.dtype)
            padded[: len(words)] = words
            runs = self.directions(padded).reshape(-1, STEP, vectors.shape[1]).sum(axis=1)
            for i in range(PASSAGE // STEP):
                vectors[: len(aligned)] += runs[i : i + len(aligned)]
        if len(aligned) < len(starts):
            vectors[-1] = self.directions(ids[starts[-1] : starts[-1] + PASSAGE]).sum(axis=0)
        return vectors

    def _in_reach(self, ids: np.ndarray, items: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> np.ndarray:
        """How many words between ``lows`` and ``highs`` each candidate's item has; items are in ascending order.

        Items are counted together, as many as keep the counts of a long text small.
        """
        firsts = np.flatnonzero(np.diff(items, prepend=-1))
        distinct, counts = items[firsts].tolist(), np.diff(np.append(firsts, len(items)))
        found = np.empty(len(items), np.int64)
        together = max(1, min(64, COUNTS // (len(ids) + len(self.weights))))
        for begin in range(0, len(distinct), together):
            part, sizes = distinct[begin : begin + together], counts[begin : begin + together]
            flags = np.zeros((len(part), len(self.weights)), bool)
            flags[np.repeat(np.arange(len(part)), self._lengths[part]), np.concatenate([self.items[i] for i in part])] = True
            held = np.zeros((len(part), len(ids) + 1), np.int32)
            np.cumsum(flags.take(ids, axis=1), axis=1, out=held[:, 1:])
            row = np.repeat(np.arange(len(part)), sizes)
            at = slice(firsts[begin], firsts[begin] + len(row))
            found[at] = held[row, highs[at]] - held[row, lows[at]]
        return found

    def matches(self, ids: np.ndarray) -> list[tuple[int, float, float, int, int]]:
        """Item, share covered, share of its end covered, and the begin and end word searched, best place of each item."""
        best: dict[int, tuple] = {}
        items, begins = self.near(ids)
        if not len(items):
            return []
        lengths, slacks = self._lengths[items], self._slacks[items]
        lows, highs = np.maximum(0, begins - 2 * slacks), np.minimum(len(ids), begins + lengths + 2 * slacks)
        # No common subsequence is longer than the number of words in reach that the item has at all.
        enough = np.flatnonzero(self._in_reach(ids, items, lows, highs) >= min(COPY, PARAPHRASE) * lengths)
        firsts = np.flatnonzero(np.diff(items[enough], prepend=-1))
        for first, last in pairwise([*firsts.tolist(), len(enough)]):
            at = enough[first:last]
            item = int(items[at[0]])
            wanted, slack, checked = self.items[item].tolist(), int(slacks[at[0]]), set()
            answer = wanted[-max(3, len(wanted) // 4) :]
            for begin, low, high in zip(begins[at].tolist(), lows[at].tolist(), highs[at].tolist(), strict=True):
                if begin // slack in checked:
                    continue
                checked.add(begin // slack)
                region = ids[low:high].tolist()
                covered = common_length(wanted, region) / len(wanted)
                if covered < min(COPY, PARAPHRASE):
                    continue
                ended = common_length(answer, region) / len(answer)
                if covered >= COPY or covered >= PARAPHRASE and ended >= ANSWER:
                    best[item] = max(best.get(item, (0.0,)), (covered, ended, low, high))
        return [(item, *found) for item, found in sorted(best.items())]


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.sqrt((vectors**2).sum(1, keepdims=True)), 1e-9)


def passage_starts(words: int, step: int) -> np.ndarray:
    """Begins of passages; the last one reaches the end of the text."""
    if not words:
        return np.empty(0, np.int64)
    starts, last = np.arange(0, max(1, words - PASSAGE + 1), step), max(0, words - PASSAGE)
    return starts if starts[-1] == last else np.append(starts, last)


def numbers(column: pa.Array, vocabulary: dict[bytes, int]) -> Iterator[np.ndarray]:
    """The numbers of the words (``words_of``) of each text, cut and looked up for many texts at once; 0 for words not in the vocabulary."""
    known = pa.array(list(vocabulary), pa.binary()).view(pa.string())
    number = np.array([0, *vocabulary.values()], np.int32)
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < len(column):
        end = max(begin + 1, int(np.searchsorted(sizes, CUT + (sizes[begin - 1] if begin else 0), "right")))
        texts = [(t or b"").translate(WORDS) for t in column[begin:end].to_pylist()]
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
        words = split.flatten()
        found = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False)
        held = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0  # white space at the ends of a text leaves empty words
        ids, bounds = number[found[held] + 1], np.append(0, np.cumsum(held))[split.offsets.to_numpy()]
        for first, last in pairwise(bounds.tolist()):
            yield ids[first:last]
        begin = end


def _cut(ids: np.ndarray) -> np.ndarray:
    """Passages one after the other, as rows of word numbers padded with 0."""
    padded = np.zeros(-(-len(ids) // PASSAGE) * PASSAGE, ids.dtype)
    padded[: len(ids)] = ids
    return padded.reshape(-1, PASSAGE)


class Gathered:
    """The passages of a task with words of the benchmark; ``settle`` gets them in blocks of bounded size."""

    def __init__(self, settle: Callable[[np.ndarray], None]):
        self.settle, self.waiting, self.count = settle, [], 0

    def add(self, rows: np.ndarray) -> None:
        self.waiting.append(rows[rows.any(axis=1)])
        self.count += len(self.waiting[-1])
        if self.count >= GATHERED:
            self.close()

    def close(self) -> None:
        rows = np.concatenate(self.waiting) if self.waiting else []
        self.waiting, self.count = [], 0
        for begin in range(0, len(rows), GATHERED):
            self.settle(rows[begin : begin + GATHERED])


def _rows(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    padded = np.concatenate([ids, np.zeros(PASSAGE, ids.dtype)])
    return padded[starts[:, None] + np.arange(PASSAGE)]


def common_length(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, by bit-parallel dynamic programming; 0 matches nothing."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        if x:
            places[x] = places.get(x, 0) | 1 << i
    row, full = 0, (1 << len(a)) - 1
    for at in filter(None, map(places.get, b)):
        either = row | at
        row = either & ~(either - (row << 1 | 1)) & full
    return row.bit_count()


def _terms(vocabulary: Broadcast, docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many passages each term occurs, over all documents, and the number of passages."""

    def each():
        counts, passages = np.zeros(len(vocabulary.value) + 1, np.int64), 0

        def settle(rows: np.ndarray) -> None:
            rows = np.sort(rows, axis=1)
            first = np.ones(rows.shape, bool)
            first[:, 1:] = rows[:, 1:] != rows[:, :-1]
            counts[:] += np.bincount(rows[first], minlength=len(counts))

        gathered = Gathered(settle)

        def row(_: int | None, ids: np.ndarray) -> Iterator[dict]:
            nonlocal passages
            rows = _cut(ids)
            gathered.add(rows)
            passages += len(rows)
            return iter(())

        def finish() -> Iterator[dict]:
            gathered.close()
            seen = np.flatnonzero(counts)
            yield {"term": np.append(seen, -1), "n": np.append(counts[seen], passages)}

        row.finish = finish
        return row

    readers = {"text": lambda column: numbers(column, vocabulary.value)}
    rows = map_tables(docs, "term long, n long", each, readers).groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(len(vocabulary.value) + 1)
    for term, n in rows:
        if term >= 0:
            counts[term] = n
    return counts, sum(n for term, n in rows if term < 0)


def _sketch(model: Broadcast, docs: DataFrame, test: np.ndarray) -> np.ndarray:
    """The product of the passages' Gram matrix with ``test``, over all documents.

    A task adds up the Gram matrix of its passages and sends its product with ``test``; Spark adds
    these up by cell.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(test)

    def each():
        _, columns, values = model.value
        above, diagonal = np.zeros(WIDTH * WIDTH), np.zeros(WIDTH)  # pairs of words in one order only, and words with themselves

        def settle(rows: np.ndarray) -> None:
            sizes = np.count_nonzero(rows, axis=1)
            cells, products = [], []
            for size in range(1, PASSAGE + 1):  # passages with as many known words, without the unknown ones
                words = rows[sizes == size]
                words = words[words > 0].reshape(-1, size)
                at, weight = columns[words], values[words]
                diagonal[:] += np.bincount(at.ravel(), (weight**2).ravel(), WIDTH)
                left, right = np.triu_indices(size, 1)
                cells.append((at[:, left] * WIDTH + at[:, right]).ravel())
                products.append((weight[:, left] * weight[:, right]).ravel())
            above[:] += np.bincount(np.concatenate(cells), np.concatenate(products), WIDTH * WIDTH)

        gathered = Gathered(settle)

        def row(_: int | None, ids: np.ndarray) -> Iterator[dict]:
            gathered.add(_cut(ids))
            return iter(())

        def finish() -> Iterator[dict]:
            gathered.close()
            gram = above.reshape(WIDTH, WIDTH)
            gram = gram + gram.T + np.diag(diagonal)
            product = (gram @ shared.value).ravel()
            if product.any():
                yield {"cell": np.arange(product.size), "value": product}

        row.finish = finish
        return row

    readers = {"text": lambda column: numbers(column, model.value[0])}
    sums = map_tables(docs, "cell long, value double", each, readers).groupBy("cell").agg(F.sum("value").alias("value")).collect()
    found = np.zeros(test.size)
    for cell, value in sums:
        found[cell] = value
    return found.reshape(test.shape)


def singular_vectors(sketch: np.ndarray, test: np.ndarray, rank: int) -> np.ndarray:
    """The leading right singular vectors of the passages, from the sketch of their Gram matrix (Nystrom's method)."""
    shift = 1e-7 * max(1e-12, float(np.linalg.norm(sketch)))
    shifted = sketch + shift * test
    core = test.T @ shifted
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    root = vectors / np.sqrt(np.maximum(values, shift * 1e-3))
    left, _, _ = np.linalg.svd(shifted @ root, full_matrices=False)
    return left[:, :rank]


def _item_rows(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = passage_starts(len(ids), ITEM_STEP)
    return _rows(ids, starts), starts


def build(docs: DataFrame, items: list[tuple[int | None, bytes]], id_column: str = "doc_id", text_column: str = "text") -> Index:
    """The index of a block of items. Document frequencies and the sketch cover all of ``docs``."""
    spark = docs.sparkSession
    split = [(number, words_of(text)) for number, text in items]
    split = [(number, words) for number, words in split if words]
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, words in split for w in words}), 1)}
    plain = texts(docs, id_column, text_column)
    rng = np.random.default_rng(11)
    columns = np.concatenate([[0], rng.integers(0, WIDTH, len(vocabulary))])
    signs = np.concatenate([[0.0], rng.choice([-1.0, 1.0], len(vocabulary))])

    known = spark.sparkContext.broadcast(vocabulary)
    counts, passages = _terms(known, plain)
    weights = np.log((1 + passages) / (1 + counts)) + 1e-3
    weights[0] = 0.0  # a word that the benchmark does not have takes no part in the comparison
    values = weights * signs
    test = np.linalg.qr(rng.normal(size=(WIDTH, RANK + EXTRA)))[0]
    model = spark.sparkContext.broadcast((vocabulary, columns, values))
    space = singular_vectors(_sketch(model, plain, test), test, RANK).astype(np.float32)

    index = Index(
        [number for number, _ in split],
        [np.array([vocabulary[w] for w in words], np.int64) for _, words in split],
        vocabulary, columns, signs, weights, space, np.zeros((0, RANK), np.float32), np.zeros(0, int), np.zeros(0, int),
    )
    windows = [_item_rows(ids) for ids in index.items]
    if windows:
        index.queries = index.latent(np.concatenate([rows for rows, _ in windows]))
        index.query_item = np.repeat(np.arange(len(windows)), [len(starts) for _, starts in windows])
        index.query_offset = np.concatenate([starts for _, starts in windows])
    return index


def indexes(docs: DataFrame, benchmark: DataFrame, item_column: str = "item_id", id_column: str = "doc_id", text_column: str = "text") -> list[Broadcast]:
    """The benchmark, a stated query set, in blocks of bounded size, each with its own index."""
    number = F.col(item_column).cast("long").alias("number")
    rows = benchmark.select(number, F.coalesce("text", F.lit("")).cast("binary").alias("text")).distinct().orderBy("number", "text")
    items, blocks = [], []
    for found in rows.toLocalIterator():
        items.append((found.number, bytes(found.text)))
        if len(items) == ITEMS:
            blocks.append(items)
            items = []
    blocks += [items] if items else []
    context = docs.sparkSession.sparkContext
    return [context.broadcast(build(docs, block, id_column, text_column)) for block in blocks]


def _numbers_by_block(blocks: list[Broadcast]) -> Callable[[pa.Array], Iterator[list[np.ndarray]]]:
    """For each text its word numbers in every block."""

    def read(column: pa.Array) -> Iterator[list[np.ndarray]]:
        found = [numbers(column, block.value.vocabulary) for block in blocks]
        return ([next(ids) for ids in found] for _ in range(len(column)))

    return read


def contaminated(
    df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document and benchmark item found in it: ``doc_id, item_id, covered, answer, begin, end``.

    ``covered`` and ``answer`` are the shares of the item and of its end that the document has in
    order; ``begin`` and ``end`` are the words between which it was found. Whole texts are searched.
    Null and empty texts and items match nothing; rows without a number and repeated rows are
    searched by themselves. An empty table on either side gives no rows.
    """
    blocks = indexes(df, benchmark, id_column=id_column, text_column=text_column)

    def each():
        def row(doc_id: int | None, numbered: list[np.ndarray]) -> Iterator[tuple]:
            for block, ids in zip(blocks, numbered, strict=True):
                index = block.value
                for item, covered, answer, begin, end in index.matches(ids):
                    yield doc_id, index.numbers[item], covered, answer, begin, end

        return row

    schema = "doc_id long, item_id long, covered double, answer double, begin long, end long"
    return map_rows(texts(df, id_column, text_column), schema, each, {"text": _numbers_by_block(blocks)})


def without_benchmark(df: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows in which no benchmark item is found, with all columns whatever their names; nothing is shuffled.

    Null and empty texts hold no item and stay. Rows without a number and repeated rows are judged by themselves. An empty
    benchmark keeps every row, an empty table stays empty.
    """
    blocks = indexes(df, benchmark, id_column=id_column, text_column=text_column)

    def each():
        return lambda numbered: not any(block.value.matches(ids) for block, ids in zip(blocks, numbered, strict=True))

    return rows_where(df, text_column, each, _numbers_by_block(blocks))
