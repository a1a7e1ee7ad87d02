"""Near duplicates by an exact n-gram Jaccard join over signature trees.

A document is the set of its word shingles. Two sets that are similar enough share one of their first
tokens in any order of all tokens; here rare tokens come first. Documents that share such a
token with a central one and are similar to it become provisional classes. Every document goes to the central one
with which it shares most, the root of its tree; a tree is divided into nodes of bounded size by
class and document size. A node holds the bitmaps of its documents OR-combined, its range of
sizes, and its documents. The dual traversal takes pairs of nodes that share a first token and are not of one
class, drops pairs whose sizes or largest possible overlap are too far apart, does the same with
the documents of the rest, and compares what is left exactly. Links inside a class change no
class, so they are not listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import map_rows, map_tables, staged
from wattline.llm.components import components
from wattline.llm.linking import Classes, Links
from wattline.llm.exact_dedup import SLOTS, split_copies
from wattline.llm.runs import WordHashes, mixed, passes, repeated, rolling

SHINGLE = 5
#: Least similarity in hundredths.
SIMILARITY = 75
#: A token in the first part of more documents than this goes to the end of the order. That moves work, not results.
COMMON = 64
#: Bits of a document's bitmap, and documents of a node.
BITS, NODE = 8192, 256

#: Homes of at least so many documents are settled before nodes are paired.
LARGE_HOME = 32
#: Children of an inner node of the tree over a part, and pairs of nodes compared at once.
CHILDREN, AT_ONCE = 8, 4096

#: A list of dropped rows up to this long is broadcast (16 bytes each), a longer one is joined by a shuffle.
BROADCAST_ROWS = 2_000_000



class Shingles:
    """Sets of shingle hashes, ascending; a text of fewer words is one shingle."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.hashes = WordHashes(lower=True)

    def of(self, text: bytes) -> np.ndarray:
        words = self.hashes.of(text)
        if len(words) >= self.size:
            return np.unique(rolling(words, self.size))
        if not len(words):
            return words
        return mixed(rolling(words, len(words)) + np.uint64(len(words)))


def first_length(n: int, similarity: int) -> int:
    """How many tokens come first: any partner holds one of them."""
    return n - (similarity * n + 99) // 100 + 1 if n else 0


def _ordered(tokens: np.ndarray, common: np.ndarray | None, similarity: int) -> np.ndarray:
    if common is not None:
        late = passes(common, tokens)
        tokens = np.concatenate([tokens[~late], tokens[late]])
    return tokens[: first_length(len(tokens), similarity)]


def _first_tokens(size: int, similarity: int, common: Broadcast | None):
    shingles = Shingles(size)
    late = common.value if common else None
    return lambda text: _ordered(shingles.of(text), late, similarity)


def _judged(docs: DataFrame, size: int, similarity: int, common: Broadcast, shared: Broadcast) -> DataFrame:
    """Every document with its set's size; those with a shared first token also with text, tokens and bitmap."""

    def each():
        shingles = Shingles(size)

        def row(doc_id: int | None, digest: bytes, text: bytes, group_size: int) -> Iterator[tuple]:
            tokens = shingles.of(text)
            first = _ordered(tokens, common.value, similarity)
            places = np.flatnonzero(passes(shared.value, first))
            alive, n = first[places], len(tokens)
            if not len(alive):
                yield doc_id, digest, group_size, n, 0, 0, None, None, None, None
                return
            bits = np.zeros(BITS, np.uint8)
            bits[tokens % np.uint64(BITS)] = 1
            excess = n - int(bits.sum())
            yield (
                doc_id, digest, group_size, n, n - len(first), excess, text, alive.view(np.int64).tolist(),
                places.tolist(), np.packbits(bits).tobytes(),
            )

        return row

    schema = (
        "doc_id long, digest binary, group_size long, n long, rest long, excess long, "
        "text binary, tokens array<long>, places array<int>, bits binary"
    )
    return map_rows(docs.select("doc_id", "digest", "text", "group_size"), schema, each)


def needed(a: str, b: str, similarity: int) -> str:
    """SQL for the least overlap of sets of ``a`` and ``b`` tokens that is similar enough."""
    return f"ceil({similarity} * ({a} + {b}) / {100 + similarity})"


def _verified(pairs: DataFrame, judged: DataFrame, size: int, similarity: int) -> DataFrame:
    """The pairs ``a, b`` whose sets are similar enough, compared exactly."""

    def each():
        shingles = Shingles(size)
        last: list = [None, None]

        def row(a: int, b: int, text_a: bytes, text_b: bytes) -> Iterator[tuple]:
            if last[0] != b:
                last[:] = b, shingles.of(text_b)
            x, y = shingles.of(text_a), last[1]
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= similarity * (len(x) + len(y) - both):
                yield a, b

        return row

    text_a = judged.select(F.col("row").alias("a"), F.col("text").alias("text_a"))
    text_b = judged.select(F.col("row").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.join(text_a, "a").join(text_b, "b").select("a", "b", "text_a", "text_b")
    return map_rows(joined, "a long, b long", each)


def _central(blocks: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of a document and a central one of its first tokens (maybe itself), with how many tokens they met at.

    The central document of a token is the one with the largest share of shared tokens.
    """
    central = F.max(F.struct(F.col("central"), -F.col("row"))).alias("best")
    leaders = staged(blocks.groupBy("token").agg(central).select("token", (-F.col("best.col2")).alias("b")), "join-central")
    met = blocks.select(F.col("row").alias("a"), "token").join(leaders, "token")
    return staged(met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("shared")), "join-met")


def _roots(judged: DataFrame, met: DataFrame, size: int, similarity: int) -> DataFrame:
    """Links of documents to central ones. Pairs that met at few tokens are left to the traversal."""
    sizes = judged.select("row", "n", "rest")
    pairs = met.where("a != b").join(sizes.toDF("a", "n_a", "rest_a"), "a").join(sizes.toDF("b", "n_b", "rest_b"), "b")
    pairs = pairs.where(f"shared + greatest(rest_a, rest_b) >= {needed('n_a', 'n_b', similarity)}")
    pairs = pairs.where(f"least(n_a, n_b) * 100 >= greatest(n_a, n_b) * {similarity}")
    return _verified(staged(pairs.select("a", "b"), "join-pairs"), judged, size, similarity)


class SignatureTree:
    """Documents by size, nodes over them and nodes over nodes: OR-combined bitmaps, ranges of sizes and of classes.

    ``levels[0]`` holds the documents, the last one few nodes. Pairs descend level by level; a pair of nodes goes
    no further if all of it is of one class, or if sizes or the largest possible overlap rule out every pair below it.
    """

    def __init__(self, roots: np.ndarray, sizes: np.ndarray, excess: np.ndarray, bits: np.ndarray, similarity: int) -> None:
        self.similarity = similarity
        self.levels = [(roots, roots, sizes, sizes, excess, bits)]
        while len(self.levels[-1][0]) > CHILDREN:
            low, high, least, most, spare, word = self.levels[-1]
            at = np.arange(0, len(low), CHILDREN)
            reduced = [np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.minimum.reduceat(least, at)]
            reduced += [np.maximum.reduceat(most, at), np.maximum.reduceat(spare, at), np.bitwise_or.reduceat(word, at, axis=0)]
            self.levels.append(tuple(reduced))

    def _possible(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        low, high, least, most, spare, word = self.levels[level]
        fits = (np.minimum(low[a], low[b]) != np.maximum(high[a], high[b])) & (
            most[a] * 100 >= least[b] * self.similarity
        ) & (most[b] * 100 >= least[a] * self.similarity)
        a, b = a[fits], b[fits]
        needed = -(-self.similarity * (least[a] + least[b]) // (100 + self.similarity))
        kept = np.zeros(len(a), bool)
        for i in range(0, len(a), AT_ONCE):
            x, y = a[i : i + AT_ONCE], b[i : i + AT_ONCE]
            shared = np.bitwise_count(word[x] & word[y]).sum(axis=1, dtype=np.int64)
            kept[i : i + AT_ONCE] = shared + np.minimum(spare[x], spare[y]) >= needed[i : i + AT_ONCE]
        return np.stack([a[kept], b[kept]])

    def pairs(self) -> Iterator[tuple[int, int]]:
        """Pairs of documents of different classes that the bounds cannot rule out, a bounded number at a time."""
        top = len(self.levels) - 1
        n = len(self.levels[top][0])
        waiting = [(top, np.stack(np.triu_indices(n)))]
        while waiting:
            level, pairs = waiting.pop()
            if pairs.shape[1] > AT_ONCE:
                waiting += [(level, pairs[:, i : i + AT_ONCE]) for i in range(0, pairs.shape[1], AT_ONCE)]
                continue
            found = self._possible(level, *pairs)
            if level == 0:
                yield from zip(*found.tolist(), strict=True)
                continue
            below = len(self.levels[level - 1][0])
            child = np.arange(CHILDREN)
            a = (found[0][:, None, None] * CHILDREN + child[:, None]) + 0 * child
            b = (found[1][:, None, None] * CHILDREN + child) + 0 * child[:, None]
            a, b = a.ravel(), b.ravel()
            inside = (a < below) & (b < below) & ((a < b) | ((a == b) & (level > 1)))
            waiting.append((level - 1, np.stack([a[inside], b[inside]])))


def _tree_links(size: int, similarity: int):
    """Compare the members ``(root, row, n, excess, bits, text)`` of a part over a signature tree, exactly in the end."""

    def each():
        shingles = Shingles(size)

        def links(members: list[tuple]) -> Iterator[tuple[int, int]]:
            members = sorted(members, key=lambda m: (m[2], m[0]))
            roots, sizes, excess = (np.array([m[i] for m in members], np.int64) for i in (0, 2, 3))
            bits = np.frombuffer(b"".join(m[4] for m in members), np.uint64).reshape(len(members), -1)
            sets: dict[int, np.ndarray] = {}
            classes = Classes()
            for i, j in SignatureTree(roots, sizes, excess, bits, similarity).pairs():
                a, b = classes.of(members[i][0]), classes.of(members[j][0])
                if a == b:
                    continue
                x, y = (sets[k] if k in sets else sets.setdefault(k, shingles.of(members[k][5])) for k in (i, j))
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= similarity * (len(x) + len(y) - both):
                    classes.join(a, b)
                    yield members[i][1], members[j][1]

        return links

    return each


def _settled(linked: DataFrame, met: DataFrame, links: DataFrame, classes: DataFrame, size: int, similarity: int) -> tuple[DataFrame, DataFrame]:
    """Links and classes after the members of large homes are compared with each other, in parts over signature trees.

    Copies whose central document is not similar to them are connected here, by links that each join two classes; the
    traversal then finds their nodes to be of one class.
    """
    homes = _homes(met)
    large = homes.groupBy("home").agg(F.count(F.lit(1)).alias("many")).where(f"many >= {LARGE_HOME}").select("home")
    rows = homes.join(large, "home").join(linked.select("row", "n"), "row").join(classes, "row", "left")
    rows = staged(rows.select("row", "home", "n", F.coalesce("root", "row").alias("root")), "join-large-homes")
    if rows.isEmpty():
        return links, classes
    sets = linked.select("row", "n", "excess", "bits", "text")
    found = Links(sets, _tree_links(size, similarity), links, classes)
    found.settle(rows, exhaustive=False)
    return found.links, found.classes


def _homes(met: DataFrame) -> DataFrame:
    home = met.groupBy("a").agg(F.max(F.struct("shared", -F.col("b"))).alias("best"))
    return home.select(F.col("a").alias("row"), (-F.col("best.col2")).alias("home"))


def _nodes(judged: DataFrame, met: DataFrame, classes: DataFrame) -> DataFrame:
    """Documents with class and node.

    A document goes to the central one with which it shares most first tokens; a node has about
    ``NODE`` documents of one home and of similar size, either all of the home's class or all of others.
    """
    home = _homes(met)
    home = staged(home.join(classes, "row", "left").withColumn("root", F.coalesce("root", "row")), "join-homes")
    home = home.join(classes.toDF("home", "home_root"), "home", "left")
    home = home.withColumn("core", F.col("root") == F.coalesce("home_root", "home")).drop("home_root")
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(4 / 3))).cast("long")
    docs = judged.select("row", "n", "excess", "bits", band.alias("band")).join(home, "row")
    docs = staged(docs, "join-homed")
    counts = docs.groupBy("home", "core", "band").agg(F.count(F.lit(1)).alias("members"))
    docs = docs.join(staged(counts, "join-bands"), ["home", "core", "band"])
    part = F.pmod(F.xxhash64("row"), F.ceil(F.col("members") / NODE))
    docs = docs.withColumn("node", F.xxhash64("home", "core", "band", part))
    return staged(docs.select("row", "n", "excess", "bits", "root", "node"), "join-nodes")


def _tree_nodes(nodes: DataFrame) -> DataFrame:
    """The documents of every node with their bitmaps, at most a few times ``NODE``."""
    docs = F.collect_list(F.struct("row", "root", "n", "excess", "bits")).alias("docs")
    return nodes.groupBy("node").agg(docs)


def _traversed(nodes: DataFrame, blocks: DataFrame, similarity: int) -> DataFrame:
    """Pairs of documents of different classes that the dual traversal cannot rule out."""
    where = nodes.select("row", "node", "root")
    # Sizes, classes and places are those of the documents of the node that have the token.
    placed = blocks.select("token", "row", "n", "place").join(where, "row").groupBy("token", "node").agg(
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.min("n").alias("least"),
        F.max("n").alias("most"),
        F.max(F.col("n") - F.col("place")).alias("after"),
    )
    placed = staged(placed, "join-placed")
    several = placed.groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low != high")
    placed = staged(placed.join(several.select("token"), "token"), "join-mixed")
    tree = staged(_tree_nodes(nodes.join(placed.select("node").distinct(), "node", "left_semi")), "join-tree")
    columns = ("node", "low", "high", "least", "most", "after")
    left, right = (placed.select("token", *(F.col(c).alias(f"{c}_{s}") for c in columns)) for s in "ab")
    # The first token that two documents share leaves enough tokens after it in both.
    pairs = left.join(right, "token").where(
        f"node_a <= node_b and least(low_a, low_b) != greatest(high_a, high_b) "
        f"and most_a * 100 >= least_b * {similarity} and most_b * 100 >= least_a * {similarity} "
        f"and least(after_a, after_b) >= {needed('least_a', 'least_b', similarity)}"
    )
    pairs = staged(pairs.select("node_a", "node_b").distinct(), "join-node-pairs")
    names = ["row", "root", "n", "excess", "bits"]
    flat = tree.select("node", *[F.expr(f"transform(docs, d -> d.{c})").alias(c) for c in names])
    pairs = pairs.join(flat.toDF("node_a", *(f"{c}_a" for c in names)), "node_a")
    pairs = pairs.join(flat.toDF("node_b", *(f"{c}_b" for c in names)), "node_b")
    columns = ["node_a", "node_b", *(f"{c}_{s}" for s in "ab" for c in names)]
    return map_tables(pairs.select(columns), "a long, b long", lambda: _compare_nodes(similarity))


def _compare_nodes(similarity: int):
    ones = np.array([bin(i).count("1") for i in range(256)], np.int64)

    def most(x: np.ndarray, y: np.ndarray, excess_x, excess_y):
        """The largest possible overlap: bits in common, and tokens of one set on the same bit."""
        return ones[x & y].sum(axis=-1) + np.minimum(excess_x, excess_y)

    def row(node_a, node_b, row_a, root_a, n_a, excess_a, bits_a, row_b, root_b, n_b, excess_b, bits_b) -> Iterator[dict]:
        row_a, root_a, n_a, excess_a = (np.array(v, np.int64) for v in (row_a, root_a, n_a, excess_a))
        row_b, root_b, n_b, excess_b = (np.array(v, np.int64) for v in (row_b, root_b, n_b, excess_b))
        x, y = (np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1) for bits in (bits_a, bits_b))
        whole_x, whole_y = np.bitwise_or.reduce(x), np.bitwise_or.reduce(y)
        least = -(-similarity * (n_a.min() + n_b.min()) // (100 + similarity))
        if most(whole_x, whole_y, excess_a.max(), excess_b.max()) < least:
            return
        needed_a = -(-similarity * (n_a + n_b.min()) // (100 + similarity))
        for i in np.flatnonzero(most(x, whole_y, excess_a, excess_b.max()) >= needed_a).tolist():
            fits = (root_b != root_a[i]) & (np.minimum(n_a[i], n_b) * 100 >= np.maximum(n_a[i], n_b) * similarity)
            if node_a == node_b:
                fits &= row_b > row_a[i]
            at = np.flatnonzero(fits)
            overlap = most(x[i], y[at], excess_a[i], excess_b[at])
            at = at[overlap >= -(-similarity * (n_a[i] + n_b[at]) // (100 + similarity))]
            if len(at):
                yield {"a": np.full(len(at), row_a[i]), "b": row_b[at]}

    return row


def similar_groups(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    similarity: int = SIMILARITY,
    slots: int = SLOTS,
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Two rows link if 100 times the tokens they share is at least ``similarity`` times the tokens
    of either; a component is what links connect, its number the smallest in it. Null and empty
    texts have no tokens and link with nothing, not even each other; a text with fewer words
    than a shingle is one token. Rows without a number come last: a component of only such rows
    has none. ``kept`` marks one row of each component, the one with the smallest number.
    """
    text = F.coalesce(F.col(text_column), F.lit("")).cast("binary")
    number = F.col(id_column).cast("long").alias("doc_id")
    rows = df.select(number, F.unhex(F.md5(text)).alias("digest"), text.alias("text"))
    unique, compared = split_copies(rows, slots)
    one = F.lit(1).cast("long").alias("group_size")
    docs = unique.select("doc_id", "digest", "text", one).unionAll(
        compared.where("kept").select("doc_id", "digest", "text", "group_size")
    )
    common = repeated(docs.select("text"), lambda: _first_tokens(shingle, similarity, None), COMMON + 1)
    shared = repeated(docs.select("text"), lambda: _first_tokens(shingle, similarity, common), 2)
    judged = _judged(docs, shingle, similarity, common, shared).withColumn("row", F.monotonically_increasing_id())
    judged = staged(judged, "join-judged")

    linked = judged.where("tokens is not null")
    centrality = (F.size("tokens") / (F.col("n") - F.col("rest"))).alias("central")
    tokens = F.explode(F.arrays_zip(F.col("tokens").alias("token"), F.col("places").alias("place"))).alias("at")
    blocks = staged(linked.select("row", "n", centrality, tokens).select("row", "n", "central", "at.*"), "join-blocks")
    met = _central(blocks)
    links = staged(_roots(linked, met, shingle, similarity), "join-links")
    classes = components(links).toDF("row", "root")
    links, classes = _settled(linked, met, links, classes, shingle, similarity)
    pairs = staged(_traversed(_nodes(linked, met, classes), blocks, similarity), "join-candidates")
    across = _verified(pairs, linked, shingle, similarity)
    classes = components(links.unionAll(across)).toDF("row", "root")
    return labelled(judged, classes, compared)


def labelled(judged: DataFrame, classes: DataFrame, compared: DataFrame) -> DataFrame:
    members = judged.select("row", "doc_id", "n", "digest", "group_size").join(classes, "row", "left")
    members = staged(members.withColumn("root", F.coalesce("root", "row")), "join-members")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    large = members.where("root != row").select("root").distinct()
    firsts = members.join(large, "root", "left_semi").groupBy("root").agg(first)
    firsts = staged(firsts.select("root", F.col("first.doc_id").alias("id"), F.col("first.row").alias("row_kept")), "join-firsts")
    found = members.join(firsts, "root", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("row_kept").isNull(), F.col("doc_id")).otherwise(F.col("id")).alias("component_id"),
        F.coalesce(F.col("row_kept") == F.col("row"), F.lit(True)).alias("kept"),
        "digest",
        "group_size",
    )
    groups = staged(found.where("group_size > 1").select("digest", "n_shingles", "component_id"), "join-groups")
    empty = F.col("n_shingles") == 0
    copies = compared.where("not kept").select("doc_id", "digest").join(groups, "digest")
    copies = copies.select(
        "doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), empty.alias("kept")
    )
    return found.drop("digest", "group_size").unionAll(copies)


def without_similar(
    df: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = SHINGLE,
    similarity: int = SIMILARITY,
) -> DataFrame:
    """One row of each component, with all columns: the one with the smallest number, or the first of several.

    Cases as in ``similar_groups``. Rows are told apart by their place in a written copy, so equal
    rows and rows without a number are no exception.
    """
    copy = staged(df.select(F.struct("*").alias("carried"), F.monotonically_increasing_id().alias("place")), "join-copy")
    plain = copy.select("place", F.col("carried")[text_column].alias("text"))
    groups = similar_groups(plain, "place", "text", shingle, similarity).select(F.col("doc_id").alias("place"), "component_id")
    groups = staged(groups, "join-components")
    joined = groups.where("place != component_id").select("component_id").distinct()
    members = groups.join(joined, "component_id", "left_semi")
    numbers = copy.select("place", F.col("carried")[id_column].cast("long").alias("number"))
    members = staged(members.join(numbers, "place"), "join-members")
    first = F.min(F.struct(F.col("number").isNull().alias("none"), "number", "place"))
    firsts = members.groupBy("component_id").agg(first.alias("first")).select(F.col("first.place").alias("place"))
    dropped = staged(members.select("place").join(firsts, "place", "left_anti"), "join-dropped")
    dropped = F.broadcast(dropped) if dropped.count() <= BROADCAST_ROWS else dropped
    return copy.join(dropped, "place", "left_anti").select("carried.*")
