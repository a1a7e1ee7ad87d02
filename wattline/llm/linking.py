"""Classes of sets that are linked, from keys that similar sets share, without listing pairs.

Rows that share a key meet in a home. A home is compared inside one task, all of it with all of it; the task keeps a
union-find and returns only links that join two classes. A home beyond a bounded size is divided at random, compared part by
part, and its members are dealt anew while that finds links, so rows that copies connect soon are one class.

First every row goes to one home, the one it shares most keys with (the smallest row of a key names its home). Then only keys are left
whose rows are of several classes: such a key's home is its smallest class, so the members of a class meet once, not key by key.
Of what still has several classes, parts of one class each are made, and only pairs of parts that are not of the same class
meet. So every pair of rows of different classes that share a key is compared, and a group of copies costs work
in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import discard, map_rows, staged
from wattline.llm.components import components

#: Most rows of a part, and about how many elements their sets hold together.
PART_ROWS, PART_ELEMENTS = 256, 1_500_000
#: Up to so many links (16 bytes each) are joined in one task.
FEW_LINKS = 100_000
#: How often large homes are dealt anew, while that finds links, before the rest meets pair by pair.
DEALS = 8


class Classes:
    """A union-find over class numbers."""

    def __init__(self) -> None:
        self.above: dict[int, int] = {}

    def of(self, number: int) -> int:
        top = number
        while (higher := self.above.get(top, top)) != top:
            top = higher
        while number != top:
            self.above[number], number = top, self.above.get(number, number)
        return top

    def join(self, a: int, b: int) -> None:
        self.above[max(a, b)] = min(a, b)


def linked_classes(sets: DataFrame, keys: DataFrame, compare: Callable[[], Callable[[list[tuple]], Iterator[tuple[int, int]]]]) -> DataFrame:
    """``row, root`` of the rows that are linked with another; ``root`` is the smallest row of the class.

    ``sets`` has one row per set: ``row``, ``n`` (its size) and whatever ``compare`` needs; ``keys`` has ``key, row, n``. Both
    are written tables. ``compare()`` runs once per task; what it returns takes the members of a part as tuples
    ``(root, row, n, ...)`` and yields links between rows whose roots differ, each of which joins two classes.
    """
    leaders = keys.groupBy("key").agg(F.min("row").alias("home"), F.count(F.lit(1)).alias("many")).where("many > 1")
    met = keys.join(leaders.select("key", "home"), "key").groupBy("row", "home").agg(F.count(F.lit(1)).alias("shared"), F.max("n").alias("n"))
    best = F.max(F.struct("shared", -F.col("home"), "n")).alias("best")
    main = met.groupBy("row").agg(best).select("row", (-F.col("best.col2")).alias("home"), F.col("best.n").alias("n"), F.col("row").alias("root"))
    found = Links(sets, compare)
    rest = found.settle(staged(main, "linking-main"), exhaustive=False)
    discard(rest)
    rooted = staged(_rooted(keys, found.classes), "linking-rooted")
    mixed = rooted.groupBy("key").agg(F.min("root").alias("home"), F.max("root").alias("high")).where("home != high")
    homes = rooted.join(mixed.select("key", "home"), "key").select("row", "home", "n", "root").distinct()
    rest = found.settle(staged(homes, "linking-homes"), exhaustive=True)
    discard(rest, rooted)
    return found.classes


class Links:
    """The links found so far and the classes that they make."""

    def __init__(
        self, sets: DataFrame, compare: Callable, links: DataFrame | None = None, classes: DataFrame | None = None
    ) -> None:
        self.sets, self.compare, self.links, self.classes = sets, compare, links, classes

    def add(self, parts: DataFrame) -> bool:
        """Compare all parts; false if that found no link."""
        fresh = _inside(self.sets, parts, self.compare)
        if self.classes is not None and fresh.isEmpty():
            return False
        self.links = fresh if self.links is None else self.links.unionAll(fresh)
        self.classes = classes_of(self.links)
        return True

    def settle(self, homes: DataFrame, exhaustive: bool) -> DataFrame:
        """Compare the members of each home (``row, home, n, root``); returns what is left of the large ones, written."""
        self.add(_parts(homes, 0))
        homes, old = staged(_large(homes), "linking-large"), homes
        discard(old)
        for deal in range(1, 1 + DEALS):
            homes, old = staged(_several(homes, self.classes), "linking-several"), homes
            discard(old)
            if homes.isEmpty() or not self.add(_parts(homes, deal)):
                break
        if exhaustive and not homes.isEmpty():
            homes, old = staged(_several(homes, self.classes), "linking-several"), homes
            discard(old)
            self.add(_pairs_of_parts(homes))
        return homes


def classes_of(links: DataFrame) -> DataFrame:
    """``row, root`` for every end of a link. Few links are joined in one task, more by contraction on all of them."""
    if links.count() > FEW_LINKS:
        return components(links).toDF("row", "root")

    def each():
        classes, ends = Classes(), {}

        def row(a: int, b: int) -> Iterator[tuple]:
            ends[a] = ends[b] = None
            x, y = classes.of(a), classes.of(b)
            if x != y:
                classes.join(x, y)
            return iter(())

        def finish() -> Iterator[tuple]:
            return ((end, classes.of(end)) for end in ends)

        row.finish = finish
        return row

    return staged(map_rows(links.select("a", "b").coalesce(1), "row long, root long", each), "linking-classes")


def _rooted(rows: DataFrame, classes: DataFrame) -> DataFrame:
    return rows.join(classes, "row", "left").withColumn("root", F.coalesce("root", "row"))


def _count_of_parts() -> F.Column:
    return F.greatest(
        F.ceil(F.count(F.lit(1)) / PART_ROWS), F.ceil(F.sum("n") / PART_ELEMENTS), F.lit(1).cast("long")
    ).alias("parts")


def _parts(homes: DataFrame, deal: int) -> DataFrame:
    """``row, root, part``: homes whole if they are small enough, or else dealt at random."""
    counts = homes.groupBy("home").agg(_count_of_parts(), F.count(F.lit(1)).alias("many")).where("many > 1").drop("many")
    place = F.pmod(F.xxhash64("row", F.lit(deal)), F.col("parts"))
    return homes.join(counts, "home").select("row", "root", F.xxhash64("home", place).alias("part"))


def _large(homes: DataFrame) -> DataFrame:
    """The members of homes that were too large for one part."""
    counts = homes.groupBy("home").agg(_count_of_parts()).where("parts > 1")
    return homes.join(counts.select("home"), "home").select("row", "home", "n", "root")


def _several(homes: DataFrame, classes: DataFrame) -> DataFrame:
    """``row, home, n, root`` of homes that still hold several classes."""
    rooted = _rooted(homes.drop("root"), classes)
    several = rooted.groupBy("home").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high")
    return rooted.join(several.select("home"), "home").select("row", "home", "n", "root")


def _pairs_of_parts(homes: DataFrame) -> DataFrame:
    """``row, root, part`` for every pair of parts of a home that are not of one and the same class."""
    sizes = homes.groupBy("home", "root").agg(F.count(F.lit(1)).alias("many"))
    # Classes of few members share parts.
    sizes = sizes.withColumn("kind", F.when(F.col("many") * 4 >= PART_ROWS, F.col("root"))).select("home", "root", "kind")
    kinds = homes.join(sizes, ["home", "root"])
    kinds = staged(kinds.withColumn("whole", F.xxhash64("home", F.coalesce("kind", F.lit(-1).cast("long")))), "linking-kinds")
    counts = kinds.groupBy("whole").agg(_count_of_parts())
    place = F.pmod(F.xxhash64("row", F.lit(99)), F.col("parts"))
    dealt = kinds.join(counts, "whole").withColumn("piece", F.xxhash64("whole", place)).select("home", "piece", "row", "root")
    dealt = staged(dealt, "linking-dealt")
    pieces = staged(dealt.groupBy("home", "piece").agg(F.min("root").alias("low"), F.max("root").alias("high")), "linking-pieces")
    a, b = (pieces.select("home", *(F.col(c).alias(f"{c}_{s}") for c in ("piece", "low", "high"))) for s in "ab")
    pairs = a.join(b, "home").where("piece_a <= piece_b and least(low_a, low_b) != greatest(high_a, high_b)")
    pairs = pairs.select("piece_a", "piece_b", F.xxhash64("piece_a", "piece_b").alias("part"))
    ends = pairs.select(F.explode(F.array_distinct(F.array("piece_a", "piece_b"))).alias("piece"), "part")
    return ends.join(dealt.select("piece", "row", "root"), "piece").select("row", "root", "part")


def _inside(sets: DataFrame, parts: DataFrame, compare: Callable) -> DataFrame:
    """The links that join classes inside each part; a part is held by one task."""
    whole = [c for c in sets.columns if c not in ("row", "n")]
    rows = parts.join(sets, "row").select("part", "root", "row", "n", *whole)
    rows = rows.repartition("part").sortWithinPartitions("part", "row")

    def each():
        links = compare()
        held: list[tuple] = []
        open_part: list = [None]

        def finish() -> Iterator[tuple]:
            if len({member[0] for member in held}) > 1:
                yield from links(held)
            held.clear()

        def row(part: int, *member) -> Iterator[tuple]:
            if part != open_part[0]:
                yield from finish()
                open_part[0] = part
            held.append(member)

        row.finish = finish
        return row

    return staged(map_rows(rows, "a long, b long", each), "linking-links")
