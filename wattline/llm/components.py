"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import discard, staged


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node in ``links`` (columns ``a`` and ``b``): the smallest node it is connected with.

    In a round every node takes its smallest neighbour as parent, parents are followed twice, and
    links are drawn between parents. Minima are combined before the shuffle and every
    join reads two written tables, so a node with very many links does not burden one task.
    Chains shrink by a factor each round; no rows reach the driver. An empty table has no nodes.
    """
    live = staged(links.where("a != b").select("a", "b").distinct(), "links")
    labels: DataFrame | None = None
    while not live.isEmpty():
        both = live.unionAll(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = staged(
            both.groupBy("a").agg(F.least("a", F.min("b")).alias("parent")).withColumnRenamed("a", "node"), "links-parents"
        )
        for _ in range(2):
            above = parents.select(F.col("node").alias("parent"), F.col("parent").alias("higher"))
            nearer = staged(parents.join(above, "parent").select("node", F.col("higher").alias("parent")), "links-parents")
            discard(parents)
            parents = nearer
        old, labels = labels, staged(_followed(labels, parents), "links-labels")
        above = [parents.toDF(end, f"{end}_parent") for end in ("a", "b")]
        moved = live.join(above[0], "a").join(above[1], "b").select(F.col("a_parent").alias("a"), F.col("b_parent").alias("b"))
        following = staged(moved.where("a != b").distinct(), "links")
        discard(live, parents, *([old] if old is not None else []))
        live = following
    discard(live)
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("root")).limit(0)
    return labels


def _followed(labels: DataFrame | None, parents: DataFrame) -> DataFrame:
    if labels is None:
        return parents.withColumnRenamed("parent", "root")
    above = parents.withColumnRenamed("node", "root")
    return labels.join(above, "root", "left").select("node", F.coalesce("parent", "root").alias("root"))
