"""From documents to packed sequences: toxicity, exact copies, near copies, benchmark passages, packing.

All stages take null texts as empty and read whole texts, carry other columns along whatever their names, judge rows without a number
and repeated rows by themselves (where one of several stays, a row with a number goes before one without), and make no rows
of an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.llm import toxicity
from wattline.llm.common import staged, table
from wattline.llm.decontaminate import without_benchmark
from wattline.llm.exact_dedup import without_copies
from wattline.llm.jaccard_join import without_similar
from wattline.llm.packing import pack


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5; learned from the labels that are not held out."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), toxicity.not_held_out())
    return toxicity.without_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal but for white space, the one with the smallest number."""
    return without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.75 or more on shingles of five words, the one with the smallest number."""
    return without_similar(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of 1024 tokens, with a checksum of its ids."""
    return pack(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack_sequences),
]

#: Most stages learn, tokenise or follow links, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; each is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
