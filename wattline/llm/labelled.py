"""Bounded samples of labelled rows, and rows kept or dropped by a judgement of their text."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattline.llm.common import shipped, texts


def remainder(id_column: str, modulus: int) -> Column:
    """crc32 of the number as text, modulo; null for a missing number."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id, label, text`` of at most ``rows`` labelled numbers, chosen by the hash of the number.

    Only numbers for which ``usable`` (a condition on ``doc_id``) holds. A number with several
    labels takes the largest; missing labels and numbers are left out. The chosen numbers are
    bounded, so they are broadcast and only their texts are shuffled. Of several rows with one number the smallest text counts.
    """
    known = labels.select(F.col(id_column).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & usable)
    chosen = known.groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = texts(docs, id_column, text_column).join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text"))


def rows_where(
    df: DataFrame, text_column: str, each: Callable[[], Callable[..., bool]], read: Callable[[pa.Array], Iterable] | None = None
) -> DataFrame:
    """The rows whose text is judged true, with all columns; nothing is shuffled or joined. Null text is empty.

    ``read`` turns the texts of a batch into what is judged; without it, that is their bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = each()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text_column)).cast(pa.binary())
            judged = read(column) if read else (t.as_py() or b"" for t in column)
            yield batch.filter(pa.array([judge(t) for t in judged], pa.bool_()))

    shipped(df.sparkSession)
    return df.mapInArrow(run, df.schema)
