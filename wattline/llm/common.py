"""What the operators share: tables, staged copies in the shared folder, and rows through Python in Arrow batches."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattline.session import shared_folder

#: A batch that a task sends back is closed at this many bytes.
BATCH_BYTES = 8 << 20
#: Words whose hash a task remembers; the memory is emptied when it is full.
REMEMBERED = 300_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> None:
    """Send the package to Python workers that would not find it: neither on PYTHONPATH nor in the working folder."""
    application, root = spark.sparkContext.applicationId, Path(__file__).resolve().parents[2]
    if application in _SHIPPED or str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or Path.cwd() == root:
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/package", "zip", root, Path(__file__).parents[1].name)
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(application)


def staged(df: DataFrame, purpose: str, **options: str) -> DataFrame:
    """The rows written to the folder that all executors share and read again: the plan behind them is cut.

    A lost executor costs a new read of these files, not a new run of what made them.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.options(**{"compression": "zstd", **options}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete staged copies that nothing reads any more."""
    for df in frames:
        session = df.sparkSession
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = session._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(session._jsc.hadoopConfiguration()).delete(path, True)


def texts(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the number and the UTF-8 bytes of each row, whatever other columns there are; null text is empty."""
    return df.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).cast("binary").alias("text"),
    )


def map_rows(
    df: DataFrame, schema: str, each: Callable[[], Callable[..., Iterator[tuple]]], readers: dict[str, Callable[[pa.Array], Iterable]] | None = None
) -> DataFrame:
    """Run ``each()`` once per task and what it returns on every row; it yields the output rows.

    ``readers`` turn columns of a batch into one value per row; of other columns a row has the Python objects.

    Output goes back in batches of bounded size, so one long text or many outputs of a row
    never add up to a large batch. If the function has a ``finish``, that gives the last rows.
    """
    shipped(df.sparkSession)
    arrow = _arrow_schema(df.sparkSession, schema)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_of, out, held = each(), [], 0
        for row in _results(batches, names, row_of, readers or {}):
            out.append(row)
            held += 64 + sum(len(v) for v in row if isinstance(v, bytes | str | list))
            if held >= BATCH_BYTES:
                yield _batch(out, arrow)
                out, held = [], 0
        if out:
            yield _batch(out, arrow)

    return df.mapInArrow(run, schema)


def map_tables(
    df: DataFrame, schema: str, each: Callable[[], Callable[..., Iterator[dict]]], readers: dict[str, Callable[[pa.Array], Iterable]] | None = None
) -> DataFrame:
    """Like ``map_rows``, but a row yields columns (dicts of numpy arrays or lists) with many output rows each."""
    shipped(df.sparkSession)
    arrow = _arrow_schema(df.sparkSession, schema)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row_of, out, held = each(), [], 0
        for columns in _results(batches, names, row_of, readers or {}):
            arrays = [pa.array(columns[f.name], f.type) for f in arrow]
            out.append(pa.RecordBatch.from_arrays(arrays, schema=arrow))
            held += 256 + out[-1].nbytes
            if held >= BATCH_BYTES or len(out) >= 4096:
                yield _joined(out, arrow)
                out, held = [], 0
        if out:
            yield _joined(out, arrow)

    return df.mapInArrow(run, schema)


def _results(batches: Iterator[pa.RecordBatch], names: list[str], row_of: Callable, readers: dict[str, Callable[[pa.Array], Iterable]]) -> Iterator:
    for batch in batches:
        for values in zip(*(readers.get(name, _objects)(batch.column(name)) for name in names), strict=True):
            yield from row_of(*values)
    if hasattr(row_of, "finish"):
        yield from row_of.finish()


def _objects(column: pa.Array) -> Iterator:
    return (v.as_py() for v in column)


def _joined(parts: list[pa.RecordBatch], schema: pa.Schema) -> pa.RecordBatch:
    merged = pa.Table.from_batches(parts, schema).combine_chunks().to_batches()
    return merged[0] if merged else pa.RecordBatch.from_arrays([pa.array([], f.type) for f in schema], schema=schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    kinds = {
        "long": pa.int64(), "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
        "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "array<int>": pa.list_(pa.int32()),
        "array<long>": pa.list_(pa.int64()), "array<float>": pa.list_(pa.float32()), "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary()),
    }
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in schema.split(", "))])
