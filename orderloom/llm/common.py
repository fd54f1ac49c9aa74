"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ids that are null behave as this one: after every other id
NULL_ID = 2**63 - 1
#: rows in one Arrow batch of whole texts
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` under the shared checkpoint folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Arrow batches of at most ``rows`` rows for what is run inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def compact(spark: SparkSession):
    """Tables written inside are zstd: smaller than by default, and without the direct buffers of the default
    codec, which executors keep outside their heap until a full collection."""
    name = "spark.sql.parquet.compression.codec"
    before = spark.conf.get(name)
    spark.conf.set(name, "zstd")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def id_order(c: Column) -> Column:
    """A null id sorts after every other id."""
    return F.coalesce(c, F.lit(NULL_ID))


def as_doc(docs: DataFrame) -> DataFrame:
    """All columns of a row as one struct ``doc``, so that no added column can clash with them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def undoc(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return df.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


_WORKER: dict = {}


def per_worker(key, make: Callable):
    """What a Python worker keeps between tasks (models, caches of words): one thing at a time.

    A worker serves the tasks of many operators; what the last one kept goes when another
    one asks for its own, so a pipeline needs no more memory than its largest stage.
    """
    if key not in _WORKER:
        if _WORKER:
            _WORKER.clear()
            _give_back()
        _WORKER[key] = make()
    return _WORKER[key]


def _give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text; a null text is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def map_texts(docs: DataFrame, text_col: str, added: str,
              start: Callable[[], Callable[[list[bytes]], list[pa.Array]]]) -> DataFrame:
    """``doc`` (every column of ``docs``) and the columns of the DDL ``added``.

    ``start()`` runs once in each task and returns the function that turns a batch of
    texts into one Arrow array for each added column. Batches hold few rows, so a task's
    memory does not follow the size of its partition.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    at = docs.columns.index(text_col)
    frame = as_doc(docs)
    extra = T._parse_datatype_string(added)
    schema = T.StructType(frame.schema.fields + extra.fields)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            doc = batch.column(0)
            yield pa.RecordBatch.from_arrays([doc, *work(text_bytes(doc.field(at)))], names=names)

    return frame.mapInArrow(run, schema)
