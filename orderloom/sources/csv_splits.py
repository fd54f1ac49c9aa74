"""CSV whose quoted fields may hold newlines, read in many tasks per file.

Whether a line begins inside quotes depends on all quotes before it, but only on
their parity:

1. each split of a file counts its quotes;
2. the parity of the splits before it says how a split begins (one row per split);
3. each split cuts its lines into records; what is open at its end, and what closes
   at its begin, leaves as a fragment (two per split at most);
4. the fragments of a record are put together, and every record is parsed by Spark.

An escaped quote (doubled, or after the escape character) does not change the
parity that counts. In a file whose first line ends in CR LF, a CR LF
inside quotes is a newline, as for Spark's reader.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from orderloom.sources.dialect import Dialect

_CORRUPT = "_corrupt_record"
WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3


def _lines(spark: SparkSession, path: str) -> DataFrame:
    meta = F.col("_metadata")
    return spark.read.option("lineSep", "\n").text(path).select(
        meta["file_path"].alias("file"), meta["file_block_start"].alias("start"), F.col("value").alias("line"))


def _quotes(line: Column, dialect: Dialect) -> Column:
    """Quotes that open or close a field; a doubled one counts twice and keeps the parity."""
    if dialect.escape != dialect.quote:
        line = F.regexp_replace(line, re.escape(dialect.escape) + "(?s:.)", "")
    return F.length(line) - F.length(F.replace(line, F.lit(dialect.quote), F.lit("")))


def split_parities(lines: DataFrame, dialect: Dialect) -> dict[tuple[str, int], tuple[bool, bool]]:
    """(file, start) -> whether the split begins inside quotes, and whether the file's first line ends in CR LF; one row per split."""
    # a split lies in one task, which reads its lines in order
    cr = F.first("line").endswith("\r").cast("int")
    per = lines.groupBy("file", "start").agg((F.sum(_quotes(F.col("line"), dialect)) % 2).alias("odd"), cr.alias("cr"))
    returns = F.max(F.when(F.col("start") == 0, F.col("cr"))).over(Window.partitionBy("file")) > 0
    before = F.coalesce(F.sum("odd").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = per.select("file", "start", before.alias("before"), returns.alias("returns")).collect()
    return {(r.file, r.start): (r.before % 2 == 1, r.returns) for r in rows}


def records(spark: SparkSession, path: str, dialect: Dialect) -> DataFrame:
    """file, start, number, record: every record's text, quoted newlines included; ``number`` counts inside a split."""
    lines = _lines(spark, path)
    inside = spark.sparkContext.broadcast(split_parities(lines, dialect))
    escaped = None if dialect.escape == dialect.quote else re.compile(re.escape(dialect.escape) + "(?s:.)")
    quote = dialect.quote

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, quoted, returns, began, number, out = None, [], False, False, False, 0, []

        def emit(kind):
            nonlocal number
            out.append((*at, number, kind, "\n".join(held)))
            held.clear()
            number += 1

        def batch_of():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()))],
                                              names=["file", "start", "number", "kind", "record"])

        for batch in batches:
            for file, start, line in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (file, start):
                    if held:
                        emit(TAIL if began else MIDDLE)
                    at, number = (file, start), 0
                    quoted, returns = inside.value[at]
                    began = not quoted      # whether what is held began in this split
                held.append(line.removesuffix("\r") if returns else line)
                quoted ^= (escaped.sub("", line) if escaped else line).count(quote) % 2 == 1
                if not quoted:
                    emit(WHOLE if began else HEAD)
                    began = True
            if out:
                yield batch_of()
                out = []
        if held:
            emit(TAIL if began else MIDDLE)
        if out:
            yield batch_of()

    cut_lines = lines.mapInArrow(cut, "file string, start bigint, number bigint, kind int, record string")
    whole = cut_lines.where(F.col("kind") == WHOLE).select("file", "start", "number", "record")
    # a TAIL, the MIDDLEs of splits that lie inside its quotes, and a HEAD: two rows per split at most
    place = Window.partitionBy("file").orderBy("start", "number")
    parts = cut_lines.where(F.col("kind") != WHOLE).withColumn("n", F.sum((F.col("kind") == TAIL).cast("int")).over(place))
    joined = parts.groupBy("file", "n").agg(F.sort_array(F.collect_list(F.struct("start", "number", "record"))).alias("parts"))
    return whole.unionByName(joined.select("file", F.col("parts")[0]["start"].alias("start"), F.col("parts")[0]["number"].alias("number"),
                                           F.array_join(F.col("parts.record"), "\n").alias("record")))


def read_csv_splits(spark: SparkSession, path: str, schema: T.StructType, dialect: Dialect | None = None) -> DataFrame:
    """The rows of the CSV files at ``path`` (each with a header), malformed records skipped.

    Equal to Spark's multiLine reader, which takes a task per file.
    """
    dialect = dialect or Dialect()
    found = records(spark, path, dialect).where(~((F.col("start") == 0) & (F.col("number") == 0)))
    fields = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {k: str(v) for k, v in dialect.options().items()} | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = found.where(F.col("record") != "").select(F.from_csv("record", fields.simpleString(), options).alias("r"))
    return parsed.where(F.col(f"r.{_CORRUPT}").isNull()).select(*[F.col(f"r.`{c}`").alias(c) for c in schema.fieldNames()])
