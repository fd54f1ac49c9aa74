"""Line de-duplication over the corpus: what is repeated is found on hashes alone.

Every line of at least ``min_chars`` code points (stripped, A-Z lower-cased)
becomes a 128-bit hash with its document and position. The occurrences are
range-partitioned by (hash, document, position), so that one hash
held by a third of all documents is spread over many partitions; each
partition gives the first and last document of every hash, and only those few rows
meet to give the owner of the line. (Spark's functions take a first occurrence with
an aggregate, which needs no order inside a partition, so the plan has no sort there.)
The lines to drop return to their documents as a compressed keep bitmap: the 64-bit
words that are not all ones. Only the last join moves texts: each document once, to
its bitmap, where the text is split again.

Spark functions only, no Python on the executors.

Defined cases: a null or empty text is one empty line; a null id counts as the
largest id; rows with one id are one document, each row keeping its own text;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import ascii_lower, id_order, stored

BLANK = " \t\n\x0b\x0c\r"
MIN_CHARS = 10
MIN_DOCS = 2


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANK)))


def split_lines(text: Column) -> Column:
    return F.split(text, "\n")


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), id_order(F.col(id_col)).alias("doc"),
                       F.xxhash64(text).alias("row"), text.alias("text"))


def line_occurrences(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h, g: hash halves, doc, row, pos) of every line long enough."""
    lines = documents.select("doc", "row", F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    return (lines.select("doc", "row", "pos", line_key(F.col("line")).alias("key"))
            .where(F.char_length("key") >= min_chars)
            .select(F.xxhash64("key").alias("h"), F.xxhash64(F.lit(17), F.col("key")).alias("g"), "doc", "row", "pos"))


def repeated_lines(occurrences: DataFrame) -> DataFrame:
    """Hashes found in at least two documents, with the smallest document that holds them.

    The composite range key splits a hot hash; a partition sends one row per hash.
    """
    ranged = occurrences.select("h", "g", "doc", "pos").repartitionByRange("h", "g", "doc", "pos")
    return (ranged.groupBy("h", "g").agg(F.min("doc").alias("owner"), F.max("doc").alias("last"))
            .where(F.col("owner") != F.col("last")).select("h", "g", "owner"))


def keep_bitmaps(docs: DataFrame, *, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc, row, keep): per document that loses lines, its keep bitmap.

    ``keep`` is an array of (word, bits), ascending: bit i of word w tells whether line
    64 w + i stays. Words of which every bit is set are left out.
    """
    return _bitmaps(_documents(docs, id_col, text_col), min_chars)


def _bitmaps(documents: DataFrame, min_chars: int) -> DataFrame:
    occurrences = stored(line_occurrences(documents, min_chars), "line-occurrences")
    repeated = stored(repeated_lines(occurrences), "repeated-lines")
    dropped = occurrences.join(repeated, ["h", "g"]).where(F.col("doc") != F.col("owner"))
    bit = F.expr("shiftleft(1L, pos % 64)")
    # summed before the shuffle: many copies without an id are one (doc, row)
    words = (dropped.groupBy("doc", "row", F.floor(F.col("pos") / 64).cast("int").alias("word"))
             .agg(F.bitwise_not(F.bit_or(bit)).alias("bits")))
    return words.groupBy("doc", "row").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("keep"))


def apply_bitmaps(documents: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (kept lines) of ``documents`` as made by ``_documents``."""
    joined = documents.join(bitmaps, ["doc", "row"], "left").withColumn("lines", split_lines(F.col("text")))
    kept = F.expr("""
        filter(transform(lines, (x, i) -> struct(x AS line, coalesce(words[cast(i / 64 AS int)], -1L) AS bits, i AS i)),
               s -> shiftrightunsigned(s.bits, s.i % 64) & 1L = 1L).line""")
    words = F.map_from_entries(F.col("keep"))
    changed = joined.withColumn("words", words)
    lines_kept = F.when(F.col("keep").isNull(), F.col("lines")).otherwise(kept)
    return changed.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), lines_kept.alias("kept"),
    ).select("doc_id", "n_lines", (F.col("n_lines") - F.size("kept")).alias("n_dropped"),
             F.array_join("kept", "\n").alias("text"))


def dedup_lines(docs: DataFrame, *, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped and the text that stays, one row per row of ``docs``."""
    documents = _documents(docs, id_col, text_col)
    return apply_bitmaps(documents, _bitmaps(documents, min_chars))
