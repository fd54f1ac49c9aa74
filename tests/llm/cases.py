"""Awkward rows that every operator must take."""

import zlib

from pyspark.sql import functions as F

BASE = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
LONG = " ".join(f"word{i % 977}x{i}" for i in range(30_000))

ROWS = [
    (1, BASE, "en", "a"), (2, BASE.upper(), "en", "a"), (2, BASE.upper(), "en", "a"), (3, None, "en", None),
    (4, "", None, "b"), (5, " \t\n ", "fr", "b"), (6, "one two", "fr", "ü"), (None, BASE + " phi", None, None),
    (None, BASE + " phi", None, None), (7, LONG, "de", "a"), (8, "x" * 50_000, "de", "z"), (9, BASE + "\n" + BASE, "es", "z"),
    (10, "Éé ñ ß\u00a0\u2003中文 emoji 😀\x1c\x0b\x0c\r\n\nthe the the", "es", "a"), (11, "!!! ... 123", "en", "b"),
]


def rows(spark, data=None, clash=()):
    """The rows as a table; ``clash`` adds columns of these names."""
    df = spark.createDataFrame(ROWS if data is None else data, "doc_id bigint, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("bigint"))
    for name in clash:
        df = df.withColumn(name, F.lit("clash"))
    return df


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
