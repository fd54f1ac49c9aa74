"""Dialect of a delimited file: the delimiter, quote and escape that cut a sample of its lines most evenly."""

from __future__ import annotations

import csv
import io
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import SparkSession

SAMPLE_LINES = 2000
# What is tried, the likelier first.
DELIMITERS, QUOTES, ESCAPES = (",", ";", "\t", "|"), ('"', "'"), ("doubled", "\\")
#: share of the records that must have the usual number of fields; malformed ones are no reason to doubt the rest
CONSISTENT = 0.5


@dataclass(frozen=True)
class Dialect:
    delimiter: str = ","
    quote: str = '"'
    escape: str = '"'        # the quote itself where quotes are doubled

    def options(self) -> dict:
        """Options of Spark's CSV reader; text is kept as it is."""
        return {"sep": self.delimiter, "quote": self.quote, "escape": self.escape,
                "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _records(sample: str, dialect: Dialect, strict: bool) -> list[list[str]]:
    doubled = dialect.escape == dialect.quote
    reader = csv.reader(io.StringIO(sample, newline=""), delimiter=dialect.delimiter, quotechar=dialect.quote,
                        doublequote=doubled, escapechar=None if doubled else dialect.escape, strict=strict)
    return [r for r in reader if r]


def _well_formed(sample: str, dialect: Dialect) -> bool:
    """Whether every closing quote ends a field."""
    try:
        return bool(_records(sample, dialect, strict=True))
    except csv.Error:
        return False


def score(sample: str, dialect: Dialect, cut_off: bool) -> tuple[float, bool, int, int] | None:
    """(share of records of the usual width, quotes well formed, fewer fields with quotes or escapes left, width); None if the
    records have one field. The last record of a sample may be cut off."""
    try:
        found = _records(sample, dialect, strict=False)
    except csv.Error:
        return None
    if cut_off and len(found) > 1:
        found = found[:-1]
    if not found:
        return None
    width, n = Counter(map(len, found)).most_common(1)[0]
    if width < 2:
        return None
    left = sum((len(x) > 1 and x[0] == x[-1] and x[0] in QUOTES) or "\\" + dialect.quote in x for r in found for x in r)
    return n / len(found), cut_off or _well_formed(sample, dialect), -left, width


def sniff(lines: list[str], cut_off: bool = False) -> Dialect:
    """The dialect of ``lines``: the evenest, then the best by ``score``, then the likeliest."""
    sample = "\n".join(lines)
    best = None
    for d in DELIMITERS:
        for q in QUOTES:
            for e in ESCAPES:
                dialect = Dialect(d, q, q if e == "doubled" else e)
                own = score(sample, dialect, cut_off)
                if own and own[0] >= CONSISTENT and (best is None or own > best[0]):
                    best = own, dialect
    if best is None:
        raise ValueError(f"no delimiter of {DELIMITERS} cuts these lines into like records: {sample[:200]!r}")
    return best[1]


def detect(spark: SparkSession, path: str) -> Dialect:
    """The dialect of the file, or of the files of one feed, at ``path``, from their first ``SAMPLE_LINES`` lines.

    Files without a line have the default dialect.
    """
    rows = spark.read.option("lineSep", "\n").text(path).limit(SAMPLE_LINES + 1).collect()
    lines = [r[0].removesuffix("\r") for r in rows]
    if not any(lines):
        return Dialect()
    return sniff(lines[:SAMPLE_LINES], cut_off=len(lines) > SAMPLE_LINES)
