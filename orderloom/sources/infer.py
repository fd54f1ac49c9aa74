"""Column types of a CSV of unknown schema, from all of its rows in one aggregate.

A column has the first type of ``LATTICE`` that every non-null value of it reads as;
what a task sees is a bit per type and column, which are combined in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.sources.dialect import Dialect, detect

_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_TIME = r"\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)?"
_ZONE = r"(Z|[+-]\d{2}(:?\d{2})?)"
_NUMBER = r"-?((0|[1-9]\d*)(\.\d*)?|\.\d+)([eE][+-]?\d+)?"
#: Spark type: what a value must look like; it must be castable besides
LATTICE = {
    "boolean": r"(?i)true|false",
    "bigint": r"-?(0|[1-9]\d*)",
    "decimal(38,0)": r"-?(0|[1-9]\d*)",
    "double": _NUMBER,
    "date": _DAY,
    "timestamp_ntz": f"{_DAY}[ T]{_TIME}|{_DAY}",
    "timestamp": f"{_DAY}[ T]{_TIME}{_ZONE}",
}


def _reads_as(value: Column, kind: str) -> Column:
    text = F.trim(value)
    return text.rlike(f"^({LATTICE[kind]})$") & text.try_cast(kind).isNotNull()


# Texts that need not be tried as every type: whole numbers and decimals that fit, what cannot be of any
# type as it begins, and what begins as a date.
_PLAIN = {r"^-?(0|[1-9]\d{0,17})\z": ("bigint", "decimal(38,0)", "double"), r"^-?(0|[1-9]\d{0,15})\.\d{1,17}\z": ("double",)}
_MAY_BE, _MAY_BE_DAY, _DAYS = r"^([-.0-9]|(?i:true|false))", r"^\d{4}-\d", ("date", "timestamp_ntz", "timestamp")


def _kinds(value: Column) -> Column:
    """A bit for every type that ``value`` reads as."""
    bits, text = {kind: 1 << k for k, kind in enumerate(LATTICE)}, F.trim(value)
    tried = lambda kinds: sum((F.when(_reads_as(value, k), F.lit(bits[k])).otherwise(F.lit(0)) for k in kinds), F.lit(0))
    plain = [(text.rlike(form), F.lit(sum(bits[k] for k in kinds))) for form, kinds in _PLAIN.items()]
    known = F
    for test, found in (*plain, (~text.rlike(_MAY_BE), F.lit(0)), (text.rlike(_MAY_BE_DAY), tried(_DAYS))):
        known = known.when(test, found)
    return known.otherwise(tried(LATTICE))


def infer_types(rows: DataFrame) -> dict[str, str]:
    """Column -> type of the text columns of ``rows``; a column without values is text."""
    if not rows.columns:
        return {}
    found = []
    for i, name in enumerate(rows.columns):
        c = F.col(f"`{name}`")
        found += [F.count(c).alias(f"n{i}"), F.bit_and(F.when(c.isNotNull(), _kinds(c))).alias(f"kinds{i}")]
    got = rows.agg(*found).first()     # two numbers for each column
    return {name: next((kind for k, kind in enumerate(LATTICE) if got[f"n{i}"] and got[f"kinds{i}"] >> k & 1), "string")
            for i, name in enumerate(rows.columns)}


def read_csv_inferred(spark: SparkSession, path: str, dialect: Dialect | None = None) -> DataFrame:
    """A header CSV with the types of all of its values; the dialect is detected if it is not given."""
    options = (dialect or detect(spark, path)).options()
    text = spark.read.options(header=True, multiLine=True, inferSchema=False, nullValue="", emptyValue="", **options).csv(path)
    types = infer_types(text)
    return text.select(*[(F.col(f"`{c}`") if t == "string" else F.trim(F.col(f"`{c}`")).cast(t)).alias(c) for c, t in types.items()])
