"""Joins with a checked broadcast side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.session import scratch_path

# A dimension may be broadcast only when a count proves it holds at most this
# many rows; beyond it the join stays a shuffle join (sort-merge, with AQE
# splitting skewed partitions).
DEFAULT_BROADCAST_ROWS = 2_000_000
# ... and this many bytes of values.
DEFAULT_BROADCAST_BYTES = 256 << 20
# Rows of one key that one task of a shuffle join may get.
ROWS_PER_TASK = 4_000_000
# Rows are first counted by a hash of their key with so many values.
KEY_HASHES = 65_536


def fits(df: DataFrame, rows: int, bytes_: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``rows`` rows and ``bytes_`` bytes of values (one partial aggregate, two numbers collected)."""
    width = F.lit(8 * len(df.columns))
    for f in df.schema.fields:
        if f.dataType.typeName() in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif f.dataType.typeName() in ("array", "map", "struct"):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{f.name}`")))), F.lit(0))
    n, size = df.agg(F.count(F.lit(1)), F.sum(width)).first()
    return n <= rows and (size or 0) <= bytes_


def bounded_broadcast(df: DataFrame, bound: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``broadcast(df)`` if its rows and bytes are proven to be within bounds, else ``df`` unchanged.

    Use on materialised tables (the count is then a cheap scan); for a lazily
    derived side leave the decision to AQE, which measures the built side at
    run time.
    """
    return F.broadcast(df) if fits(df, bound) else df


def salt_counts(big: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """(key, salts) of the keys with more than ``rows_per_task`` rows: tasks enough for all of them.

    A key with so many rows has a hash with so many: rows are counted by hash first, at most ``KEY_HASHES``
    numbers from each task, and only the keys of such hashes are counted themselves, with a
    map-side-combined aggregate. It stays a table: how many keys are hot follows the data.
    """
    hashed = big.select(key, F.pmod(F.xxhash64(key), F.lit(KEY_HASHES)).alias("_hash"))
    full = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_task)
    # bounded by the number of hashes
    full = [r["_hash"] for r in full.select("_hash").collect()]
    if not full:
        return hashed.select(key, F.lit(1).alias("_salts")).limit(0)
    hashes = F.broadcast(big.sparkSession.createDataFrame([(x,) for x in full], "_hash bigint"))
    counts = (hashed.join(hashes, "_hash", "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
              .filter(F.col("_n") > rows_per_task))
    return counts.select(key, F.ceil(F.col("_n") / rows_per_task).cast("int").alias("_salts"))


def salted_join(big: DataFrame, dim: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK, counted: DataFrame | None = None) -> DataFrame:
    """Inner equi-join of a large side with a dimension when one key may hold
    a large share of the large side's rows.

    A key with more than ``rows_per_task`` rows is dealt to as many tasks as its counted rows
    need: its rows get a salt from a hash of the row itself, and its dimension rows are
    replicated once per salt. Every other key keeps salt 0 and is not replicated. The
    salt is deterministic, so a map task recomputed after a lost executor sends every
    row to the same reducer as before. The table of hot keys, written once, has at most
    ``rows / rows_per_task`` rows and is broadcast after a check of its size.

    ``counted``: a table that has every key at least as often as ``big`` (the lines before another join),
    to count on, so that ``big`` is not built once more for it.
    """
    spark = big.sparkSession
    path = scratch_path(spark, "hot-keys")
    salts = salt_counts(big if counted is None else counted, key, rows_per_task)
    salts.write.parquet(path)
    hot = spark.read.schema(salts.schema).parquet(path)
    if hot.isEmpty():
        return big.join(dim, key)
    hot = bounded_broadcast(hot)
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    row_hash = F.xxhash64(*[F.col(c) for c in big.columns])
    big_s = big.join(hot, key, "left").withColumn("_salt", F.pmod(row_hash, salts).cast("int")).drop("_salts")
    dim_s = dim.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return big_s.join(dim_s, [key, "_salt"]).drop("_salt")


def join_dimension(big: DataFrame, dim: DataFrame, key: str, bound: int | None = None,
                   rows_per_task: int = ROWS_PER_TASK, counted: DataFrame | None = None) -> DataFrame:
    """Broadcast join when the dimension is proven small, else a salted shuffle join."""
    if fits(dim, DEFAULT_BROADCAST_ROWS if bound is None else bound):
        return big.join(F.broadcast(dim), key)
    return salted_join(big, dim, key, rows_per_task, counted)


def joins_counted_on(lines: DataFrame):
    """``join(big, dim, key)`` for inner joins of ``lines`` with one dimension after another: all count on ``lines``."""
    return lambda big, dim, key: join_dimension(big, dim, key, counted=lines)
