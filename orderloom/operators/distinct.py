"""Exact distinct counts that merge: bitmaps over dense keys.

COUNT(DISTINCT order_id) of a slice cannot be added up from the counts of its days,
but a set of dense keys is a bitmap, and bitmaps can be OR-ed. ``distinct_bitmaps``
keeps, for each day x region x category, the orders and customers of its lines as
bitmaps of 32,768 keys each; any slice or grouping of these columns is counted from
them without reading a line. Order keys follow the first day of an order, so the
orders of a day lie in few bitmaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.keys import with_dense_key

GRAIN = ("order_day", "region", "category")
COUNTED = {"orders": "order_id", "customers": "customer_id"}


def _keyed(sales: DataFrame, column: str) -> DataFrame:
    """column -> dense key, in the order of the first day that the value is seen on."""
    first = (sales.where(F.col(column).isNotNull()).groupBy(column)
             .agg(F.min(F.to_date("order_date")).alias("first_day"))
             .select(column, F.struct(F.col("first_day"), F.col(column)).alias("place")))
    return with_dense_key(first, "place", "key", key_type="long").select(column, "key")


def distinct_bitmaps(sales: DataFrame) -> DataFrame:
    """order_day, region, category, counted ('orders', 'customers'), bucket, bits; a null value is in no bitmap."""
    found = None
    for name, column in COUNTED.items():
        lines = sales.select(F.to_date("order_date").alias("order_day"), "region", "category", column).distinct()
        places = (lines.join(_keyed(sales, column), column)
                  .select(*GRAIN, F.bitmap_bucket_number("key").alias("bucket"), F.bitmap_bit_position("key").alias("bit")))
        # the places cross the shuffle, not 4 KB of bitmap for every few of them
        bits = (places.repartition(*GRAIN, "bucket").groupBy(*GRAIN, "bucket")
                .agg(F.bitmap_construct_agg("bit").alias("bits"))
                .select(*GRAIN, F.lit(name).alias("counted"), "bucket", "bits"))
        found = bits if found is None else found.unionByName(bits)
    return found


def distinct_counts(bitmaps: DataFrame, *by: str | Column) -> DataFrame:
    """orders and customers per group of ``by`` (columns of the grain, or expressions of them), from the bitmaps alone."""
    names = [F.col(c) if isinstance(c, str) else c for c in by]
    merged = bitmaps.groupBy(*names, "counted", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    keys = [c for c in merged.columns if c not in ("counted", "bucket", "n")]
    per = [F.coalesce(F.sum(F.when(F.col("counted") == name, F.col("n"))), F.lit(0)).alias(name) for name in COUNTED]
    return merged.groupBy(*keys).agg(*per)
