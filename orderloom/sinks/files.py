"""Batch sinks: partitioned Parquet export, result CSV, one-record JSON."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.schemas import ENRICHED_COLUMNS
from orderloom.session import shuffles_freed
from orderloom.sources.files import GZIP, RESULT_CSV_WRITE


def with_year_month(sales: DataFrame) -> DataFrame:
    return sales.select(*ENRICHED_COLUMNS,
                        F.year("order_date").alias("year"),
                        F.month("order_date").alias("month"))


ROW_GROUP_BYTES = 32 << 20
#: dimensions of the clustering inside a month, with the bits each takes part with
CLUSTERED = {"region": 4, "category": 4, "customer_id": 12}
#: columns looked up by value
KEYS = ("order_id", "customer_id")


def curve_key(bits: dict[str, int]) -> Column:
    """A Z-order key: the bits of the columns' hashes in turn, the first bit of each before the second of any.

    Rows that agree in one or more of the columns lie in few runs of the order, whichever columns
    they are; the hash spreads every column evenly whatever its values.
    """
    hashes = {c: F.pmod(F.xxhash64(c), F.lit(1 << n)) for c, n in bits.items()}
    turns = [(c, n - 1 - i) for i in range(max(bits.values())) for c, n in bits.items() if i < n]
    key = F.lit(0).cast("long")
    for c, bit in turns:
        key = F.shiftleft(key, 1).bitwiseOR(F.shiftright(hashes[c], bit).bitwiseAND(F.lit(1).cast("long")))
    return key


def export_sales_parquet(sales: DataFrame, path: str, row_group_bytes: int = ROW_GROUP_BYTES,
                         unpacked: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """K1: the enriched sales as ZSTD Parquet partitioned by year / month (overwrite).

    Rows are clustered by (year, month) with a REBALANCE hint rather than a
    plain ``repartition``: each directory is written by few tasks instead of
    every task leaving a small file in every directory, and AQE splits a
    month that holds a large share of the rows into advisory-size pieces
    (and merges small months), so no single task writes a hot month.

    Inside a month rows follow a curve over region, category and customer, and the files
    carry Bloom filters of the order and customer ids, so that a slice or a lookup skips row
    groups: what the reference's secondary indexes are for.

    With ``unpacked``, ``sales`` holds less than the view, ``order_date`` as it is, and ``unpacked``
    makes the view of it behind the shuffle, so that what can be derived does not cross it.
    """
    moved = sales.withColumns({"year": F.year("order_date"), "month": F.month("order_date")}).hint("rebalance", "year", "month")
    writer = (with_year_month(unpacked(moved) if unpacked else moved)
              .sortWithinPartitions("year", "month", curve_key(CLUSTERED))
              .write.mode("overwrite")
              .partitionBy("year", "month")
              .option("compression", "zstd")
              .option("parquet.block.size", row_group_bytes)
              .option("parquet.bloom.filter.adaptive.enabled", "true"))
    for name in KEYS:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    with shuffles_freed(sales.sparkSession):
        writer.parquet(path)


def export_result_csv(result: DataFrame, path: str, gzip: bool = False) -> None:
    """K4 / K7: a result table as CSV with a header.

    Results here are aggregates (bounded by labels or by a LIMIT), or the cart items, which grow
    with the data (``gzip``); the rows are written by the executors, nothing passes through the driver.
    """
    with shuffles_freed(result.sparkSession):
        result.write.mode("overwrite").options(**RESULT_CSV_WRITE, **(GZIP if gzip else {})).csv(path)


def write_record_json(record: DataFrame, path: str) -> None:
    """K5 / K6: a one-row result (KPI or quality record) as one JSON object."""
    record.coalesce(1).write.mode("overwrite").json(path)
