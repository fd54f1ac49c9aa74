"""Data-quality rules: one ordered rule list drives reasons, rejects and accepts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _blank(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) == F.lit(""))


def _outside(c: str, low, high) -> Column:
    return ~F.col(c).between(low, high) | F.col(c).isNull()


def rules() -> list[tuple[str, Column]]:
    """(message, failing predicate) pairs; NULL fails every rule it touches."""
    # Rule messages and their order in the joined reason text.
    return [
        ("missing line_id", _blank("line_id")),
        ("missing order_id", _blank("order_id")),
        ("invalid order_date", F.col("order_date").isNull()),
        ("missing customer_id", F.col("customer_id").isNull()),
        ("missing product_id", _blank("product_id")),
        ("invalid quantity", _outside("quantity", 1, 20)),
        ("invalid unit_price", (F.col("unit_price") <= 0) | F.col("unit_price").isNull()),
        ("invalid discount", _outside("discount_pct", 0, 80)),
    ]


REASON_SEPARATOR = "; "


def rejection_reason() -> Column:
    """Failed rule messages joined with '; ' in rule order; '' when all pass."""
    return F.concat_ws(REASON_SEPARATOR, *[F.when(pred, F.lit(msg)) for msg, pred in rules()])


def with_reason(stg: DataFrame) -> DataFrame:
    return stg.withColumn("rejection_reason", rejection_reason())


def rejected(stg: DataFrame) -> DataFrame:
    """``rejected_orders``: staged rows failing at least one rule, with reasons."""
    return with_reason(stg).filter(F.col("rejection_reason") != F.lit(""))


def accepted(stg: DataFrame) -> DataFrame:
    """Staged rows passing every rule (the same list, so typed = clean + rejected).

    No rule is ever NULL, so each is simply negated; plain comparisons reach the scan of
    a stored table.
    """
    for _, failing in rules():
        stg = stg.filter(~failing)
    return stg


def row_count(df: DataFrame) -> Column:
    """COUNT(*) that still reads one real column.

    A bare count over the tolerant CSV reader would prune every column but
    the corrupt-record flag, which Spark refuses; non-NULL plus NULL values
    of the first column keeps one field in the scan (a never-NULL expression
    would be folded back into count(1)).
    """
    first = F.col(df.columns[0])
    return F.count(first) + F.count_if(first.isNull())


def quality_report(raw: DataFrame | Column, stg: DataFrame, fact: DataFrame, rejects: DataFrame,
                   dim_customer: DataFrame, dim_product: DataFrame) -> DataFrame:
    """One row: counts per stage, distinct orders, dims, date span.

    Each figure is an uncorrelated scalar subquery over its own table; no
    cross join is built. ``raw`` is the raw feed, or a scalar Column holding
    its row count when the feed is no longer kept.
    """
    raw_rows = raw if isinstance(raw, Column) else raw.agg(row_count(raw)).scalar()
    base = fact.agg(
        F.count(F.lit(1)).alias("clean_rows"),
        F.count_distinct("order_id").alias("orders"),
        F.min("order_date").alias("min_date"),
        F.max("order_date").alias("max_date"),
    )
    return base.select(
        raw_rows.alias("raw_rows"),
        stg.agg(F.count(F.lit(1))).scalar().alias("typed_rows"),
        "clean_rows",
        rejects.agg(F.count(F.lit(1))).scalar().alias("rejected_rows"),
        "orders",
        dim_customer.agg(F.count(F.lit(1))).scalar().alias("customers"),
        dim_product.agg(F.count(F.lit(1))).scalar().alias("products"),
        "min_date",
        "max_date",
    )
