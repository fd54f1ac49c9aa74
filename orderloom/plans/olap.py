"""ROLLUP / CUBE / GROUPING SETS reports.

Spark expands each input row once per grouping set and aggregates the
expanded rows with one partial + final hash aggregate, so all levels share a
single scan and a single shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import exact_sum, money_round, realized, realized_revenue
from orderloom.plans.reports import small_report


def _realized(sales: DataFrame) -> DataFrame:
    return sales.filter(realized())


def rollup_region_category(sales: DataFrame) -> DataFrame:
    """Category subtotals by region plus a grand total, NULLs last."""
    out = _realized(sales).rollup("region", "category").agg(money_round(exact_sum("net_revenue")).alias("revenue"))
    return small_report(out, F.asc_nulls_last("region"), F.asc_nulls_last("category"))


def cube_region_channel(sales: DataFrame) -> DataFrame:
    """All region x channel combinations with GROUPING() flags."""
    out = (_realized(sales).cube("region", "sales_channel")
                           .agg(money_round(exact_sum("net_revenue")).alias("revenue"),
                                F.grouping("region").cast("bigint").alias("all_regions"),
                                F.grouping("sales_channel").cast("bigint").alias("all_channels")))
    return small_report(out, "all_regions", "all_channels", F.desc("revenue"))


_SETS = [["region", "category"], ["region"], ["category"], []]


def grouping_sets_raw(sales: DataFrame) -> DataFrame:
    """GROUPING SETS ((region, category), (region), (category), ())."""
    return (_realized(sales).groupingSets(_SETS, "region", "category")
                            .agg(money_round(exact_sum("net_revenue")).alias("revenue")))


def grouping_sets_labeled(sales: DataFrame) -> DataFrame:
    """The same sets over all lines, totals labelled, revenue as a CASE sum.

    Labels come from GROUPING(), so a real NULL category stays NULL instead of
    being mistaken for the 'ALL CATEGORIES' total.
    """
    agg = sales.groupingSets(_SETS, "region", "category").agg(
        money_round(realized_revenue()).alias("revenue"),
        F.grouping("region").cast("bigint").alias("region_total"),
        F.grouping("category").cast("bigint").alias("category_total"),
    )
    out = agg.select(
        F.when(F.col("region_total") == 1, F.lit("ALL REGIONS")).otherwise(F.col("region")).alias("region"),
        F.when(F.col("category_total") == 1, F.lit("ALL CATEGORIES")).otherwise(F.col("category")).alias("category"),
        "revenue", "region_total", "category_total")
    return small_report(out, "region_total", "category_total", F.desc("revenue"))
