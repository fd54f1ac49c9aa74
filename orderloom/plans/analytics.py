"""Analytical queries: category / region performance, rankings, KPI record."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions import RETURNED_STATUS, exact_sum, money_round, percent, realized, realized_revenue, return_rate
from orderloom.plans import views
from orderloom.plans.reports import small_report
from orderloom.session import scratch_path, shuffles_freed


def category_revenue(sales: DataFrame) -> DataFrame:
    """Realized lines only: revenue and distinct orders per category, revenue desc."""
    out = (sales.filter(realized())
                .groupBy("category")
                .agg(money_round(exact_sum("net_revenue")).alias("revenue"),
                      F.count_distinct("order_id").alias("orders")))
    return small_report(out, F.desc("revenue"), F.asc_nulls_last("category"))


def region_top_customers(sales: DataFrame, top: int = 5) -> DataFrame:
    """Per region the customers of the ``top`` highest dense ranks (ties kept).

    The rank filter sits right above the window, so Catalyst inserts a
    WindowGroupLimit that trims each map partition before the shuffle: a
    region with millions of customers ships only its local leaders.
    """
    per_customer = (sales.filter(realized())
                         .groupBy("region", "customer_id")
                         .agg(exact_sum("net_revenue").alias("revenue")))
    rank = F.dense_rank().over(Window.partitionBy("region").orderBy(F.desc("revenue")))
    out = (per_customer.withColumn("regional_rank", rank)
                       .filter(F.col("regional_rank") <= top)
                       .select("region", "customer_id", money_round("revenue").alias("revenue"),
                               F.col("regional_rank").cast("bigint").alias("regional_rank")))
    # regions x top ranks: a bounded result
    return small_report(out, "region", "regional_rank", "customer_id")


def category_performance(sales: DataFrame) -> DataFrame:
    """All accepted lines: realized revenue, distinct orders, line return rate %."""
    out = (sales.groupBy("category")
                .agg(money_round(realized_revenue()).alias("revenue"),
                     F.count_distinct("order_id").alias("orders"),
                     money_round(return_rate()).alias("return_rate_pct")))
    return small_report(out, F.desc("revenue"), F.asc_nulls_last("category"))


def region_performance(sales: DataFrame) -> DataFrame:
    out = (sales.groupBy("region")
                .agg(money_round(realized_revenue()).alias("revenue"),
                     F.count_distinct("order_id").alias("orders")))
    return small_report(out, F.desc("revenue"), F.asc_nulls_last("region"))


def top_customers(sales: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` best customers with a global dense rank by realized revenue.

    Ranking every customer globally would need one task; take the top ``n``
    first (a distributed top-k) and rank only those. Ranks agree because
    every customer with more revenue than a kept one is kept too. Ties at
    the cut are broken by customer id.
    """
    per_customer = (sales.groupBy("customer_id", "customer_segment", "region")
                         .agg(realized_revenue().alias("revenue_exact"),
                              F.count_distinct("order_id").alias("orders")))
    best = per_customer.orderBy(F.desc("revenue_exact"), F.asc("customer_id")).limit(n)
    rank = F.dense_rank().over(Window.orderBy(F.desc("revenue_exact")))
    return (best.withColumn("revenue_rank", rank.cast("bigint"))
                .select("customer_id", "customer_segment", "region",
                        money_round("revenue_exact").alias("revenue"), "orders", "revenue_rank")
                .sortWithinPartitions("revenue_rank", "customer_id"))


def category_sum(sales: DataFrame) -> DataFrame:
    """The profiled query: realized SUM(net_revenue) per category."""
    return (sales.filter(realized())
                 .groupBy("category")
                 .agg(exact_sum("net_revenue").alias("revenue")))


def _first(df: DataFrame, value: str, *order) -> F.Column:
    return df.orderBy(*order).limit(1).select(value).scalar()


def kpi_base(sales: DataFrame) -> DataFrame:
    """Per customer, label and order: earned revenue (cents stay exact), lines earned, returned and all.

    Written once under the shared folder, so that every figure of the KPI record reads this
    and the sales are read once.
    """
    base = sales.groupBy("customer_id", "customer_segment", "region", "category", "order_id").agg(
        realized_revenue().alias("earned"), F.count_if(realized()).alias("earned_lines"),
        F.count_if(F.col("order_status") == F.lit(RETURNED_STATUS)).alias("returned_lines"),
        F.count(F.lit(1)).alias("lines"))
    path = scratch_path(sales.sparkSession, "kpi_base")
    with shuffles_freed(sales.sparkSession):
        base.write.option("compression", "zstd").parquet(path)
    return sales.sparkSession.read.schema(base.schema).parquet(path)


def kpi_summary(sales: DataFrame) -> DataFrame:
    """The KPI record: one row of totals plus leaders and the grouping-set size.

    Every figure is a scalar subquery over its own small result of ``kpi_base``
    (no cross join, nothing collected).
    """
    base = kpi_base(sales)
    earned = exact_sum("earned")
    by = lambda *keys: base.groupBy(*keys).agg(earned.alias("exact"), money_round(earned).alias("revenue"))
    repeat = views.repeat_share(base.filter("earned_lines > 0"))
    grouping_rows = base.select("region", "category").distinct().cube("region", "category").count().agg(F.count(F.lit(1)))
    earned_lines = F.sum("earned_lines")
    totals = base.agg(
        money_round(earned).alias("revenue"),
        F.count_distinct("order_id").alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        money_round(F.when(earned_lines > 0, earned) / earned_lines.cast("double")).alias("avg_line_value"),
        money_round(percent(F.sum("returned_lines"), F.sum("lines"))).alias("return_rate_pct"),
    )
    return totals.select(
        "*",
        repeat.select("repeat_customer_pct").scalar().alias("repeat_customer_pct"),
        _first(by("category"), "category", F.desc("revenue"), F.asc_nulls_last("category")).alias("top_category"),
        _first(by("region"), "region", F.desc("revenue"), F.asc_nulls_last("region")).alias("top_region"),
        _first(by("customer_id", "customer_segment", "region"), "customer_id", F.desc("exact"), "customer_id").alias("top_customer"),
        grouping_rows.scalar().alias("grouping_set_rows"),
    )
