"""Reusable views over the enriched sales (daily, monthly growth, repeat share)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions import exact_sum, money_round, month_start, percent, realized, realized_revenue


def daily_revenue(sales: DataFrame) -> DataFrame:
    """Per day: realized revenue (cents), distinct orders, distinct customers."""
    return (sales.groupBy(F.to_date("order_date").alias("sales_date"))
                 .agg(money_round(realized_revenue()).alias("revenue"),
                      F.count_distinct("order_id").alias("orders"),
                      F.count_distinct("customer_id").alias("customers")))


def monthly_growth(sales: DataFrame) -> DataFrame:
    """Per month: revenue, orders, previous month's revenue and growth %.

    LAG runs over the aggregated months (one row per calendar month), so its
    single window partition is bounded by the calendar, not by the data.
    A month with no sales is skipped, not zero-filled.
    """
    monthly = (sales.groupBy(month_start("order_date").alias("sales_month"))
                    .agg(realized_revenue().alias("revenue"),
                         F.count_distinct("order_id").alias("orders")))
    prev = F.lag("revenue").over(Window.orderBy("sales_month"))
    compared = monthly.withColumn("prev", prev)
    return compared.select(
        "sales_month",
        money_round("revenue").alias("revenue"),
        "orders",
        money_round("prev").alias("previous_month_revenue"),
        money_round(F.lit(100.0) * (F.col("revenue") - F.col("prev"))
                    / F.nullif(F.col("prev"), F.lit(0.0))).alias("growth_pct"),
    )


def repeat_customer_pct(sales: DataFrame) -> DataFrame:
    """Customers with realized orders, those with more than one, and the share."""
    return repeat_share(sales.filter(realized()))


def repeat_share(orders: DataFrame) -> DataFrame:
    """The same over rows that all belong to realized orders."""
    per_customer = orders.groupBy("customer_id").agg(F.count_distinct("order_id").alias("order_count"))
    repeat = F.count_if(F.col("order_count") > 1)
    return per_customer.agg(
        F.count(F.lit(1)).alias("purchasing_customers"),
        repeat.alias("repeat_customers"),
        money_round(percent(repeat, F.count(F.lit(1)))).alias("repeat_customer_pct"),
    )


def daily_change(sales: DataFrame) -> DataFrame:
    """Daily revenue with the change from the previous and to the next sales day."""
    w = Window.orderBy("sales_date")
    return daily_revenue(sales).select(
        "sales_date", "revenue",
        (F.col("revenue") - F.lag("revenue").over(w)).alias("change_from_previous_day"),
        (F.lead("revenue").over(w) - F.col("revenue")).alias("change_to_next_day"),
    )


__all__ = ["daily_revenue", "monthly_growth", "repeat_customer_pct", "daily_change"]
