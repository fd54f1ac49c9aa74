"""Realized revenue by region x category over three storages.

B1 reads the raw text feed and cleans inline (no de-duplication, fewer
rules); B2 reads the year/month partitioned Parquet export; B3 goes through
the star join. B1 is therefore not the same computation as B2/B3.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import exact_sum, money_round, realized, sentence_case, try_double, try_integer
from orderloom.plans.reports import small_report

# Lower-case realized statuses as the raw query matches them.
_RAW_REALIZED = ("delivered", "shipped")


def raw_region_category(raw: DataFrame) -> DataFrame:
    """B1: casts, clean-up and range filters inline on the raw text columns.

    The line amount is not rounded here, so the DOUBLE sum depends on the
    addition order; the total is reported to the cent.
    """
    q, p, d = try_integer("quantity"), try_double("unit_price"), try_double("discount_pct")
    keep = (F.lower(F.trim("order_status")).isin(*_RAW_REALIZED)
            & q.between(1, 20) & (p > 0) & d.between(0, 80))
    return (raw.filter(keep)
               .groupBy(F.upper(F.trim("region")).alias("region"), sentence_case("category").alias("category"))
               .agg(money_round(F.sum(q * p * (F.lit(1) - d / F.lit(100.0)))).alias("revenue"))
               .transform(lambda df: small_report(df, F.desc("revenue"))))


def region_category_revenue(sales: DataFrame) -> DataFrame:
    """B3 (and B2 on the Parquet export): realized SUM(net_revenue) per region x category."""
    return (sales.filter(realized())
                 .groupBy("region", "category")
                 .agg(exact_sum("net_revenue").alias("revenue"))
                 .transform(lambda df: small_report(df, F.desc("revenue"))))
