"""Star schema: product / customer / date dimensions and the sales fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import date_key, money_round
from orderloom.operators.keys import with_dense_key
from orderloom.schemas import ENRICHED_COLUMNS, FACT_COLUMNS


def first_by_line(attr: str) -> Column:
    """Attribute value from the smallest line id that carries a non-NULL value.

    A deterministic stand-in for ``any_value``. The buffer is (value, line id)
    per group and combines map-side, so a hot customer costs nothing extra.
    """
    order = F.struct(F.col("line_id").isNull().alias("n"), F.col("line_id").alias("id"))
    return F.min_by(F.col(attr), F.when(F.col(attr).isNotNull(), order)).alias(attr)


def of_products(stg: DataFrame) -> DataFrame:
    return stg.filter(F.col("product_id").isNotNull() & (F.col("product_id") != F.lit("")))


def of_customers(stg: DataFrame) -> DataFrame:
    return stg.filter(F.col("customer_id").isNotNull())


PRODUCT_NAMES, CUSTOMER_NAMES = ("product_name", "category"), ("customer_segment", "region")


def attributes(keyed: DataFrame, key: str, names: tuple[str, ...]) -> DataFrame:
    return keyed.groupBy(key).agg(*map(first_by_line, names))


def product_attributes(stg: DataFrame) -> DataFrame:
    """One row per non-blank product id: product_id, product_name, category."""
    return attributes(of_products(stg), "product_id", PRODUCT_NAMES)


def customer_attributes(stg: DataFrame) -> DataFrame:
    """One row per non-NULL customer id: customer_id, customer_segment, region."""
    return attributes(of_customers(stg), "customer_id", CUSTOMER_NAMES)


def mixed_keys(keyed: DataFrame, key: str, names: tuple[str, ...]) -> DataFrame:
    """The keys whose lines do not all carry the same values of ``names`` (or all none). A line of any other key has its attributes.

    Distinct rows are hashed, where a minimum of texts would sort all lines by key.
    """
    return keyed.select(key, *names).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)


def with_attributes(keyed: DataFrame, mixed: DataFrame, key: str, names: tuple[str, ...]) -> DataFrame:
    """Lines with the attributes of their key, of which only those of the ``mixed`` keys are joined: the others' lines carry them."""
    joined = keyed.join(F.broadcast(mixed.select(key, F.struct(*names).alias("_attributes"))), key, "left")
    own = {c: F.when(F.col("_attributes").isNotNull(), F.col("_attributes")[c]).otherwise(F.col(c)) for c in names}
    return joined.withColumns(own).drop("_attributes")


def dim_product(stg: DataFrame) -> DataFrame:
    keyed = with_dense_key(product_attributes(stg), "product_id", "product_key")
    return keyed.select("product_key", "product_id", "product_name", "category")


def dim_customer(stg: DataFrame) -> DataFrame:
    keyed = with_dense_key(customer_attributes(stg), "customer_id", "customer_key")
    return keyed.select("customer_key", "customer_id", "customer_segment", "region")


def dim_date(stg: DataFrame) -> DataFrame:
    """Every calendar day from the first to the last staged order date.

    The size is the calendar span (days), not the row count: one aggregate
    row generates it.
    """
    span = stg.agg(F.min(F.to_date("order_date")).alias("lo"), F.max(F.to_date("order_date")).alias("hi"))
    days = span.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("d"))
    return days.select(
        date_key("d").alias("date_key"),
        F.col("d").alias("full_date"),
        F.year("d").alias("year"),
        F.quarter("d").alias("quarter"),
        F.month("d").alias("month"),
        F.date_format("d", "MMMM").alias("month_name"),
        F.weekofyear("d").alias("week_of_year"),
        (F.dayofweek("d") - 1).alias("day_of_week"),
    )


def line_amounts(df: DataFrame) -> DataFrame:
    """Rounded price / discount and the line amounts (from the unrounded price)."""
    q, p, d = F.col("quantity"), F.col("unit_price"), F.col("discount_pct")
    return df.withColumns({
        "gross_amount": money_round(q * p),
        "net_revenue": money_round(q * p * (F.lit(1) - d / F.lit(100.0))),
        "unit_price": money_round(p),
        "discount_pct": money_round(d),
    })


def sales_enriched(accepted: DataFrame, customers: DataFrame, products: DataFrame, join=None) -> DataFrame:
    """The enriched sales view (18 columns) straight from accepted staged lines.

    Joins on the natural ids, which are 1:1 with the surrogate keys, so the
    fact -> dims round trip of the reference collapses into one pass. The
    planner (AQE) decides broadcast vs shuffle from the measured dim sizes;
    for the shuffle case AQE's skew-join splitting is enabled in the session.
    ``join(big, dim, key)``: another strategy (see ``fact_sales``).
    """
    join = join or (lambda big, dim, key: big.join(dim, key))
    joined = join(join(accepted.drop("customer_segment", "region", "product_name", "category"),
                       customers.select("customer_id", "customer_segment", "region"), "customer_id"),
                  products.select("product_id", "product_name", "category"), "product_id")
    return line_amounts(joined).select(*ENRICHED_COLUMNS)


def fact_sales(accepted: DataFrame, dim_cust: DataFrame, dim_prod: DataFrame, join=None) -> DataFrame:
    """``fact_sales``: accepted lines with surrogate keys, date key and amounts.

    ``join(big, dim, key)`` picks the join strategy (e.g. ``joins.join_dimension``:
    checked broadcast, else a salted join for hot keys); default: the planner's.
    """
    join = join or (lambda big, dim, key: big.join(dim, key))
    joined = join(join(accepted, dim_cust.select("customer_id", "customer_key"), "customer_id"),
                  dim_prod.select("product_id", "product_key"), "product_id")
    return line_amounts(joined).withColumn("date_key", date_key("order_date")).select(*FACT_COLUMNS)


def enriched_from_fact(fact: DataFrame, dim_cust: DataFrame, dim_prod: DataFrame, join=None) -> DataFrame:
    """The view as the reference defines it: fact ⋈ dims on surrogate keys, by ``join`` (see ``fact_sales``)."""
    join = join or (lambda big, dim, key: big.join(dim, key))
    return join(join(fact, dim_cust, "customer_key"), dim_prod, "product_key").select(*ENRICHED_COLUMNS)
