"""Named queries over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Every query starts from the given tables (``sources.testmap``) and runs the
full pipeline lazily; writes that a query needs (CSV / Parquet round trips,
dense-key checkpoints) go under the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.functions import (
    CHANNELS, REGIONS, SEGMENTS, blank_to_null, canonicalize, sentence_case,
    trimmed, try_double, try_integer, try_timestamp,
)
from orderloom.operators.cleaning import dedupe_by_key
from orderloom.operators.distinct import distinct_bitmaps, distinct_counts
from orderloom.operators.joins import salted_join
from orderloom.plans import analytics, olap, slices, storage, views
from orderloom.plans.registry_more import more_queries
from orderloom.plans.snapshot_queries import cart_items_csv
from orderloom.plans.warehouse import StagedWarehouse, Warehouse
from orderloom.schemas import RAW_ORDERS
from orderloom.session import configure, scratch_path, shuffles_freed
from orderloom.sinks import files as sinks
from orderloom.sources import files as sources
from orderloom.sources import testmap
from orderloom.sources.csv_splits import read_csv_splits
from orderloom.sources.dialect import detect
from orderloom.sources.infer import read_csv_inferred

Query = Callable[[SparkSession, str], DataFrame]


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    configure(spark)
    return Warehouse(testmap.raw_orders(spark, sf_dir), order_by=testmap.TIE_BREAK)


def staged(spark: SparkSession, sf_dir: str) -> StagedWarehouse:
    """For queries that use the staged lines more than once: written once per query."""
    configure(spark)
    return StagedWarehouse(testmap.raw_orders(spark, sf_dir), order_by=testmap.TIE_BREAK)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return testmap.raw_orders(spark, sf_dir)


def _stored_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw feed joined and written once, for queries that write it more than once."""
    raw, path = _raw(spark, sf_dir).select(*RAW_ORDERS.fieldNames()), scratch_path(spark, "raw_orders")
    with shuffles_freed(spark):
        raw.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(raw.schema).parquet(path)


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(spark, sf_dir).sales_enriched


def _on_sales(fn) -> Query:
    return lambda spark, sf_dir: fn(_sales(spark, sf_dir))


def _on_default_slice(fn) -> Query:
    def run(spark, sf_dir):
        sales = staged(spark, sf_dir).stored_sales
        return fn(sales, slices.default_slice(sales))
    return run


# -- cleaning functions, each over every raw line ---------------------------

def clean_trim(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.select(*[trimmed(c).alias(c) for c in
                        ("line_id", "order_id", "product_id", "product_name", "payment_method")])


def clean_blank_to_null(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.select(F.col("customer_id").alias("raw_customer_id"),
                      blank_to_null("customer_id").alias("customer_id"))


def clean_canonical_labels(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.select(F.col("customer_segment").alias("raw_segment"),
                      F.col("region").alias("raw_region"),
                      F.col("sales_channel").alias("raw_channel"),
                      canonicalize("customer_segment", SEGMENTS).alias("customer_segment"),
                      canonicalize("region", REGIONS).alias("region"),
                      canonicalize("sales_channel", CHANNELS).alias("sales_channel"))


def clean_sentence_case(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.select(F.col("category").alias("raw_category"), F.col("order_status").alias("raw_status"),
                      sentence_case("category").alias("category"),
                      sentence_case("order_status").alias("order_status"))


def clean_numeric_cast(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.select(F.col("quantity").alias("raw_quantity"), F.col("unit_price").alias("raw_unit_price"),
                      F.col("discount_pct").alias("raw_discount"),
                      F.col("shipping_days").alias("raw_shipping_days"),
                      try_integer("quantity").alias("quantity"), try_double("unit_price").alias("unit_price"),
                      try_double("discount_pct").alias("discount_pct"),
                      try_integer("shipping_days").alias("shipping_days"))


def clean_timestamp_cast(spark, sf_dir):
    raw = _raw(spark, sf_dir)
    return raw.select(F.col("order_date").alias("raw_order_date"), try_timestamp("order_date").alias("order_date"))


def dedupe_lines(spark, sf_dir):
    raw = _raw(spark, sf_dir).select(trimmed("line_id").alias("line_id"), "order_id", "product_id", "quantity",
                                     *testmap.TIE_BREAK)
    return dedupe_by_key(raw, "line_id", testmap.TIE_BREAK)


# -- sources / sinks round trips --------------------------------------------

def scan_orders_csv(spark, sf_dir):
    """Write the raw feed as CSV, read it back through the tolerant reader."""
    path = scratch_path(spark, "raw_orders_csv")
    sources.write_orders_csv(_raw(spark, sf_dir), path)
    return sources.read_orders_csv(spark, path)


def scan_orders_csv_dialects(spark, sf_dir):
    """The raw feed landed with four delimiters, each read back by its detected dialect; rows by delimiter."""
    raw, found = _stored_raw(spark, sf_dir), None
    for name, delimiter in (("comma", ","), ("semicolon", ";"), ("tab", "\t"), ("pipe", "|")):
        path = scratch_path(spark, f"raw_orders_{name}")
        sources.write_orders_csv(raw, path, delimiter, gzip=True)
        own = sources.read_orders_csv(spark, path).withColumn("delimiter", F.lit(name))
        found = own if found is None else found.unionByName(own)
    return found


def scan_orders_csv_splits(spark, sf_dir):
    """The raw feed read record by record from splits of its files, whatever their size."""
    path = scratch_path(spark, "raw_orders_splits")
    sources.write_orders_csv(_raw(spark, sf_dir), path)
    return read_csv_splits(spark, path, RAW_ORDERS, detect(spark, path))


def scan_cart_items_inferred(spark, sf_dir):
    """The cart items CSV with the types of its values (the instant shown without its zone, UTC)."""
    found = read_csv_inferred(spark, cart_items_csv(spark, sf_dir))
    return found.withColumn("observed_at_utc", F.col("observed_at_utc").cast("timestamp_ntz"))


def export_sales_parquet(spark, sf_dir):
    """K1: export year/month partitioned Parquet, return the table read back."""
    wh, path = staged(spark, sf_dir), scratch_path(spark, "sales_parquet")
    sinks.export_sales_parquet(wh.packed_sales, path, unpacked=wh.unpacked_sales)
    return sources.read_sales_parquet(spark, path)


def scan_sales_parquet(spark, sf_dir):
    """B2: region x category over the partitioned Parquet export."""
    return storage.region_category_revenue(export_sales_parquet(spark, sf_dir))


def export_result_csv(spark, sf_dir):
    """K4: a result table written as CSV with header and read back."""
    from pyspark.sql import types as T
    result = analytics.category_performance(_sales(spark, sf_dir))
    path = scratch_path(spark, "category_performance_csv")
    sinks.export_result_csv(result, path)
    schema = T.StructType([T.StructField("category", T.StringType()), T.StructField("revenue", T.DoubleType()),
                           T.StructField("orders", T.LongType()),
                           T.StructField("return_rate_pct", T.DoubleType())])
    return spark.read.schema(schema).options(**sources.RESULT_CSV_READ).csv(path)


# -- the stored star: built once per query, read by surrogate keys ------------

def stored(spark: SparkSession, sf_dir: str):
    return warehouse(spark, sf_dir).materialize()


def _on_stored(fn) -> Query:
    return lambda spark, sf_dir: fn(stored(spark, sf_dir))


def _bitmaps(spark, sf_dir) -> DataFrame:
    """The bitmaps of the sales, written and read back: the counts below read no line."""
    path = scratch_path(spark, "distinct_bitmaps")
    bitmaps = distinct_bitmaps(staged(spark, sf_dir).stored_sales)
    with shuffles_freed(spark):
        bitmaps.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(bitmaps.schema).parquet(path)


def daily_distinct_merged(spark, sf_dir):
    """V2's distinct orders and customers per day, from bitmaps."""
    return distinct_counts(_bitmaps(spark, sf_dir), F.col("order_day").alias("sales_date"))


def label_distinct_merged(spark, sf_dir):
    """Distinct orders and customers by category, by region and over all, from the same bitmaps."""
    bitmaps, found = _bitmaps(spark, sf_dir), None
    for by in ("category", "region", None):
        part = distinct_counts(bitmaps, by) if by else distinct_counts(bitmaps)
        part = part.select(F.lit(by or "all").alias("grouped_by"), (F.col(by) if by else F.lit(None)).cast("string").alias("label"), "orders", "customers")
        found = part if found is None else found.unionByName(part)
    return found


def salted_sales(wh) -> DataFrame:
    """The view through the salted shuffle join, whatever the size of the dimensions."""
    return wh.enriched(lambda big, dim, key: salted_join(big, dim, key, rows_per_task=5_000))


def _json_record(record: DataFrame) -> DataFrame:
    """K5 / K6: a one-row result written as JSON and read back."""
    path = scratch_path(record.sparkSession, "record_json")
    sinks.write_record_json(record, path)
    return record.sparkSession.read.schema(record.schema).json(path)


# -- slices ------------------------------------------------------------------

def narrow_slice(sales: DataFrame) -> slices.Slice:
    """A year and a half of days, two regions, the first three categories."""
    names = [r[0] for r in sales.select("category").where("category IS NOT NULL").distinct().orderBy("category").limit(3).collect()]
    return slices.as_slice("1996-03-05", "1997-04-20", ["North", "West"], names)


def _on_narrow_slice(fn) -> Query:
    def run(spark, sf_dir):
        sales = staged(spark, sf_dir).stored_sales
        return fn(sales, narrow_slice(sales))
    return run


def empty_slice_kpis(spark, sf_dir):
    return slices.slice_kpis(_sales(spark, sf_dir), slices.as_slice("1801-01-01", "1801-12-31", ["North"], ["Books"]))


def batch_queries() -> dict[str, Query]:
    w = warehouse
    narrow = {f"narrow_{fn.__name__}": _on_narrow_slice(fn) for fn in (
        slices.slice_filter, slices.slice_kpis, slices.slice_monthly, slices.slice_category,
        slices.slice_region_channel, slices.slice_top_products)}
    by_key = {
        "stored_sales_enriched": _on_stored(lambda wh: wh.sales_enriched),
        "stored_fact_sales": _on_stored(lambda wh: wh.fact_sales),
        "stored_region_category": _on_stored(lambda wh: storage.region_category_revenue(wh.sales_enriched)),
        "salted_region_category": _on_stored(lambda wh: storage.region_category_revenue(salted_sales(wh))),
        "stored_quality_report": _on_stored(lambda wh: wh.quality_report()),
        "stored_kpi_summary": _on_stored(lambda wh: analytics.kpi_summary(wh.sales_enriched)),
        "export_quality_json": _on_stored(lambda wh: _json_record(wh.quality_report())),
        "export_kpi_json": _on_stored(lambda wh: _json_record(analytics.kpi_summary(wh.sales_enriched))),
        "empty_slice_kpis": empty_slice_kpis,
    }
    return narrow | by_key | {
        "clean_trim": clean_trim,
        "clean_blank_to_null": clean_blank_to_null,
        "clean_canonical_labels": clean_canonical_labels,
        "clean_sentence_case": clean_sentence_case,
        "clean_numeric_cast": clean_numeric_cast,
        "clean_timestamp_cast": clean_timestamp_cast,
        "dedupe_lines": dedupe_lines,
        "stg_orders": lambda s, d: w(s, d).stg_orders,
        "rejected_orders": lambda s, d: w(s, d).rejected_orders,
        "accepted_orders": lambda s, d: w(s, d).accepted_orders,
        "dim_product": lambda s, d: w(s, d).dim_product,
        "dim_customer": lambda s, d: w(s, d).dim_customer,
        "dim_date": lambda s, d: w(s, d).dim_date,
        "fact_sales": lambda s, d: staged(s, d).fact_sales,
        "line_amounts": lambda s, d: staged(s, d).fact_sales.select(
            "line_id", "unit_price", "discount_pct", "gross_amount", "net_revenue"),
        "sales_enriched": lambda s, d: staged(s, d).sales_enriched,
        "quality_report": lambda s, d: staged(s, d).quality_report(),
        "daily_revenue": _on_sales(views.daily_revenue),
        "monthly_growth": _on_sales(views.monthly_growth),
        "repeat_customer_pct": _on_sales(views.repeat_customer_pct),
        "category_revenue": _on_sales(analytics.category_revenue),
        "region_top_customers": _on_sales(analytics.region_top_customers),
        "daily_change": _on_sales(views.daily_change),
        "category_performance": _on_sales(analytics.category_performance),
        "region_performance": _on_sales(analytics.region_performance),
        "top_customers": _on_sales(analytics.top_customers),
        "kpi_summary": _on_sales(analytics.kpi_summary),
        "category_sum": _on_sales(analytics.category_sum),
        "rollup_region_category": _on_sales(olap.rollup_region_category),
        "cube_region_channel": _on_sales(olap.cube_region_channel),
        "grouping_sets_raw": _on_sales(olap.grouping_sets_raw),
        "grouping_sets_labeled": _on_sales(olap.grouping_sets_labeled),
        "filter_domain": _on_sales(slices.filter_domain),
        "slice_filter": _on_default_slice(slices.slice_filter),
        "slice_kpis": _on_default_slice(slices.slice_kpis),
        "slice_monthly": _on_default_slice(slices.slice_monthly),
        "slice_category": _on_default_slice(slices.slice_category),
        "slice_region_channel": _on_default_slice(slices.slice_region_channel),
        "slice_top_products": _on_default_slice(slices.slice_top_products),
        "raw_region_category": lambda s, d: storage.raw_region_category(_raw(s, d)),
        "region_category_revenue": _on_sales(storage.region_category_revenue),
        "scan_sales_parquet": scan_sales_parquet,
        "export_sales_parquet": export_sales_parquet,
        "daily_distinct_merged": daily_distinct_merged,
        "label_distinct_merged": label_distinct_merged,
        "scan_orders_csv": scan_orders_csv,
        "scan_orders_csv_dialects": scan_orders_csv_dialects,
        "scan_orders_csv_splits": scan_orders_csv_splits,
        "scan_cart_items_inferred": scan_cart_items_inferred,
        "export_result_csv": export_result_csv,
    }


def all_queries() -> dict[str, Query]:
    return batch_queries() | more_queries()
