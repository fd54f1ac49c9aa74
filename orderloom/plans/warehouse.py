"""The warehouse: every table of the star schema as a lazily built DataFrame."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderloom.operators import cleaning, quality, star
from orderloom.operators.joins import DEFAULT_BROADCAST_ROWS, fits, join_dimension, joins_counted_on
from orderloom.schemas import ENRICHED_COLUMNS
from orderloom.session import scratch_path, shuffles_freed


class Warehouse:
    """Star schema over one raw orders frame (16 text columns).

    Nothing runs until a table is used, except the surrogate-key tables
    (``dim_product``, ``dim_customer``, ``fact_sales``), which checkpoint a
    ranged copy of the dimension to number it.
    """

    def __init__(self, raw: DataFrame, order_by: Sequence[str] = ()):
        self.raw = raw
        self.order_by = list(order_by)

    @property
    def spark(self) -> SparkSession:
        return self.raw.sparkSession

    @cached_property
    def stg_orders(self) -> DataFrame:
        return cleaning.stage_orders(self.raw, self.order_by)

    @cached_property
    def rejected_orders(self) -> DataFrame:
        return quality.rejected(self.stg_orders)

    @cached_property
    def accepted_orders(self) -> DataFrame:
        return quality.accepted(self.stg_orders)

    @cached_property
    def customers(self) -> DataFrame:
        return star.customer_attributes(self.stg_orders)

    @cached_property
    def products(self) -> DataFrame:
        return star.product_attributes(self.stg_orders)

    @cached_property
    def dim_product(self) -> DataFrame:
        return star.dim_product(self.stg_orders)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return star.dim_customer(self.stg_orders)

    @cached_property
    def dim_date(self) -> DataFrame:
        return star.dim_date(self.stg_orders)

    @cached_property
    def fact_sales(self) -> DataFrame:
        return star.fact_sales(self.accepted_orders, self.dim_customer, self.dim_product)

    @cached_property
    def sales_enriched(self) -> DataFrame:
        return star.sales_enriched(self.accepted_orders, self.customers, self.products)

    def quality_report(self) -> DataFrame:
        return quality.quality_report(self.raw, self.stg_orders, self.sales_enriched,
                                      self.rejected_orders, self.customers, self.products)

    def materialize(self, root: str | None = None) -> "StoredWarehouse":
        """Write every table as ZSTD Parquet (a full refresh, like the reference's CTAS).

        ``stg_orders`` is written first and everything else is derived from
        the stored copy: the raw feed is read once, and each written table
        cuts the lineage, so a lost executor re-reads a table instead of
        recomputing the chain. The raw row count is observed during that
        single pass.
        """
        root = (root or scratch_path(self.spark, "warehouse")).rstrip("/")
        observed = Observation("raw")
        raw = self.raw.observe(observed, F.count(F.lit(1)).alias("raw_rows"))
        _write(cleaning.stage_orders(raw, self.order_by), f"{root}/stg_orders")
        raw_rows = int(observed.get["raw_rows"])
        self.spark.createDataFrame([(raw_rows,)], "raw_rows long").coalesce(1) \
            .write.mode("overwrite").json(f"{root}/_raw_rows")

        stored = StoredWarehouse(self.spark, root)
        stg = stored.stg_orders
        # independent tables: submit their jobs concurrently so small stages
        # (the dimensions) share the cluster instead of queueing
        builders = {
            "rejected_orders": lambda: quality.rejected(stg),
            "dim_product": lambda: star.dim_product(stg),
            "dim_customer": lambda: star.dim_customer(stg),
            "dim_date": lambda: star.dim_date(stg),
        }
        with ThreadPoolExecutor(max_workers=len(builders)) as pool:
            futures = [pool.submit(lambda n=n, b=b: _write(b(), f"{root}/{n}")) for n, b in builders.items()]
            for f in futures:
                f.result()
        accepted = quality.accepted(stg)
        fact = star.fact_sales(accepted, stored.dim_customer, stored.dim_product, join=joins_counted_on(accepted))
        _write(fact, f"{root}/fact_sales")
        return stored


class StagedWarehouse(Warehouse):
    """The same tables for jobs that use them more than once.

    The view reads the staged lines three times (lines, customers, products), a slice reads the
    view twice; each time the raw feed would be joined, cleaned and shuffled again. Here the staged
    lines are written once, when first used. In the view a line of a key whose lines all carry the same
    attributes keeps its own; only the other keys' attributes are collected from their lines and joined by
    a broadcast, if they are proven few. Else the attribute tables are written once and joined as in
    ``StoredWarehouse``: by a broadcast only if proven small, else with salted hot keys.
    """

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, name)
        with shuffles_freed(self.spark):
            _write(df, path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def stg_orders(self) -> DataFrame:
        return self._stored("stg_orders", cleaning.stage_orders(self.raw, self.order_by))

    @cached_property
    def customers(self) -> DataFrame:
        return self._stored("customers", star.customer_attributes(self.stg_orders))

    @cached_property
    def products(self) -> DataFrame:
        return self._stored("products", star.product_attributes(self.stg_orders))

    @cached_property
    def dim_product(self) -> DataFrame:
        return self._stored("dim_product", star.dim_product(self.stg_orders))

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self._stored("dim_customer", star.dim_customer(self.stg_orders))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return star.fact_sales(self.accepted_orders, self.dim_customer, self.dim_product, join=joins_counted_on(self.accepted_orders))

    @cached_property
    def _view(self) -> tuple[DataFrame, bool]:
        """The lines of the view, without its amounts, and whether they have a shuffle."""
        lines, shuffled = self.accepted_orders, False
        for keyed, whole, key, names in ((star.of_customers, lambda: self.customers, "customer_id", star.CUSTOMER_NAMES),
                                         (star.of_products, lambda: self.products, "product_id", star.PRODUCT_NAMES)):
            keys = self._stored("mixed_keys", star.mixed_keys(keyed(self.stg_orders), key, names))
            if fits(keys, DEFAULT_BROADCAST_ROWS):
                own = keyed(self.stg_orders).join(F.broadcast(keys), key, "left_semi")
                mixed = self._stored("mixed", star.attributes(own, key, names))
                if fits(mixed, DEFAULT_BROADCAST_ROWS):
                    lines = star.with_attributes(keyed(lines), mixed, key, names)
                    continue
            shuffled = True
            lines = join_dimension(lines.drop(*names), whole(), key, counted=self.accepted_orders)
        return lines, shuffled

    @cached_property
    def sales_enriched(self) -> DataFrame:
        return star.line_amounts(self._view[0]).select(*ENRICHED_COLUMNS)

    @property
    def packed_sales(self) -> DataFrame:
        """What a shuffle of the view needs to move: ``unpacked_sales`` makes the view of it."""
        own = [c for c in ENRICHED_COLUMNS if c in self._view[0].columns]
        return cleaning.pack_labels(self._view[0].select(*own))

    @staticmethod
    def unpacked_sales(packed: DataFrame) -> DataFrame:
        return star.line_amounts(cleaning.unpack_labels(packed)).select(*ENRICHED_COLUMNS)

    @cached_property
    def stored_sales(self) -> DataFrame:
        """For jobs that read the view more than once: written once if it has a shuffle, else read from the staged lines."""
        return self._stored("sales_enriched", self.sales_enriched) if self._view[1] else self.sales_enriched


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


class StoredWarehouse:
    """Tables written by ``Warehouse.materialize``; the view joins on keys."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}")

    @property
    def stg_orders(self) -> DataFrame:
        return self.table("stg_orders")

    @property
    def rejected_orders(self) -> DataFrame:
        return self.table("rejected_orders")

    @property
    def dim_product(self) -> DataFrame:
        return self.table("dim_product")

    @property
    def dim_customer(self) -> DataFrame:
        return self.table("dim_customer")

    @property
    def dim_date(self) -> DataFrame:
        return self.table("dim_date")

    @property
    def fact_sales(self) -> DataFrame:
        return self.table("fact_sales")

    @cached_property
    def sales_enriched(self) -> DataFrame:
        # dims are stored tables: each is broadcast only if proven small, else joined with salted hot keys
        return self.enriched(joins_counted_on(self.fact_sales))

    def enriched(self, join) -> DataFrame:
        """The view with ``join(big, dim, key)`` for both dimensions."""
        return star.enriched_from_fact(self.fact_sales, self.dim_customer, self.dim_product, join)

    def quality_report(self) -> DataFrame:
        # the raw feed is not kept; its row count was stored at build time
        raw_rows = self.spark.read.json(f"{self.root}/_raw_rows").agg(F.sum("raw_rows").cast("long")).scalar()
        return quality.quality_report(raw_rows, self.stg_orders, self.fact_sales,
                                      self.rejected_orders, self.dim_customer, self.dim_product)


def register_views(wh: "Warehouse | StoredWarehouse", prefix: str = "", order_events: DataFrame | None = None) -> list[str]:
    """Register the reference's table and view names as temp views for ``spark.sql``.

    Tables: stg_orders, rejected_orders, dim_product, dim_customer, dim_date,
    fact_sales. Views: vw_sales_enriched, vw_daily_revenue, vw_monthly_growth,
    vw_repeat_customer_pct; with the stored ``order_events`` also these and
    vw_events_by_minute. All stay lazy; SQL over them is planned by Catalyst
    together with the view bodies.
    """
    from orderloom.plans import views
    from orderloom.streaming import metrics

    sales = wh.sales_enriched
    frames = {
        "stg_orders": wh.stg_orders,
        "rejected_orders": wh.rejected_orders,
        "dim_product": wh.dim_product,
        "dim_customer": wh.dim_customer,
        "dim_date": wh.dim_date,
        "fact_sales": wh.fact_sales,
        "vw_sales_enriched": sales,
        "vw_daily_revenue": views.daily_revenue(sales),
        "vw_monthly_growth": views.monthly_growth(sales),
        "vw_repeat_customer_pct": views.repeat_customer_pct(sales),
    }
    if order_events is not None:
        frames |= {"order_events": order_events, "vw_events_by_minute": metrics.events_by_minute(order_events)}
    names = []
    for name, df in frames.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names
