"""Physical-plan assertions: pushdown, pruning, broadcast, window limits."""

import tempfile

import pytest
from pyspark.sql import functions as F

from orderloom.plans import analytics, storage
from orderloom.plans.warehouse import Warehouse
from orderloom.sinks.files import export_sales_parquet
from orderloom.sources import testmap
from orderloom.sources.files import read_sales_parquet

from conftest import SF_SMALL


def plan_of(df) -> str:
    df.collect()  # AQE: the final plan is known after a run
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    w = Warehouse(testmap.raw_orders(spark, SF_SMALL), order_by=testmap.TIE_BREAK)
    return w.materialize(tempfile.mkdtemp(prefix="orderloom-wh-"))


def test_status_filter_reaches_the_fact_scan(spark, stored):
    plan = storage.region_category_revenue(stored.sales_enriched)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(order_status" in plan or "PushedFilters: [IsNotNull(order_status), In(order_status" in plan


def test_fact_scan_reads_only_needed_columns(spark, stored):
    df = storage.region_category_revenue(stored.sales_enriched)
    plan = df._jdf.queryExecution().executedPlan().toString()
    fact_scan = [line for line in plan.splitlines() if "fact_sales" in line and "ReadSchema" in line][0]
    read_schema = fact_scan.split("ReadSchema: ")[1]
    assert "net_revenue" in read_schema and "payment_method" not in read_schema


def test_dimensions_are_broadcast_after_a_size_check(spark, stored):
    plan = plan_of(storage.region_category_revenue(stored.sales_enriched))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_regional_top_k_uses_window_group_limit(spark, stored):
    df = analytics.region_top_customers(stored.sales_enriched)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_dense_key_has_no_single_partition_exchange(spark, stored):
    plan = stored.dim_customer._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_month_slice_prunes_partitions(spark, stored):
    path = tempfile.mkdtemp(prefix="orderloom-pq-") + "/sales"
    export_sales_parquet(stored.sales_enriched, path)
    df = read_sales_parquet(spark, path).filter((F.col("year") == 1996) & (F.col("month") == 3))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(month#" in plan
    assert df.count() == stored.sales_enriched.filter(
        (F.year("order_date") == 1996) & (F.month("order_date") == 3)).count()


def test_top_customers_is_a_distributed_top_k(spark, stored):
    plan = analytics.top_customers(stored.sales_enriched)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_hot_customer_shuffle_join_keeps_every_row(spark):
    """One customer holds a third of the lines and the dimension is not broadcast:
    the enriched join runs as a sort-merge join and keeps every row."""
    from orderloom.operators import star

    n = 60000
    accepted = spark.range(n).select(
        F.col("id").cast("string").alias("line_id"),
        F.when(F.col("id") % 3 == 0, F.lit("C-HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 5000).cast("string"))).alias("customer_id"),
        F.concat(F.lit("P"), (F.col("id") % 50).cast("string")).alias("product_id"),
        F.lit("O1").alias("order_id"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("order_date"),
        F.lit("Web").alias("sales_channel"), F.lit(2).alias("quantity"), F.lit(10.0).alias("unit_price"),
        F.lit(5.0).alias("discount_pct"), F.lit("UPI").alias("payment_method"), F.lit("Delivered").alias("order_status"),
        F.lit(1).alias("shipping_days"), F.lit("x").alias("customer_segment"), F.lit("x").alias("region"),
        F.lit("x").alias("product_name"), F.lit("x").alias("category"))
    customers = accepted.select("customer_id").distinct().select(
        "customer_id", F.lit("Consumer").alias("customer_segment"), F.lit("West").alias("region"))
    products = accepted.select("product_id").distinct().select(
        "product_id", F.lit("Widget").alias("product_name"), F.lit("Books").alias("category"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = star.sales_enriched(accepted, customers, products).groupBy("region").agg(F.count("*").alias("n"))
        assert df.collect()[0].n == n
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_salted_join_spreads_a_hot_key(spark):
    from orderloom.operators.joins import join_dimension, salt_counts

    n = 60000
    big = spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("C-HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 5000).cast("string"))).alias("customer_id"))
    dim = big.select("customer_id").distinct().withColumn("segment", F.lit("Consumer"))
    assert [tuple(r) for r in salt_counts(big, "customer_id", 5000).collect()] == [("C-HOT", 4)]
    joined = join_dimension(big, dim, "customer_id", bound=10, rows_per_task=5000)     # too big to broadcast
    per_task = joined.filter("customer_id = 'C-HOT'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in per_task) == n // 3            # whole: every hot row joined once
    assert len(per_task) > 1                                       # and spread over several tasks
    assert joined.count() == n


def test_hot_keys_are_counted_by_hash_first_and_on_the_given_lines(spark, monkeypatch):
    from orderloom.operators import joins

    lines = spark.range(30000).select(F.concat(F.lit("C"), (F.col("id") % 5000).cast("string")).alias("customer_id"), "id")
    # no key is hot: none is counted itself, so no row of it is shuffled
    calm = joins.salt_counts(lines, "customer_id", 5000)
    assert calm.collect() == [] and "Exchange" not in calm._jdf.queryExecution().executedPlan().toString()
    # hashes shared by hot and other keys, and by keys that are only hot together; null is a key
    monkeypatch.setattr(joins, "KEY_HASHES", 2)
    mixed = lines.select(F.when(F.col("id") % 3 == 0, "C-HOT").when(F.col("id") % 3 == 1, F.col("customer_id")).alias("customer_id"), "id")
    found = {tuple(r) for r in joins.salt_counts(mixed, "customer_id", 4000).collect()}
    assert found == {("C-HOT", 3), (None, 3)}
    # the table that is joined is not built for the counts
    never = mixed.where(F.raise_error(F.lit("built")).isNull())
    dim = lines.select("customer_id").distinct()
    joins.salted_join(never, dim, "customer_id", 4000, counted=mixed)
    monkeypatch.setattr(joins, "DEFAULT_BROADCAST_ROWS", 10)
    joins.joins_counted_on(mixed)(never, dim, "customer_id")
    joined = joins.salted_join(mixed.where("id % 2 = 0"), dim.union(spark.createDataFrame([("C-HOT",)], "customer_id string")), "customer_id", 4000, counted=mixed)
    assert joined.count() == mixed.where("id % 2 = 0 AND customer_id IS NOT NULL").count()


def test_aqe_splits_a_hot_key_in_a_shuffle_join(spark):
    """The session settings leave AQE's skew-join split on: a key with a third
    of the rows is split across tasks (thresholds lowered to local sizes)."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        big = spark.range(200000).select(
            F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000).alias("k"))
        dim = spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
        df = big.join(dim, "k").groupBy("v").count()
        assert df.collect()[0]["count"] == 200000
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin(skew=true)" in plan


def test_reports_sort_behind_the_final_aggregate(spark):
    """The last aggregate keeps its own tasks: an exchange stands between it and the one-task sort."""
    from orderloom.plans.reports import small_report
    df = small_report(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "k")
    lines = df._jdf.queryExecution().sparkPlan().toString().splitlines()
    nodes = [next(w for w in ("Sort", "RoundRobin", "SinglePartition", "Repartition", "Exchange", "HashAggregate", "Coalesce", "Range", "Project") if w in x) for x in lines if any(
        w in x for w in ("Sort", "Exchange", "Repartition", "HashAggregate", "Coalesce", "Range", "Project"))]
    assert "Coalesce" not in nodes
    assert nodes.index("Sort") < nodes.index("SinglePartition") < nodes.index("HashAggregate")
    assert [r["count"] for r in df.collect()] == [143] * 6 + [142]


def test_size_checks_do_not_gather_rows(spark):
    from orderloom.operators.joins import fits
    df = spark.range(1000).selectExpr("id", "repeat('x', 100) AS s")
    assert fits(df, 1000) and not fits(df, 999) and not fits(df, 1000, bytes_=100_000)


def test_accepted_rows_push_their_rules_down(spark):
    from orderloom.operators import quality
    from orderloom.plans.registry import warehouse
    from orderloom.session import scratch_path
    from conftest import SF_SMALL
    path = scratch_path(spark, "stg")
    warehouse(spark, SF_SMALL).stg_orders.write.parquet(path)
    stored = spark.read.parquet(path)
    kept = quality.accepted(stored)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThan(unit_price,0.0)" in pushed and "IsNotNull(order_date)" in pushed
    assert kept.count() + quality.rejected(stored).count() == stored.count()


def test_slices_prune_months_of_the_export(spark):
    from orderloom.plans import slices
    from orderloom.plans.registry import export_sales_parquet
    from conftest import SF_SMALL
    sales = export_sales_parquet(spark, SF_SMALL)
    s = slices.as_slice("1995-03-05", "1995-04-20", ["North", "West"], [r.category for r in sales.select("category").distinct().collect()][:3])
    part = slices.slice_filter(sales, s)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "year" in plan.split("PartitionFilters:")[1].split("]")[0]
    days = sales.selectExpr("to_date(order_date) AS d", "region", "category").collect()
    assert part.count() == sum(s.date_from <= r.d <= s.date_to and r.region in s.regions and r.category in s.categories for r in days)
