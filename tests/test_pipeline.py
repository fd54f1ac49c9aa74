"""Staging, quality, dimensions: invariants and skew-safe constructs."""

from pyspark.sql import functions as F

from orderloom.operators.cleaning import dedupe_by_key, stage_orders
from orderloom.operators.keys import with_dense_key
from orderloom.plans.warehouse import Warehouse
from orderloom.schemas import RAW_ORDER_COLUMNS
from orderloom.sources import testmap

from conftest import SF_SMALL


def _raw_rows(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in RAW_ORDER_COLUMNS))


def _line(line_id, **kw):
    base = dict(line_id=line_id, order_id="O1", order_date="2024-03-01 10:00:00", customer_id="C1",
                customer_segment="consumer", region="west", sales_channel="web", product_id="P1",
                product_name="Widget", category="books", quantity="2", unit_price="10.00", discount_pct="10",
                payment_method="UPI", order_status="delivered", shipping_days="3")
    base.update(kw)
    return tuple(base[c] for c in RAW_ORDER_COLUMNS)


def test_rules_reasons_and_split(spark):
    raw = _raw_rows(spark, [
        _line("L1"),
        _line("L2", quantity="3.7"),                     # tolerant cast -> 4, accepted
        _line("L3", quantity="1e2"),                     # 100 -> invalid quantity
        _line("L4", order_date="2024", customer_id="  "),  # bare year + blank id: two reasons
        _line("L5", unit_price=None, discount_pct="140"),
        _line(None), _line(None, order_id="O9"),         # NULL ids: one survives
        _line("  "),                                     # blank id
        _line("L1"),                                     # exact duplicate
    ])
    w = Warehouse(raw)
    stg = w.stg_orders
    assert stg.count() == 7
    reasons = {r.line_id: r.rejection_reason for r in w.rejected_orders.collect()}
    assert reasons["L3"] == "invalid quantity"
    assert reasons["L4"] == "invalid order_date; missing customer_id"
    assert reasons["L5"] == "invalid unit_price; invalid discount"
    assert reasons[None] == "missing line_id"
    assert reasons[""] == "missing line_id"
    accepted = {r.line_id: r for r in w.accepted_orders.collect()}
    assert set(accepted) == {"L1", "L2"} and accepted["L2"].quantity == 4
    # one rule list: typed = clean + rejected
    assert stg.count() == w.accepted_orders.count() + w.rejected_orders.count()
    sales = {r.line_id: r for r in w.sales_enriched.collect()}
    assert sales["L1"].net_revenue == 18.0 and sales["L1"].region == "West"


def test_dedupe_hot_key_is_combined_map_side(spark):
    # one key holds a third of all rows
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("v"))
    out = dedupe_by_key(df, "k", ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan          # partial aggregate before the shuffle
    assert out.filter("k = 'HOT'").first().v == 0
    assert out.count() == 20001


def test_dense_key_equals_global_row_number(spark, duck):
    ids = [f"C{(i * 7919) % 5003:06d}" for i in range(3000)]
    df = spark.createDataFrame([(i,) for i in set(ids)], "customer_id string")
    keyed = with_dense_key(df, "customer_id", "customer_key", num_partitions=7)
    got = {r.customer_id: r.customer_key for r in keyed.collect()}
    assert sorted(got.values()) == list(range(1, len(got) + 1))
    assert all(got[a] < got[b] for a, b in zip(sorted(got), sorted(got)[1:]))


def test_invariants_on_driver_tables(spark):
    w = Warehouse(testmap.raw_orders(spark, SF_SMALL), order_by=testmap.TIE_BREAK)
    typed = w.stg_orders.count()
    assert typed == w.accepted_orders.count() + w.rejected_orders.count()
    assert w.fact_sales.count() == w.sales_enriched.count() == w.accepted_orders.count()
    q = w.quality_report().first()
    assert q.raw_rows == 6000 or q.raw_rows == testmap.raw_orders(spark, SF_SMALL).count()
    assert q.typed_rows == typed
    # dense keys cover 1..n
    keys = [r.product_key for r in w.dim_product.select("product_key").collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))


def test_stage_orders_keeps_declared_schema(spark):
    from orderloom.schemas import STG_ORDERS
    stg = stage_orders(_raw_rows(spark, [_line("L1")]))
    assert [(f.name, f.dataType) for f in stg.schema.fields] == [(f.name, f.dataType) for f in STG_ORDERS.fields]


def test_reference_names_work_in_spark_sql(spark):
    from orderloom.plans.warehouse import register_views
    w = Warehouse(testmap.raw_orders(spark, SF_SMALL), order_by=testmap.TIE_BREAK)
    register_views(w)
    got = spark.sql("""
        SELECT region, category, SUM(net_revenue) AS revenue
        FROM vw_sales_enriched WHERE order_status IN ('Delivered', 'Shipped')
        GROUP BY 1, 2""").count()
    assert got == 30
    assert spark.sql("SELECT * FROM vw_repeat_customer_pct").count() == 1
    assert spark.sql("SELECT COUNT(*) FROM fact_sales f JOIN dim_customer c USING (customer_key)").first()[0] \
        == w.accepted_orders.count()


def test_narrow_slice_matches_brute_force(spark, duck):
    import datetime as dt

    import pytest

    from orderloom.plans import oracle, slices
    w = Warehouse(testmap.raw_orders(spark, SF_SMALL), order_by=testmap.TIE_BREAK)
    s = slices.as_slice("1996-01-01", "1997-06-30", ["North", "West"], ["Standard", "Promo", "Large"])
    got = {(r.product_name, r.category): (r.revenue, r.units)
           for r in slices.slice_top_products(w.sales_enriched, s).collect()}
    kp = slices.slice_kpis(w.sales_enriched, s).first()
    for t in ["region", "nation", "customer", "part", "orders", "lineitem"]:
        duck.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    where = ("order_date::DATE BETWEEN DATE '1996-01-01' AND DATE '1997-06-30' "
             "AND region IN ('North', 'West') AND category IN ('Standard', 'Promo', 'Large')")
    top = duck.execute(oracle.with_sales(f"""
        SELECT product_name, category, {oracle.EARNED} AS revenue, CAST(SUM(quantity) AS BIGINT) AS units
        FROM sold WHERE {where} GROUP BY 1, 2
        ORDER BY revenue DESC, product_name NULLS LAST, category NULLS LAST LIMIT 10""")).fetchall()
    assert got == {(a, b): (c, d) for a, b, c, d in top}
    k = duck.execute(oracle.with_sales(f"""
        SELECT {oracle.EARNED}, COUNT(DISTINCT order_id), COUNT(DISTINCT customer_id), {oracle.RETURNED}
        FROM sold WHERE {where}""")).fetchone()
    assert (kp.revenue, kp.orders, kp.customers) == k[:3]
    assert kp.return_rate == pytest.approx(k[3])
    with pytest.raises(ValueError):
        slices.as_slice("1996-01-01", "1997-06-30", [], ["Standard"])
    assert isinstance(s.date_from, dt.date)
