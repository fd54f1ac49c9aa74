"""Queries that use the staged lines more than once read the raw feed once."""
import itertools

import pytest
from conftest import SF_SMALL
from orderloom.functions import CHANNELS, REGIONS, SEGMENTS, UNKNOWN
from orderloom.operators import cleaning
from orderloom.plans.registry import batch_queries
from orderloom.plans.warehouse import StagedWarehouse, Warehouse
from orderloom.schemas import RAW_ORDERS
from pyspark.sql import functions as F


@pytest.mark.parametrize("name", ["sales_enriched", "fact_sales", "line_amounts", "slice_filter", "narrow_slice_kpis"])
def test_the_feed_is_joined_once(spark, name):
    files = batch_queries()[name](spark, SF_SMALL).inputFiles()
    assert files and not [f for f in files if "lineitem" in f]      # what follows reads stored tables


def _line(n, **given):
    base = {"line_id": f"L{n}", "order_id": f"O{n // 2}", "order_date": "2024-03-01 10:00:00", "customer_id": f"C{n % 3}",
            "customer_segment": "consumer", "region": "north", "sales_channel": "web", "product_id": f"P{n % 2}",
            "product_name": f"p{n}", "category": "books", "quantity": "2", "unit_price": "5.5", "discount_pct": "10",
            "payment_method": "Card", "order_status": "shipped", "shipping_days": "1"} | given
    return tuple(base[f.name] for f in RAW_ORDERS.fields)


def test_stored_tables_hold_the_rows_of_the_lazy_ones(spark):
    data = [_line(n) for n in range(12)] + [_line(3, region="south"), _line(3, quantity="7"), _line(5, customer_id=None),
                                            _line(7, line_id=None), _line(8, line_id=None), _line(9, product_id=" ")]
    raw = spark.createDataFrame(data, RAW_ORDERS)
    lazy, once = Warehouse(raw), StagedWarehouse(raw)
    for table in ("stg_orders", "sales_enriched", "fact_sales", "dim_customer", "dim_product", "rejected_orders"):
        a, b = getattr(lazy, table), getattr(once, table)
        assert a.columns == b.columns and [f.dataType for f in a.schema] == [f.dataType for f in b.schema]
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())), table
    assert once.stored_sales.count() == lazy.sales_enriched.count() > 0


def test_large_attribute_tables_join_only_the_keys_that_do_not_agree(spark, monkeypatch):
    from orderloom.plans import warehouse

    data = [_line(n, customer_id=f"C{n % 40}", product_id=f"P{n % 30}", product_name=f"p{n % 30}") for n in range(240)]
    data += [_line(900, customer_id="C7", region="south"), _line(901, customer_id="C9", region="west", customer_segment="corporate"),
             _line(902, product_id="P3", product_name=None), _line(903, product_id="P4", product_name="aaa"), _line(904, product_id="P99", product_name=None),
             _line(905, customer_id=None), _line(906, product_id=" "), _line(907, line_id=None, customer_id="C5", region="east"), _line(908, category=None)]
    raw = spark.createDataFrame(data, RAW_ORDERS)
    wanted = sorted(map(repr, Warehouse(raw).sales_enriched.collect()))
    plans = []
    for bound in (5, 0):                # a few keys that do not agree are shipped; more than fit: all are joined as before
        monkeypatch.setattr(warehouse, "DEFAULT_BROADCAST_ROWS", bound)
        monkeypatch.setattr("orderloom.operators.joins.DEFAULT_BROADCAST_ROWS", bound)
        found = StagedWarehouse(raw).sales_enriched
        assert found.columns == Warehouse(raw).sales_enriched.columns
        assert sorted(map(repr, found.collect())) == wanted
        plans.append(found._jdf.queryExecution().optimizedPlan().toString())
    assert plans[0].count("LeftOuter") == 2 and "Inner" not in plans[0] and plans[1].count("Join Inner") == 2


def test_packed_labels_keep_text_and_order(spark):
    rows = [_line(0, customer_segment=a, region=b, sales_channel=c)
            for a, b, c in itertools.product((*SEGMENTS, "?"), (*REGIONS, None), (*CHANNELS, ""))]
    typed = spark.createDataFrame(rows, RAW_ORDERS).select(*cleaning.typed_columns())
    packed = cleaning._pack_labels(typed)
    names = ["customer_segment", "region", "sales_channel"]
    read = [tuple(r) for r in packed.orderBy("_labels").select(*map(cleaning._unpacked, names)).collect()]
    assert read == sorted(itertools.product((*SEGMENTS, UNKNOWN), (*REGIONS, UNKNOWN), (*CHANNELS, UNKNOWN)))
    assert packed.select(F.count_distinct("_labels")).first()[0] == len(rows)
