"""Row groups that a slice or a key lookup over the export does not read."""

import tempfile

import pytest
from pyspark.sql import functions as F

from orderloom.plans.warehouse import Warehouse
from orderloom.sinks.files import CLUSTERED, curve_key, export_sales_parquet
from orderloom.sources import testmap

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def one_month(spark):
    """All sales in one month, with distinct order ids of no order, in small row groups."""
    sales = Warehouse(testmap.raw_orders(spark, SF_SMALL), order_by=testmap.TIE_BREAK).sales_enriched
    sales = sales.withColumns({"order_date": F.lit("2024-03-05 00:00:00").cast("timestamp_ntz"),
                               "order_id": F.concat(F.md5("order_id"), F.md5("line_id"))}).coalesce(1)
    path = tempfile.mkdtemp(prefix="orderloom-test-") + "/sales"
    export_sales_parquet(sales, path, row_group_bytes=16 << 10)
    return spark.read.parquet(path)


def rows_read(df) -> tuple[int, int]:
    """Rows that the scan put out, and rows of the result."""
    n = len(df.collect())
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value(), n


def test_a_slice_reads_few_row_groups(one_month):
    everything = one_month.count()
    found = one_month.where("region = 'West' AND category = 'Promo'").select("line_id", "region", "category", "net_revenue")
    read, n = rows_read(found)
    assert 0 < n <= read < everything / 2


def test_a_key_is_found_by_bloom_filter(one_month):
    everything = one_month.count()
    order = one_month.select("order_id").first()[0]
    read, n = rows_read(one_month.where(F.col("order_id") == order).select("order_id", "line_id"))
    assert 1 <= n <= read < everything / 4
    read, n = rows_read(one_month.where("order_id = 'no such order'").select("order_id"))
    assert (read, n) == (0, 0)


def test_curve_key_takes_bits_in_turn(spark):
    rows = spark.range(500).selectExpr("string(id % 5) AS region", "string(id % 6) AS category", "string(id) AS customer_id")
    hashed = rows.select(curve_key(CLUSTERED).alias("key"), *[F.pmod(F.xxhash64(c), F.lit(1 << n)).alias(c) for c, n in CLUSTERED.items()])
    for r in hashed.collect():
        bits = {c: format(r[c], f"0{n}b") for c, n in CLUSTERED.items()}
        expected = "".join(bits[c][i] for i in range(12) for c in CLUSTERED if i < len(bits[c]))
        assert r.key == int(expected, 2)
