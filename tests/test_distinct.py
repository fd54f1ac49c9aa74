"""Distinct counts from merged bitmaps equal COUNT(DISTINCT) for any slice, without reading lines."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderloom.operators.distinct import distinct_bitmaps, distinct_counts


@pytest.fixture(scope="module")
def sales(spark):
    rows = [(f"O{i % 4001}" if i % 97 else None, f"C{i * i % 1009}", ["North", "West", None][i % 3], f"cat{i % 4}",
             dt.datetime(2024, 1, 1) + dt.timedelta(hours=i % 700)) for i in range(9000)]
    rows += [(f"big{i}", "one", "North", "cat0", dt.datetime(2024, 1, 3)) for i in range(40_000)]   # more keys than one bitmap holds
    return spark.createDataFrame(rows, "order_id string, customer_id string, region string, category string, order_date timestamp_ntz").cache()


@pytest.fixture(scope="module")
def bitmaps(spark, sales, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bits") / "t")
    distinct_bitmaps(sales).write.parquet(path)
    return spark.read.parquet(path)


def test_slices_and_groups(sales, bitmaps):
    day = F.to_date("order_date")
    measures = [F.count_distinct("order_id").alias("orders"), F.count_distinct("customer_id").alias("customers")]
    lines = sales.withColumn("order_day", day)
    for where in ("true", "region = 'North'", "category IN ('cat1', 'cat2') AND order_day BETWEEN '2024-01-02' AND '2024-01-20'", "region IS NULL"):
        for by in ((), ("order_day",), ("region", "category")):
            expected = sorted(map(tuple, lines.where(where).groupBy(*by).agg(*measures).collect()), key=repr)
            assert sorted(map(tuple, distinct_counts(bitmaps.where(where), *by).collect()), key=repr) == expected, (where, by)
    month = F.trunc("order_day", "month").alias("month")
    assert distinct_counts(bitmaps, month).first()["orders"] == sales.select("order_id").dropna().distinct().count()


def test_several_buckets_and_an_empty_slice(bitmaps):
    assert bitmaps.where("counted = 'orders'").select("bucket").distinct().count() > 1
    assert distinct_counts(bitmaps.where("region = 'nowhere'")).first() == (0, 0)
    assert distinct_counts(bitmaps.where("region = 'nowhere'"), "category").collect() == []
