"""What crosses the shuffles of the distinct counts."""
import datetime as dt

from orderloom.operators.distinct import distinct_bitmaps


def test_no_partial_bitmap_is_shuffled(spark):
    rows = [(f"O{i}", f"C{i % 7}", "North", "cat", dt.datetime(2024, 1, 1 + i % 9)) for i in range(50)]
    sales = spark.createDataFrame(rows, "order_id string, customer_id string, region string, category string, order_date timestamp_ntz")
    plan = distinct_bitmaps(sales)._jdf.queryExecution().executedPlan().toString().split("\n")
    partial = [i for i, line in enumerate(plan) if "partial_bitmap_construct_agg" in line]
    assert partial
    for i in partial:
        final = max(j for j in range(i) if "bitmap_construct_agg" in plan[j])
        assert not any("Exchange" in line for line in plan[final:i])
