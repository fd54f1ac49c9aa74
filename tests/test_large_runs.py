"""What keeps the queries over large tables within time and disk: compiled cleaning, hashed aggregates, freed shuffles."""
from orderloom.functions import columns as C
from orderloom.operators import cleaning, star
from orderloom.operators.keys import with_dense_key
from orderloom.plans import warehouse
from orderloom.plans.warehouse import StagedWarehouse, Warehouse
from orderloom.schemas import RAW_ORDERS
from orderloom.session import configure, shuffles_freed
from orderloom.sources import infer
from pyspark.sql import functions as F

from conftest import SF_SMALL
from test_staged import _line

FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cleaning_runs_as_methods_that_java_compiles(spark):
    # the steps of staging in one method have more bytes than Java compiles
    configure(spark)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    raw = spark.createDataFrame([_line(1)], RAW_ORDERS)
    assert len(cleaning.stage_orders(raw).collect()) == 1


def test_plain_texts_are_read_by_one_test_as_by_all(spark):
    numbers = ["12", "-3", "0", "-0", "007", "3.7", "-1.50", "12\n", " 12", "1e2", "1_000", "10d", "0x1F", "1.", ".5", "+4", "--1", "-", "", None, "\x01 5",
               "123456789", "1234567890", "2147483648", "-2147483649", "9" * 320, "1.5.2", "٣", "NaN", "Infinity"]
    whole = spark.createDataFrame([(x,) for x in numbers], "s string")
    s, digits = F.col("s"), F.regexp_replace("s", C._DIGIT_GROUPS, "")
    double = F.when(~s.rlike(C._CONTROL_EDGE) & ~s.rlike(C._FLOAT_SUFFIX), digits.try_cast("double"))
    integer = F.when(s.rlike(C._HEX), F.conv(F.substring(F.trim(s), 3, 8), 16, 10).try_cast("int")).otherwise(F.round(double).try_cast("int"))
    for r in whole.select("s", double.alias("a"), C.try_double("s").alias("b"), integer.alias("c"), C.try_integer("s").alias("d")).collect():
        assert (repr(r.a), r.c) == (repr(r.b), r.d), r
    times = ["2024-02-29", "2023-02-29", "2024-01-02 03:04:05", "2024-01-02 24:00:00", "2024-01-02 23:60:00", "2024-01-02 3:4", "2024/01/02 00:00:00",
             "2024-1-2", "2024", "not-a-date", "2024-01-02\n", "2024-01-02 25:00:00", "0000-01-01", "2024-13-01", None]
    want = ["2024-02-29 00:00:00", None, "2024-01-02 03:04:05", "2024-01-03 00:00:00", None, None, "2024-01-02 00:00:00",
            "2024-01-02 00:00:00", None, None, "2024-01-02 00:00:00", None, "0000-01-01 00:00:00", None, None]
    got = spark.createDataFrame([(i, x) for i, x in enumerate(times)], "i int, s string").orderBy("i").select(C.try_timestamp("s").cast("string"))
    found = [r[0] for r in got.collect()]
    assert [(a, b) for a, b in zip(times, found) if a != "2024-01-02 3:4"] == [(a, b) for a, b in zip(times, want) if a != "2024-01-02 3:4"]


def test_keys_that_do_not_agree_are_found_by_hashing(spark):
    rows = [("a", "x", None), ("a", "x", None), ("b", "x", "y"), ("b", "x", None), ("c", None, None), ("d", "p", "q"), ("d", "q", "p"), ("e", "p", "q")]
    keyed = spark.createDataFrame(rows, "k string, n string, m string")
    mixed = star.mixed_keys(keyed, "k", ("n", "m"))
    assert sorted(r.k for r in mixed.collect()) == ["b", "d"]
    assert "SortAggregate" not in _plan(mixed)      # which would sort all lines


def test_the_view_collects_no_attributes_of_keys_that_agree(spark, monkeypatch):
    raw = spark.createDataFrame([_line(n, product_name="p") for n in range(40)] + [_line(90, product_name="p", customer_id="C1", region="west")], RAW_ORDERS)
    written = []
    own = StagedWarehouse._stored
    monkeypatch.setattr(StagedWarehouse, "_stored", lambda self, name, df: written.append(name) or own(self, name, df))
    wh = StagedWarehouse(raw)
    assert sorted(map(repr, wh.stored_sales.collect())) == sorted(map(repr, Warehouse(raw).sales_enriched.collect()))
    # neither attribute table, nor the view, which has no shuffle
    assert sorted(set(written)) == ["mixed", "mixed_keys", "stg_orders"]


def test_shuffles_of_a_written_table_are_freed(spark, monkeypatch):
    raw, seen = spark.createDataFrame([_line(n) for n in range(9)], RAW_ORDERS), []
    own = warehouse._write
    monkeypatch.setattr(warehouse, "_write", lambda df, path: seen.append(spark.conf.get(FREED)) or own(df, path))
    assert StagedWarehouse(raw).sales_enriched.count() == 9
    assert set(seen) == {"true"} and spark.conf.get(FREED) == "false"
    with shuffles_freed(spark):
        assert spark.conf.get(FREED) == "true"


def test_dense_keys_read_ranges_written_as_a_table(spark):
    keyed = with_dense_key(spark.range(100).select((F.col("id") * 7 % 100).alias("x")), "x", "n", num_partitions=5)
    assert keyed.inputFiles() and "Scan ExistingRDD[x" not in _plan(keyed)
    assert sorted((r.x, r.n) for r in keyed.collect()) == [(i, i + 1) for i in range(100)]
    none = with_dense_key(spark.range(0).withColumnRenamed("id", "x"), "x", "n")
    assert {*none.columns} == {"n", "x"} and none.count() == 0


def test_the_feed_of_all_dialects_is_joined_once_and_landed_compressed(spark, monkeypatch):
    from orderloom.plans import registry

    joined, own = [], registry.testmap.raw_orders
    monkeypatch.setattr(registry.testmap, "raw_orders", lambda *a: joined.append(a) or own(*a))
    files = registry.scan_orders_csv_dialects(spark, SF_SMALL).inputFiles()
    assert len(joined) == 1 and files and all(f.endswith(".csv.gz") for f in files)


def test_cart_items_are_landed_compressed_and_their_types_found_once_per_value(spark, tmp_path):
    from orderloom.plans.snapshot_queries import cart_items_csv

    landed = spark.read.text(cart_items_csv(spark, SF_SMALL)).inputFiles()
    assert landed and all(f.endswith(".csv.gz") for f in landed)
    texts = ["1", "-7", "007", "0", "-0", "9" * 18, "9" * 19, "9" * 38, "9" * 39, "1.5", "-0.25", ".5", "1.", "01.5", "1e3", "-1.5E-7", "9" * 400 + ".1", "true", "FALSE",
             "trues", "tab", "F", "-", ".", "", " ", " 12 ", "12\n", "1.5\n", "true\n", "2024-02-29", "2023-02-29", "2024-1-2", "2024-01-02 03:04", "2024-01-02T03:04:05.5Z",
             "2024-01-02 03:04:05+01", "2024-01-02 25:00", "2024-01-02\n", "20240-1-1", "9999-99", "N/A", "٣"]
    values = spark.createDataFrame([(x,) for x in texts], "s string")
    kinds = [infer._reads_as(F.col("s"), k).alias(f"k{i}") for i, k in enumerate(infer.LATTICE)]
    for r in values.select("s", infer._kinds(F.col("s")).alias("bits"), *kinds).collect():
        assert r.bits == sum(1 << i for i in range(len(kinds)) if r[f"k{i}"]), r
    rows = spark.createDataFrame([("1", "a", "2024-01-02", "1", None), ("2.5", "1", "2024-01-02 03:04", None, None)], "a string, b string, c string, d string, e string")
    assert infer.infer_types(rows) == {"a": "double", "b": "string", "c": "timestamp_ntz", "d": "bigint", "e": "string"}


def test_the_export_moves_labels_as_a_number_and_no_amounts(spark, tmp_path):
    from orderloom.plans import registry
    from orderloom.sinks import files as sinks

    raw = spark.createDataFrame([_line(n, customer_segment=["consumer", "?", None][n % 3], region=["north", "", "WEST"][n % 3], unit_price="5.555")
                                 for n in range(30)], RAW_ORDERS)
    wh = StagedWarehouse(raw)
    assert not {"gross_amount", "net_revenue", "region", "customer_segment", "sales_channel"} & {*wh.packed_sales.columns}
    sinks.export_sales_parquet(wh.packed_sales, str(tmp_path / "a"), unpacked=wh.unpacked_sales)
    sinks.export_sales_parquet(wh.sales_enriched, str(tmp_path / "b"))
    a, b = (spark.read.parquet(str(tmp_path / x)) for x in "ab")
    assert a.columns == b.columns and sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())) and a.count() == 30
    given = {}
    own, sinks.export_sales_parquet = sinks.export_sales_parquet, lambda *a, **k: given.update(columns=a[0].columns) or own(*a, **k)
    try:
        registry.export_sales_parquet(spark, SF_SMALL)
    finally:
        sinks.export_sales_parquet = own
    assert "_labels" in given["columns"] and "net_revenue" not in given["columns"]
