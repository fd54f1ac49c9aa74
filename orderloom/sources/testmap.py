"""Map the driver's TPC-H-like tables onto the raw orders feed.

The reference reads one dirty orders CSV. The test tables are a clean star
schema, so this module derives a 16-column all-text ``raw_orders`` frame from
``lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ region ⋈ part`` and injects the
reference's defect kinds deterministically (blank / NULL ids, bad dates,
out-of-range numbers, messy labels, duplicate line ids). The same mapping is
written in SQL for the DuckDB oracle (``orderloom.plans.oracle``).

Three numeric tie-break columns ride along (``tb_*``): together with the line
id they are unique, so the de-duplication survivor is well defined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import shuffles_freed

TIE_BREAK = ["tb_partkey", "tb_suppkey", "tb_price"]

# Defect / label mapping from driver columns to raw text.
SEGMENT_TEXT = {"AUTOMOBILE": " consumer", "BUILDING": "Consumer", "FURNITURE": "CORPORATE",
                "HOUSEHOLD": "Small Business "}
REGION_TEXT = {"AFRICA": " north ", "AMERICA": "South", "ASIA": "EAST", "EUROPE": "west"}
REGION_OTHER = "Central"
CHANNEL_TEXT = {"1": "Web", "2": "WEB", "3": "mobile app", "4": " Marketplace "}
CHANNEL_OTHER = "phone"
STATUS_TEXT = dict(enumerate(["returned", "DELIVERED", "Shipped", " cancelled "]))
PAYMENT_TEXT = ["UPI", "Card", "Wallet", "Cash on Delivery"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _padded(c, width: int):
    return F.lpad(F.col(c).cast("string"), width, "0")


def _code(c, keys) -> Column:
    """The place of ``c`` among ``keys``; null for any other value."""
    code = None
    for n, key in enumerate(keys):
        code = F.when(c == F.lit(key), F.lit(n)) if code is None else code.when(c == F.lit(key), F.lit(n))
    return code


def _text(code: str, mapping: dict, default) -> Column:
    """The text of the key at that place; ``default`` if there is none."""
    return _lookup(code, dict(enumerate(mapping.values())), default)


def _lookup(c, mapping: dict, default):
    expr = None
    for key, text in mapping.items():
        hit = F.col(c) == F.lit(key) if isinstance(c, str) else c == F.lit(key)
        expr = F.when(hit, F.lit(text)) if expr is None else expr.when(hit, F.lit(text))
    return expr.otherwise(default)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")

    # nation and region are tiny files: the planner broadcasts them on its
    # own size check; lineitem/orders/part/customer joins are left to it.
    # The customer is joined to the orders, so that the lines are shuffled for orders and part only.
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    # Labels cross the shuffles as the place of their text; a segment without one as itself.
    segment = F.col("c_mktsegment")
    placed = (orders.join(customer, F.col("o_custkey") == customer.c_custkey)
                    .join(geo, F.col("c_nationkey") == geo.n_nationkey)
                    .select("o_orderkey", "o_custkey", "o_orderdate",
                            _code(F.substring("o_orderpriority", 1, 1), CHANNEL_TEXT).alias("channel"),
                            _code(F.col("r_name"), REGION_TEXT).alias("region"), _code(segment, SEGMENT_TEXT).alias("segment"),
                            F.when(_code(segment, SEGMENT_TEXT).isNull(), segment).alias("other_segment")))
    status = (F.when(F.col("l_returnflag") == "R", F.lit(0)).when(F.col("l_returnflag") == "A", F.lit(1))
               .when(F.col("l_linestatus") == "O", F.lit(2)).otherwise(F.lit(3)))
    li = li.withColumn("status", status).drop("l_shipdate", "l_returnflag", "l_linestatus")
    joined = (li.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
                .join(part, F.col("l_partkey") == part.p_partkey))

    okey = _padded("l_orderkey", 9)
    cust_sel = (F.col("l_orderkey") + F.col("l_partkey")) % 500
    return joined.select(
        F.concat(F.lit("L"), okey, F.lit("-"), F.col("l_linenumber").cast("string")).alias("line_id"),
        F.concat(F.lit("O"), okey).alias("order_id"),
        F.when(F.col("l_orderkey") % 211 == 0, F.lit("not-a-date"))
         .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("order_date"),
        F.when(cust_sel == 0, F.lit(None).cast("string"))
         .when(cust_sel == 1, F.lit("  "))
         .otherwise(F.concat(F.lit("C"), _padded("o_custkey", 7))).alias("customer_id"),
        _text("segment", SEGMENT_TEXT, F.col("other_segment")).alias("customer_segment"),
        _text("region", REGION_TEXT, F.lit(REGION_OTHER)).alias("region"),
        _text("channel", CHANNEL_TEXT, F.lit(CHANNEL_OTHER)).alias("sales_channel"),
        F.concat(F.lit("P"), _padded("l_partkey", 7)).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lower("p_type"))
         .otherwise(F.concat(F.lit(" "), F.col("p_type"), F.lit(" "))).alias("category"),
        F.when(F.col("l_suppkey") % 97 == 0, F.lit("-3"))
         .otherwise((F.round("l_quantity").cast("bigint") % 22 + 1).cast("string")).alias("quantity"),
        F.when((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 650 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string")).alias("unit_price"),
        F.when((F.col("l_orderkey") + F.col("l_suppkey")) % 1000 == 0, F.lit("140"))
         .otherwise(F.round(F.col("l_discount") * 100).cast("bigint").cast("string")).alias("discount_pct"),
        _lookup(F.round(F.col("l_tax") * 100).cast("bigint") % 4,
                {0: PAYMENT_TEXT[0], 1: PAYMENT_TEXT[1], 2: PAYMENT_TEXT[2]},
                F.lit(PAYMENT_TEXT[3])).alias("payment_method"),
        _text("status", STATUS_TEXT, None).alias("order_status"),
        (F.col("l_suppkey") % 11).cast("string").alias("shipping_days"),
        F.col("l_partkey").alias("tb_partkey"),
        F.col("l_suppkey").alias("tb_suppkey"),
        F.col("l_extendedprice").alias("tb_price"),
    )


# Labels given to the driver's events when they become order events.
EVENT_CATEGORIES = ["Electronics", "Home", "Fashion", "Beauty", "Sports", "Books"]
EVENT_REGIONS = ["North", "South", "East", "West", "Central"]


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON order-event payload per row of ``events``.

    event_id -> UUID-shaped id, ts -> event_time (UTC), user_id -> customer,
    props.k -> quantity (0 occurs and must be refused), value -> unit price,
    event_type -> sales channel with doubled inner spaces (normalised away),
    every third region padded with spaces, no discount field when
    event_id % 5 = 0 (the model's default 0 applies), and the 'error' events
    with event_id % 50 = 0 sent as truncated JSON (dead letters).
    """
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    region = F.element_at(F.array(*[F.lit(r) for r in EVENT_REGIONS]), (eid % 5 + 1).cast("int"))
    fields = F.struct(
        F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(eid.cast("string"), 12, "0")).alias("event_id"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z")).alias("event_time"),
        F.concat(F.lit("EV-"), eid.cast("string")).alias("order_id"),
        F.concat(F.lit("C"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("customer_id"),
        F.concat(F.lit("P"), F.lpad((eid % 48 + 1).cast("string"), 3, "0")).alias("product_id"),
        F.element_at(F.array(*[F.lit(c) for c in EVENT_CATEGORIES]),
                     (F.col("user_id") % 6 + 1).cast("int")).alias("category"),
        F.get_json_object("props", "$.k").cast("int").alias("quantity"),
        F.col("value").alias("unit_price"),
        F.when(eid % 5 != 0, ((eid % 5) * 5).cast("decimal(3,0)") / F.lit(100).cast("decimal(3,0)"))
         .cast("decimal(3,2)").alias("discount_pct"),
        F.when(eid % 3 == 0, F.concat(F.lit("  "), region, F.lit(" "))).otherwise(region).alias("region"),
        F.concat(F.col("event_type"), F.lit("  app")).alias("sales_channel"),
    )
    broken = (F.col("event_type") == "error") & (eid % 50 == 0)
    payload = F.when(broken, F.concat(F.lit('{"broken": '), eid.cast("string"))).otherwise(F.to_json(fields))
    return ev.select(eid.alias("source_event_id"), payload.alias("payload"))


def land_event_files(spark: SparkSession, sf_dir: str, root: str, files: int = 4) -> str:
    """Write every payload as NDJSON in ``files`` files, then all of them again.

    The second copy is a full redelivery (at-least-once), so every valid
    event arrives twice and must be stored once. Returns the glob to stream.
    """
    payloads = event_payloads(spark, sf_dir)
    for copy in ("a-first", "b-replay"):
        (payloads.repartitionByRange(files, "source_event_id").select("payload")
                 .write.mode("overwrite").text(f"{root}/{copy}"))
    return f"{root}/*"


# Orders per snapshot document: keeps every nested list bounded (carts per
# document by this, items per cart by the 7-line TPC-H order limit).
SNAPSHOT_ORDERS_PER_DOC = 500


def snapshot_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested snapshot documents built from orders, lineitem and part.

    Document d holds the orders with o_orderkey div 500 = d as carts (items =
    their lines) and, as products, the parts its items use except those with
    p_partkey % 7 = 0 (absent -> 'unknown' fallbacks); parts with
    p_partkey % 5 = 0 are listed twice, a stale brand first, so the last
    listing must win. Items with l_linenumber % 3 = 0 carry no title (the
    product's title applies); odd lines give discountedPrice instead of
    discountedTotal. Explicit nulls: the given title of parts with p_partkey % 11 = 0,
    the given discountedTotal with % 13 = 0, a product's category with % 17 = 0 and
    brand with % 19 = 0.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                                                 "l_discount")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_retailprice")
    doc = (F.col("l_orderkey") / SNAPSHOT_ORDERS_PER_DOC).cast("bigint")
    lines = (li.join(orders, li.l_orderkey == orders.o_orderkey)
               .join(part, li.l_partkey == part.p_partkey)
               .withColumn("doc", doc))
    total = F.col("p_retailprice") * F.col("l_quantity")
    item = F.struct(
        F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("id"),
        F.when(F.col("l_linenumber") % 3 != 0, F.col("p_name")).alias("title"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("p_retailprice").alias("price"),
        (F.col("l_discount") * 100).alias("discountPercentage"),
        total.alias("total"),
        F.when(F.col("l_linenumber") % 2 == 0, total * (F.lit(1) - F.col("l_discount"))).alias("discountedTotal"),
        F.when(F.col("l_linenumber") % 2 != 0, total * (F.lit(1) - F.col("l_discount"))).alias("discountedPrice"),
    )
    # one shuffle by document serves carts, documents and their join with the products
    carts = (lines.repartition("doc").groupBy("doc", "l_orderkey", "o_custkey")
                  .agg(F.sort_array(F.collect_list(item)).alias("items"))
                  .select("doc", F.struct(F.col("l_orderkey").alias("id"), F.col("o_custkey").alias("userId"),
                                          F.col("items").alias("products"))
                          .alias("cart"))
                  .groupBy("doc").agg(F.sort_array(F.collect_list("cart")).alias("carts")))
    listed = lines.filter(F.col("p_partkey") % 7 != 0).select("doc", "p_partkey", "p_name", "p_type", "p_brand") \
                  .repartition("doc").distinct()
    entry = lambda seq, brand: F.struct(F.col("p_partkey").alias("id"), F.lit(seq).alias("seq"),
                                        F.col("p_name").alias("title"), F.lower("p_type").alias("category"),
                                        brand.alias("brand"))
    stale = entry(0, F.concat(F.lit("OLD-"), F.col("p_brand")))
    current = entry(1, F.col("p_brand"))
    entries = F.when(F.col("p_partkey") % 5 == 0, F.array(stale, current)).otherwise(F.array(current))
    products = (listed.select("doc", F.explode(entries).alias("p")).groupBy("doc")
                     .agg(F.sort_array(F.collect_list("p")).alias("ps"))
                     .select("doc", F.transform("ps", _product).alias("products")))
    observed = F.date_format(F.timestamp_seconds(F.lit(1767225600) + F.col("doc") * 3600), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return (carts.join(products, "doc", "left")
                 .select(observed.alias("observed_at_utc"),
                         F.struct(F.coalesce("products", F.array().cast("array<struct<id:bigint,title:variant,"
                                                                       "category:variant,brand:variant>>"))
                                  .alias("products")).alias("products"),
                         F.struct(F.transform("carts", _cart).alias("carts")).alias("carts")))


def _field(value: Column, null_every: int, part: Column) -> Column:
    """A JSON field: absent where ``value`` is null, an explicit null for every ``null_every``-th part."""
    null = F.parse_json(F.lit("null"))
    return F.when(value.isNotNull() & (part % null_every == 0), null).otherwise(value.cast("variant"))


def _item(i: Column) -> Column:
    return F.struct(i["id"].alias("id"), _field(i["title"], 11, i["id"]).alias("title"), i["quantity"].alias("quantity"),
                    i["price"].alias("price"), i["discountPercentage"].alias("discountPercentage"), i["total"].alias("total"),
                    _field(i["discountedTotal"], 13, i["id"]).alias("discountedTotal"), i["discountedPrice"].cast("variant").alias("discountedPrice"))


def _cart(c: Column) -> Column:
    return F.struct(c["id"].alias("id"), c["userId"].alias("userId"), F.transform(c["products"], _item).alias("products"))


def _product(p: Column) -> Column:
    return F.struct(p["id"].alias("id"), p["title"].cast("variant").alias("title"), _field(p["category"], 17, p["id"]).alias("category"),
                    _field(p["brand"], 19, p["id"]).alias("brand"))


def land_snapshots(spark: SparkSession, sf_dir: str, path: str) -> str:
    """Write the snapshot documents as gzipped NDJSON (one document per line)."""
    with shuffles_freed(spark):
        snapshot_documents(spark, sf_dir).write.mode("overwrite").option("compression", "gzip").json(path)
    return path


def table_version(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Changes whenever a file of the table does (path, size, time; one row per file is summed)."""
    files = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(
        "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    n, total = files.agg(F.count("*"), F.sum(F.xxhash64(*files.columns).cast("decimal(38,0)"))).first()
    return f"{n}:{total}"
