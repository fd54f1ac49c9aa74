"""Declared schemas (no inference on the hot path)."""

from pyspark.sql import types as T

# The raw orders CSV header, in file order.
RAW_ORDER_COLUMNS = [
    "line_id", "order_id", "order_date", "customer_id", "customer_segment",
    "region", "sales_channel", "product_id", "product_name", "category",
    "quantity", "unit_price", "discount_pct", "payment_method", "order_status",
    "shipping_days",
]

# Landing schema: every field is text, types are applied while staging.
RAW_ORDERS = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_ORDER_COLUMNS])

STG_ORDERS = T.StructType([
    T.StructField("line_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_segment", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("sales_channel", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("discount_pct", T.DoubleType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("shipping_days", T.IntegerType()),
])

FACT_COLUMNS = [
    "line_id", "order_id", "date_key", "order_date", "customer_key", "product_key",
    "sales_channel", "quantity", "unit_price", "discount_pct", "gross_amount",
    "net_revenue", "payment_method", "order_status", "shipping_days",
]

ENRICHED_COLUMNS = [
    "order_date", "order_id", "line_id", "customer_id", "customer_segment", "region",
    "sales_channel", "product_id", "product_name", "category", "quantity", "unit_price",
    "discount_pct", "gross_amount", "net_revenue", "payment_method", "order_status",
    "shipping_days",
]

# Flattened snapshot cart item (12 columns, in output order).
CART_ITEMS = T.StructType([
    T.StructField("observed_at_utc", T.StringType()),
    T.StructField("cart_id", T.LongType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("product_title", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("unit_price", T.DoubleType()),
    T.StructField("discount_pct", T.DoubleType()),
    T.StructField("line_total", T.DoubleType()),
    T.StructField("discounted_total", T.DoubleType()),
])

# Variant fields tell an explicit null (a null variant) from an absent key (NULL).
_SNAPSHOT_PRODUCT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.VariantType()),
    T.StructField("category", T.VariantType()),
    T.StructField("brand", T.VariantType()),
])

_SNAPSHOT_ITEM = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.VariantType()),
    T.StructField("quantity", T.LongType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("discountPercentage", T.DoubleType()),
    T.StructField("total", T.DoubleType()),
    T.StructField("discountedTotal", T.VariantType()),
    T.StructField("discountedPrice", T.VariantType()),
])

_SNAPSHOT_CART = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("userId", T.LongType()),
    T.StructField("products", T.ArrayType(_SNAPSHOT_ITEM)),
])

# One landed API snapshot document.
SNAPSHOT = T.StructType([
    T.StructField("observed_at_utc", T.StringType()),
    T.StructField("products", T.StructType([T.StructField("products", T.ArrayType(_SNAPSHOT_PRODUCT))])),
    T.StructField("carts", T.StructType([T.StructField("carts", T.ArrayType(_SNAPSHOT_CART))])),
])

# Order event as it arrives: every field read as text, then validated.
EVENT_FIELDS = [
    "event_id", "event_time", "order_id", "customer_id", "product_id", "category",
    "quantity", "unit_price", "discount_pct", "region", "sales_channel",
]
EVENT_TEXT = T.StructType([T.StructField(c, T.StringType(), True) for c in EVENT_FIELDS]
                          + [T.StructField("_corrupt_record", T.StringType(), True)])

# Stored order event (the table the idempotent sink maintains).
ORDER_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("event_time", T.TimestampType(), False),
    T.StructField("order_id", T.StringType(), False),
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("product_id", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("unit_price", T.DecimalType(12, 2), False),
    T.StructField("discount_pct", T.DecimalType(5, 4), False),
    T.StructField("region", T.StringType(), False),
    T.StructField("sales_channel", T.StringType(), False),
    T.StructField("net_revenue", T.DecimalType(14, 2), False),
    T.StructField("received_at", T.TimestampType(), False),
])

DEAD_LETTER = T.StructType([
    T.StructField("failed_at", T.StringType()),
    T.StructField("error", T.StringType()),
    T.StructField("payload", T.StringType()),
])
