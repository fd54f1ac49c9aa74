"""Snapshot ingestion: flatten nested product / cart documents into cart items.

A snapshot document is ``{observed_at_utc, products: {products: [...]},
carts: {carts: [{id, userId, products: [items]}]}}``. Each document is
enriched with its own product list, as one API pull is: the product map is
keyed by (observed_at_utc, product id) and the last duplicate in a document's
list wins.

Documents are rows (NDJSON, one document per line), so many snapshots read
in parallel; a single pretty-printed document can be read with multiLine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fallback label for a product missing from the snapshot.
UNKNOWN = "unknown"


def product_lookup(docs: DataFrame) -> DataFrame:
    """(observed_at_utc, id) -> title, category, brand; the last listing wins.

    ``posexplode`` keeps each product's position in its list, and
    ``max_by(…, pos)`` picks the last one per id (combined map-side).
    """
    listed = docs.select("observed_at_utc", F.posexplode("products.products").alias("pos", "p"))
    return (listed.groupBy("observed_at_utc", F.col("p.id").alias("id"))
                  .agg(F.max_by("p", "pos").alias("p"))
                  .select("observed_at_utc", "id", F.col("p.title").alias("title"),
                          F.col("p.category").alias("category"), F.col("p.brand").alias("brand")))


def cart_items(docs: DataFrame) -> DataFrame:
    """One row per (cart, item) - the nested loop as two explodes."""
    carts = docs.select("observed_at_utc", F.explode("carts.carts").alias("cart"))
    return carts.select("observed_at_utc", F.col("cart.id").alias("cart_id"),
                        F.col("cart.userId").alias("user_id"), F.explode("cart.products").alias("item"))


def flatten(docs: DataFrame) -> DataFrame:
    """E2 + E3: flattened, enriched cart items (12 columns).

    The item's own title wins, else the product's; category and brand fall
    back to 'unknown'; discountedTotal falls back to discountedPrice. Only an
    absent key falls back: an explicit null is a value and stays null.
    """
    items = cart_items(docs)
    products = product_lookup(docs)
    joined = items.join(products, (items.observed_at_utc == products.observed_at_utc)
                        & (F.col("item.id") == products.id), "left")
    return joined.select(
        items.observed_at_utc,
        "cart_id", "user_id",
        F.col("item.id").alias("product_id"),
        _given(F.col("item.title"), "string", _given(products.title, "string")).alias("product_title"),
        _given(products.category, "string", F.lit(UNKNOWN)).alias("category"),
        _given(products.brand, "string", F.lit(UNKNOWN)).alias("brand"),
        F.col("item.quantity").alias("quantity"),
        F.col("item.price").alias("unit_price"),
        F.col("item.discountPercentage").alias("discount_pct"),
        F.col("item.total").alias("line_total"),
        _given(F.col("item.discountedTotal"), "double", _given(F.col("item.discountedPrice"), "double")).alias("discounted_total"),
    )


def _given(value: Column, kind: str, absent: Column | None = None) -> Column:
    """A variant field as ``kind``; ``absent`` where the key is not there. Null, or no ``kind``, is NULL."""
    return F.when(value.isNotNull(), F.try_variant_get(value, "$", kind)).otherwise(F.lit(None) if absent is None else absent)


def ingestion_metadata(docs: DataFrame, flat: DataFrame, loaded: DataFrame) -> DataFrame:
    """Per snapshot - distinct products, carts, flattened items, rows loaded back."""
    per_doc = docs.select(
        "observed_at_utc",
        F.size(F.array_distinct(F.col("products.products.id"))).alias("products"),
        F.size("carts.carts").alias("carts"),
    ).groupBy("observed_at_utc").agg(F.sum("products").cast("bigint").alias("products"),
                                     F.sum("carts").cast("bigint").alias("carts"))
    flat_n = flat.groupBy("observed_at_utc").agg(F.count(F.lit(1)).alias("flattened_cart_items"))
    loaded_n = loaded.groupBy("observed_at_utc").agg(F.count(F.lit(1)).alias("loaded_rows"))
    return (per_doc.join(flat_n, "observed_at_utc", "left")
                   .join(loaded_n, "observed_at_utc", "left")
                   .select("observed_at_utc", "products", "carts",
                           F.coalesce("flattened_cart_items", F.lit(0)).alias("flattened_cart_items"),
                           F.coalesce("loaded_rows", F.lit(0)).alias("loaded_rows")))
