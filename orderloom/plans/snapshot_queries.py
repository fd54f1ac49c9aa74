"""Named queries for snapshot ingestion (nested JSON -> cart items)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import SparkSession

from orderloom.operators import snapshot
from orderloom.session import configure, scratch_path
from orderloom.sinks import files as sinks
from orderloom.sources import files as sources
from orderloom.sources import testmap


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """The landed documents of these files; landed anew if a table changes."""
    configure(spark)
    versions = tuple(testmap.table_version(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    return _landed_version(spark, sf_dir, versions)


@lru_cache(maxsize=8)
def _landed_version(spark: SparkSession, sf_dir: str, versions: tuple[str, ...]) -> str:
    return testmap.land_snapshots(spark, sf_dir, scratch_path(spark, "snapshots"))


def snapshot_flatten(spark, sf_dir):
    """S5 + E1..E3: read landed documents, flatten and enrich."""
    return snapshot.flatten(sources.read_snapshots(spark, _landed(spark, sf_dir)))


def cart_items_csv(spark, sf_dir) -> str:
    """A fresh CSV of the flattened items."""
    path = scratch_path(spark, "cart_items_csv")
    sinks.export_result_csv(snapshot_flatten(spark, sf_dir), path, gzip=True)
    return path


def scan_cart_items_csv(spark, sf_dir):
    """K7 + S2: flattened items written as header CSV and read back typed."""
    return sources.read_cart_items_csv(spark, cart_items_csv(spark, sf_dir))


def snapshot_metadata(spark, sf_dir):
    """Per snapshot - products, carts, flattened items, rows loaded back from CSV."""
    docs = sources.read_snapshots(spark, _landed(spark, sf_dir))
    flat = snapshot.flatten(docs)
    loaded = sources.read_cart_items_csv(spark, cart_items_csv(spark, sf_dir))
    return snapshot.ingestion_metadata(docs, flat, loaded)


def snapshot_queries() -> dict:
    return {
        "snapshot_flatten": snapshot_flatten,
        "scan_cart_items_csv": scan_cart_items_csv,
        "snapshot_metadata": snapshot_metadata,
    }
