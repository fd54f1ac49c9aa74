"""Named queries for the event stream (and snapshot ingestion, see ``snapshot``)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.plans.snapshot_queries import snapshot_queries
from orderloom.schemas import DEAD_LETTER, ORDER_EVENTS
from orderloom.session import configure, scratch_path
from orderloom.sources import testmap
from orderloom.streaming import events as ev
from orderloom.streaming import metrics
from orderloom.streaming.live import LiveState
from orderloom.streaming.sink import run_file_stream


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    payloads = testmap.event_payloads(spark, sf_dir)
    return ev.validate(payloads, "payload")


def _money(c: str):
    return F.col(c).cast("double").alias(c)


def event_validate(spark, sf_dir):
    """Every payload with its verdict and error text."""
    return _checked(spark, sf_dir).select("event_id", "is_valid", "errors")


def event_normalize(spark, sf_dir):
    """R2: normalised text fields of every payload (NULL where it is no JSON)."""
    return _checked(spark, sf_dir).select("event_id", *ev.TEXT_LIMITS)


def event_net_revenue(spark, sf_dir):
    """Exact net revenue of the valid events."""
    return (_checked(spark, sf_dir).filter("is_valid")
            .select("event_id", "quantity", _money("unit_price"), _money("discount_pct"), _money("net_revenue")))


def _ingest(spark: SparkSession, sf_dir: str) -> str:
    """The stored stream of these event files; another ingest if the files change."""
    configure(spark)
    return _ingest_version(spark, sf_dir, testmap.table_version(spark, sf_dir, "events"))


@lru_cache(maxsize=8)
def _ingest_version(spark: SparkSession, sf_dir: str, version: str) -> str:
    """Land the payload files (all events, then a full redelivery) and stream them in."""
    root = scratch_path(spark, "event_stream")
    source = testmap.land_event_files(spark, sf_dir, f"{root}/landing")
    # 4 files per trigger: batch 0 = the first copy of every event (those files
    # are older), batch 1 = the full redelivery, all duplicates of batch 0
    run_file_stream(spark, source, f"{root}/store", f"{root}/_checkpoint", files_per_trigger=4)
    return f"{root}/store"


def _stored(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{_ingest(spark, sf_dir)}/order_events")


def _stored_view(df: DataFrame) -> DataFrame:
    return df.select("event_id", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "order_id",
                     "customer_id", "product_id", "category", "quantity", _money("unit_price"),
                     _money("discount_pct"), "region", "sales_channel", _money("net_revenue"))


def stream_ingest(spark, sf_dir):
    """The stored events after the stream ran (wall-clock column left out)."""
    return _stored_view(_stored(spark, sf_dir))


def stream_insert_status(spark, sf_dir):
    """Inserted vs duplicate verdicts over every valid delivery."""
    status = spark.read.parquet(f"{_ingest(spark, sf_dir)}/insert_status")
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("events"))


def _state_ingest(spark: SparkSession, sf_dir: str) -> str:
    configure(spark)
    return _state_ingest_version(spark, sf_dir, testmap.table_version(spark, sf_dir, "events"))


@lru_cache(maxsize=8)
def _state_ingest_version(spark: SparkSession, sf_dir: str, version: str) -> str:
    """The same deliveries through the state store, with live metrics that follow the stream."""
    root = scratch_path(spark, "event_state_stream")
    source = testmap.land_event_files(spark, sf_dir, f"{root}/landing")
    run_file_stream(spark, source, f"{root}/store", f"{root}/_checkpoint", files_per_trigger=4, dedupe="state", live=True)
    return f"{root}/store"


def stream_delivery_status(spark, sf_dir):
    """The verdict on every valid delivery, decided in the state store; deliveries count by arrival."""
    status = spark.read.parquet(f"{_state_ingest(spark, sf_dir)}/insert_status")
    order = Window.partitionBy("event_id").orderBy("arrival")
    return status.select("event_id", F.row_number().over(order).cast("bigint").alias("delivery"), "status")


def live_metrics_state(spark, sf_dir):
    """R9 from the state that follows the stream, as of the newest event; the stored events are not read."""
    live = LiveState(f"{_state_ingest(spark, sf_dir)}/live", ORDER_EVENTS)
    newest = live.metrics(spark, F.current_timestamp()).first().last_event_time
    out = live.metrics(spark, F.lit(newest))
    return out.select("total_events", _money("live_revenue"), "events_last_60_seconds",
                      F.col("last_event_time").cast("timestamp_ntz").alias("last_event_time"), "live_customers")


def recent_orders_state(spark, sf_dir):
    """R10/R11 from the newest rows that follow the stream."""
    live = LiveState(f"{_state_ingest(spark, sf_dir)}/live", ORDER_EVENTS)
    out = live.recent_orders(spark, limit=10, panel=True)
    return out.select(F.col("event_time").cast("timestamp_ntz").alias("event_time"), "order_id", "category",
                      "quantity", _money("net_revenue"), "region", "sales_channel")


def stream_dead_letters(spark, sf_dir):
    """Dead-letter records (failure time left out)."""
    dead = spark.read.schema(DEAD_LETTER).json(f"{_ingest(spark, sf_dir)}/dead_letters")
    return dead.select("error", "payload")


def events_by_minute(spark, sf_dir):
    """R8 (view form) over the stored events."""
    out = metrics.events_by_minute(_stored(spark, sf_dir))
    return out.select(F.col("event_minute").cast("timestamp_ntz").alias("event_minute"), "event_count",
                      _money("revenue"))


def stream_minute_windows(spark, sf_dir):
    """R8 (streaming form): one-minute windows kept by a streaming aggregation."""
    configure(spark)
    root = scratch_path(spark, "minute_windows")
    source = testmap.land_event_files(spark, sf_dir, f"{root}/landing")
    metrics.minute_windows_stream(spark, source, f"{root}/out", f"{root}/_checkpoint", files_per_trigger=2)
    out = metrics.read_minute_windows(spark, f"{root}/out")
    return out.select(F.col("event_minute").cast("timestamp_ntz").alias("event_minute"), "event_count",
                      _money("revenue"))


def live_metrics(spark, sf_dir):
    """R9 with ``as_of`` = the newest stored event time."""
    stored = _stored(spark, sf_dir)
    as_of = stored.agg(F.max("event_time")).scalar()
    out = metrics.live_metrics(stored, as_of)
    return out.select("total_events", _money("live_revenue"), "events_last_60_seconds",
                      F.col("last_event_time").cast("timestamp_ntz").alias("last_event_time"), "live_customers")


def recent_orders(spark, sf_dir):
    """The ten newest arrivals, panel columns."""
    out = metrics.recent_orders(_stored(spark, sf_dir), limit=10, panel=True)
    return out.select(F.col("event_time").cast("timestamp_ntz").alias("event_time"), "order_id", "category",
                      "quantity", _money("net_revenue"), "region", "sales_channel")


def more_queries() -> dict:
    return snapshot_queries() | {
        "event_validate": event_validate,
        "event_normalize": event_normalize,
        "event_net_revenue": event_net_revenue,
        "stream_ingest": stream_ingest,
        "stream_insert_status": stream_insert_status,
        "stream_delivery_status": stream_delivery_status,
        "live_metrics_state": live_metrics_state,
        "recent_orders_state": recent_orders_state,
        "stream_dead_letters": stream_dead_letters,
        "events_by_minute": events_by_minute,
        "stream_minute_windows": stream_minute_windows,
        "live_metrics": live_metrics,
        "recent_orders": recent_orders,
    }
