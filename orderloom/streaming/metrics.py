"""Live views over the stored order events: per minute, live metrics, recent orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.streaming.events import validate, with_arrival


def events_by_minute(events: DataFrame) -> DataFrame:
    """event_minute, event_count, revenue (late events simply update their minute)."""
    return (events.groupBy(F.date_trunc("minute", "event_time").alias("event_minute"))
                  .agg(F.count(F.lit(1)).alias("event_count"),
                       F.sum("net_revenue").cast("decimal(38,2)").alias("revenue")))


def live_metrics(events: DataFrame, as_of: Column) -> DataFrame:
    """Totals, revenue, events in the 60 s before ``as_of`` (no upper bound), last time, customers."""
    window_start = as_of - F.expr("INTERVAL 60 SECONDS")
    return events.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.coalesce(F.sum("net_revenue"), F.lit(0)).cast("decimal(38,2)").alias("live_revenue"),
        F.count_if(F.col("event_time") >= window_start).alias("events_last_60_seconds"),
        F.max("event_time").alias("last_event_time"),
        F.count_distinct("customer_id").alias("live_customers"),
    )


def clamp_limit(limit: int) -> int:
    return min(max(int(limit), 1), 100)


# The columns the live panel shows.
PANEL_COLUMNS = ["event_time", "order_id", "category", "quantity", "net_revenue", "region", "sales_channel"]


def recent_orders(events: DataFrame, limit: int = 20, panel: bool = False) -> DataFrame:
    """Newest events by arrival; a distributed top-k (no global sort).

    Ties inside one batch (same ``received_at``) are broken by event time,
    then id, so the answer is deterministic.
    """
    n = clamp_limit(limit)
    top = events.orderBy(F.desc("received_at"), F.desc("event_time"), F.asc("event_id")).limit(n)
    cols = PANEL_COLUMNS if panel else [c for c in events.columns if c != "batch_id"]
    return top.select(*cols)


def minute_windows_stream(spark: SparkSession, source_dir: str, out_path: str, checkpoint: str,
                          files_per_trigger: int = 1) -> None:
    """Per-minute counts maintained by a streaming aggregation.

    Valid events, first copy per id (state keyed by id), one-minute tumbling
    windows. Update mode: a batch writes the minutes it changed into its own
    ``batch_id`` folder, so a reader never meets a half-written table and a replayed
    batch overwrites its own folder only (``read_minute_windows`` takes the newest row of each
    minute). No watermark: like the reference's view, a late event still updates its minute.
    """
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(source_dir)
    valid = (validate(with_arrival(stream), "payload")
             .filter(F.col("is_valid"))
             .dropDuplicates(["event_id"]))
    counts = (valid.groupBy(F.window("event_time", "1 minute").alias("w"))
                   .agg(F.count(F.lit(1)).alias("event_count"),
                        F.sum("net_revenue").alias("revenue")))

    def write_changed(df: DataFrame, batch_id: int) -> None:
        (df.select(F.col("w.start").alias("event_minute"), "event_count",
                   F.col("revenue").cast("decimal(38,2)").alias("revenue"))
           .write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}"))

    query = (counts.writeStream.outputMode("update")
                   .foreachBatch(write_changed)
                   .option("checkpointLocation", checkpoint)
                   .trigger(availableNow=True)
                   .start())
    query.awaitTermination()


MINUTE_WINDOWS = "event_minute timestamp, event_count bigint, revenue decimal(38,2), batch_id bigint"


def read_minute_windows(spark: SparkSession, out_path: str) -> DataFrame:
    """The state of every minute: its row from the newest batch that changed it."""
    rows = spark.read.schema(MINUTE_WINDOWS).parquet(out_path)
    newest = rows.groupBy("event_minute").agg(F.max_by(F.struct("event_count", "revenue"), "batch_id").alias("w"))
    return newest.select("event_minute", "w.event_count", "w.revenue")
