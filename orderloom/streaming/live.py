"""Live metrics and newest orders that follow the stream without reading the stored events.

A batch merges its inserted events into the state of the batch before it:

- totals: one row (events, revenue, newest event time, distinct customers);
- recent: events by exact event time, back to 60 seconds before the batch's clock
  or the newest event, whichever is earlier; future events are in it too;
- newest: the 100 newest arrivals;
- the customers seen, as a bucketed ``KeySet``.

Each batch writes its own ``batch_id`` folders and reads those of the last earlier
batch, so a replay gives the same state; older folders than these two are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.streaming.keyset import KeySet, file_system, subfolders
from orderloom.streaming.metrics import PANEL_COLUMNS, clamp_limit

WINDOW = "INTERVAL 60 SECONDS"
NEWEST = 100
TOTALS = "total_events bigint, live_revenue decimal(38,2), last_event_time timestamp, live_customers bigint"
RECENT = "event_time timestamp, n bigint"


class LiveState:
    """The state under ``root``; ``columns``: schema of the stored events."""

    def __init__(self, root: str, columns):
        self.root, self.columns = root.rstrip("/"), columns
        self.customers = KeySet(f"{self.root}/customers")

    def _read(self, spark: SparkSession, name: str, schema, batch_id: int | None) -> DataFrame:
        if batch_id is None:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{self.root}/{name}/batch_id={batch_id}")

    def batches(self, spark: SparkSession) -> list[int]:
        return sorted(int(name.partition("=")[2]) for name in subfolders(spark, f"{self.root}/totals"))

    def update(self, inserted: DataFrame, batch_id: int, now: Column) -> None:
        """Merge the events that a batch inserted; ``inserted`` is read several times (persist it)."""
        spark = inserted.sparkSession
        earlier = [b for b in self.batches(spark) if b < batch_id]
        last = earlier[-1] if earlier else None
        part = f"batch_id={batch_id}"

        customers = inserted.where(F.col("customer_id").isNotNull()).select(F.col("customer_id").alias("key"))
        new_customers = self.customers.unseen(customers, batch_id).persist()
        try:
            own = inserted.agg(F.count(F.lit(1)).alias("total_events"), F.sum("net_revenue").cast("decimal(38,2)").alias("live_revenue"),
                               F.max("event_time").alias("last_event_time"))
            own = own.withColumn("live_customers", F.lit(new_customers.count()).cast("bigint"))
            totals = self._read(spark, "totals", TOTALS, last).unionByName(own).agg(
                F.sum("total_events").alias("total_events"), F.sum("live_revenue").cast("decimal(38,2)").alias("live_revenue"),
                F.max("last_event_time").alias("last_event_time"), F.sum("live_customers").alias("live_customers"))
            self.customers.add(new_customers, batch_id)
        finally:
            new_customers.unpersist()
        newest_time = totals.select("last_event_time").scalar()
        recent = (self._read(spark, "recent", RECENT, last)
                  .unionByName(inserted.groupBy("event_time").agg(F.count(F.lit(1)).alias("n")))
                  .groupBy("event_time").agg(F.sum("n").alias("n"))
                  .where(F.col("event_time") >= F.least(now, newest_time) - F.expr(WINDOW)))
        newest = (self._read(spark, "newest", self.columns, last).unionByName(inserted.select(*self.columns.fieldNames()))
                  .orderBy(F.desc("received_at"), F.desc("event_time"), F.asc("event_id")).limit(NEWEST))
        newest.write.mode("overwrite").parquet(f"{self.root}/newest/{part}")
        recent.write.mode("overwrite").parquet(f"{self.root}/recent/{part}")
        # last: a batch counts as merged once its totals are there
        totals.write.mode("overwrite").parquet(f"{self.root}/totals/{part}")
        for old in earlier[:-1]:
            for name in ("totals", "recent", "newest"):
                fs, path = file_system(spark, f"{self.root}/{name}/batch_id={old}")
                fs.delete(path, True)

    def metrics(self, spark: SparkSession, as_of: Column) -> DataFrame:
        """As ``metrics.live_metrics`` over all events, for an ``as_of`` not before the last batch's clock or the newest event."""
        known = self.batches(spark)
        last = known[-1] if known else None
        recent = self._read(spark, "recent", RECENT, last).where(F.col("event_time") >= as_of - F.expr(WINDOW))
        totals = self._read(spark, "totals", TOTALS, last).agg(
            F.coalesce(F.sum("total_events"), F.lit(0)).alias("total_events"),
            F.coalesce(F.sum("live_revenue"), F.lit(0)).cast("decimal(38,2)").alias("live_revenue"),
            F.max("last_event_time").alias("last_event_time"), F.coalesce(F.sum("live_customers"), F.lit(0)).alias("live_customers"))
        in_window = recent.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
        return totals.select("total_events", "live_revenue", in_window.alias("events_last_60_seconds"), "last_event_time", "live_customers")

    def recent_orders(self, spark: SparkSession, limit: int = 20, panel: bool = False) -> DataFrame:
        """As ``metrics.recent_orders`` over all events, from at most ``NEWEST`` rows."""
        known = self.batches(spark)
        newest = self._read(spark, "newest", self.columns, known[-1] if known else None)
        top = newest.orderBy(F.desc("received_at"), F.desc("event_time"), F.asc("event_id")).limit(clamp_limit(limit))
        return top.select(*(PANEL_COLUMNS if panel else self.columns.fieldNames()))
