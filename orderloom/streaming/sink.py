"""Idempotent order-event sink and dead letters, as a ``foreachBatch`` function.

Per micro-batch (the analogue of the reference's 25-event / 2-second flush):

1. validate every payload; invalid ones go to the dead-letter folder;
2. first write wins inside the batch: one survivor per event id, smallest
   arrival order (a map-side-combined aggregate, so a flood of copies of one
   id does not pile up in one task);
3. first write wins across batches: survivors whose id is already stored by
   an *earlier* batch are dropped (anti join with the buckets of stored ids that
   the batch's ids fall into, see ``keyset``);
4. the batch writes its rows, dead letters and per-event statuses into its own
   ``batch_id=<n>`` folders in overwrite mode.

Step 3 has another form, ``dedupe="state"``: the streaming state store decides
(``firstwrite``), and the batch arrives with the ids that no earlier batch brought.

If Spark replays a batch after a failure between the write and the commit,
step 3 ignores the batch's own folder and step 4 overwrites it, so the stored
table ends up the same: effectively once, like ack-after-commit with a
primary key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.cleaning import dedupe_by_key
from orderloom.operators.joins import bounded_broadcast
from orderloom.schemas import ORDER_EVENTS
from orderloom.streaming.events import EVENT_COLUMNS, validate, with_arrival
from orderloom.streaming.firstwrite import DUPLICATE, INSERTED, NEW_ID, with_new_ids
from orderloom.streaming.keyset import KeySet
from orderloom.streaming.live import LiveState

# A micro-batch is bounded by the trigger (maxFilesPerTrigger /
# maxOffsetsPerTrigger); its ids are broadcast only below this proven count.
BATCH_BROADCAST_ROWS = 5_000_000


class OrderEventSink:
    """``writeStream.foreachBatch(OrderEventSink(root))``.

    ``root`` gets three tables partitioned by ``batch_id``: ``order_events``
    (the stored events), ``dead_letters`` and ``insert_status``.
    ``clock`` gives ``received_at`` (default: the batch's current time).
    """

    def __init__(self, root: str, clock=None, live: bool = False):
        self.root = root.rstrip("/")
        self.clock = clock
        self.ids = KeySet(f"{self.root}/event_ids")
        #: metrics and newest orders that follow the stream
        self.live = LiveState(f"{self.root}/live", ORDER_EVENTS) if live else None

    @property
    def events_path(self) -> str:
        return f"{self.root}/order_events"

    @property
    def dead_letter_path(self) -> str:
        return f"{self.root}/dead_letters"

    @property
    def status_path(self) -> str:
        return f"{self.root}/insert_status"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        now = F.lit(self.clock(batch_id)) if self.clock else F.current_timestamp()
        # position inside the batch as the last tie-break: identical copies in
        # one file still get one winner (the batch is persisted, so it is stable)
        batch = batch.withColumn("arrival", F.struct(F.col("arrival").alias("a"),
                                                     F.monotonically_increasing_id().alias("seq")))
        checked = validate(batch, "payload", now=now).withColumn("received_at", now.cast("timestamp"))
        # what is kept: the fields of an event, or the text of an invalid one
        checked = checked.withColumn("payload", F.when(~F.col("is_valid"), F.col("payload")))
        checked = checked.select(*[c for c in (*EVENT_COLUMNS, "received_at", "arrival", "is_valid", "errors", "payload", NEW_ID)
                                   if c in checked.columns]).persist()
        try:
            self._write_batch(checked, batch_id, now)
        finally:
            checked.unpersist()

    def _write_batch(self, checked: DataFrame, batch_id: int, now) -> None:
        part = f"batch_id={batch_id}"
        new_ids = None
        if NEW_ID in checked.columns:
            new_ids = checked.filter(F.col(NEW_ID).isNotNull()).select(F.col(NEW_ID).alias("event_id"))
            checked = checked.filter(F.col(NEW_ID).isNull())
        (checked.filter(~F.col("is_valid"))
                .select(F.date_format("received_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("failed_at"),
                        F.col("errors").alias("error"), F.col("payload"))
                .write.mode("overwrite").json(f"{self.dead_letter_path}/{part}"))

        valid = checked.filter(F.col("is_valid"))
        found = valid.select(*EVENT_COLUMNS, "received_at", "arrival")
        if new_ids is not None:
            # of copies that arrive at one place (the same line twice in a file) the last is the inserted one
            place = F.struct(F.col("arrival.a"), -F.col("arrival.seq"))
            winners = dedupe_by_key(found.withColumn("place", place), "event_id", ["place"]).drop("place")
            winners = winners.join(new_ids, "event_id", "left_semi")
        else:
            winners = dedupe_by_key(found, "event_id", ["arrival"])
            keys = bounded_broadcast(winners.select(F.col("event_id").alias("key")), BATCH_BROADCAST_ROWS)
            earlier = self.ids.seen(keys, batch_id)
            if earlier is not None:
                already = earlier.join(keys, "key", "left_semi").withColumnRenamed("key", "event_id")
                winners = winners.join(already, "event_id", "left_anti")
        winners = winners.select(*EVENT_COLUMNS, "received_at", "arrival").persist()
        try:
            stored = winners.drop("arrival")
            stored.write.mode("overwrite").parquet(f"{self.events_path}/{part}")
            if new_ids is None:
                self.ids.add(winners.select(F.col("event_id").alias("key")), batch_id)
            first = winners.select("event_id", "arrival", F.lit(INSERTED).alias("status"))
            status = (valid.select("event_id", "arrival").join(first, ["event_id", "arrival"], "left")
                           .select("event_id", "arrival", F.coalesce("status", F.lit(DUPLICATE)).alias("status")))
            status.write.mode("overwrite").parquet(f"{self.status_path}/{part}")
            if self.live:
                self.live.update(stored, batch_id, now)
        finally:
            winners.unpersist()


def run_file_stream(spark: SparkSession, source_dir: str, root: str, checkpoint: str,
                    files_per_trigger: int = 1, clock=None, dedupe: str = "history", live: bool = False) -> OrderEventSink:
    """Ingest every NDJSON file under ``source_dir`` (available-now trigger).

    ``dedupe``: "history" (default; the sink probes the buckets of ids stored by earlier
    batches) or "state" (``firstwrite.with_new_ids``). Both are exact, with a status for every
    valid delivery, and neither drops a late event. ``live`` keeps ``LiveState`` up to date.
    """
    sink = OrderEventSink(root, clock=clock, live=live)
    stream = with_arrival(spark.readStream.format("text")
                               .option("maxFilesPerTrigger", files_per_trigger)
                               .load(source_dir))
    query = _started(stream, sink, checkpoint, dedupe, {"availableNow": True})
    query.awaitTermination()
    return sink


# The state store that keeps its keys on disk; one row per event id ever seen is too many for memory.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Java never compiles a method of more bytes than this. All rules of a payload in one method have some
# 20,000; stages above the limit run as several methods, which are compiled.
COMPILED_METHOD_BYTES = 8000


def _started(stream: DataFrame, sink: OrderEventSink, checkpoint: str, dedupe: str, trigger: dict):
    if dedupe not in ("history", "state"):
        raise ValueError(f"dedupe must be 'history' or 'state', not {dedupe!r}")
    conf, settings = stream.sparkSession.conf, {"spark.sql.codegen.hugeMethodLimit": COMPILED_METHOD_BYTES}
    if dedupe == "state":
        settings["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
        stream = with_new_ids(stream)
    before = {name: conf.get(name) for name in settings}
    for name, value in settings.items():
        conf.set(name, value)
    try:  # a query keeps the settings it was started with
        return (stream.writeStream.foreachBatch(sink)
                      .option("checkpointLocation", checkpoint)
                      .trigger(**trigger)
                      .start())
    finally:
        for name, value in before.items():
            conf.set(name, value)


def start_event_stream(stream: DataFrame, root: str, checkpoint: str, trigger_seconds: float = 2.0,
                       dedupe: str = "state", live: bool = True):
    """Production form: a running query flushing every ``trigger_seconds``.

    ``stream`` must carry ``payload`` (text) and ``arrival`` (an orderable
    arrival position, e.g. Kafka partition/offset). ``dedupe="state"`` (default) looks up only
    the batch's own ids, in a RocksDB state store, so the cost of a batch does not follow
    the history; "history" opens the stored ids of the batch's own buckets.
    """
    return _started(stream, OrderEventSink(root, live=live), checkpoint, dedupe, {"processingTime": f"{trigger_seconds} seconds"})


def kafka_events(spark: SparkSession, servers: str, topic: str, max_per_trigger: int) -> DataFrame:
    """Kafka source shaped for the sink (needs the spark-sql-kafka package).

    ``max_per_trigger`` bounds the offsets of one micro-batch: at a trigger of s seconds the stream
    takes at most ``max_per_trigger / s`` events a second, the rest waits in the topic.
    """
    raw = (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", servers)
                .option("subscribe", topic)
                .option("maxOffsetsPerTrigger", max_per_trigger)
                .load())
    return raw.select(F.col("value").cast("string").alias("payload"),
                      F.struct("partition", "offset").alias("arrival"))
