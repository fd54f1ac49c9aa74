"""First write wins with a status for each delivery, the bucketed key set, and metrics that follow the stream."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from orderloom.streaming.keyset import KeySet
from orderloom.streaming.metrics import live_metrics, recent_orders
from orderloom.streaming.sink import OrderEventSink, run_file_stream

from test_streaming import EVENT_A, EVENT_B, _batch, _clock, _scratch


def _event(i, **changes):
    return dict(EVENT_A, event_id=f"0b9ef7d8-3c86-4d55-9a55-{i:012d}", order_id=f"ORDER-{i:04d}", **changes)


def _status(spark, store):
    rows = spark.read.parquet(f"{store}/insert_status").orderBy("batch_id", "arrival").collect()
    return [(r.batch_id, r.event_id[-2:], r.status) for r in rows]


def _land(landing, name, events, at):
    path = os.path.join(landing, name)
    with open(path, "w") as f:
        f.write("\n".join(e if isinstance(e, str) else json.dumps(e) for e in events) + "\n")
    os.utime(path, (at, at))


def test_state_gives_every_delivery_a_status(spark):
    root = _scratch()
    landing = os.path.join(root, "landing")
    os.makedirs(landing)
    later = dict(EVENT_A, order_id="LATER-COPY")
    # three copies of one id in one batch, the earliest file of which must win
    _land(landing, "b.json", [later], 1_700_000_100)
    _land(landing, "a.json", [EVENT_A, "{bad"], 1_700_000_000)
    _land(landing, "c.json", [later], 1_700_000_200)
    run_file_stream(spark, landing, f"{root}/store", f"{root}/ckpt", files_per_trigger=3, dedupe="state")
    assert _status(spark, f"{root}/store") == [(0, "01", "inserted"), (0, "01", "duplicate"), (0, "01", "duplicate")]
    _land(landing, "d.json", [EVENT_B, EVENT_A], 1_700_000_300)                     # after a restart
    run_file_stream(spark, landing, f"{root}/store", f"{root}/ckpt", dedupe="state")
    assert sorted(_status(spark, f"{root}/store"))[3:] == [(1, "01", "duplicate"), (1, "02", "inserted")]
    # the commit of the last batch is lost: it runs again with the state of the batch before it
    for name in os.listdir(f"{root}/ckpt/commits"):
        if name.strip(".").startswith("1"):
            os.remove(f"{root}/ckpt/commits/{name}")
    run_file_stream(spark, landing, f"{root}/store", f"{root}/ckpt", dedupe="state")
    assert sorted(_status(spark, f"{root}/store"))[3:] == [(1, "01", "duplicate"), (1, "02", "inserted")]
    stored = spark.read.parquet(f"{root}/store/order_events").collect()
    assert sorted(r.order_id for r in stored) == ["LIVE-TEST-001", "LIVE-TEST-002"]
    assert spark.read.json(f"{root}/store/dead_letters").count() == 1


def test_both_modes_agree(spark):
    events = [_event(i % 37, quantity=1 + i % 5) for i in range(120)]
    found = {}
    for mode in ("history", "state"):
        root = _scratch()
        landing = os.path.join(root, "landing")
        os.makedirs(landing)
        for i in range(4):
            _land(landing, f"{i}.json", events[i * 30:(i + 1) * 30], 1_700_000_000 + i)
        run_file_stream(spark, landing, f"{root}/store", f"{root}/ckpt", files_per_trigger=2, dedupe=mode)
        found[mode] = (sorted(_status(spark, f"{root}/store")),
                       sorted((r.event_id, r.order_id, r.quantity) for r in spark.read.parquet(f"{root}/store/order_events").collect()))
    assert found["history"] == found["state"]
    assert sum(s == "inserted" for _, _, s in found["state"][0]) == 37


def test_key_set_opens_only_the_buckets_of_the_batch(spark):
    keys = KeySet(_scratch(), buckets=64)
    frame = lambda values: spark.createDataFrame([(v,) for v in values], "key string")
    assert keys.unseen(frame(["a", "a", "b"]), 0).count() == 2 and keys.seen(frame(["a"]), 0) is None
    history = [f"id-{i}" for i in range(3000)]
    for batch in range(3):
        keys.add(frame(history[batch * 1000:(batch + 1) * 1000]), batch)
    small = frame(["id-5", "id-1500", "new"])
    assert len(keys.paths(spark, small)) <= 3
    files = keys.seen(small, 3).inputFiles()
    assert 0 < len(files) <= 3 * 3                       # of 3 x 64
    assert {r.key for r in keys.unseen(small, 3).collect()} == {"new"}
    assert {r.key for r in keys.unseen(small, 1).collect()} == {"id-1500", "new"}    # a replay of batch 1
    keys.add(frame(history[1000:2000]), 1)                                          # and its write again
    assert keys.seen(frame(history), 3).count() == 3000


def test_history_mode_reads_few_stored_ids(spark):
    sink = OrderEventSink(_scratch(), clock=_clock)
    sink(_batch(spark, [_event(i) for i in range(400)]), 0)
    sink(_batch(spark, [_event(5), _event(9999)]), 1)
    assert [s for _, _, s in _status(spark, sink.root)][-2:] == ["duplicate", "inserted"]
    probe = spark.createDataFrame([(_event(5)["event_id"],), (_event(9999)["event_id"],)], "key string")
    assert len(sink.ids.seen(probe, 1).inputFiles()) <= 2 * 2      # of some 200 files


@pytest.mark.parametrize("replay", [False, True])
def test_live_state_equals_the_full_queries_after_every_batch(spark, replay):
    sink = OrderEventSink(_scratch(), clock=_clock, live=True)
    start = dt.datetime(2025, 5, 1, 9, 59, 0, tzinfo=dt.timezone.utc)
    at = lambda i: (start + dt.timedelta(seconds=(i * 7) % 100, microseconds=i)).isoformat()
    batches = [[_event(i, event_time=at(i), customer_id=f"C{i % 23}") for i in range(60)],
               ["{bad"],                                                              # nothing inserted
               [_event(i, event_time=at(i), customer_id=f"C{i % 31}") for i in range(40, 130)],
               [_event(200, event_time="2025-05-01T10:30:00Z", customer_id="C1")],      # a future event
               [_event(201, event_time="2024-01-01T00:00:00Z", customer_id="new")]]     # a late one
    for n, events in enumerate(batches):
        sink(_batch(spark, events), n)
        if replay:
            sink(_batch(spark, events), n)
        stored = spark.read.schema(sink.live.columns).parquet(f"{sink.root}/order_events")
        newest = stored.agg(F.max("event_time")).first()[0]
        clock = dt.datetime(2025, 5, 1, 10, 0, n)                                     # the session is in UTC
        for as_of in {clock, newest or clock, max(newest or clock, clock), min(newest or clock, clock)}:
            moment = F.lit(as_of).cast("timestamp")
            assert sink.live.metrics(spark, moment).collect() == live_metrics(stored, moment).collect()
        for limit in (1, 7, 100):
            assert sink.live.recent_orders(spark, limit).collect() == recent_orders(stored, limit).select(*sink.live.columns.fieldNames()).collect()
    paths = sink.live.recent_orders(spark, 5)._jdf.queryExecution().toString()
    assert "order_events" not in paths
    assert sink.live.batches(spark) == [3, 4]                                       # older folders are gone
