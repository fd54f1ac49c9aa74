"""Event stream: the reference's idempotency tests, plus replay and restart."""

import datetime as dt
import json
import os

import pytest
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from orderloom.streaming.events import validate
from orderloom.streaming.metrics import events_by_minute, live_metrics, recent_orders
from orderloom.streaming.sink import OrderEventSink, run_file_stream

EVENT_A = {"event_id": "0b9ef7d8-3c86-4d55-9a55-6a2f1b1f7c01", "event_time": "2025-05-01T10:00:00Z",
           "order_id": "LIVE-TEST-001", "customer_id": "C000001", "product_id": "P001",
           "category": "Electronics", "quantity": 2, "unit_price": "125.50", "discount_pct": "0.10",
           "region": "West", "sales_channel": "Web"}
EVENT_B = dict(EVENT_A, event_id="0b9ef7d8-3c86-4d55-9a55-6a2f1b1f7c02", order_id="LIVE-TEST-002")


def _scratch():
    return tempfile.mkdtemp(prefix="orderloom-test-")


def _batch(spark, payloads, file="f1"):
    rows = [(json.dumps(p) if isinstance(p, dict) else p, (0, file, i), i) for i, p in enumerate(payloads)]
    df = spark.createDataFrame(rows, "payload string, a struct<t:long,f:string,h:long>, i long")
    return df.select("payload", F.col("a").alias("arrival"))


def _clock(batch_id):
    return dt.datetime(2025, 5, 1, 10, 0, batch_id, tzinfo=dt.timezone.utc)


def test_same_event_twice_is_inserted_then_duplicate(spark):
    sink = OrderEventSink(_scratch(), clock=_clock)
    sink(_batch(spark, [EVENT_A]), 0)
    sink(_batch(spark, [EVENT_A]), 1)
    status = spark.read.parquet(sink.status_path).orderBy("batch_id").collect()
    assert [r.status for r in status] == ["inserted", "duplicate"]
    stored = spark.read.parquet(sink.events_path)
    m = live_metrics(stored, F.lit(dt.datetime(2025, 5, 1, 10, 0, 30))).first()
    assert m.total_events == 1 and m.live_customers == 1
    assert m.live_revenue == Decimal("225.90")
    assert recent_orders(stored, 10).first().order_id == "LIVE-TEST-001"


def test_batches_are_idempotent(spark):
    sink = OrderEventSink(_scratch(), clock=_clock)
    sink(_batch(spark, [EVENT_A, EVENT_B]), 0)
    sink(_batch(spark, [EVENT_A, EVENT_B]), 1)
    status = spark.read.parquet(sink.status_path)
    got = {(r.batch_id, r.status): r.n for r in status.groupBy("batch_id", "status").agg(F.count("*").alias("n")).collect()}
    assert got == {(0, "inserted"): 2, (1, "duplicate"): 2}
    assert spark.read.parquet(sink.events_path).count() == 2


def test_copies_inside_one_batch_first_wins(spark):
    sink = OrderEventSink(_scratch(), clock=_clock)
    sink(_batch(spark, [EVENT_A, dict(EVENT_A, order_id="LATER-COPY"), EVENT_A]), 0)
    stored = spark.read.parquet(sink.events_path).collect()
    assert len(stored) == 1 and stored[0].order_id == "LIVE-TEST-001"
    status = [r.status for r in spark.read.parquet(sink.status_path).orderBy("arrival").collect()]
    assert status == ["inserted", "duplicate", "duplicate"]


def test_quantity_zero_and_bad_json_go_to_dead_letters(spark):
    sink = OrderEventSink(_scratch(), clock=_clock)
    sink(_batch(spark, [dict(EVENT_B, quantity=0), "{not json", EVENT_A]), 0)
    dead = spark.read.json(sink.dead_letter_path).collect()
    errors = sorted(r.error for r in dead)
    assert errors == ["invalid JSON payload", "quantity: must be > 0 and <= 100"]
    assert spark.read.parquet(sink.events_path).count() == 1


def test_replayed_batch_leaves_table_unchanged(spark):
    sink = OrderEventSink(_scratch(), clock=_clock)
    sink(_batch(spark, [EVENT_A]), 0)
    sink(_batch(spark, [EVENT_B]), 1)
    sink(_batch(spark, [EVENT_B]), 1)      # Spark re-runs batch 1 after a crash
    ids = sorted(r.order_id for r in spark.read.parquet(sink.events_path).collect())
    assert ids == ["LIVE-TEST-001", "LIVE-TEST-002"]




def test_field_rules(spark):
    cases = {
        "ok": EVENT_A,
        "ok_lax": dict(EVENT_A, quantity="5", unit_price=12),
        "float_qty": dict(EVENT_A, quantity=5.5),
        "price_3dp": dict(EVENT_A, unit_price="1.005"),
        "price_13_digits": dict(EVENT_A, unit_price="12345678901.25"),
        "discount_high": dict(EVENT_A, discount_pct="0.81"),
        "short_order": dict(EVENT_A, order_id="AB"),
        "blank_region": dict(EVENT_A, region="   "),
        "bad_uuid": dict(EVENT_A, event_id="xyz"),
        "qty_101": dict(EVENT_A, quantity=101),
    }
    df = spark.createDataFrame([(k, json.dumps(v)) for k, v in cases.items()], "k string, payload string")
    got = {r.k: (r.is_valid, r.errors) for r in validate(df, "payload").collect()}
    assert got["ok"] == (True, "") and got["ok_lax"][0]
    for bad in cases:
        if bad.startswith("ok"):
            continue
        assert not got[bad][0], bad
    assert got["price_3dp"][1] == "unit_price: at most 2 decimal places"
    assert got["blank_region"][1] == "region: value cannot be blank"


def test_normalisation_and_half_even_revenue(spark):
    payload = dict(EVENT_A, region="  North \t  East ", unit_price="0.25", quantity=1, discount_pct="0.5")
    df = spark.createDataFrame([(json.dumps(payload),)], "payload string")
    row = validate(df, "payload").first()
    assert row.region == "North East"
    assert row.net_revenue == Decimal("0.12")   # 0.125 -> half-even


def test_file_stream_restart_from_checkpoint(spark):
    root = _scratch()
    landing = os.path.join(root, "landing")
    os.makedirs(landing)

    def land(name, events):
        with open(os.path.join(landing, name), "w") as f:
            f.write("\n".join(json.dumps(e) for e in events) + "\n")

    land("001.json", [EVENT_A])
    run_file_stream(spark, landing, f"{root}/store", f"{root}/ckpt")
    land("002.json", [EVENT_A, EVENT_B])      # redelivery of A plus a new event
    run_file_stream(spark, landing, f"{root}/store", f"{root}/ckpt")
    stored = spark.read.parquet(f"{root}/store/order_events")
    assert sorted(r.order_id for r in stored.collect()) == ["LIVE-TEST-001", "LIVE-TEST-002"]
    assert events_by_minute(stored).first().event_count == 2


def test_a_late_event_is_stored_whatever_came_before(spark):
    for mode in ("history", "state"):
        root = _scratch()
        landing = os.path.join(root, "landing")
        os.makedirs(landing)
        batches = [["{bad", dict(EVENT_A, event_time="2099-01-01T00:00:00Z")], [dict(EVENT_B, event_time="2025-01-01T00:00:00Z")]]
        for i, events in enumerate(batches):
            with open(os.path.join(landing, f"{i}.json"), "w") as f:
                f.write("\n".join(e if isinstance(e, str) else json.dumps(e) for e in events) + "\n")
            run_file_stream(spark, landing, f"{root}/store", f"{root}/ckpt", dedupe=mode)
        stored = spark.read.parquet(f"{root}/store/order_events")
        assert sorted(r.order_id for r in stored.collect()) == ["LIVE-TEST-001", "LIVE-TEST-002"]
    with pytest.raises(ValueError):
        run_file_stream(spark, landing, f"{root}/store", f"{root}/ckpt", dedupe="watermark")


def test_no_valid_event_has_a_null_field(spark):
    cases = {
        "whole_10": (dict(EVENT_A, unit_price="1234567890.12"), ""),
        "whole_11": (dict(EVENT_A, unit_price="12345678901"), "unit_price: at most 10 whole digits"),
        "whole_11_1": (dict(EVENT_A, unit_price="12345678901.5"), "unit_price: at most 10 whole digits"),
        "null_time": (dict(EVENT_A, event_time=None), "event_time: null is not a value"),
        "null_id": (dict(EVENT_A, event_id=None), "event_id: null is not a value"),
        "null_discount": (dict(EVENT_A, discount_pct=None), "discount_pct: null is not a value"),
        "millis": (dict(EVENT_A, event_time=1704067200000), ""),
        "seconds": (dict(EVENT_A, event_time=1704067200), ""),
        "far": (dict(EVENT_A, event_time=10**18), "event_time: not a datetime"),
    }
    df = spark.createDataFrame([(k, json.dumps(v)) for k, (v, _) in cases.items()], "k string, payload string")
    got = {r.k: r for r in validate(df, "payload").collect()}
    for k, (_, error) in cases.items():
        assert (got[k].is_valid, got[k].errors) == (error == "", error), k
        if not error:
            assert None not in (got[k].unit_price, got[k].net_revenue, got[k].event_time)
    assert got["millis"].event_time == got["seconds"].event_time


def test_a_clean_stream_reads_back_as_no_dead_letters(spark):
    from orderloom.schemas import DEAD_LETTER
    sink = OrderEventSink(_scratch(), clock=_clock)
    sink(_batch(spark, [EVENT_A]), 0)
    assert spark.read.schema(DEAD_LETTER).json(sink.dead_letter_path).select("error", "payload").count() == 0


def test_state_store_mode_is_exact_across_batches_and_restarts(spark):
    root = _scratch()
    landing = os.path.join(root, "landing")
    os.makedirs(landing)

    def land(name, events):
        with open(os.path.join(landing, name), "w") as f:
            f.write("\n".join(e if isinstance(e, str) else json.dumps(e) for e in events) + "\n")

    land("001.json", [EVENT_A, "{bad"])
    run_file_stream(spark, landing, f"{root}/store", f"{root}/ckpt", dedupe="state")
    land("002.json", [EVENT_A, EVENT_B, "{bad"])          # redelivery after a restart
    run_file_stream(spark, landing, f"{root}/store", f"{root}/ckpt", dedupe="state")
    stored = spark.read.parquet(f"{root}/store/order_events")
    assert sorted(r.order_id for r in stored.collect()) == ["LIVE-TEST-001", "LIVE-TEST-002"]
    assert spark.read.json(f"{root}/store/dead_letters").count() == 2   # every bad delivery
