"""The state mode decides in Spark's own state store and reads a payload once for all of its rules."""
import json

from pyspark.sql import functions as F

from orderloom.streaming.events import validate
from orderloom.streaming.firstwrite import NEW_ID, with_new_ids

from orderloom.streaming.sink import OrderEventSink

from test_streaming import EVENT_A, EVENT_B, _clock, _scratch


def _deliveries(spark):
    rows = [(json.dumps(EVENT_A), 1), (json.dumps(EVENT_A), 2), (json.dumps(EVENT_B), 3), ("{bad", 4), (None, 5)]
    return spark.createDataFrame(rows, "payload string, arrival int")


def test_every_delivery_and_one_row_for_each_new_id(spark):
    found = with_new_ids(_deliveries(spark))
    assert found.where(F.col(NEW_ID).isNull()).count() == 5
    ids = found.where(F.col(NEW_ID).isNotNull()).select(NEW_ID, "payload", "arrival").collect()
    assert sorted(map(tuple, ids)) == [(EVENT_A["event_id"], None, None), (EVENT_B["event_id"], None, None)]


def test_a_payload_is_parsed_once(spark):
    plan = with_new_ids(_deliveries(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") <= 2 and "python" not in plan.lower()     # a filter pushed down held some 180
    fields = validate(_deliveries(spark))._jdf.queryExecution().executedPlan().toString()
    assert fields.count("(?U)") == 6                                             # each text is normalised once


def test_of_copies_at_one_place_the_last_is_inserted(spark):
    rows = [(json.dumps(EVENT_A), 2, None), (json.dumps(EVENT_A), 1, None), (json.dumps(EVENT_A), 1, None), (None, None, EVENT_A["event_id"])]
    sink = OrderEventSink(_scratch(), clock=_clock)
    sink(spark.createDataFrame(rows, "payload string, arrival int, new_id string").coalesce(1), 0)
    status = spark.read.parquet(sink.status_path).orderBy("arrival").collect()
    assert [(r.arrival.a, r.status) for r in status] == [(1, "duplicate"), (1, "inserted"), (2, "duplicate")]
    assert spark.read.parquet(sink.events_path).count() == 1
