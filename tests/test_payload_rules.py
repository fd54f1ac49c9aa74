"""The rules share what they read of a payload, and a stream runs them as methods that Java compiles."""
import json

from orderloom.streaming import sink as sinks
from orderloom.streaming.events import validate
from pyspark.sql import functions as F

from test_streaming import EVENT_A, _scratch

LIMIT = "spark.sql.codegen.hugeMethodLimit"


def _verdicts(spark, *events):
    df = spark.createDataFrame([(i, json.dumps(EVENT_A | e)) for i, e in enumerate(events)], "i int, payload string")
    return validate(df)


def test_keys_and_roundings_are_read_once(spark):
    plan = _verdicts(spark, {}).select("errors")._jdf.queryExecution().executedPlan().toString()
    assert plan.lower().replace("_", "").count("objectkeys(") == 1
    assert plan.count("round(_q#") == 1 and plan.count("round(_p#") == 3


def test_verdicts_on_numbers_and_explicit_nulls(spark):
    cases = [({"quantity": 2.0}, ""), ({"quantity": 2.5}, "quantity: must be a whole number"), ({"quantity": "x"}, "quantity: must be a whole number"),
             ({"quantity": 0}, "quantity: must be > 0 and <= 100"), ({"unit_price": "1.25"}, ""),
             ({"unit_price": "1.255"}, "unit_price: at most 2 decimal places"), ({"unit_price": "10000000000.5"}, "unit_price: at most 10 whole digits"),
             ({"unit_price": "99999999999.99"}, "unit_price: at most 12 digits"), ({"event_id": None}, "event_id: null is not a value"),
             ({"event_time": None, "discount_pct": None}, "event_time: null is not a value; discount_pct: null is not a value")]
    found = _verdicts(spark, *[e for e, _ in cases]).orderBy("i").collect()
    assert [r.errors for r in found] == [message for _, message in cases]


def test_a_stream_runs_its_rules_as_compiled_methods(spark):
    landing, before, seen = _scratch(), spark.conf.get(LIMIT), []
    spark.createDataFrame([(json.dumps(EVENT_A),)], "payload string").write.mode("overwrite").text(landing)
    stream = spark.readStream.format("text").load(landing).select(F.col("value").alias("payload"), F.lit(1).alias("arrival"))
    sink = lambda batch, _: seen.append((batch.count(), batch.sparkSession.conf.get(LIMIT)))
    sinks._started(stream, sink, _scratch(), "state", {"availableNow": True}).awaitTermination()
    assert seen == [(2, "8000")] and spark.conf.get(LIMIT) == before
