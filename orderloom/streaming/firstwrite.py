"""First write wins, with a status for every delivery, in the streaming state store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.streaming.events import validate

INSERTED, DUPLICATE = "inserted", "duplicate"
#: set in the rows that name an id the stream has never had before; these carry no delivery
NEW_ID = "new_id"


def with_new_ids(stream: DataFrame) -> DataFrame:
    """payload, arrival, new_id: every delivery (columns payload, arrival), and one row more for each event id that is new.

    The state holds the event ids, one row each, so a batch looks up its own ids only, whatever the
    history. It is Spark's own streaming de-duplication, which decides whether the batch is the first
    to bring an id; which of its deliveries wins is for the sink. A replayed batch or a restart
    reads the state of the batch before it and names the same ids.
    """
    payload, arrival = stream.schema["payload"].dataType, stream.schema["arrival"].dataType
    # a generator, as a filter would be pushed into the parse and evaluate it once for each rule
    ids = validate(stream, "payload").select(F.explode(F.when(F.col("is_valid"), F.array("event_id"))).alias(NEW_ID))
    new = ids.dropDuplicates([NEW_ID]).select(F.lit(None).cast(payload).alias("payload"), F.lit(None).cast(arrival).alias("arrival"), NEW_ID)
    return stream.select("payload", "arrival", F.lit(None).cast("string").alias(NEW_ID)).unionByName(new)
