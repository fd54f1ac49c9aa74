"""Dense surrogate keys equal to ``ROW_NUMBER() OVER (ORDER BY id)``, distributed.

A window with no partition puts every row in one task. Instead:

1. range-partition by the id and sort inside each partition, so partition i
   holds only ids below those of partition i+1;
2. write this to the shared folder, each row with the index of its partition and
   its position there (``monotonically_increasing_id``: partition index in the
   high bits, row position in the low 33 bits), which fixes both (range bounds
   come from a sample and could differ on a re-run) and cuts the lineage;
3. count rows per partition (one small row per partition reaches the driver)
   and turn the counts into running offsets;
4. key = offset of the partition + position inside it, joined to the offsets by
   broadcast - the offsets table has exactly one row per partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.session import scratch_path, shuffles_freed

_ROW_BITS = 33


def with_dense_key(df: DataFrame, order_col: str, key_col: str,
                   num_partitions: int | None = None, key_type: str = "int") -> DataFrame:
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, F.col(order_col).asc())
                .sortWithinPartitions(F.col(order_col).asc())
                .withColumn("_mid", F.monotonically_increasing_id()))
    path = scratch_path(spark, "ranged")
    with shuffles_freed(spark):
        ranged.write.parquet(path)
    tagged = spark.read.schema(ranged.schema).parquet(path)
    part = F.shiftright(F.col("_mid"), _ROW_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))

    counts = sorted(tuple(r) for r in tagged.groupBy(part.alias("p")).count().collect())
    offsets, running = [], 0
    for p, c in counts:
        offsets.append((int(p), running))
        running += int(c)
    if not offsets:
        return tagged.drop("_mid").withColumn(key_col, F.lit(None).cast(key_type)).limit(0)
    offset_df = spark.createDataFrame(offsets, "_p long, _off long")
    keyed = tagged.join(F.broadcast(offset_df), part == F.col("_p"))
    key = (F.col("_off") + pos + F.lit(1)).cast(key_type).alias(key_col)
    return keyed.select(key, *[F.col(c) for c in df.columns])
