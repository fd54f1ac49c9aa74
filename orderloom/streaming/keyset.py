"""A stored set of keys that a micro-batch can probe without reading the whole history.

Keys lie in hash buckets (``bucket=<b>/batch_id=<n>``). A probe opens the buckets
that the batch's own keys fall into and no other; their number is at most ``buckets``,
and so is what the driver learns. Keys added by a batch overwrite that batch's own
folders, and a probe looks at earlier batches only, so a replayed batch sees the
same set as the first time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, and ``path`` for it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def subfolders(spark: SparkSession, path: str) -> list[str]:
    fs, p = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


class KeySet:
    def __init__(self, path: str, buckets: int = 256):
        self.path, self.buckets = path.rstrip("/"), buckets

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def paths(self, spark: SparkSession, keys: DataFrame) -> list[str]:
        """The folders that the keys (column ``key``) can be in."""
        wanted = {f"bucket={r[0]}" for r in keys.select(self.bucket(F.col("key"))).distinct().collect()}
        return [f"{self.path}/{b}" for b in subfolders(spark, self.path) if b in wanted]

    def seen(self, keys: DataFrame, before_batch: int) -> DataFrame | None:
        """The stored keys of earlier batches in the buckets of ``keys``; None if there is no such bucket."""
        spark = keys.sparkSession
        paths = self.paths(spark, keys)
        if not paths:
            return None
        stored = spark.read.schema("key string, bucket int, batch_id bigint").option("basePath", self.path).parquet(*paths)
        return stored.where(F.col("batch_id") < before_batch).select("key")

    def unseen(self, keys: DataFrame, before_batch: int) -> DataFrame:
        """The distinct keys that no earlier batch has added."""
        own, earlier = keys.select("key").distinct(), self.seen(keys, before_batch)
        return own if earlier is None else own.join(earlier, "key", "left_anti")

    def add(self, keys: DataFrame, batch_id: int) -> None:
        (keys.select("key", self.bucket(F.col("key")).alias("bucket"), F.lit(batch_id).cast("bigint").alias("batch_id"))
         .repartition("bucket").sortWithinPartitions("bucket", "key")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch_id").parquet(self.path))
