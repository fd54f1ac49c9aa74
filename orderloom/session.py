"""Session settings and the shared scratch / checkpoint location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL settings every job here relies on. They are safe to set on an
# existing session (the driver's, a notebook's, a cluster job's).
SQL_CONF = {
    # the reference stores event times in UTC and all date math assumes it
    "spark.sql.session.timeZone": "UTC",
    # AQE: coalesce small shuffle partitions, split skewed join partitions,
    # turn a sort-merge join into a broadcast one when a side turns out small
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    # compressed; a task of a join with an aggregate sorts some ten times as much, three times over
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    # the JVM compiles no method of more bytes: the many expressions of a cleaning step, generated
    # as one method, would be interpreted; beyond the limit they are generated in parts
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files behind. Else they stay until the driver's JVM collects its garbage.

    For a query that is run once, as one that writes a table.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def build_session(master: str | None = None, app: str = "orderloom",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in SQL_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory the cluster names.

    ``spark.checkpoint.dir`` (or an already set SparkContext directory) wins.
    Only a local-mode session without one gets a fresh temporary folder; on a
    cluster a machine-local folder would be lost with its executor, so that
    case is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        configured = tempfile.mkdtemp(prefix="orderloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory for a written table."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/orderloom-tables/{name}-{uuid.uuid4().hex[:12]}"
