"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# Partitions that a shuffle begins with at least. A partition is read by one task, so few of them
# grow with the input; many small ones are packed again by adaptive execution, 64 MB at most.
FIRST_PARTITIONS = 400
_FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

# Runtime SQL settings only: nothing here needs a new session. A setting the
# cluster operator would size (shuffle partitions, memory) is left alone.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the join output feeds an aggregate on the
    # same key; the extra exchange then runs after partial aggregation.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows are dealt out as they are read. A scan's order is fixed; where an order is not, Spark
    # repeats the whole stage after a loss, so nothing need be sorted in one task's memory for it.
    "spark.sql.execution.sortBeforeRepartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if spark.conf.get(_FIRST, None) is None:  # else the operator's own, or set before
        spark.conf.set(_FIRST, str(max(FIRST_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return spark


def local_session(app: str, cores: int = 8, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="loanloom-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` (or the folder given to ``setCheckpointDir``) names
    storage every executor can reach, so tables written below it survive a lost
    executor. Where neither is set, only a session whose executors are threads of
    this process gets a temporary folder; a cluster must name a shared one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = held.get() if held.isDefined() else None
    if not root and spark.sparkContext.master.startswith("local") and "cluster" not in spark.sparkContext.master:
        root = _local_scratch()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/loanloom/{label}-{uuid.uuid4().hex}"
