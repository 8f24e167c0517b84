"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Runtime SQL settings the plans rely on. Nothing here depends on the size of the cluster.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even when that costs an extra exchange further up
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows dealt by one key are not dealt again to be joined by that key and another; a hot key's partition is split
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # what an execution has shuffled goes when it ends; a query is several, as it stores tables on its way
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # arrays of many small groups are gathered in sorted rows; by hash Spark would begin and then sort after all
    "spark.sql.execution.useObjectHashAggregateExec": "false",
    # a task that writes a few partitions of a table keeps their files open and need not sort its rows by them
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    "spark.sql.session.timeZone": "UTC",
}

# Codec of tables stored on the way.
PACKED = "zstd"

# Bytes a fixed-width value takes in a row at most, when rows are measured.
FIXED_WIDTH = 16

_own_root: str | None = None


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller already owns."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's checkpoint dir.

    A single-machine session without one gets a temporary folder; on a cluster that would be a different disk for
    every executor, so it is an error there.
    """
    global _own_root
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
    if _own_root is None:
        _own_root = tempfile.mkdtemp(prefix="tillhouse-")
    return _own_root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_root(spark)}/tillhouse/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives the loss of any executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def measured_bytes(df: DataFrame, limit: int) -> int:
    """Bytes of a frame as counted by running it, or some number above `limit`; it is read no further than that.

    Catalyst's own estimate does not grow over explode and is a product over joins, so it decides nothing here.
    """
    width = FIXED_WIDTH * max(1, len(df.columns))
    texts = [F.octet_length(f.name) for f in df.schema.fields if f.dataType.typeName() == "string"]
    size = F.lit(width)
    for text in texts:
        size = size + F.coalesce(text, F.lit(0))
    return df.limit(limit // width + 1).agg(F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()[0]


def fits(df: DataFrame, limit: int) -> bool:
    return measured_bytes(df, limit) <= limit
