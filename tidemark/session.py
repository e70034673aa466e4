"""Session settings and the shared folder that long jobs cut their lineage into."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job in this package relies on for right results.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}

# Settings that only change the physical plan.
ADVISED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # no broadcast on estimates: a side is broadcast only once its shuffled size is known to be
    # small, or where the code says why its size is bounded
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Settings that only take effect when the session starts.
AT_START = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in {**REQUIRED, **ADVISED}.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**REQUIRED, **ADVISED, **AT_START, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a local session without one gets a temporary folder."""
    context = spark.sparkContext
    configured = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", context.master):  # one machine; local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="tidemark-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for one written table."""
    return f"{shared_folder(spark).rstrip('/')}/tidemark/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and continue from there.

    Used where a result must not be recomputed differently (row positions after a range
    shuffle) or where a plan is read several times. Survives the loss of executors.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a compressed table in the shared folder, read back.

    Like ``cut`` for rows that are many: a checkpoint's files are not compressed. Shuffle files that made the
    table go with it; what needs them again makes them again.
    """
    spark, path, cleanup = df.sparkSession, scratch_path(df.sparkSession, name), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, None)
    spark.conf.set(cleanup, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(cleanup) if before is None else spark.conf.set(cleanup, before)
    return spark.read.schema(df.schema).parquet(path)
