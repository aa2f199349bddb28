"""Session settings, shared scratch space and plan-size checks."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when that costs one more shuffle further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Parquet is several times smaller than the rows it holds; without this, a join side
    # is broadcast on its compressed size, and adaptive execution does not undo that.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # Shuffle files go when the write or action they were made for has ended, not when the driver
    # happens to collect its garbage: a load leaves nothing but its table.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # The JVM leaves longer methods uncompiled; stages of many packed columns are run in shorter ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

SHUFFLE_PARTITION_BYTES = 128 << 20

_local_scratch: str | None = None


def get_session(app_name: str = "millrace") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    # Without call-site capture per column expression, plans are built several times faster.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    return configure(builder.getOrCreate())


def configure(spark: SparkSession, inputs: list[DataFrame] | None = None) -> SparkSession:
    """Apply the runtime settings; with ``inputs``, also raise the shuffle width to fit them.

    The width is only ever raised. Adaptive execution merges the partitions
    that turn out small, so a wide start costs little and a narrow one spills.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if inputs:
        wanted = math.ceil(sum(plan_bytes(df) for df in inputs) / SHUFFLE_PARTITION_BYTES)
        if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
            spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the folder that all executors share (``spark.checkpoint.dir``).

    Only a local master may fall back to a temporary folder of this machine.
    """
    global _local_scratch
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if _local_scratch is None:
            _local_scratch = tempfile.mkdtemp(prefix="millrace-")
        base = _local_scratch
    return f"{base.rstrip('/')}/millrace/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df``, written to the shared folder and read again: lineage ends there."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_bytes(df: DataFrame) -> int:
    """Spark's own size estimate of a plan: file sizes for scans, real size once cached."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    """True when Spark itself would broadcast ``df`` under the session's threshold."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return plan_bytes(df) <= int(conf.autoBroadcastJoinThreshold())


def may_broadcast(df: DataFrame) -> bool:
    """Whether the session lets Spark broadcast at all."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()) >= 0
