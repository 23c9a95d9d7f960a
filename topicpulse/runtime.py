"""Small helpers around the session: shared folder, lineage cuts and size-checked broadcast."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest side (rows) that may be broadcast; everything above is joined by shuffle.
BROADCAST_ROWS = 2_000_000


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a private one only for local sessions."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="topicpulse-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result survives the loss of executors and has its true size, so plans that use it
    again and again (rounds of an iteration) keep small estimates.
    """
    path = scratch_path(df.sparkSession, "stored")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of plans that are no longer referenced.

    Listener threads hold on to the last event, and with it to the last plan, until another one comes.
    """
    spark.sql("SELECT 1").collect()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def broadcast_if(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast ``df`` when its known row bound is small, else leave the join to AQE."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
