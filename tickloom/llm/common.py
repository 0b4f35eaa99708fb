"""Shared folder, written cuts and small helpers of the training-data operators."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Prefix of every internal column, so that no column of a caller can clash with one.
P = "__tl_"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.  Where it is unset a local session gets one of its own; a cluster raises."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = os.path.join(tempfile.gettempdir(), "tickloom-checkpoints")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, what: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark)}/tickloom-{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame, what: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder, in folders ``by`` columns of few values, and read it back: later stages survive a lost executor."""
    spark = df.sparkSession
    path, writers = fresh_path(spark, what), "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    spark.conf.set(writers, "16" if by else before)  # as many files of a task are open at a time; its rows are sorted only beyond that
    try:
        df.write.parquet(path, partitionBy=by)
    finally:
        spark.conf.set(writers, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*cuts: DataFrame) -> None:
    """Delete the files of written cuts that nothing reads any more."""
    for df in cuts:
        spark = df.sparkSession
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {re.match(r".*?/tickloom-[^/]*-[0-9a-f]{32}(?=/)", f)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 4 MB and 2,000 rows, so that a Python worker's memory doesn't grow with the length of texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2000:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing holds any more: it does so when the driver collects its garbage."""
    for _ in range(2):  # the first lets go of what Python held, the second of what that held
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def broadcast_within(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Broadcast ``df`` when its counted rows are within ``limit``; otherwise leave it to a shuffled join."""
    return F.broadcast(df) if rows <= limit else df


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], broadcast: bool = False) -> DataFrame:
    """Inner join on equal ``keys``, where null equals null."""
    other = right.withColumnsRenamed({k: f"{P}{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"{P}{k}")) for k in keys]
    return left.join(F.broadcast(other) if broadcast else other, on).drop(*[f"{P}{k}" for k in keys])
