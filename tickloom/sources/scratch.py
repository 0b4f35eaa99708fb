"""Written intermediate tables in the folder that driver and executors share, so that a lost executor costs no lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  A local session without one gets a folder of its own; a cluster raises."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tickloom-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


class Scratch:
    """Tables written for one computation; ``drop`` deletes those that nothing reads any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.paths = spark, f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}", {}

    def write(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self.paths)}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (path, out)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths[id(t)][0])
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
