"""Session-level helpers: table access, the shared scratch folder, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named table of a data folder; any path that Spark can open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    A cluster names it in ``spark.checkpoint.dir``; without it nothing is
    written there. Only a session whose master is local (such as in tests) makes
    a temporary folder once.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        sc = spark.sparkContext
        named = sc.getCheckpointDir()
        if not named:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            named = "file://" + tempfile.mkdtemp(prefix="corvane-")
            sc.setCheckpointDir(named)
    return named.rstrip("/")


def scratch(spark: SparkSession, kind: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage by a reliable checkpoint in the shared folder.

    The files survive the loss of any executor, and later reads do not
    recompute what stands before.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch path through Hadoop's file system layer."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def parts_for(df: DataFrame, size: int) -> int:
    """Tasks for a frame: one for each ``size`` bytes of its stored input, as the planner estimates it, or the shuffle partitions if they are more.

    Where nothing is known of the size, the shuffle partitions.
    """
    least = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    known = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return least if known >= 1 << 60 else max(least, -(-known // size))


class Stored:
    """Writes frames as tables below the shared folder and reads them back; ``drop`` deletes them all."""

    def __init__(self, spark: SparkSession, kind: str):
        self.spark, self.kind, self.paths = spark, kind, []

    def __call__(self, df: DataFrame) -> DataFrame:
        path = scratch(self.spark, self.kind)
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def drop(self) -> None:
        """Only once nothing that is read later stands on them."""
        for path in self.paths:
            drop_path(self.spark, path)
        self.paths.clear()
