"""Scratch tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the one named in ``spark.checkpoint.dir``. Only where that is unset and all
    runs on one machine, as in tests, a temporary folder is made and set; a cluster
    without it is an error, as its executors would write where no other one reads.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"spark.checkpoint.dir must name a folder that {master} shares")
        found = "file://" + tempfile.mkdtemp(prefix="siftstone-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a scratch path through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_at_exit, spark, path)
    return path


def _at_exit(spark: SparkSession, path: str) -> None:
    with suppress(Exception):  # the session may be gone; the folder is scratch
        delete(spark, path)


class Scratch:
    """Tables written to the shared folder to cut lineage.

    A lost executor costs only the tasks that ran on it: what was written before
    is read again from the shared folder. ``codec`` is how Parquet packs them: zstd takes
    less disk for texts, and more time.
    """

    def __init__(self, spark: SparkSession, name: str, codec: str = "snappy"):
        self.spark, self.name, self.codec, self.paths = spark, name, codec, {}

    def save(self, df: DataFrame, step: str) -> DataFrame:
        path = scratch_path(self.spark, f"{self.name}-{step}")
        df.write.option("compression", self.codec).parquet(path)
        self.paths[step] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *steps: str) -> None:
        """Delete steps that nothing reads any more."""
        for step in steps:
            if path := self.paths.pop(step, None):
                delete(self.spark, path)

    def settle(self) -> None:
        """Have Spark delete the shuffle files behind the tables saved so far.

        It does so when the driver collects the exchanges as garbage. A driver that holds
        little hardly ever does, and on a large input the files of all steps pile up.
        """
        for _ in range(2):  # at first, Spark's listeners may still hold the step just ended
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
            time.sleep(0.2)

    def clear(self, keep: str = "") -> None:
        """Delete all steps but one."""
        self.drop(*[step for step in self.paths if step != keep])
