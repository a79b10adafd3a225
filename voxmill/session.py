"""Session helpers: the folder that driver and executors share, and cutting lineage in it."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; unset, a folder for the time of a local session, where all tasks see it, and an error on a cluster."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="voxmill-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder; the files go with the data frame where spark.cleaner.referenceTracking.cleanCheckpoints is set."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def discard(spark: SparkSession, path: str) -> None:
    """Delete an intermediate folder that nothing reads any more."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
