"""Session helpers: table access and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

# Scratch folders that this process has named.
_NAMED: list[str] = []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir`` or set as checkpoint folder.

    Driver and executors have to see the same files there, so nothing is made up on a
    cluster. Only where all tasks run inside this machine's single JVM, a temporary folder
    is set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the driver and all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pagemill-"))
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables; it is removed when the session's process ends."""
    base = f"{shared_folder(spark).rstrip('/')}/pagemill/{uuid.uuid4().hex}"
    _NAMED.append(base)
    return f"{base}/{name}"


@atexit.register
def delete_scratch() -> None:
    """Remove the scratch folders, as long as there is a session to do it with."""
    spark = SparkSession.getActiveSession()
    while spark is not None and _NAMED:
        try:
            delete_path(spark, _NAMED.pop())
        except (Py4JError, OSError):  # the store or the JVM has gone before
            return


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder in whatever store holds it; one that is not there is no error."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder, so that its lineage ends there.

    A lost executor then costs a new read, never the work before.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a scan with fewer splits than there are cores one partition per core.

    For scans that feed heavy per-row work. Tables large enough to keep all cores busy
    are left as they are, so nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *keys)
