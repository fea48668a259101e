"""The shared folder of the cluster, and cutting lineage through it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    Only a local session without the setting gets a temporary folder: on a cluster a
    machine-local folder would be invisible to the other machines.
    """
    named = spark.conf.get(_SETTING, None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if named is None:
            if not context.master.startswith("local"):
                raise ValueError(f"set {_SETTING} to a folder all executors share")
            named = tempfile.mkdtemp(prefix="tillroll-")
        context.setCheckpointDir(named)
    return named or context.getCheckpointDir()


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right under a path, none if there is no such path."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(root):
        return []
    return sorted(s.getPath().getName() for s in store.listStatus(root) if s.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the lake. Spark's own writers only ever replace one."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def stage(df: DataFrame) -> DataFrame:
    """Compute a small intermediate once and keep it in the shared folder, so several
    branches can read it without going back to the fact table. It outlives executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
