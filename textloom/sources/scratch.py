"""Written tables used to cut lineage and to hand data between jobs.

The folder comes from ``spark.checkpoint.dir``, which a cluster points at shared storage.
Only a local master may fall back to a fresh folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None


def scratch_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="textloom-")
    return _local_root


def run_folder(spark: SparkSession) -> str:
    """Folder of all tables that this application hands between its jobs."""
    return f"{scratch_root(spark)}/textloom-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path no other run uses, so a retried job never reads half of an older one."""
    return f"{run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_run(spark: SparkSession) -> bool:
    """Delete this application's folder and nothing else, once none of its results is read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back: a lineage cut that survives the loss of executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
