"""Tables written to a folder that all executors share and read again: they cut lineage, and a lost executor costs a read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor and the driver can reach: the session's ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder; on a cluster it is an
    error, since each machine would write to its own disk.
    """
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not given:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        given = tempfile.mkdtemp(prefix="vellum-shared-")
        spark.sparkContext.setCheckpointDir(given)
    return given.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/vellum/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` as a table in the shared folder and read it back."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def forget(spark: SparkSession, *paths: str) -> None:
    """Delete intermediate tables that nothing reads any more."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
