"""Resumable updates: new rows by anti-join, in batch stages that are published whole, or as a stream."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vellum.operators.harmonize import new_rows
from vellum.storage import forget


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def published_parts(spark: SparkSession, path: str) -> list[str]:
    """Folders of the table's parts, of which each has a mark; what a broken run left has none."""
    fs, marks = _folder(spark, f"{path}/published")
    if not fs.exists(marks):
        return []
    return sorted(f"{path}/parts/{s.getPath().getName()}" for s in fs.listStatus(marks))


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of all published parts; None before the first."""
    parts = published_parts(spark, path)
    return spark.read.parquet(*parts) if parts else None


def publish(df: DataFrame, path: str) -> None:
    """Write a part aside, then mark it: a reader sees all of it or nothing. A part without rows adds nothing, unless it is the first."""
    spark, name = df.sparkSession, uuid.uuid4().hex
    part = f"{path}/parts/{name}"
    df.write.parquet(part)
    if published_parts(spark, path) and spark.read.parquet(part).isEmpty():
        forget(spark, part)
        return
    fs, mark = _folder(spark, f"{path}/published/{name}")
    # A mark is one small file: it is there or it isn't.
    fs.create(mark, False).close()


def sweep(spark: SparkSession, path: str) -> int:
    """Delete the parts that broken runs left, while no run is going on; how many there were."""
    fs, folder = _folder(spark, f"{path}/parts")
    known = {p.rpartition("/")[2] for p in published_parts(spark, path)}
    lost = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName() not in known] if fs.exists(folder) else []
    for p in lost:
        fs.delete(p, True)
    return len(lost)


def run_stage(spark: SparkSession, source: DataFrame, path: str, key: str, stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Publish the stage's result for rows whose key isn't in its table yet; the whole table. A second run adds nothing.

    A run that breaks off, in the stage or while it writes, leaves the table as it was, and the next one does all that is missing.
    """
    known = read_table(spark, path)
    publish(stage(source if known is None else new_rows(source, known, key)), path)
    return read_table(spark, path)


def stream_updates(source: DataFrame, path: str, key: str, checkpoint: str, event_time: str | None = None, delay: str = "10 minutes") -> StreamingQuery:
    """Append a stream's first row of each key to a table, exactly once; stops when the source is read."""
    distinct = source.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key]) if event_time else source.dropDuplicates([key])
    return distinct.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
