"""Session builder and table loading shared by the queries, the bench and the tests."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "vellum", cpus: int | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    """A local session with the settings the library expects; a cluster brings its own session.

    Nothing in the library needs these exact values: they pin the time zone so that
    timestamps compare across engines, and keep small inputs from being over-partitioned.
    """
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("VELLUM_DRIVER_MEMORY", "6g"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one parquet table of a dataset directory through Spark's own reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
