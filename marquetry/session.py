"""Session factory with the settings every operator of the engine assumes."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "marquetry", master: str | None = None, **extra: str) -> SparkSession:
    """Session with UTC time, AQE and Arrow; `master` is only for local runs, a cluster sets its own."""
    builder = SparkSession.builder.appName(app)
    if master:
        cores = os.environ.get("BENCH_CPUS", "8")
        builder = builder.master(master).config("spark.sql.shuffle.partitions", cores)
        builder = builder.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    return builder.config(map=DEFAULTS | extra).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):
    """The parquet table `name` under `sf_dir`."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
