"""Session settings for local runs; on a cluster the session comes from the submitter."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "riskspark", cpus: str | int | None = None) -> SparkSession:
    """A local session with UTC time, ANSI mode, adaptive execution and no web page."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
