"""Intermediate tables written to the shared checkpoint folder of the session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``, or a temporary folder on a local master only."""
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="riskspark-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in this application's part of the scratch folder."""
    return f"{scratch_root(spark)}/riskspark/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def persist_table(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as parquet and read it back: cuts lineage, fixes row placement, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
