"""Joins of transactions with identities, runs and maps; nearest neighbours are in :mod:`neighbours`."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.clean import rename_dashes


def with_identity(tx: DataFrame, ident: DataFrame, key: str = "TransactionID") -> DataFrame:
    """Left equi-join; the key is unique on both sides, so no key is hot."""
    return tx.join(rename_dashes(ident), key, "left")


def split_back(enriched: DataFrame, part: DataFrame, key: str = "TransactionID") -> DataFrame:
    """Rows of the enriched union that belong to ``part``."""
    return enriched.join(part.select(key), key, "left_semi")


def align_by_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Put two frames side by side by their unique key, never by position."""
    return left.join(right, key)


def model_metrics(models: DataFrame, runs: DataFrame) -> DataFrame:
    """Registry with the first matching run by version; the version is the file name without its affixes."""
    version = F.regexp_replace(F.regexp_replace("name", "model_", ""), r"\.pkl", "")
    first = Window.partitionBy("version").orderBy("hyperparameters", "model_type")
    one = runs.withColumn("_rn", F.row_number().over(first)).where(F.col("_rn") == 1).drop("_rn")
    return models.withColumn("version", version).join(one, "version", "left")
