"""Bounds that are stated are also enforced."""

import time

import pytest
from pyspark.sql import functions as F

from riskspark.plans import hashing
from riskspark.sources import tables


def test_documents_of_bounded_length(spark, tmp_path):
    df = spark.range(30).select((F.col("id") % 3).alias("key"), F.col("id").alias("item"))
    assert tables.to_document(df, ["key"], ["item"], most=10).count() == 3
    for bad in (lambda: tables.to_document(df, ["key"], ["item"], most=9), lambda: tables.write_documents(df, ["key"], {"items": ["item"]}, str(tmp_path / "d"), most=9)):
        with pytest.raises(ValueError):
            bad()


def test_many_strata_are_refused(spark, monkeypatch):
    monkeypatch.setattr(hashing, "MOST_STRATA", 4)
    df = spark.range(40).select("id", (F.col("id") % 4).alias("few"), (F.col("id") % 5).alias("many"))
    assert hashing.hash_take(df, "id", lambda n: F.floor(n / 2), ["few"]).count() == 20
    with pytest.raises(ValueError):
        hashing.hash_take(df, "id", lambda n: F.floor(n / 2), ["many"])


def test_activations_within_a_millisecond_keep_their_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(time, "time", lambda: 1_700_000_000.0)
    root = str(tmp_path)
    for version in ("a", "b", "a", "c", "b"):
        tables._register(spark, root, version, f"{root}/{version}", "activated")
    assert tables.active_version(spark, root) == "b"
    reg = spark.read.schema(tables.REGISTRY_SCHEMA).parquet(f"{root}/registry")
    assert reg.select("created_at").distinct().count() == 5
