"""Connected components of an edge table by alternating star steps; no adjacency list is ever built."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.base import forget, stored


def _least_below(edges: DataFrame) -> DataFrame:
    return stored(edges.groupBy("big").agg(F.min("small").alias("least")), "least")


def _oriented(pairs: DataFrame) -> DataFrame:
    return pairs.where("big <> small").select(
        F.greatest("big", "small").alias("big"), F.least("big", "small").alias("small")
    ).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge; ``root`` is the smallest node of its component.

    Each round hangs larger neighbours of a node on its smallest one (large star), then a node's smaller neighbours and
    itself on the smallest of them (small star). Edges never grow in number; rounds grow with the logarithm of the longest
    chain. Only one count per round comes to the driver. Minima are stored before they are joined, so that the join of a hub
    with its many neighbours is dealt out to several tasks.
    """
    now = stored(_oriented(edges.select(F.col(a).alias("big"), F.col(b).alias("small"))), "edges")
    while True:
        least = _least_below(now)
        hung = now.join(least.withColumnRenamed("big", "small"), "small", "left")
        large = stored(_oriented(hung.select("big", F.coalesce("least", "small").alias("small"))), "edges")
        forget(least, now)
        least = _least_below(large)
        both = large.join(least, "big")
        now = stored(
            _oriented(both.select(F.col("small").alias("big"), F.col("least").alias("small")).unionByName(least.withColumnRenamed("least", "small"))),
            "edges",
        )
        forget(least, large)
        hubs = now.select(F.col("small").alias("big")).distinct()
        if now.join(hubs, "big", "left_semi").limit(1).count() == 0 and now.groupBy("big").count().where("count > 1").limit(1).count() == 0:
            break
    return now.select(F.col("big").alias("node"), F.col("small").alias("root")).unionByName(
        now.select(F.col("small").alias("node"), F.col("small").alias("root")).distinct()
    )
