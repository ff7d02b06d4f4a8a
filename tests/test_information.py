"""Neighbour information against every distance."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.operators import information


def psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, int(n)))


def brute(x, y, k):
    keep = np.array([(y == c).sum() > 1 for c in y])
    x, y = x[keep], y[keep]
    n, total = len(x), 0.0
    for i in range(n):
        mine = np.flatnonzero(y == y[i])
        kk = min(k, len(mine) - 1)
        r = np.sort(np.abs(x[mine[mine != i]] - x[i]))[kk - 1]
        m = (np.abs(x - x[i]) < r).sum() if r > 0 else (x == x[i]).sum()
        total += psi(kk) - psi(len(mine)) - psi(m)
    return max(0.0, psi(n) + total / n)


@pytest.mark.parametrize("k,parts", [(3, 7), (1, 3), (5, 40)])
def test_against_every_distance(spark, k, parts, monkeypatch):
    """Ties, copies, gaps, a class of two rows and one of a single row, over parts that are smaller than k."""
    r = np.random.default_rng(k)
    n = 260
    y = r.integers(0, 2, n)
    y[:2], y[2] = 5, 7
    x = np.column_stack((r.integers(0, 12, n), np.round(r.normal(size=n) * 64) + 40 * y, np.where(r.random(n) < 0.4, 3.0, r.integers(0, 10**6, n)), np.full(n, 2.0))).astype(float)
    rows = [(*(None if (i + c) % 9 == 0 and c == 0 else float("nan") if c == 2 and i % 50 == 0 else float(v) for c, v in enumerate(a)), int(b)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows + [(1.0, 1.0, 1.0, 1.0, None)], "a double, b double, c double, d double, isFraud int").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r["column"]: r["mi"] for r in information.neighbour_information(df, list("abcd"), k=k).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for c, name in enumerate("abcd"):
        v = np.array([-1.0 if q[c] is None or math.isnan(q[c]) else q[c] for q in rows])
        assert got[name] == pytest.approx(brute(v, y, k), abs=1e-9), name
    assert k == 1 or got["b"] > 0.05


def test_tables_without_classes(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 0)], "a double, isFraud int")
    assert information.neighbour_information(df, ["a"]).count() == 0
    assert information.neighbour_information(df.limit(0), ["a"]).count() == 0


def test_digamma(spark):
    row = spark.range(1, 60).select("id", information.digamma(F.col("id")).alias("p")).collect()
    assert [r["p"] for r in row] == pytest.approx([psi(r["id"]) for r in row], abs=1e-12)
