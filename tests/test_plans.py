"""Building blocks: positions, running totals, exact quantiles, skew-safe lookups, hash order."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.plans.hashing import hash_rank, hash_take
from riskspark.plans.quantiles import SMALL_VALUES, column_quantiles, counted_quantiles, grouped_quantiles
from riskspark.plans.ranking import global_position, running_totals
from riskspark.plans.scratch import scratch_root
from riskspark.plans.skew import lookup_join


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows hold one key; values have ties; one key is NULL."""
    rng = random.Random(1)
    rows = []
    for i in range(3000):
        key = "hot" if rng.random() < 0.66 else rng.choice(["a", "b", None])
        rows.append((i, key, float(rng.randint(0, 40)) / 4 if rng.random() < 0.9 else None, rng.randint(0, 1)))
    return rows, spark.createDataFrame(rows, "id bigint, key string, v double, y int").repartition(7)


def test_global_position_with_ties(spark, skewed):
    rows, df = skewed
    got = {r["id"]: r["pos"] for r in global_position(df.where("v is not null"), ["v", "id"]).collect()}
    want = [r[0] for r in sorted((r for r in rows if r[2] is not None), key=lambda r: (r[2], r[0]))]
    assert [i for i, _ in sorted(got.items(), key=lambda x: x[1])] == want
    assert sorted(got.values()) == list(range(len(want)))


@pytest.mark.parametrize("cell", [10, 600, 10**6])
def test_counted_quantiles_rank_only_groups_in_full_cells(spark, skewed, cell):
    """Groups in full cells and in others, one of them without any value: counts of all rows, values and quantiles."""
    rows, df = skewed
    df = df.select("key", "v").unionByName(spark.createDataFrame([("none", None)] * 3, "key string, v double"))
    out = counted_quantiles(df, ["key"], "v", {"q": 0.25, "m": 0.5}, "rows", small_values=0, cell_values=cell)
    assert ("Window" in out._jdf.queryExecution().optimizedPlan().toString()) == (cell < 10**6)
    got = {r["key"]: r for r in out.collect()}
    assert set(got) == {"hot", "a", "b", None, "none"} and (got["none"]["rows"], got["none"]["n"], got["none"]["m"]) == (3, 0, None)
    for key in ("hot", "a", "b", None):
        values = [x[2] for x in rows if x[1] == key and x[2] is not None]
        assert (got[key]["rows"], got[key]["n"]) == (sum(x[1] == key for x in rows), len(values))
        assert [got[key]["q"], got[key]["m"]] == pytest.approx(np.quantile(values, [0.25, 0.5]).tolist(), abs=1e-12)


def test_running_totals_descending(spark, skewed):
    rows, df = skewed
    per_value = df.where("v is not null").groupBy("v").agg(F.count("*").alias("n"))
    got = {r["v"]: r["before"] for r in running_totals(per_value, [F.desc("v")], {"before": F.col("n")}).collect()}
    values = [r[2] for r in rows if r[2] is not None]
    assert got == {v: sum(x > v for x in values) for v in set(values)}


@pytest.mark.parametrize("parts", [None, 1, 5])
def test_running_totals_need_no_window_over_a_part(spark, parts):
    """Sums are carried on while a part is written, over batches and parts; a missing entry counts 0."""
    rows = [(i, (i * 37) % 11 if i % 5 else None) for i in range(25_000)]
    out = running_totals(spark.createDataFrame(rows, "id bigint, n int").repartition(3), ["id"], {"before": F.col("n")}, parts=parts)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 1  # that of the offsets, one row per part
    total, want = 0, {}
    for i, n in rows:
        want[i], total = total, total + (n or 0)
    assert {r["id"]: r["before"] for r in out.collect()} == want


def test_empty_table(spark):
    empty = spark.createDataFrame([], "id bigint, v double")
    assert global_position(empty, ["v", "id"]).count() == 0
    assert column_quantiles(empty, ["v"], {"m": 0.5}) == [{"column": "v", "n": 0, "m": None}]


@pytest.mark.parametrize("small", [SMALL_VALUES, 0])
def test_grouped_quantiles(skewed, small):
    rows, df = skewed
    probs = {"min": 0.0, "q": 0.25, "m": 0.5, "p": 0.995, "max": 1.0}
    got = {r["key"]: r for r in grouped_quantiles(df, ["key"], "v", probs, small_values=small).collect()}
    assert set(got) == {"hot", "a", "b", None}
    for key, r in got.items():
        values = np.array([x[2] for x in rows if x[1] == key and x[2] is not None])
        assert r["n"] == len(values)
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.quantile(values, p), abs=1e-12)


@pytest.mark.parametrize("cells", [1, 3, 20_000])
def test_column_quantiles_large_path(spark, cells):
    rng = np.random.default_rng(0)
    a, b = rng.lognormal(3, 2, 4000), np.repeat([0.0, 5.0], 2000)
    b[:10] = -3.0
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double").withColumn("none", F.lit(None).cast("double"))
    got = {r["column"]: r for r in column_quantiles(df, ["a", "b", "none"], {"lo": 0.0, "m": 0.5, "p": 0.995, "hi": 1.0}, cells=cells, small_values=0)}
    for name, values in (("a", a), ("b", b)):
        for key, p in (("lo", 0.0), ("m", 0.5), ("p", 0.995), ("hi", 1.0)):
            assert got[name][key] == pytest.approx(np.quantile(values, p), rel=1e-12)
    assert got["none"]["m"] is None


@pytest.mark.parametrize("limit", [200_000, 0])
def test_lookup_join_keeps_every_row(skewed, limit):
    rows, df = skewed
    stats = df.groupBy("key").agg(F.count("*").alias("n"), F.sum("y").alias("s"))
    out = lookup_join(df, stats, ["key"], "n", F.col("id"), broadcast_rows=limit, hot_share=3, salts=4).collect()
    assert len(out) == len(rows) and len({r["id"] for r in out}) == len(rows)
    for r in out:
        assert r["n"] == sum(x[1] == r["key"] for x in rows)


def test_lookup_join_unseen_key(spark, skewed):
    _, df = skewed
    stats = df.where("key = 'a'").groupBy("key").agg(F.count("*").alias("n"))
    out = lookup_join(df, stats, ["key"], "n", F.col("id"), broadcast_rows=0)
    assert out.where("key <> 'a' and n is not null").count() == 0
    assert out.count() == df.count()


def test_hash_rank_and_take(skewed):
    rows, df = skewed
    ranks = hash_rank(df, "id", ["y"], digits=2).collect()
    for y in (0, 1):
        mine = sorted(r["hash_rank"] for r in ranks if r["y"] == y)
        assert mine == list(range(len(mine)))
    first = {(r["y"], r["id"]) for r in ranks if r["hash_rank"] < 100}
    taken = {(r["y"], r["id"]) for r in hash_take(df, "id", lambda n: F.lit(100), ["y"]).collect()}
    assert first == taken


def test_scratch_follows_the_session(spark):
    assert scratch_root(spark) == (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()).rstrip("/")
