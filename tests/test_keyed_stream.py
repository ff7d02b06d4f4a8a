"""The stateful velocity stream against the batch operator, however the rows are cut into batches."""

import random

import pytest
from pyspark.sql import functions as F

from riskspark.operators.behavior import velocity
from riskspark.streaming import keyed

SCHEMA = "id bigint, ts timestamp, card string, kind string"
WINDOWS = [600, 5000]


def rows(spark, n=240, seed=0):
    r = random.Random(seed)
    t, out = 1_700_000_000, []
    for i in range(n):
        t += r.choice([0, 0, 7, 60, 300, 900])
        out.append((i * 7 % n, t, r.choice(["a", "a", "b ", "B", None, f"c{i}"]), r.choice(["x", "x", "x", "y"])))
    return out


def frame(spark, part):
    return spark.createDataFrame(part, "id bigint, t bigint, card string, kind string").select("id", F.timestamp_seconds("t").alias("ts"), "card", "kind")


def streamed(spark, path, parts, lateness, salts=None, windows=WINDOWS):
    for part in parts:
        frame(spark, part).coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
    return keyed.velocity_counts(keyed.velocity_stream(source, ["card", "kind"], "ts", "id", windows, lateness, salts), "keyed-test")


def batch(spark, all_rows):
    df = spark.createDataFrame(all_rows, "id bigint, t bigint, card string, kind string")
    return sorted(map(tuple, velocity(df, ["card", "kind"], "t", "id", WINDOWS).collect()))


@pytest.mark.parametrize("cuts,salts", [(1, None), (5, None), (4, {("kind", "x"): 3, ("card", None): 2})])
def test_counts_do_not_depend_on_the_batches(spark, tmp_path, cuts, salts):
    """Rows in order, and rows that come one or two batches late."""
    r = random.Random(cuts)
    all_rows = rows(spark)
    parts = [[] for _ in range(cuts)]
    for i, row in enumerate(all_rows):
        at = i * cuts // len(all_rows)
        late = r.choice([0, 0, 0, 1, 2])
        parts[min(cuts - 1, at + late)].append(row)
    got = streamed(spark, str(tmp_path / "in"), [p for p in parts if p], "30 days", salts)
    assert got.columns == ["entity", "id", "cnt_600s", "cnt_5000s"]
    assert sorted(map(tuple, got.collect())) == batch(spark, all_rows)


def test_a_late_row_corrects_what_was_given_out(spark, tmp_path):
    t = 1_700_000_000
    parts = [[(1, t, "a", "x"), (2, t + 500, "a", "x")], [(3, t + 100, "a", "x")]]
    got = {r["id"]: r["cnt_600s"] for r in streamed(spark, str(tmp_path / "in"), parts, "1 hour").where("entity = 'card'").collect()}
    assert got == {1: 0, 3: 1, 2: 2}


def test_rows_behind_the_watermark_are_dropped_and_old_state_goes(spark, tmp_path):
    t = 1_700_000_000
    parts = [[(1, t, "a", "x"), (2, t + 100_000, "b", "x")], [(3, t + 100_100, "b", "x")], [(4, t + 50, "a", "x"), (5, t + 100_200, "a", "x")]]
    got = {r["id"]: r["cnt_600s"] for r in streamed(spark, str(tmp_path / "in"), parts, "1 hour").where("entity = 'card'").collect()}
    assert got == {1: 0, 2: 0, 3: 1, 5: 0}


def test_a_state_holds_many_values_of_one_time_slice(spark, tmp_path):
    """Few states however many values there are: each bucket and slice has one, and late rows still correct what they come in front of."""
    all_rows = [(i, 1_700_000_000 + 37 * i, f"c{i % 150}", "x") for i in range(600)]
    r = random.Random(3)
    parts = [[], []]
    for row in all_rows:
        parts[r.random() < 0.4].append(row)
    for part in parts:
        frame(spark, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    stream = keyed.velocity_stream(source, ["card", "kind"], "ts", "id", WINDOWS, "30 days", {("kind", "x"): 2}, buckets=3)
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "bucket" in plan and "slice" in plan
    got = keyed.velocity_counts(stream, "keyed-test")
    assert sorted(map(tuple, got.collect())) == batch(spark, all_rows)
    df = frame(spark, all_rows)
    assert keyed.bucket_count(df, "ts", WINDOWS, 100) == 6 and keyed.bucket_count(df.limit(0), "ts", WINDOWS, 100) == 1
    assert keyed.crowded_values(df, ["card", "kind"], "ts", WINDOWS, 300) == {("kind", "x"): 2}


def test_hot_values_are_those_above_the_share(spark):
    df = frame(spark, rows(spark, 400))
    got = keyed.hot_values(df, ["card", "kind"], 0.1, 4)
    assert {k for k in got if k[0] == "kind"} == {("kind", "x"), ("kind", "y")}
    assert set(got.values()) == {4} and ("card", "a") in got


def test_an_empty_stream(spark, tmp_path):
    assert streamed(spark, str(tmp_path / "in"), [[]], "1 hour").count() == 0
