"""Velocity, momentum, lookups and encodings against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from riskspark.operators import behavior as B
from riskspark.operators import stages, timeseries


@pytest.fixture(scope="module")
def visits(spark):
    rng = random.Random(3)
    rows = [(i, rng.randint(0, 400) * 100, "big" if rng.random() < 0.5 else rng.choice(["x", "y", None]), rng.randint(0, 1)) for i in range(600)]
    return rows, spark.createDataFrame(rows, "id bigint, t bigint, card string, y int").repartition(5)


def brute_velocity(rows, w):
    out = {}
    for i, t, c, _ in rows:
        out[i] = sum(1 for j, u, d, _ in rows if d == c and u >= t - w and (u, j) < (t, i))
    return out


@pytest.mark.parametrize("min_hot", [10**9, 100, 0])
def test_velocity_matches_pairwise_count(visits, min_hot):
    rows, df = visits
    got = B.velocity(df, ["card"], "t", "id", [500, 5000], min_hot_rows=min_hot, hot_share=1000).collect()
    assert len(got) == len(rows)
    for w in (500, 5000):
        want = brute_velocity(rows, w)
        assert {r["id"]: r[f"cnt_{w}s"] for r in got} == want


@pytest.mark.parametrize("rows_back,delay,chunk", [(10, 0, 50), (10, 5, 15), (7, 0, 10_000)])
def test_momentum(visits, rows_back, delay, chunk):
    rows, df = visits
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    mean = sum(r[3] for r in rows) / len(rows)
    got = {r["id"]: r["momentum"] for r in B.momentum(df, "t", "id", "y", rows_back, delay, chunk).collect()}
    for n, r in enumerate(order):
        seen = [x[3] for x in order[max(0, n - rows_back - delay) : max(0, n - delay)]]
        assert got[r[0]] == pytest.approx(sum(seen) / len(seen) if seen else mean)


def test_users_with_zero_median_and_unseen(spark):
    fit = spark.createDataFrame([(1, 7, 1, 0.0), (2, 7, 1, 0.0), (3, 8, None, 4.0), (4, 8, None, 8.0), (5, 9, 2, 10.0)],
                                "id bigint, card1 bigint, addr1 int, TransactionAmt double")
    users = B.fit_users(fit)
    new = spark.createDataFrame([(1, 7, 1, 2.0), (2, 8, None, 3.0), (3, 55, 5, 8.0)], fit.schema)
    got = {r["id"]: r for r in B.apply_users(new, users, "id").collect()}
    assert got[1]["Amt_to_Median_User"] == pytest.approx(200.0)  # zero median counts as 0.01
    assert got[2]["user_count"] == 2 and got[2]["Amt_to_Median_User"] == pytest.approx(0.5)
    assert got[3]["user_count"] == 1 and got[3]["Amt_to_Median_User"] == pytest.approx(2.0)  # overall median 4


def test_entity_degrees_count_null_as_missing(spark):
    df = spark.createDataFrame([(1, 1, "A"), (2, 1, " a "), (3, 1, None), (4, None, "b"), (5, None, None)], "id bigint, card1 bigint, P_emaildomain string")
    got = {r["id"]: r for r in B.with_entity_degrees(df, "id").collect()}
    assert got[1]["entity__card1__unique_P_emaildomain"] == 2  # "a" twice, "missing"
    assert got[3]["entity__P_emaildomain__unique_card1"] == 2
    assert got[4]["entity__card1__unique_P_emaildomain"] == 2


def test_codes_by_first_appearance(spark):
    df = spark.createDataFrame([(3, "z"), (1, "m"), (2, None), (4, "m")], "id bigint, c string")
    codes = B.fit_codes(df, "c", "id")
    new = spark.createDataFrame([(1, "z"), (2, "m"), (3, None), (4, "new")], df.schema)
    assert [r["code2"] for r in B.apply_codes(new, codes, "c", "code2", "id").orderBy("id").collect()] == [2, 0, 1, -1]


def test_levels_mode_tie_and_limit(spark):
    df = spark.createDataFrame([("b", str(i)) for i in range(7)] + [("a", str(i)) for i in range(7, 14)], "c string, many string")
    got = {r["column"]: r for r in B.level_summary(df, ["c", "many"]).collect()}
    assert got["c"]["mode"] == "a" and got["c"]["levels"] == ["a", "b"]
    assert got["many"]["n_levels"] == 14 and got["many"]["levels"] is None


def test_hourly_null_and_negative_time(spark):
    df = spark.createDataFrame([(None, 1), (10, 0), (-1, 1), (3600, None)], "TransactionDT bigint, isFraud int")
    got = {r["hour_window"]: (r["total"], r["fraud_count"], r["fraud_rate"]) for r in timeseries.hourly(df).collect()}
    assert got == {0: (1, 1, 1.0), -1: (1, 1, 1.0), 1: (1, 0, 0.0)}


def test_anomaly_is_one_sided(spark):
    rows = [(i, 0.5) for i in range(30)] + [(30, 1.0), (31, 0.0)]
    got = timeseries.anomalies(spark.createDataFrame(rows, "hour_window bigint, fraud_rate double")).where("is_anomaly = 1").collect()
    assert [r["hour_window"] for r in got] == [30]


def test_behavior_stage_keeps_its_columns(spark, sf_dir, tmp_path):
    from riskspark.sources.views import txn

    t = txn(spark, sf_dir).drop("k")
    model = stages.BehaviorFeatures().fit(t)
    none_missing = t.where(F.col("dist1").isNotNull())
    assert model.transform(t).columns == model.transform(none_missing).columns  # decided at fit time
    model.write().overwrite().save(str(tmp_path / "m"))
    again = stages.BehaviorFeaturesModel.load(str(tmp_path / "m"))
    assert sorted(map(tuple, again.transform(t).collect())) == sorted(map(tuple, model.transform(t).collect()))


def test_ensemble_features_include_velocity_and_degrees(spark, sf_dir):
    from riskspark.queries.profile_queries import txn_with_device

    t = txn_with_device(spark, sf_dir).drop("k")
    out = stages.EnsembleFeatures().fit(t).transform(t)
    assert out.count() == t.count()
    for c in ("vel__card1__cnt_3600s", "entity__card1__unique_DeviceInfo", "DeviceInfo__has_chrome", "card1__addr1__amt_ratio", "ProductCD__click"):
        assert c in out.columns


def test_large_key_sets_share_their_exchanges(spark, sf_dir):
    from riskspark.operators import behavior as B
    from riskspark.plans.scratch import persist_table
    from riskspark.sources.views import txn

    t = txn(spark, sf_dir).select("TransactionID", "TransactionAmt", "card1", "addr1", "card4", "P_emaildomain")
    sets = [["card1"], ["card1", "addr1"], ["card1", "P_emaildomain"], ["card4", "addr1"]]
    stats = persist_table(B.key_set_stats(t.where("TransactionID % 3 <> 0"), sets), "sets")
    small, large = (B.with_key_sets(t, stats, sets, 7.0, "TransactionID", broadcast_rows=n) for n in (200_000, 0))
    assert small.columns == large.columns
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    pairs = [("card1", "P_emaildomain"), ("card4", "addr1")]
    few, many = (B.with_entity_degrees(t, "TransactionID", pairs, broadcast_rows=n) for n in (200_000, 0))
    assert few.columns == many.columns and sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
