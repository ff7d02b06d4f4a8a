"""Hand-made inputs for the traps: bad cells, NaN, constants, ties, empty classes, bin edges."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions import scalars as S
from riskspark.operators import clean, evaluate, monitor, profile, resample, rules, selection
from riskspark.sources import tables


def test_conform_adds_drops_and_zeroes(spark):
    schema = T.StructType([T.StructField("TransactionAmt", T.DoubleType()), T.StructField("card1", T.LongType())])
    raw = spark.createDataFrame([("250.0", 99), ("bad_type", 88)], "TransactionAmt string, unseen_col int")
    out = clean.conform(raw, schema)
    assert out.columns == ["TransactionAmt", "card1"]
    assert [tuple(r) for r in out.collect()] == [(250.0, 0), (0.0, 0)]
    kept = clean.conform(spark.createDataFrame([(None,), ("7",)], "TransactionAmt string"), schema, zero_fill=False)
    assert [r[0] for r in kept.collect()] == [None, 7.0]


def test_finite_and_numbers(spark):
    df = spark.createDataFrame([(1.0, "3.5"), (float("nan"), "x"), (float("inf"), None), (None, "nan")], "v double, s string")
    got = df.select(S.finite("v").alias("v"), S.finite("v", -1.0).alias("f"), S.to_number("s").alias("s")).collect()
    assert [r["v"] for r in got] == [1.0, None, None, None]
    assert [r["f"] for r in got] == [1.0, -1.0, -1.0, -1.0]
    assert [r["s"] for r in got] == [3.5, None, None, None]


def test_time_parts_of_negative_time(spark):
    r = spark.createDataFrame([(-1,)], "t bigint").select(S.hour_of_day("t"), S.day_of_week("t"), S.day_of_month("t"), S.legacy_day_of_week("t")).first()
    assert tuple(r) == (23, 6, 29, 5)


def test_composite_key_keeps_missing_parts(spark):
    df = spark.createDataFrame([(1, None)], "card1 bigint, addr1 int")
    assert tuple(df.select(S.user_key(), S.composite_key(["card1", "addr1"])).first()) == ("1_nan", "1|missing")


def test_amount_items_and_buckets(spark):
    df = spark.createDataFrame([(0.0,), (50.0,), (50.01,), (200.0,), (201.0,), (-4.0,)], "a double")
    assert [r[0] for r in df.select(S.amount_item("a")).collect()] == [None, "Amt=Low", "Amt=Mid", "Amt=Mid", "Amt=High", None]
    assert [r[0] for r in df.select(profile.edge_bucket("a", profile.AMOUNT_EDGES)).collect()] == [None, 1, 2, 3, 3, None]


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (0.125,), (-0.125,)], "v double")
    assert [r[0] for r in df.select(S.round_half_even("v", 0)).collect()][:3] == [0.0, 2.0, 2.0]
    assert [r[0] for r in df.select(S.round_half_even("v", 2)).collect()][3:] == [0.12, -0.12]


def test_histogram_edges_match_array_histogram(spark):
    values = [i / 100 for i in range(101)] + [1.0001, -0.1]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r["b"]: r["count"] for r in df.groupBy(profile.histogram_bin(F.col("v"), 0.0, 1.0, 50).alias("b")).count().collect()}
    want, _ = np.histogram(values, bins=50, range=(0.0, 1.0))
    assert got.pop(None) == 2
    assert [got.get(i, 0) for i in range(50)] == list(want)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "v double")
    assert df.select(profile.histogram_bin(F.col("v"), 3.0, 3.0, 50)).distinct().first()[0] == 25


def test_skewness_correction(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (10.0, 2.0)], "a double, c double")
    r = df.agg(profile.corrected_skew(F.col("a")), profile.corrected_skew(F.col("c"))).first()
    assert r[0] == pytest.approx(1.6523167403329906) and r[1] == 0.0


def test_balance_without_positives(spark):
    r = profile.class_balance(spark.createDataFrame([(0,), (0,)], "isFraud int")).first()
    assert (r["pos_weight"], r["pos_weight_guarded"], r["ratio"]) == (1.0, 2.0, None)


@pytest.mark.parametrize("more", [0, 2, 16])
def test_pair_correlations(spark, more):
    rng = np.random.default_rng(5)
    a = rng.normal(size=200)
    b = a * 2 + rng.normal(size=200)
    b[::3] = np.nan
    rows = [(float(x), None if math.isnan(y) and i % 2 else float(y), 4.0, None, float("inf") if i == 7 else float(i), *rng.normal(size=more).tolist())
            for i, (x, y) in enumerate(zip(a, b))]
    names = ["a", "b", "c", "n", "f"] + [f"z{i}" for i in range(more)]
    df = spark.createDataFrame(rows, ", ".join(f"{x} double" for x in names)).repartition(4)
    both = ~np.isnan(b)
    want = np.corrcoef(a[both], b[both])[0, 1]
    for columns in (names[:2], names[:4], names[:5], names):
        got = {(r["a"], r["b"]): r["r"] for r in selection.pair_correlations(df, columns).collect()}
        assert len(got) == len(columns) * (len(columns) - 1) // 2
        assert got[("a", "b")] == pytest.approx(want, abs=1e-12)
        assert all(v is None for (x, y), v in got.items() if {x, y} & {"c", "n", "f"})
        assert selection.correlated_columns(df, columns, want - 0.001) == ["b"] and selection.correlated_columns(df, columns, 0.9999) == []
    labelled = {r["column"]: r["r"] for r in selection.label_correlations(df, ["b", "c", "n", "f"], "a").collect()}
    assert labelled["b"] == pytest.approx(want, abs=1e-12) and labelled["c"] is labelled["n"] is labelled["f"] is None


def test_correlation_prune_drops_chains(spark):
    rows = [(float(i), float(i) + (i % 2) * 0.1, float(i) + (i % 3) * 0.1, float((i * 7) % 11)) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    assert selection.correlated_columns(df, ["a", "b", "c", "d"], 0.98) == ["b", "c"]


def test_mutual_information_of_an_exact_copy(spark):
    df = spark.createDataFrame([(i % 2, float(i % 2), 1.0) for i in range(100)], "isFraud int, same double, flat double")
    got = {r["column"]: r["mi"] for r in selection.mutual_information(df, ["same", "flat"]).collect()}
    assert got["same"] == pytest.approx(math.log(2)) and got["flat"] == pytest.approx(0.0)


def test_pr_areas_and_threshold(spark):
    y = [1, 0, 1, 1, 0, 0, 1, 0]
    p = [0.9, 0.9, 0.8, 0.7, 0.7, 0.4, 0.4, 0.1]
    df = spark.createDataFrame(list(zip(y, p)), "isFraud int, p double")
    r = evaluate.ranking_metrics(df).first()
    pairs = [(a, b) for a, ya in zip(p, y) if ya for b, yb in zip(p, y) if not yb]
    assert r["auc_roc"] == pytest.approx(sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs))
    assert r["average_precision"] == pytest.approx(0.25 * 0.5 + 0.25 * 2 / 3 + 0.25 * 0.6 + 0.25 * 4 / 7)
    assert r["auc_pr"] == pytest.approx(0.25 * (1 + 0.5) / 2 + 0.25 * (0.5 + 2 / 3) / 2 + 0.25 * (2 / 3 + 0.6) / 2 + 0.25 * (0.6 + 4 / 7) / 2)
    best = evaluate.best_threshold(df).first()
    assert best["threshold"] == 0.4 and best["f1"] == pytest.approx(8 / 11)


def test_threshold_without_rows(spark):
    empty = spark.createDataFrame([], "isFraud int, p double")
    assert evaluate.best_threshold(empty).first()["threshold"] == 0.5


def test_metrics_without_positives(spark):
    r = evaluate.classification_metrics(spark.createDataFrame([(0, 0), (0, 0)], "isFraud int, prediction int")).first()
    assert (r["precision"], r["recall"], r["f1"], r["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_rank_test_p_value(spark):
    a, b = [1.1, 2.2, 2.2, 3.5, 9.0], [2.2, 4.0, 5.0, 6.0, 7.0, 8.0]
    rows = [(1, x) for x in a] + [(0, x) for x in b]
    r = evaluate.rank_test_p(spark.createDataFrame(rows, "isFraud int, v double"), ["v"]).first()
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    assert r["u"] == pytest.approx(u)
    n1, n0, ties = 5, 6, 3**3 - 3
    sigma = math.sqrt(n1 * n0 / 12 * (12 - ties / (11 * 10)))
    z = (max(u, 30 - u) - 15 - 0.5) / sigma
    assert r["p_value"] == pytest.approx(math.erfc(z / math.sqrt(2)))


def test_drift_share_of_close_samples(spark):
    rng = np.random.default_rng(42)
    ref = spark.createDataFrame([(float(a), float(b)) for a, b in zip(rng.normal(0, 1, 100), rng.normal(5, 2, 100))], "feature1 double, feature2 double")
    cur = spark.createDataFrame([(float(a), float(b)) for a, b in zip(rng.normal(0.1, 1, 100), rng.normal(5.5, 2, 100))], "feature1 double, feature2 double")
    r = monitor.drift_share(monitor.numeric_drift(ref, cur, ["feature1", "feature2"])).first()
    assert r["share"] < 0.6 and r["columns"] == 2
    far = monitor.numeric_drift(ref, ref.select((F.col("feature1") + 9).alias("feature1"), "feature2"), ["feature1", "feature2"])
    assert {x["column"]: x["drifted"] for x in far.collect()} == {"feature1": 1, "feature2": 0}


def test_score_drift_of_equal_sets_is_zero(spark):
    df = spark.createDataFrame([(i / 100,) for i in range(100)], "p double")
    assert monitor.score_drift(df, df).first()["drift"] == pytest.approx(0.0)


def test_duplicates_and_missing(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (None, "x")], "a int, b string")
    assert tuple(monitor.data_quality(df).first()) == (4, 1, 3, 3 / 8)


def test_itemsets_equal_the_library_miner(spark, sf_dir):
    from pyspark.ml.fpm import FPGrowth

    from riskspark.queries.feature_queries import labelled_baskets

    baskets = labelled_baskets(spark, sf_dir).select("items")
    mine = {tuple(r["items"]): r["freq"] for r in rules.frequent_itemsets(baskets, 0.02).collect()}
    lib = {tuple(sorted(r["items"])): r["freq"] for r in FPGrowth(minSupport=0.02).fit(baskets).freqItemsets.collect()}
    assert mine == lib


def test_split_sizes(spark):
    df = spark.createDataFrame([(i, i // 2, int(i % 10 == 0)) for i in range(101)], "id bigint, t bigint, isFraud int")
    parts = {r["part"]: r["count"] for r in resample.chronological_split(df, "t", "id").groupBy("part").count().collect()}
    assert parts == {"train": 70, "val": 15, "test": 16}
    folds = resample.assign_folds(df, "id", 5, "isFraud").groupBy("isFraud", "fold").count().collect()
    assert {r["count"] for r in folds if r["isFraud"] == 0} == {18} and {r["count"] for r in folds if r["isFraud"] == 1} == {2, 3}
    under = {r["isFraud"]: r["count"] for r in resample.undersample(df, "id", "isFraud").groupBy("isFraud").count().collect()}
    assert under == {1: 11, 0: 22}


def test_records_and_checks(spark):
    lines = spark.createDataFrame([('{"TransactionAmt":100}',), ('{"card1":3}',), ('{"TransactionAmt":1,"x":2,"P_emaildomain":"a"}',)], "line string")
    assert [tuple(r) for r in tables.parse_records(lines, "line").collect()] == [(100.0, 0.0, 0.0, 0.0, ""), (1.0, 0.0, 0.0, 0.0, "a")]
    with pytest.raises(ValueError, match="absent"):
        tables.check_table(lines, ["isFraud"], None)


def test_samples_and_folds_keep_rows_without_label(spark):
    from riskspark.operators import resample

    df = spark.createDataFrame([(i, None if i % 10 == 0 else i % 3) for i in range(100)], "id bigint, y int")
    folds = resample.assign_folds(df, "id", 4, "y").collect()
    assert sorted(r["id"] for r in folds) == list(range(100))
    for y in (None, 0, 1, 2):
        sizes = [sum(r["y"] == y and r["fold"] == f for r in folds) for f in range(4)]
        assert max(sizes) - min(sizes) <= 1
    parts = resample.stratified_split(df, "id", "y").collect()
    assert sum(r["part"] == "train" and r["y"] is None for r in parts) == 8
    for n in (7, 50, 99, 100, 500):
        assert resample.stratified_sample(df, "id", "y", n).count() == min(n, 100)
    assert resample.stratified_sample(df.limit(0), "id", "y", 5).count() == 0
