"""Neighbours, representation, calibration, forecast and registry."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.sql import functions as F

from riskspark.operators import models as M
from riskspark.operators import neighbours, represent, stages, timeseries
from riskspark.queries import model_queries as Q
from riskspark.sources import tables
from riskspark.sources.views import scored, txn


@pytest.fixture(scope="module")
def points(spark):
    """Clusters of points; a third of them are copies of one point."""
    rng = np.random.default_rng(2)
    x = np.vstack([rng.normal(c, 0.3, (60, 3)) for c in (0, 5, -4)])
    x = np.vstack([x, np.repeat(x[:1], 90, axis=0)]).round(3)
    rows = [(i, [float(v) for v in p], int(i % 6 == 0)) for i, p in enumerate(x)]
    return x, spark.createDataFrame(rows, "id bigint, x array<double>, y int").repartition(6)


def brute(x, q, k, skip_self):
    d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
    order = [i for i in sorted(range(len(x)), key=lambda i: (d[i], i)) if not (skip_self and i == q)]
    return order[:k]


@pytest.mark.parametrize("block,pivots", [(1024, 8), (16, 4), (7, 1)])
def test_knn_join_is_exact(points, block, pivots):
    x, df = points
    got = neighbours.knn_join(df, df, 4, "id", "x", exclude_self=True, block=block, pivots=pivots, sample=20).collect()
    near = {}
    for r in sorted(got, key=lambda r: (r["q"], r["place"])):
        near.setdefault(r["q"], []).append(r["nn"])
    assert near == {i: brute(x, i, 4, True) for i in range(len(x))}


def test_smote_size_and_hull(points):
    x, df = points
    made = neighbours.smote(df, "id", "x", F.col("y") == 1, 0.5).collect()
    n_min = sum(i % 6 == 0 for i in range(len(x)))
    assert len(made) == int(0.5 * (len(x) - n_min)) - n_min
    for r in made:
        a, b, v = x[r["id"]], x[r["nn"]], np.array(r["x"])
        assert r["id"] % 6 == 0 and r["nn"] % 6 == 0
        assert np.all(v >= np.minimum(a, b) - 1e-9) and np.all(v <= np.maximum(a, b) + 1e-9)


def test_pca_matches_eigenvectors(spark, points):
    x, df = points
    flat = df.select("id", *[F.col("x")[i].alias(f"c{i}") for i in range(3)])
    pca = represent.fit_pca(flat, ["c0", "c1", "c2"], 2)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    shares = values[::-1] / values.sum()
    assert pca["shares"] == pytest.approx(list(shares[:2]))
    got = np.array([[r["pca_comp_1"], r["pca_comp_2"]] for r in represent.apply_pca(flat, pca).orderBy("id").collect()])
    want = z @ vectors[:, ::-1][:, :2]
    assert np.abs(got) == pytest.approx(np.abs(want), abs=1e-8)


def test_clusters_cover_all_rows(spark, points):
    x, df = points
    flat = df.select("id", *[F.col("x")[i].alias(f"c{i}") for i in range(3)])
    c = represent.fit_clusters(flat, ["c0", "c1", "c2"], 3, restarts=3)
    assert c["centres"] == sorted(c["centres"])
    got = {r["cluster_label"]: r["count"] for r in represent.apply_clusters(flat, c).groupBy("cluster_label").count().collect()}
    assert got == {0: 60, 1: 150, 2: 60}


def test_all_restarts_in_one_scan_are_the_best_single_run(spark, monkeypatch):
    """Every run as plain numpy from the same first centres; the one of least cost is the result."""
    r = np.random.default_rng(4)
    x = np.vstack([r.normal(c, 1.0, (80, 2)) for c in ((0, 0), (4, 1), (1, 5), (6, 6))]).round(2)
    x[:60] = x[0]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in x], "a double, b double").repartition(5)
    starts = []
    kept = represent.first_centres
    monkeypatch.setattr(represent, "first_centres", lambda *a: starts.append(kept(*a)) or starts[-1])
    got = represent.fit_clusters(df, ["a", "b"], 9, restarts=6)
    assert len(starts) == 6
    runs = []
    for c in starts:
        for _ in range(300):
            near = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
            moved = np.array([x[near == j].mean(0) if (near == j).any() else c[j] for j in range(len(c))])
            still = ((moved - c) ** 2).sum(1).max() <= 1e-8
            c = moved
            if still:
                break
        runs.append((((x[:, None] - c[None]) ** 2).sum(2).min(1).sum(), sorted(c.tolist())))
    cost, centres = min(runs)
    assert got["cost"] == pytest.approx(cost) and np.array(got["centres"]) == pytest.approx(np.array(centres))
    assert len({round(c, 6) for c, _ in runs}) > 1


def test_cells_give_the_sums_of_all_rows_and_leave_few_to_measure(spark):
    """Sums by cells against every row measured, for even, repeated and missing values; most rows are counted by whole cells."""
    r = np.random.default_rng(7)
    for x in (r.normal(0, 1, (20_000, 2)), np.column_stack((r.integers(0, 3, 9_001), r.integers(0, 2_000_000, 9_001))).astype(float), np.ones((130, 3)),
              np.vstack((r.normal(0, 1, (500, 2)), [[np.nan, 1.0], [np.inf, 0.0]]))):
        x = x[represent.near_order(x)]
        cells, centres = represent.cell_table(x), x[:: max(1, len(x) // 6)][:5]
        with np.errstate(invalid="ignore"):
            gap = ((x[:, None] - centres[None]) ** 2).sum(2)
        near = gap.argmin(1)
        want = np.array([[*x[near == j].sum(0), (near == j).sum(), gap[near == j, j].sum()] for j in range(len(centres))])
        assert represent.block_sums(cells, x, centres) == pytest.approx(want, rel=1e-9, nan_ok=True)
        if len(x) > 9_000:
            assert cells[represent.whole_cells(cells, centres)[1], -1].sum() > 0.6 * len(x)


def test_centres_move_over_cells_in_memory_that_are_given_back(spark, monkeypatch):
    r = np.random.default_rng(12)
    df = spark.createDataFrame(r.random((500, 2)).tolist(), "a double, b double")
    scan, seen = represent._centre_sums, []

    def counted(packed, sets):
        seen.append((packed, packed.storageLevel.useMemory and packed.storageLevel.useDisk))
        return scan(packed, sets)

    monkeypatch.setattr(represent, "_centre_sums", counted)
    represent.fit_clusters(df, ["a", "b"], 5, restarts=2)
    assert len(seen) > 2 and all(kept for _, kept in seen)
    assert not seen[0][0].storageLevel.useMemory


def test_a_labelled_batch_is_scored_once(spark):
    """The scores and their metrics come from one run of the chain."""
    runs = spark.sparkContext.accumulator(0)
    rows = spark.range(50).select(F.col("id"), (F.col("id") % 2).cast("int").alias("isFraud"), F.col("id").cast("double").alias("x"))
    model = M.logistic(M.assemble(rows, ["x"]))

    class Counting(Transformer):
        def _transform(self, df):
            @F.udf("double")
            def passed(v):
                runs.add(1)
                return v

            return df.withColumn("x", passed("x"))

    got, metrics = M.score_batch(PipelineModel([Counting(), model]), rows, ["x"], "id")
    assert got.count() == 50 and metrics.count() == 1 and got.agg(F.sum("probability")).first()[0] > 0
    assert runs.value == 50


def test_fewer_rows_than_centres(spark):
    df = spark.createDataFrame([(1.0, None)] * 5 + [(2.0, 3.0)], "a double, b double")
    got = represent.fit_clusters(df, ["a", "b"], 4, restarts=2)
    assert got["centres"] == [[1.0, 0.0], [2.0, 3.0]] and got["cost"] == 0
    with pytest.raises(ValueError):
        represent.fit_clusters(df.limit(0), ["a", "b"])


def test_isotonic_is_monotone(spark, sf_dir):
    s = scored(spark, sf_dir).withColumn("label", F.col("isFraud").cast("double"))
    out = M.apply_isotonic(M.isotonic(s), s, out="c").select("p", "c").distinct().orderBy("p").collect()
    c = [r["c"] for r in out]
    assert c == sorted(c) and 0 <= c[0] and c[-1] <= 1


@pytest.mark.parametrize("together", [2, 16])
def test_isotonic_by_ranges_is_the_sequential_fit(spark, together):
    """Ties, gaps and copies, over many ranges of scores."""
    r = np.random.default_rng(5)
    p = np.round(r.random(900), 2)
    y = (r.random(900) < p**2).astype(float)
    p[:200], y[:200] = 0.31, 1.0
    rows = [(float(a), float(b)) for a, b in zip(p, y)] + [(None, 1.0), (float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "p double, label double").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = M.isotonic(df, together=together).state["blocks"]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    x = np.unique(p)
    s, n = (np.array([f(y[p == v]) for v in x], dtype=float) for f in (sum, len))
    low, high, total, count = M.pool(x.tolist(), x.tolist(), s.tolist(), n.tolist())
    assert got == [[a, b, c / d] for a, b, c, d in zip(low, high, total, count)]
    for a, b, v in got:
        i = np.searchsorted(x, a)
        want = max(min(s[j : k + 1].sum() / n[j : k + 1].sum() for k in range(i, len(x))) for j in range(i + 1))
        assert v == pytest.approx(want, abs=1e-12)
    out = {r["p"]: r["c"] for r in M.apply_isotonic(M.IsotonicMap({"blocks": got}), df, "p", "c").collect()}
    assert out[None] is None and out[0.31] == next(v for a, b, v in got if a <= 0.31 <= b)
    none = M.isotonic(df.limit(0))
    assert {r["c"] for r in M.apply_isotonic(none, df, "p", "c").collect()} == {None}


def test_ridge_matches_normal_equations(spark, sf_dir):
    series = timeseries.hourly(txn(spark, sf_dir))
    got = M.ridge_forecast(series).orderBy("hour_window").collect()
    cols = [f"lag_{i}" for i in range(1, 7)] + ["hour_sin", "hour_cos", "day_sin", "day_cos"]
    frame = timeseries.lag_frame(series).orderBy("hour_window").select(*cols, "target").toPandas().to_numpy(dtype=float)
    n = int(0.8 * len(frame))
    x, y = frame[:n, :-1], frame[:n, -1]
    std = x.std(axis=0)
    std[std == 0] = 1
    z = (x - x.mean(axis=0)) / std
    beta = np.linalg.solve(z.T @ z + np.eye(10), z.T @ (y - y.mean()))
    want = np.maximum(0, y.mean() + (frame[:, :-1] - x.mean(axis=0)) / std @ beta)
    assert np.array([r["predicted"] for r in got]) == pytest.approx(want, abs=1e-8)
    assert [r["part"] for r in got] == ["train"] * n + ["test"] * (len(frame) - n)


def test_ensemble_and_stack(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b), int(a + b + rng.normal(0, 0.5) > 0)) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))]
    df = M.assemble(spark.createDataFrame(rows, "id bigint, a double, b double, isFraud int"), ["a", "b"])
    train, val, test = (df.where(f"id % 3 = {k}") for k in range(3))
    fitters = {"lr": lambda t: M.logistic(t), "rf": lambda t: M.random_forest(t, trees=5, depth=3)}
    e = M.WeightedEnsemble(fitters).fit(train, val)
    assert sum(e.weights.values()) == pytest.approx(1.0)
    out = e.transform(test).select("p", "prediction").collect()
    assert all(0 <= r["p"] <= 1 and r["prediction"] in (0, 1) for r in out)
    oof, held = M.stack(train, test, fitters, "id", folds=2)
    assert oof.count() == train.count() and held.count() == test.count()
    assert M.all_metrics(held, "stack").first()["auc_roc"] > 0.8


def test_registry_and_run_log(spark, sf_dir, tmp_path):
    t = txn(spark, sf_dir).drop("k")
    root = str(tmp_path / "models")
    for version in ("v1", "v2"):
        tables.save_model(spark, Pipeline(stages=[stages.RuleRiskScore(), stages.FrequencyEncoder(columns=["ProductCD"])]).fit(t), root, version)
    assert [r["version"] for r in tables.list_models(spark, root).collect()] == ["v2", "v1"]
    assert tables.active_version(spark, root) == "v2"
    tables.activate_model(spark, root, "v1")
    assert "association_risk_score" in tables.load_active(spark, root).transform(t).columns
    with pytest.raises(ValueError):
        tables.activate_model(spark, root, "v9")
    log = str(tmp_path / "runs")
    tables.append_run(spark, log, {"version": "v1", "model_type": "GBT", "precision": 0.5})
    assert tables.read_runs(spark, log).select("version", "recall").first() == ("v1", "")


def test_gate_raises(spark):
    bad = spark.createDataFrame([(0.2,)], "auc_pr double")
    with pytest.raises(ValueError):
        M.require_quality(bad)
    assert M.quality_gate(bad).first()["passes"] == 0


def test_hashed_candidates_find_the_neighbours(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16)) * 3
    x = centres[rng.integers(0, 12, 800)] + rng.normal(size=(800, 16))
    x[1::2] = x[1]  # one vector in half of the rows
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, x array<double>")
    def pairs(**options):
        return {(r["q"], r["place"]): r["dist"] for r in neighbours.knn_join(df, df, 5, "id", "x", exclude_self=True, **options).collect()}
    exact, hashed = pairs(), pairs(method="hashed", block=64)
    assert exact.keys() == hashed.keys() and len(exact) == 4000
    assert np.mean([abs(hashed[k] - d) < 1e-9 for k, d in exact.items()]) >= 0.9
    assert all(hashed[k] >= d - 1e-9 for k, d in exact.items())
    votes = neighbours.knn_classify(df, df, 5, "id", "x", F.col("id") % 2 == 1, method="hashed", block=64)
    assert votes.count() == 800


def test_model_queries_use_the_operators_sizes(monkeypatch):
    """Forests, boosted trees, folds and trials are the operators' own; the comparison has the six of the matrix beside four others."""
    calls = []

    class Stop(Exception):
        pass

    def note(name):
        def run(*args, **kwargs):
            calls.append((name, args, kwargs))
            raise Stop
        return run

    monkeypatch.setattr(Q, "frame", lambda spark, d: ("train", "val", "test"))
    for name in ("stack", "search", "boosted_trees", "WeightedEnsemble"):
        monkeypatch.setattr(M, name, note(name))
    for fn in (Q.ml01, Q.ml08, Q.ml09, Q.ml12):
        with pytest.raises(Stop):
            fn(None, None)
    boosted, stack, ensemble, search = calls
    assert boosted[1:] == (("train",), {})
    assert stack[1][2]["rf"] is M.random_forest and stack[2] == {} and len(stack[1]) == 4
    assert ensemble[1][0]["rf"] is M.random_forest
    assert search[2] == {} and set(search[1][2]) == {"rounds", "depth", "step", "min_weight", "subsample", "columns"}
    monkeypatch.setattr(Q, "synthetic_balance", lambda train: "balanced")
    monkeypatch.setattr(Q, "advanced", lambda train, test: (f"{train}+", f"{test}+"))
    runs = {n: (f.keywords["max_iter"], f.keywords["depth"], f.keywords["balanced"], a, b) for n, (f, a, b) in Q.matrix("train", "test").items()}
    assert runs == {
        "baseline balanced": (100, 6, False, "balanced", "test"), "advanced balanced": (100, 6, False, "balanced+", "test+"),
        "champion balanced": (400, 9, False, "balanced+", "test+"), "baseline original": (100, 6, True, "train", "test"),
        "advanced original": (100, 6, True, "train+", "test+"), "champion original": (400, 9, True, "train+", "test+"),
    }


def test_balanced_rows_of_the_comparison(spark):
    rows = [(i, int(i % 20 == 0), float(i % 7), float(i % 11)) for i in range(400)]
    train = M.assemble(spark.createDataFrame(rows, "TransactionID bigint, isFraud int, a double, b double"), ["a", "b"])
    got = {r["label"]: r["count"] for r in Q.synthetic_balance(train).groupBy("label").count().collect()}
    assert got == {1.0: 76, 0.0: 152}  # a fifth of 380 negatives, then two negatives for each positive


@pytest.mark.parametrize("shift,digits", [(0.0, 2), (1e6, 0)])
def test_block_search_by_products_is_the_exact_order(shift, digits):
    """Distances by a matrix product only choose what is measured: ids, ties and distances are those of plain sums."""
    import pandas as pd

    r = np.random.default_rng(8)
    asked, points = (np.unique(r.normal(size=(n, 3)).round(digits), axis=0) + shift for n in (300, 400))
    free = iter(r.permutation(4 * len(points)).tolist())
    ids = [sorted(next(free) for _ in range(1 + i % 3)) for i in range(len(points))]
    got = neighbours._best(4)(pd.DataFrame({"x": list(asked)}), pd.DataFrame({"x": list(points), "ids": ids}))
    dist = neighbours._distances(asked, points)
    want = [sorted((d, i) for d, some in zip(row, ids) for i in some)[:4] for row in dist]
    assert list(zip(got["dist"], got["nn"])) == [p for row in want for p in row]
    kth = np.sort(dist, axis=1)[:, 3]
    bound = neighbours._bound(asked, points, 4)
    assert (bound >= kth).all() and bound == pytest.approx(kth, rel=1e-5, abs=0.5 if shift else 1e-5)


def test_a_block_measures_few_pairs():
    r = np.random.default_rng(9)
    i, _, _ = neighbours._near_pairs(r.normal(size=(100, 16)), r.normal(size=(500, 16)), 5)
    assert len(i) == 500


def test_a_fit_of_many_rows_is_dealt_to_tasks(spark, monkeypatch):
    monkeypatch.setattr(M, "TASK_ROWS", 100)
    df = spark.range(450).select("id", (F.col("id") % 2).cast("double").alias("label")).coalesce(1)
    made = M.dealt(df)
    assert made.rdd.getNumPartitions() == 5 and made.count() == 450 and made.distinct().count() == 450
    assert M.dealt(df.limit(90)).rdd.getNumPartitions() == 1


def test_blocks_grow_and_cells_join_before_vectors_are_copied_often(spark, monkeypatch):
    """Of points that distances do not tell apart, few copies are made, and the neighbours are still exact."""
    side, bundle = neighbours._bundles([20_000] * 32, [640_000] * 32, 4096)
    assert side == 65_536 and max(bundle) == 10
    assert neighbours._bundles([20_000] * 32, [25_000] * 32, 4096)[1] == list(range(32))
    r = np.random.default_rng(6)
    x = r.normal(size=(240, 12)).round(2)
    x[5] = x[9]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, x array<double>").repartition(4)
    monkeypatch.setattr(neighbours, "COPIES", 4)
    seen = []
    kept = neighbours._bundles
    monkeypatch.setattr(neighbours, "_bundles", lambda *a: seen.append(kept(*a)) or seen[-1])
    got = {}
    for row in sorted(neighbours.knn_join(df, df, 4, "id", "x", exclude_self=True, block=4, pivots=8, sample=20).collect(), key=lambda row: (row["q"], row["place"])):
        got.setdefault(row["q"], []).append(row["nn"])
    assert got == {i: brute(x, i, 4, True) for i in range(len(x))}
    assert seen[0][0] > 4 and len(set(seen[0][1])) < 8


def test_single_precision_only_where_nothing_is_lost(spark):
    one, two = (spark.createDataFrame([(v,)], "x array<double>") for v in ([0.5, 0.25], [0.1, float("nan")]))
    assert [f.schema["x"].dataType.simpleString() for f in neighbours._narrow(one, one)] == ["array<float>"] * 2
    assert [f.schema["x"].dataType.simpleString() for f in neighbours._narrow(one, two)] == ["array<double>"] * 2
