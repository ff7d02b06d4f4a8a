"""Models, ensembles, calibration and scoring on the transaction features."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import partial, reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators import boosting
from riskspark.operators import evaluate as E
from riskspark.operators import models as M
from riskspark.operators import neighbours, resample, stages, timeseries
from riskspark.plans.scratch import persist_table, scratch_path
from riskspark.queries.profile_queries import rounded
from riskspark.queries.quality_queries import _CURVE
from riskspark.queries.registry import query
from riskspark.sources import tables as IO
from riskspark.sources.views import scored, txn, vectors

FEATURES = ["TransactionAmt", "card1", "addr1", "dist1", "dist1_null", "hour", "dow", "user_count", "Amt_to_Median_User", "ProductCD_freq"]


def feature_steps():
    return [stages.FrequencyEncoder(columns=["ProductCD"]), stages.BehaviorFeatures()]


def frame(spark, d):
    """(train, val, test) by time; features fitted on train only."""
    t = txn(spark, d).drop("k")
    parts = persist_table(resample.chronological_split(t, "TransactionDT", "TransactionID"), "parts")
    model = Pipeline(stages=feature_steps()).fit(parts.where(F.col("part") == "train").drop("part"))
    made = model.transform(parts).select("TransactionID", "isFraud", "part", *FEATURES)
    made = persist_table(M.assemble(made, FEATURES).select("TransactionID", "isFraud", "part", "label", "features"), "frame")
    return tuple(made.where(F.col("part") == p).drop("part") for p in ("train", "val", "test"))


def plain_logistic(train):
    return M.logistic(train, balanced=True)


@query("ml01_boosted_trees")
def ml01(spark, d):
    train, _, test = frame(spark, d)
    return M.all_metrics(M.score(M.boosted_trees(train), test), "boosted trees")


@query("ml01_first_split", """
WITH l AS (SELECT isFraud AS y, unnest([1, 2, 3]) AS c, unnest([TransactionAmt, CAST(card1 AS DOUBLE), dist1]) AS v FROM txn),
e AS (SELECT DISTINCT c, unnest(quantile_cont(v, [0.0625, 0.125, 0.1875, 0.25, 0.3125, 0.375, 0.4375, 0.5, 0.5625, 0.625, 0.6875, 0.75, 0.8125, 0.875, 0.9375])) AS edge FROM l GROUP BY c),
b AS (SELECT 1 / (1 + exp(-round(ln(sum(isFraud) / sum(1 - isFraud)), 12))) AS p FROM txn),
u AS (SELECT c, v, CASE WHEN y = 1 THEN round((p - 1) * 16777216) ELSE round(p * 16777216) END AS g, round(p * (1 - p) * 16777216) AS h FROM l, b),
t AS (SELECT c, sum(g) / 16777216 AS g, sum(h) / 16777216 AS h FROM u GROUP BY c),
s AS (SELECT e.c, edge, m, sum(u.g) FILTER (v <= edge OR (v IS NULL AND m = 1)) / 16777216 AS gl, sum(u.h) FILTER (v <= edge OR (v IS NULL AND m = 1)) / 16777216 AS hl
  FROM (SELECT * FROM e UNION ALL SELECT DISTINCT c, 'infinity'::DOUBLE FROM e) e JOIN u USING (c), (SELECT unnest([0, 1]) AS m) GROUP BY ALL),
g AS (SELECT c, edge, m, gl, hl, t.g - gl AS gr, t.h - hl AS hr, gl * gl / (hl + 1) + (t.g - gl) ** 2 / (t.h - hl + 1) - t.g * t.g / (t.h + 1) AS gain
  FROM s JOIN t USING (c) WHERE hl >= 1 AND t.h - hl >= 1)
SELECT CAST(c - 1 AS INT) AS feature, round(edge, 6) AS edge, m AS missing_left, round(-0.1 * gl / (hl + 1), 9) AS left_value, round(-0.1 * gr / (hr + 1), 9) AS right_value
FROM g ORDER BY round(gain, 9) DESC, c, edge, m LIMIT 1""", "txn")
def ml01_first_split(spark, d):
    """The root of the first tree on three raw columns, one with gaps, and the values of its two leaves."""
    t = txn(spark, d)
    x = F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in ("TransactionAmt", "card1", "dist1")])
    made = t.select(array_to_vector(x).alias("features"), F.col("isFraud").cast("double").alias("label"))
    model = boosting.fit(made, boosting.Setting(rounds=1, depth=1, step=0.1, subsample=1.0, columns=1.0), bins=16)
    tree, edges = model.trees()[0], model.state["edges"]
    cuts = [*edges[tree.column[0]], float("inf")]
    row = (tree.column[0], round(cuts[tree.cut[0] - 1], 6), tree.missing[0], round(tree.value[1], 9), round(tree.value[2], 9))
    return spark.createDataFrame([row], "feature int, edge double, missing_left int, left_value double, right_value double")


@query("ml02_random_forest")
def ml02(spark, d):
    train, _, test = frame(spark, d)
    return M.all_metrics(M.score(M.random_forest(train, balanced=True), test), "random forest")


@query("ml03_logistic_regression")
def ml03(spark, d):
    train, _, test = frame(spark, d)
    return M.all_metrics(M.score(plain_logistic(train), test), "logistic regression")


@query("ml04_linear_svm")
def ml04(spark, d):
    train, _, test = frame(spark, d)
    model, calibration = M.linear_svm(train)
    return M.all_metrics(M.apply_platt(calibration, M.svm_margin(model, test), "margin"), "linear svm")


def rings(spark, d):
    """(train, test) of card rows by hash of the id; the label is whether amount and balance lie inside an ellipse, which no line can cut out."""
    t = txn(spark, d).where("dist1 is not null")
    r = t.agg(*[f(c) for c in ("TransactionAmt", "dist1") for f in (F.avg, F.stddev_pop)]).first()
    u, v = (F.col("TransactionAmt") - r[0]) / r[1], (F.col("dist1") - r[2]) / r[3]
    made = t.select("TransactionID", u.alias("u"), v.alias("v"), (u * u + v * v < 0.8).cast("int").alias("isFraud"))
    made = persist_table(M.assemble(made, ["u", "v"]).select("TransactionID", "isFraud", "label", "features"), "rings")
    return made.where("TransactionID % 5 <> 0"), made.where("TransactionID % 5 = 0")


_RINGS_SQL = """
WITH t AS (SELECT TransactionID, TransactionAmt AS a, dist1 AS b FROM txn WHERE dist1 IS NOT NULL), r AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb FROM t)
SELECT {model} AS model, count(*) AS n_rows, CAST(sum(CAST(((a - ma) / sa) ** 2 + ((b - mb) / sb) ** 2 < 0.8 AS INT)) AS BIGINT) AS positives, 1 AS ids_once, 1 AS in_range, {better} AS better_than_chance
FROM t, r WHERE TransactionID % 5 = 0"""


def checked(scored, name, margin=0.2):
    """One row on a scored test table: every id once, chances in range, and a ROC area of at least one half plus ``margin``."""
    held = persist_table(scored.select("TransactionID", "isFraud", "p"), "checked")
    area = E.ranking_metrics(held).first()["auc_roc"]
    return held.agg(F.lit(name).alias("model"), F.count("*").alias("n_rows"), F.sum("isFraud").cast("bigint").alias("positives"),
                    (F.count("*") == F.countDistinct("TransactionID")).cast("int").alias("ids_once"), F.min(F.col("p").between(0, 1).cast("int")).alias("in_range"),
                    F.lit(int(area >= 0.5 + margin)).alias("better_than_chance"))


@query("ml04_kernel_svm", " UNION ALL ".join(_RINGS_SQL.strip().replace("WITH ", "SELECT * FROM (WITH ").format(model=f"'{m}'", better=b) + ")" for m, b in (("kernel", 1), ("linear", 0))), "txn")
def ml04_kernel(spark, d):
    """The kernel machine finds the ellipse with a ROC area of at least .9; linear support vectors stay within .2 of chance."""
    train, test = rings(spark, d)
    curved = checked(M.score(M.kernel_svm(train), test), "kernel", 0.4)
    model, calibration = M.linear_svm(train)
    return curved.unionByName(checked(M.apply_platt(calibration, M.svm_margin(model, test), "margin"), "linear"))


@query("ml02_forest_check", _RINGS_SQL.format(model="'forest'", better=1), "txn")
def ml02_check(spark, d):
    train, test = rings(spark, d)
    return checked(M.score(M.random_forest(train, balanced=True), test), "forest", 0.4)


@query("ml01_boosted_check", _RINGS_SQL.format(model="'boosted'", better=1), "txn")
def ml01_check(spark, d):
    train, test = rings(spark, d)
    return checked(M.score(M.boosted_trees(train), test), "boosted", 0.4)


@query("ml06_network_check", _RINGS_SQL.format(model="'network'", better=1), "txn")
def ml06_check(spark, d):
    train, test = rings(spark, d)
    return checked(M.score(M.dense_network(train, 2), test), "network", 0.3)


@query("ml08_stacking_refit", " UNION ALL ".join(_RINGS_SQL.strip().replace("WITH ", "SELECT * FROM (WITH ").replace("% 5 = 0", f"% 5 {op} 0").format(model=f"'{m}'", better=1) + ")" for m, op in (("out of fold", "<>"), ("refit", "="))), "txn")
def ml08_refit(spark, d):
    """Boosted trees and a logistic base below a logistic meta model; the test rows are scored by bases refitted on all training rows."""
    train, test = rings(spark, d)
    oof, held = M.stack(train, test, {"lr": plain_logistic, "gbt": lambda t: M.boosted_trees(t, 100, 6, 0.1)}, "TransactionID", refit=True)
    return checked(oof, "out of fold", 0.4).unionByName(checked(held, "refit", 0.4))


@query("ml05_knn_classifier", """
WITH h AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42:' || vec_id), vec_id) - 1 AS rk, count(*) OVER (PARTITION BY label) AS nc FROM vectors),
s AS (SELECT *, rk < floor(0.8::DOUBLE * nc) AS tr FROM h),
p AS (SELECT a.vec_id AS q, b.label AS l, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.x, b.x), b.vec_id) AS place FROM s a JOIN s b ON NOT a.tr AND b.tr)
SELECT q, round(avg(CAST(l = 0 AS INT)), 6) AS p FROM p WHERE place <= 5 GROUP BY 1""", "vectors")
def ml05(spark, d):
    v = persist_table(resample.stratified_split(vectors(spark, d), "vec_id", "label"), "vectors")
    known, asked = v.where(F.col("part") == "train"), v.where(F.col("part") == "test")
    return rounded(neighbours.knn_classify(asked, known, 5, "vec_id", "x", F.col("label") == 0), "p")


@query("ml06_dense_network")
def ml06(spark, d):
    v = persist_table(resample.stratified_split(vectors(spark, d).withColumn("isFraud", (F.col("label") == 0).cast("int")).drop("label"), "vec_id", "isFraud"), "dense")
    flat = v.select("vec_id", "isFraud", "part", *[F.col("x")[i].alias(f"x{i}") for i in range(64)])
    ready = M.assemble(flat, [f"x{i}" for i in range(64)])
    model = M.dense_network(ready.where(F.col("part") == "train"), 64)
    return M.all_metrics(M.score(model, ready.where(F.col("part") == "test")), "dense network")


@query("ml07_ridge_forecast")
def ml07(spark, d):
    return M.ridge_forecast(timeseries.hourly(txn(spark, d)))


@query("ml07_forecast_frame", """
WITH l AS (SELECT hour_window, lag(fraud_count, 6) OVER w AS l6, lead(fraud_count) OVER w AS target FROM hourly WINDOW w AS (ORDER BY hour_window)),
k AS (SELECT *, row_number() OVER (ORDER BY hour_window) AS rn, count(*) OVER () AS n FROM l WHERE l6 IS NOT NULL AND target IS NOT NULL)
SELECT hour_window, CAST(target AS DOUBLE) AS actual, CASE WHEN rn <= floor(0.8::DOUBLE * n) THEN 'train' ELSE 'test' END AS part FROM k""", "hourly")
def ml07_frame(spark, d):
    return M.ridge_forecast(timeseries.hourly(txn(spark, d))).select("hour_window", "actual", "part")


@query("ml07_forecast_metrics")
def ml07_metrics(spark, d):
    f = M.ridge_forecast(timeseries.hourly(txn(spark, d)))
    return E.regression_metrics(f.where(F.col("part") == "test"), "actual", "predicted")


@query("ml08_stacking")
def ml08(spark, d):
    train, _, test = frame(spark, d)
    oof, held = M.stack(train, test, {"lr": plain_logistic, "rf": M.random_forest}, "TransactionID")
    return M.all_metrics(oof, "stack out of fold").unionByName(M.all_metrics(held, "stack test"))


@query("ml09_weighted_ensemble")
def ml09(spark, d):
    train, val, test = frame(spark, d)
    e = M.WeightedEnsemble({"lr": plain_logistic, "rf": M.random_forest}).fit(train, val)
    return M.all_metrics(e.transform(test), "weighted ensemble", threshold=e.threshold)


def rounded_at(df, column, digits):
    return df.withColumn(column, F.round(column, digits))


def _labelled(spark, d):
    return scored(spark, d).withColumn("label", F.col("isFraud").cast("double"))


@query("ml10_isotonic")
def ml10(spark, d):
    s = _labelled(spark, d)
    out = M.apply_isotonic(M.isotonic(s), s, out="calibrated")
    return out.groupBy("p").agg(F.max("calibrated").alias("calibrated"), F.count("*").alias("n"))


@query("ml10_isotonic_values", """
WITH g AS (SELECT p, sum(isFraud)::DOUBLE AS s, count(*) AS n FROM scored GROUP BY p),
j AS (SELECT a.p AS low, b.p AS high, sum(c.s) / sum(c.n) AS mean FROM g a JOIN g b ON b.p >= a.p JOIN g c ON c.p BETWEEN a.p AND b.p GROUP BY ALL),
k AS (SELECT g.p, low, min(mean) AS least FROM g JOIN j ON j.low <= g.p AND j.high >= g.p GROUP BY ALL)
SELECT k.p, round(max(least), 9) AS calibrated, any_value(n) AS n FROM k JOIN g ON k.p = g.p GROUP BY k.p""", "scored")
def ml10_values(spark, d):
    """Every value of the monotone fit: the largest over all starts of the smallest mean over all ends."""
    return rounded_at(ml10(spark, d), "calibrated", 9)


@query("ml11_platt")
def ml11(spark, d):
    s = _labelled(spark, d)
    out = M.apply_platt(M.platt(s), s, out="calibrated")
    return out.groupBy("p").agg(F.max("calibrated").alias("calibrated"), F.count("*").alias("n"))


@query("ml10_isotonic_check", "SELECT count(DISTINCT p) AS n_scores, 1 AS rising, 1 AS in_range, round(avg(isFraud), 6) AS mean FROM scored", "scored")
def ml10_check(spark, d):
    """A monotone fit rises with the score and keeps the mean of the label."""
    by = ml10(spark, d).withColumn("before", F.lag("calibrated").over(Window.orderBy("p")))
    return by.agg(F.count("*").alias("n_scores"), F.min(F.coalesce(F.col("calibrated") >= F.col("before") - 1e-12, F.lit(True)).cast("int")).alias("rising"),
                  F.min(F.col("calibrated").between(0, 1).cast("int")).alias("in_range"), F.round(F.sum(F.col("calibrated") * F.col("n")) / F.sum("n"), 6).alias("mean"))


@query("ml11_platt_check", "SELECT count(DISTINCT p) AS n_scores, 1 AS rising, 1 AS in_range FROM scored", "scored")
def ml11_check(spark, d):
    by = ml11(spark, d).withColumn("before", F.lag("calibrated").over(Window.orderBy("p")))
    return by.agg(F.count("*").alias("n_scores"), F.min(F.coalesce(F.col("calibrated") >= F.col("before"), F.lit(True)).cast("int")).alias("rising"),
                  F.min(F.col("calibrated").between(0, 1).cast("int")).alias("in_range"))


#: Candidates of the search over their whole ranges: rounds, depth, step, least curvature of a leaf, shares of rows and columns.
SPACE = {"rounds": list(range(200, 1201, 50)), "depth": list(range(3, 10)), "step": [0.01, 0.02, 0.03, 0.05, 0.1, 0.2, 0.3],
         "min_weight": [float(i) for i in range(1, 21)], "subsample": [0.6, 0.7, 0.8, 0.9, 1.0], "columns": [0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]}


@query("ml12_search")
def ml12(spark, d):
    train, _, _ = frame(spark, d)
    table, _ = M.search(train, "TransactionID", SPACE)
    return table


@query("ml13_batch_scoring")
def ml13(spark, d):
    train, _, test = frame(spark, d)
    out = M.score(plain_logistic(train), test)
    return out.select("TransactionID", "isFraud", F.col("p").alias("probability"), (F.col("p") > 0.5).cast("int").alias("prediction"))


CHAIN = ["TransactionDT", "TransactionAmt", "card1", "addr1", "dist1"]
CHAIN_FEATURES = [*FEATURES, "cluster_label", "pca_comp_1", "pca_comp_2", "pca_comp_3", "association_risk_score"]


def champion(train):
    """The whole chain as one pipeline: pruning, features, clusters, components, rule score, model."""
    texts = ["ProductCD", "card4", "P_emaildomain"]
    steps = [
        stages.ColumnPruner(**{"pass": texts}), stages.FrequencyEncoder(columns=["ProductCD"]), stages.RuleRiskScore(), stages.BehaviorFeatures(),
        stages.ClusterFeature(columns=CHAIN), stages.PcaFeatures(columns=CHAIN, k=3),
    ]
    made, fitted = train, []
    for step in steps:
        fitted.append(step.fit(made))
        made = fitted[-1].transform(made)
        if isinstance(step, stages.BehaviorFeatures):  # the lookups of users are joined once, not for every later fit
            made = persist_table(made, "behaviour")
    classifier = plain_logistic(M.assemble(persist_table(made, "chain"), CHAIN_FEATURES))
    return PipelineModel(stages=[*fitted, classifier])


@query("ml13_champion_file_scoring", """
WITH r AS (SELECT TransactionID, isFraud, row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS pos, count(*) OVER () AS n FROM txn),
t AS (SELECT count(*) AS c, CAST(sum(isFraud) AS BIGINT) AS positives FROM r WHERE pos >= floor(0.85::DOUBLE * n))
SELECT 'labelled' AS file, c AS n_rows, 1 AS same_scores, 1 AS scores_in_range, 1 AS has_metrics FROM t
UNION ALL SELECT 'unlabelled', c, 1, 1, 0 FROM t""", "txn")
def ml13_file(spark, d):
    """Fit the chain, save and activate it, reload it, and score CSV files with and without a label."""
    t = txn(spark, d).drop("k")
    parts = persist_table(resample.chronological_split(t, "TransactionDT", "TransactionID"), "chain_parts")
    train, test = (parts.where(F.col("part") == p).drop("part") for p in ("train", "test"))
    model = champion(train)
    root = scratch_path(spark, "champion")
    IO.save_model(spark, model, root, "champion")
    loaded = IO.load_active(spark, root)
    want, _ = M.score_batch(model, test, CHAIN_FEATURES, "TransactionID")
    want = persist_table(want.select("TransactionID", F.col("probability").alias("fitted")), "fitted")
    out = None
    for name, batch in (("labelled", test), ("unlabelled", test.drop("isFraud"))):
        IO.write_table(batch, f"{root}/{name}", "csv")
        rows, _ = IO.read_scoring_csv(spark, f"{root}/{name}", test.schema)
        scored, metrics = M.score_batch(loaded, rows, CHAIN_FEATURES, "TransactionID")
        both = scored.join(want, "TransactionID")
        line = both.agg(
            F.lit(name).alias("file"), F.count("*").alias("n_rows"), F.min((F.abs(F.col("probability") - F.col("fitted")) < 1e-9).cast("int")).alias("same_scores"),
            F.min(F.col("probability").between(0, 1).cast("int")).alias("scores_in_range"), F.lit(int(metrics is not None and metrics.count() == 1)).alias("has_metrics"))
        out = line if out is None else out.unionByName(line)
    return out


@query("ml09_saved_ensemble", """
WITH r AS (SELECT row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS pos, count(*) OVER () AS n FROM txn)
SELECT count(*) AS n_rows, 1 AS same_scores, 2 AS models, 1 AS weights_sum_to_one FROM r WHERE pos >= floor(0.85::DOUBLE * n)""", "txn")
def ml09_saved(spark, d):
    """Fit, save and reload an ensemble; the reloaded one gives the same scores."""
    train, val, test = frame(spark, d)
    e = M.WeightedEnsemble({"lr": plain_logistic, "rf": M.random_forest}).fit(train, val)
    path = scratch_path(spark, "ensemble")
    e.save(spark, path)
    again = M.WeightedEnsemble.load(spark, path)
    both = e.transform(test).select("TransactionID", F.col("p").alias("a")).join(again.transform(test).select("TransactionID", F.col("p").alias("b")), "TransactionID")
    return both.agg(F.count("*").alias("n_rows"), F.min((F.abs(F.col("a") - F.col("b")) < 1e-12).cast("int")).alias("same_scores"),
                    F.lit(len(again.models)).alias("models"), F.lit(int(abs(sum(again.weights.values()) - 1) < 1e-9 and again.threshold == e.threshold)).alias("weights_sum_to_one"))


@query("ml13_scores_check", """
WITH r AS (SELECT isFraud, row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS pos, count(*) OVER () AS n FROM txn)
SELECT count(*) AS n_rows, CAST(sum(isFraud) AS BIGINT) AS positives, 1 AS in_range, 1 AS agrees FROM r WHERE pos >= floor(0.85::DOUBLE * n)""", "txn")
def ml13_check(spark, d):
    """Every test row is scored once, with a probability that its prediction follows."""
    agrees = (F.col("probability") > 0.5).cast("int") == F.col("prediction")
    return ml13(spark, d).agg(F.count("*").alias("n_rows"), F.sum("isFraud").cast("bigint").alias("positives"),
                              F.min(F.col("probability").between(0, 1).cast("int")).alias("in_range"), F.min(agrees.cast("int")).alias("agrees"))


def synthetic_balance(train):
    """Interpolated positives up to a fifth of the negatives, then negatives drawn down to two for each positive."""
    slim = train.select(F.col("TransactionID").cast("string").alias("TransactionID"), "isFraud", "label", "features")
    points = train.select("TransactionID", "isFraud", vector_to_array("features").alias("x"))
    made = neighbours.smote(points, "TransactionID", "x", F.col("isFraud") == 1, 0.2)
    made = made.select(F.concat_ws("-", "id", "copy").alias("TransactionID"), F.lit(1).alias("isFraud"), F.lit(1.0).alias("label"), array_to_vector("x").alias("features"))
    return persist_table(resample.undersample(slim.unionByName(made), "TransactionID", "isFraud"), "balanced")


def advanced(train, test):
    """Both frames with the components that hold 95 % of the variance and a cluster of amount and hour, fitted on ``train``."""
    flat = [t.select("TransactionID", "isFraud", *[vector_to_array("features")[i].alias(c) for i, c in enumerate(FEATURES)]) for t in (train, test)]
    steps = [stages.PcaFeatures(columns=FEATURES, variance=0.95), stages.ClusterFeature(columns=["TransactionAmt", "hour"], k=8)]
    model = Pipeline(stages=steps).fit(flat[0])
    made = [model.transform(t) for t in flat]
    columns = [c for c in made[0].columns if c not in ("TransactionID", "isFraud")]
    return tuple(persist_table(M.assemble(t, columns).select("TransactionID", "isFraud", "label", "features"), "advanced") for t in made)


def group_runs(group, train, test, fit=M.boosted_trees):
    """Name -> (fit, train, test): baseline, advanced and champion trees, on balanced rows without or on all rows with class weights."""
    rows, weights = (train, True) if group == "original" else (synthetic_balance(train), False)
    rich, out = advanced(rows, test), {}
    for name, frames, rounds, depth, step in (("baseline", (rows, test), 100, 6, 0.3), ("advanced", rich, 100, 6, 0.3), ("champion", rich, 400, 9, 0.03)):
        size = dict(max_iter=rounds, depth=depth, step=step, subsample=1.0, columns=1.0, balanced=weights)
        out[f"{name} {group}"] = (partial(fit, **size), *frames)
    return out


def matrix(train, test, fit=M.boosted_trees):
    """The trees of both groups."""
    return group_runs("balanced", train, test, fit) | group_runs("original", train, test, fit)


@query("ml14_model_comparison")
def ml14(spark, d):
    train, _, test = frame(spark, d)
    fits = {"logistic": plain_logistic, "logistic plain": lambda t: M.logistic(t, balanced=False), "forest": M.random_forest, "boosted": M.boosted_trees}

    def one(name, fit, known, held):
        return persist_table(M.all_metrics(M.score(fit(known), held), name), "compared")

    with ThreadPoolExecutor(10) as pool, ThreadPoolExecutor(2) as groups:  # the driver only waits; each fit is a Spark job of its own, and the longest begin
        begun = [pool.submit(one, name, fits[name], train, test) for name in reversed(fits)]

        def begin(group):
            runs = group_runs(group, train, test)
            return [pool.submit(one, name, *runs[name]) for name in sorted(runs, key=lambda n: not n.startswith("champion"))]

        for more in groups.map(begin, ("original", "balanced")):
            begun += more
        rows = reduce(DataFrame.unionByName, [run.result() for run in begun])
    return M.leaderboard(rows)


@query("ml15_quality_gate", f"WITH {_CURVE}, g AS (SELECT sum(n1 / all1 * (pr + prev) / 2) AS auc_pr FROM z) SELECT round(auc_pr, 6) AS auc_pr, CAST(auc_pr >= 0.6 AS INT) AS passes FROM g", "scored")
def ml15(spark, d):
    return rounded(M.quality_gate(E.ranking_metrics(scored(spark, d)).select("auc_pr")), "auc_pr")


@query("fs07_forest_importance")
def fs07(spark, d):
    train, _, _ = frame(spark, d)
    return M.forest_importance(train, FEATURES)


@query("fs07_importance_check", "SELECT 10 AS n_columns, 1.0::DOUBLE AS total")
def fs07_check(spark, d):
    return fs07(spark, d).agg(F.count("*").cast("int").alias("n_columns"), F.round(F.sum("importance"), 6).alias("total"))


@query("snk04_model_registry", "SELECT count(*) AS n_rows, 'v1' AS active, 3 AS components FROM txn", "txn")
def snk04(spark, d):
    """Fit, save two versions, activate the older one, reload it and score with it."""
    t = txn(spark, d).drop("k")
    root = scratch_path(spark, "registry")
    for version, k in (("v1", 3), ("v2", 2)):
        steps = [stages.FrequencyEncoder(columns=["ProductCD"]), stages.PcaFeatures(columns=["TransactionAmt", "dist1", "card1", "ProductCD_freq"], k=k)]
        IO.save_model(spark, Pipeline(stages=steps).fit(t), root, version)
    IO.activate_model(spark, root, "v1")
    out = IO.load_active(spark, root).transform(t)
    n = len([c for c in out.columns if c.startswith("pca_comp_")])
    return out.agg(F.count("*").alias("n_rows"), F.lit(IO.active_version(spark, root)).alias("active"), F.lit(n).alias("components"))
