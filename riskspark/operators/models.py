"""Classifiers, calibration, ensembles, search, forecasting and scoring on Spark ML."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators import boosting, forest, kernel, network
from riskspark.operators import evaluate as E
from riskspark.operators.resample import assign_folds
from riskspark.operators.stages import _Fitted
from riskspark.operators.timeseries import lag_frame
from riskspark.plans.ranking import ranged
from riskspark.plans.scratch import persist_table

LABEL = "isFraud"


# ---- frames ---------------------------------------------------------------------------------------------------------

def assemble(df: DataFrame, columns: list[str], out: str = "features", label: str = LABEL) -> DataFrame:
    """Feature vector with NULL as 0 and the label as double ``label``."""
    filled = df.withColumns({f"_f_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})
    filled = VectorAssembler(inputCols=[f"_f_{c}" for c in columns], outputCol=out).transform(filled)
    filled = filled.drop(*[f"_f_{c}" for c in columns])
    return filled.withColumn("label", F.col(label).cast("double")) if label in df.columns else filled


def class_weights(df: DataFrame, mode: str = "positive") -> dict[float, float]:
    """``positive``: n0/n1 on the positives. ``balanced``: n / (2 n_class)."""
    row = df.agg(F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1")).first()
    n0, n1 = row["n0"], row["n1"]
    if mode == "positive":
        return {0.0: 1.0, 1.0: n0 / n1 if n1 else 1.0}
    return {0.0: (n0 + n1) / (2.0 * max(n0, 1)), 1.0: (n0 + n1) / (2.0 * max(n1, 1))}


def weighted(df: DataFrame, weights: dict[float, float]) -> DataFrame:
    return df.withColumn("weight", F.when(F.col("label") == 1, F.lit(weights[1.0])).otherwise(F.lit(weights[0.0])))


def probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def score(model, df: DataFrame, out: str = "p") -> DataFrame:
    """Add the positive-class probability and drop the model's working columns."""
    made = model.transform(df).withColumn(out, probability())
    return made.drop("rawPrediction", "probability", "prediction")


# ---- classifiers ----------------------------------------------------------------------------------------------------

#: Rows of one task of a fit; a table stored in a few small files is dealt to more tasks.
TASK_ROWS = 20_000


def dealt(train: DataFrame) -> DataFrame:
    """``train`` in as many parts as its rows need, by a hash of all columns; a small table stays as it is."""
    parts = min(-(-train.count() // TASK_ROWS), 4 * train.sparkSession.sparkContext.defaultParallelism)
    if parts <= max(1, train.rdd.getNumPartitions()):
        return train
    return train.repartition(parts, F.xxhash64(*[vector_to_array(c) if c == "features" else F.col(c) for c in train.columns]))


def boosted_trees(train: DataFrame, max_iter: int = 500, depth: int = 12, step: float = 0.02, subsample: float = 0.8,
                  columns: float = 0.8, seed: int = 42, balanced: bool = True, **options):
    """Boosted trees on histograms, positives weighted by n0/n1 if ``balanced``."""
    frame = weighted(train, class_weights(train, "positive") if balanced else {0.0: 1.0, 1.0: 1.0})
    return boosting.fit(frame, boosting.Setting(max_iter, depth, step, subsample, columns, seed=seed), **options)


def random_forest(train: DataFrame, trees: int = 100, depth: int = 15, balanced: bool = False, seed: int = 42):
    """A forest that grows in tasks which hold the whole table as bins; one too large for them goes to Spark's."""
    weights = class_weights(train, "balanced") if balanced else {0.0: 1.0, 1.0: 1.0}
    frame = dealt(train)
    grown = forest.fit(frame, trees, depth, weights, seed)
    return grown or RandomForestClassifier(numTrees=trees, maxDepth=depth, weightCol="weight", seed=seed, cacheNodeIds=True).fit(weighted(frame, weights))


def forest_importance(train: DataFrame, columns: list[str], top: int = 20, trees: int = 50, depth: int = 10, seed: int = 42) -> DataFrame:
    """(column, importance) of the strongest columns."""
    model = random_forest(train, trees, depth, seed=seed)
    rows = sorted(zip(columns, model.featureImportances.toArray().tolist()), key=lambda r: -r[1])[:top]
    return train.sparkSession.createDataFrame(rows, "column string, importance double")


def logistic(train: DataFrame, balanced: bool = True, reg: float | None = None, max_iter: int = 100):
    """Standardised logistic regression; the default penalty is 1/n."""
    frame = weighted(train, class_weights(train, "balanced") if balanced else {0.0: 1.0, 1.0: 1.0})
    penalty = 1.0 / max(train.count(), 1) if reg is None else reg
    return LogisticRegression(weightCol="weight", regParam=penalty, maxIter=max_iter).fit(frame)


def dense_network(train: DataFrame, n_inputs: int, hidden: tuple[int, ...] = (256, 128, 64), max_iter: int = 100, seed: int = 42):
    return network.fit(dealt(train), [n_inputs, *hidden, 2], max_iter, seed)


def linear_svm(train: DataFrame, reg: float = 0.01, max_iter: int = 100):
    """Linear support vectors with a logistic calibration of the margin."""
    frame = weighted(train, class_weights(train, "balanced"))
    model = LinearSVC(weightCol="weight", regParam=reg, maxIter=max_iter).fit(frame)
    return model, platt(svm_margin(model, frame), "margin")


def svm_margin(model, df: DataFrame) -> DataFrame:
    made = model.transform(df).withColumn("margin", vector_to_array(F.col("rawPrediction"))[1])
    return made.drop("rawPrediction", "prediction")


class KernelSvm:
    """Support vectors with a radial kernel: a landmark map, linear support vectors on its image, a logistic calibration of the margin."""

    def __init__(self, kernel_map, linear, calibration):
        self.kernel_map, self.linear, self.calibration = kernel_map, linear, calibration

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``probability``, a vector of two; its own features stay."""
        made = self.kernel_map.transform(df.withColumn("_raw", F.col("features")))
        p = apply_platt(self.calibration, svm_margin(self.linear, made), "margin", "_p").drop("margin", "features").withColumnRenamed("_raw", "features")
        return p.withColumn("probability", array_to_vector(F.array(1 - F.col("_p"), F.col("_p")))).drop("_p")


def kernel_svm(train: DataFrame, landmarks: int = 200, gamma: float | None = None, reg: float = 0.001, max_iter: int = 100) -> KernelSvm:
    """Balanced support vectors on the whitened kernel map of ``landmarks`` rows; the solver and the calibration see all rows."""
    kernel_map = kernel.fit_map(train, landmarks, gamma)
    linear, calibration = linear_svm(persist_table(kernel_map.transform(train), "mapped"), reg, max_iter)
    return KernelSvm(kernel_map, linear, calibration)


# ---- calibration ----------------------------------------------------------------------------------------------------

class IsotonicMap(_Fitted):
    """Score -> value: constant on the blocks of the fit, linear between them, NULL for a missing score or without any block."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.apply(df, "p", "p")

    def apply(self, df: DataFrame, column: str, out: str) -> DataFrame:
        blocks = self.state["blocks"]
        if not blocks:
            return df.withColumn(out, F.lit(None).cast("double"))
        at = np.array([x for low, high, _ in blocks for x in ((low, high) if high > low else (low,))])
        value = np.array([v for low, high, v in blocks for _ in range(2 if high > low else 1)])

        @F.pandas_udf("double")
        def mapped(x):
            import pandas as pd

            return pd.Series(np.interp(x.to_numpy(dtype=float), at, value))

        made = mapped(F.col(column).cast("double"))
        return df.withColumn(out, F.when(~F.isnan(made), made))


def pool(low: list, high: list, total: list, n: list) -> tuple[list, list, list, list]:
    """Pool adjacent violators: blocks in rising order, joined until their means rise strictly."""
    out: tuple = ([], [], [], [])
    for a, b, s, c in zip(low, high, total, n):
        while out[0] and out[2][-1] * c >= s * out[3][-1]:
            a, s, c = out[0].pop(), s + out[2].pop(), c + out[3].pop()
            out[1].pop()
        for o, v in zip(out, (a, b, s, c)):
            o.append(v)
    return out


def isotonic(df: DataFrame, column: str = "p", together: int = 16) -> IsotonicMap:
    """Monotone map score -> label rate by least squares; rows without a score take no part.

    Equal scores are one weighted row. Each range of scores pools its violators in a task of its own; the block lists of ``together``
    neighbouring ranges are then joined and pooled again, level by level, so the driver gets the blocks of the fit only.
    """
    counts = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double"))).groupBy(F.col(column).cast("double").alias("x"))
    counts = counts.agg(F.sum("label").cast("double").alias("s"), F.count("*").cast("double").alias("n"))
    rows = ranged(counts, ["x"], "isotonic")
    parts = max(1, (rows.agg(F.max("_part")).first()[0] or 0) + 1)
    schema = "part bigint, low array<double>, high array<double>, s array<double>, n array<double>"

    def joined(key, lists):
        import pyarrow as pa

        made = pool(*lists)
        return pa.table([pa.array([key]), *[pa.array([x], pa.list_(pa.float64())) for x in made]], names=["part", "low", "high", "s", "n"])

    def first(key, table):
        table = table.sort_by("x")
        x = table.column("x").to_pylist()
        return joined(key[0].as_py(), (x, x, table.column("s").to_pylist(), table.column("n").to_pylist()))

    def merge(key, table):
        table = table.sort_by("part")
        return joined(key[0].as_py(), [[v for row in table.column(c).to_pylist() for v in row] for c in ("low", "high", "s", "n")])

    blocks = rows.select(F.col("_part").cast("bigint").alias("part"), "x", "s", "n").groupBy("part").applyInArrow(first, schema)
    while parts > 1:
        parts = -(-parts // together)
        blocks = persist_table(blocks, "pooled").withColumn("up", F.expr(f"part div {together}")).groupBy("up").applyInArrow(merge, schema)
    found = blocks.first()
    return IsotonicMap({"blocks": [[a, b, s / n] for a, b, s, n in zip(*(found[c] for c in ("low", "high", "s", "n")))] if found else []})


def apply_isotonic(model: IsotonicMap, df: DataFrame, column: str = "p", out: str = "p") -> DataFrame:
    return model.apply(df, column, out)


def platt(df: DataFrame, column: str = "p"):
    """One-feature logistic regression of the label on the score, over all rows."""
    rows = VectorAssembler(inputCols=["s"], outputCol="features").transform(df.select(F.col(column).alias("s"), "label"))
    return LogisticRegression(regParam=1.0 / max(rows.count(), 1)).fit(rows)


def apply_platt(model, df: DataFrame, column: str = "p", out: str = "p") -> DataFrame:
    z = F.lit(float(model.coefficients[0])) * F.col(column) + F.lit(float(model.intercept))
    return df.withColumn(out, 1 / (1 + F.exp(-z)))


# ---- ensembles ------------------------------------------------------------------------------------------------------

def stack(train: DataFrame, test: DataFrame, fitters: dict, id_col: str, folds: int = 5, label: str = LABEL, seed: int = 42, refit: bool = False):
    """Out-of-fold base probabilities -> logistic meta model.

    ``fitters`` maps a name to a function frame -> model. Test probabilities are means over the fold models, or come from a
    refit on all rows. Returns (out-of-fold scores, test scores), both with ``p``.
    """
    marked = persist_table(assign_folds(train, id_col, folds, label, seed), "folds")
    oof, fold_models = None, {n: [] for n in fitters}
    for f in range(folds):
        inside, outside = marked.where(F.col("fold") != f), marked.where(F.col("fold") == f)
        for name, fit in fitters.items():
            model = fit(inside)
            fold_models[name].append(model)
            outside = score(model, outside, name)
        oof = outside if oof is None else oof.unionByName(outside)
    names = list(fitters)
    oof = persist_table(oof.select(id_col, label, "label", *names), "oof")
    held = test
    for name, fit in fitters.items():
        models = [fit(train)] if refit else fold_models[name]
        parts = []
        for i, m in enumerate(models):
            held = score(m, held, f"_{name}_{i}")
            parts.append(F.col(f"_{name}_{i}"))
        total = parts[0]
        for p in parts[1:]:
            total = total + p
        held = held.withColumn(name, total / len(parts)).drop(*[f"_{name}_{i}" for i in range(len(models))])
    meta_in = VectorAssembler(inputCols=names, outputCol="meta")
    meta = LogisticRegression(featuresCol="meta", regParam=1.0 / max(oof.count(), 1)).fit(meta_in.transform(oof))
    return score(meta, meta_in.transform(oof)).drop("meta"), score(meta, meta_in.transform(held)).drop("meta", "features")


class WeightedEnsemble:
    """Base models weighted by average precision on the validation rows, isotonic calibration, F1-best threshold."""

    def __init__(self, fitters: dict):
        self.fitters = fitters

    def fit(self, train: DataFrame, val: DataFrame, label: str = LABEL) -> "WeightedEnsemble":
        self.models = {n: f(train) for n, f in self.fitters.items()}
        held = val
        for n, m in self.models.items():
            held = score(m, held, f"p_{n}")
        held = persist_table(held.drop("features"), "ensemble_val")
        ap = {n: E.ranking_metrics(held, label, f"p_{n}").first()["average_precision"] or 0.0 for n in self.models}
        raw = {n: max(v, 1e-6) for n, v in ap.items()}
        self.weights = {n: v / sum(raw.values()) for n, v in raw.items()}
        blended = held.withColumn("p", self._blend())
        self.calibrator = isotonic(blended)
        calibrated = apply_isotonic(self.calibrator, blended)
        self.threshold = E.best_threshold(calibrated, label).first()["threshold"]
        return self

    def save(self, spark, path: str) -> None:
        """Base models, calibration and a line of settings below ``path``."""
        for n, m in self.models.items():
            m.write().overwrite().save(f"{path}/models/{n}")
        self.calibrator.write().overwrite().save(f"{path}/calibrator")
        rows = [(n, float(self.weights[n]), float(self.threshold)) for n in self.models]
        spark.createDataFrame(rows, "name string, weight double, threshold double").write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark, path: str) -> "WeightedEnsemble":
        rows = spark.read.parquet(f"{path}/settings").orderBy("name").collect()
        out = cls({})
        out.models = {r["name"]: DefaultParamsReader.loadParamsInstance(f"{path}/models/{r['name']}", spark) for r in rows}
        out.calibrator = DefaultParamsReader.loadParamsInstance(f"{path}/calibrator", spark)
        out.weights = {r["name"]: r["weight"] for r in rows}
        out.threshold = rows[0]["threshold"]
        return out

    def _blend(self) -> Column:
        total = F.lit(0.0)
        for n, w in self.weights.items():
            total = total + F.col(f"p_{n}") * F.lit(w)
        return total

    def transform(self, df: DataFrame) -> DataFrame:
        out = df
        for n, m in self.models.items():
            out = score(m, out, f"p_{n}")
        out = apply_isotonic(self.calibrator, out.withColumn("p", self._blend()))
        return out.withColumn("prediction", (F.col("p") >= F.lit(self.threshold)).cast("int"))


def search(train: DataFrame, id_col: str, space: dict, trials: int = 20, folds: int = 3, seed: int = 42, rungs: int = 4, **options) -> tuple[DataFrame, object]:
    """Successive halving over random boosted-tree settings by stratified folds; returns (budget table, best model on all rows).

    ``space`` maps a field of ``boosting.Setting`` to its candidate values. The table has a line per rung and trial that took part:
    (rung, trial, params, rounds, average_precision, goes_on); the setting that goes on from the last rung is refitted.
    """
    marked = persist_table(assign_folds(weighted(train, class_weights(train, "positive")), id_col, folds, "isFraud", seed), "search")

    def score_all(chances: DataFrame) -> dict:
        return {r["model"]: r["average_precision"] for r in E.average_precisions(chances, "model").collect()}

    prepared = boosting._prepared(marked, options.get("bins", boosting.BINS), F.col("fold"))  # the refit uses the blocks of the search
    table, best = boosting.halving(marked, "fold", folds, boosting.draws(space, trials, seed), score_all, rungs, prepared=prepared, **options)
    rows = [(rung, trial, str({k: getattr(s, k) for k in space}), rounds, value, int(on)) for rung, trial, s, rounds, value, on in table]
    schema = "rung int, trial int, params string, rounds int, average_precision double, goes_on int"
    return train.sparkSession.createDataFrame(rows, schema), boosting.fit(marked, best, prepared=prepared, **options)


# ---- forecast -------------------------------------------------------------------------------------------------------

def ridge_forecast(series: DataFrame, lags: int = 6, alpha: float = 1.0, train: float = 0.8) -> DataFrame:
    """(hour_window, part, actual, predicted): exact ridge regression of the next count on lags and cyclic time columns.

    Means, deviations and the Gram matrix come from two aggregations; a 10 x 10 system is solved on the driver.
    """
    cols = [f"lag_{i}" for i in range(1, lags + 1)] + ["hour_sin", "hour_cos", "day_sin", "day_cos"]
    frame = lag_frame(series, lags)
    n = frame.count()
    rn = F.row_number().over(Window.orderBy("hour_window"))  # hourly table: one row per hour
    frame = frame.withColumn("part", F.when(rn <= int(train * n), "train").otherwise("test"))
    fit = frame.where(F.col("part") == "train")
    stats = fit.agg(*[F.avg(c) for c in cols], *[F.stddev_pop(c) for c in cols], F.avg("target")).first()
    k = len(cols)
    mean, std, y_mean = stats[:k], [s or 1.0 for s in stats[k:2 * k]], stats[2 * k]
    z = [(F.col(c) - F.lit(float(m))) / F.lit(float(s)) for c, m, s in zip(cols, mean, std)]
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = fit.agg(*[F.sum(z[i] * z[j]) for i, j in pairs], *[F.sum(z[i] * (F.col("target") - F.lit(float(y_mean)))) for i in range(k)]).first()
    gram = np.zeros((k, k))
    for (i, j), v in zip(pairs, sums):
        gram[i, j] = gram[j, i] = v
    beta = np.linalg.solve(gram + alpha * np.eye(k), np.array(sums[len(pairs):]))
    guess = F.lit(float(y_mean))
    for x, b in zip(z, beta):
        guess = guess + x * F.lit(float(b))
    return frame.select("hour_window", "part", F.col("target").cast("double").alias("actual"), F.greatest(F.lit(0.0), guess).alias("predicted"))


def score_batch(model, batch: DataFrame, columns: list[str], id_col: str, label: str = LABEL, out: str = "probability", threshold: float = 0.5):
    """Scores of a batch and, if it carries labels, one row of metrics (else None).

    ``model`` is a fitted pipeline up to the features ``columns`` and the classifier; rows without label are scored, but do
    not enter the metrics.
    """
    steps, classifier = model.stages[:-1], model.stages[-1]
    made = batch
    for step in steps:
        made = step.transform(made)
    has_label = label in batch.columns
    scored = score(classifier, assemble(made, columns, label=label), "_score").withColumnRenamed("_score", out)
    kept = scored.select(id_col, *([label] if has_label else []), out, (F.col(out) > threshold).cast("int").alias("prediction"))
    if not has_label:
        return kept, None
    kept = persist_table(kept, "batch")
    return kept, all_metrics(kept.where(F.col(label).isNotNull()), "batch", label, out, threshold)


# ---- reports --------------------------------------------------------------------------------------------------------

def all_metrics(df: DataFrame, name: str, label: str = LABEL, p: str = "p", threshold: float = 0.5) -> DataFrame:
    """One row of threshold and ranking metrics for a scored table."""
    scored = persist_table(df.select(F.col(label).cast("int").alias("y"), F.col(p).alias("p")), "scored")
    rank = E.ranking_metrics(scored, "y", "p").first()
    m = E.classification_metrics(scored.withColumn("prediction", (F.col("p") > threshold).cast("int")), "y", "prediction")
    return m.select(F.lit(name).alias("model"), "precision", "recall", "f1", F.lit(rank["auc_roc"]).alias("auc_roc"),
                    F.lit(rank["average_precision"]).alias("average_precision"), F.lit(rank["auc_pr"]).alias("auc_pr"))


def leaderboard(rows: DataFrame) -> DataFrame:
    """Rank by PR area; one row per model."""
    return rows.withColumn("place", F.rank().over(Window.orderBy(F.desc("auc_pr"))).cast("bigint"))


def quality_gate(metrics: DataFrame, limit: float = 0.60, metric: str = "auc_pr") -> DataFrame:
    return metrics.withColumn("passes", (F.col(metric) >= limit).cast("int"))


def require_quality(metrics: DataFrame, limit: float = 0.60, metric: str = "auc_pr") -> None:
    """Raise when the gate is not passed, so that nothing is saved."""
    value = metrics.first()[metric]
    if value is None or value < limit:
        raise ValueError(f"{metric} {value} is below {limit}")
