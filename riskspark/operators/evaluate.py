"""Exact classification and regression metrics. Curves are built from one row per distinct score and running totals over
a range-partitioned order, so neither the number of rows nor the number of distinct scores needs one task."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.plans.quantiles import long_form
from riskspark.plans.ranking import running_totals

# Published target metrics by method (roc, pr, f1, balanced accuracy, g-mean).
TARGETS = {
    "Proposed Stacking": (0.918, 0.891, 0.856, 0.810, 0.824),
    "XGBoost": (0.887, 0.834, 0.802, 0.756, 0.771),
    "LightGBM": (0.882, 0.821, 0.791, 0.741, 0.756),
    "Random Forest": (0.865, 0.796, 0.768, 0.712, 0.724),
    "Weighted Voting": (0.901, 0.861, 0.828, 0.784, 0.801),
    "Simple Voting": (0.885, 0.819, 0.784, 0.734, 0.748),
    "CatBoost": (0.890, 0.837, 0.805, 0.761, 0.776),
    "Logistic Regression": (0.812, 0.721, 0.651, 0.593, 0.603),
}
TARGET_METRICS = ["auc_roc", "auc_pr", "f1", "bal_acc", "g_mean"]


def _ratio(num, den):
    """0 when the denominator is 0."""
    return F.coalesce(F.try_divide(num.cast("double"), den), F.lit(0.0))


# ---- counts at a threshold ------------------------------------------------------------------------------------------

def confusion_counts(df: DataFrame, label: str = "isFraud", prediction: str = "prediction", by: list[str] = ()) -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    return df.groupBy(*by).agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))


def classification_metrics(df: DataFrame, label: str = "isFraud", prediction: str = "prediction", by: list[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, F1, specificity, balanced accuracy and G-mean; an empty denominator gives 0."""
    c = confusion_counts(df, label, prediction, by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    c = c.withColumns({
        "accuracy": _ratio(tp + tn, tp + fp + fn + tn),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        "specificity": _ratio(tn, tn + fp),
    })
    return c.withColumns({
        "balanced_accuracy": (F.col("recall") + F.col("specificity")) / 2,
        "g_mean": F.sqrt(F.col("recall") * F.col("specificity")),
    })


def class_report(df: DataFrame, label: str = "isFraud", prediction: str = "prediction") -> DataFrame:
    """(class, precision, recall, f1, support) for 0, 1, macro and weighted averages."""
    c = confusion_counts(df, label, prediction)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))

    def line(name, hit, false, miss):
        return F.struct(F.lit(name).alias("class"), _ratio(hit, hit + false).alias("precision"), _ratio(hit, hit + miss).alias("recall"),
                        _ratio(2 * hit, 2 * hit + false + miss).alias("f1"), (hit + miss).alias("support"))

    both = c.select(line("0", tn, fn, fp).alias("a"), line("1", tp, fp, fn).alias("b"))
    a, b = F.col("a"), F.col("b")
    n = a["support"] + b["support"]

    def mix(name, wa, wb):
        parts = [(a[m] * wa + b[m] * wb).alias(m) for m in ("precision", "recall", "f1")]
        return F.struct(F.lit(name).alias("class"), *parts, n.alias("support"))

    rows = F.array(a, b, mix("macro", F.lit(0.5), F.lit(0.5)), mix("weighted", _ratio(a["support"], n), _ratio(b["support"], n)))
    return both.select(F.explode(rows).alias("r")).select("r.*")


def confusion_matrix(df: DataFrame, label: str = "isFraud", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n) with all four cells."""
    c = confusion_counts(df, label, prediction)
    cells = [F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(n).alias("n")) for y, p, n in
             ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))]
    return c.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


# ---- curves ---------------------------------------------------------------------------------------------------------

def score_table(df: DataFrame, label: str = "isFraud", score: str = "p") -> DataFrame:
    """One row per distinct score, highest first: own counts, cumulative ``tp``/``fp`` and those before it."""
    counts = df.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(label)).cast("bigint").alias("n1"), F.sum(1 - F.col(label)).cast("bigint").alias("n0"))
    cum = running_totals(counts, [F.desc("score")], {"tp_before": F.col("n1"), "fp_before": F.col("n0")}, "scores")
    return cum.withColumns({"tp": F.col("tp_before") + F.col("n1"), "fp": F.col("fp_before") + F.col("n0")})


def _totals(df: DataFrame, label: str) -> tuple[int, int]:
    row = df.agg(F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)).first()
    return row[0], row[1]


def curve_points(df: DataFrame, label: str = "isFraud", score: str = "p") -> DataFrame:
    """(score, fpr, tpr, precision, recall) at every distinct score."""
    n1, n0 = _totals(df, label)
    s = score_table(df, label, score)
    tp, fp = F.col("tp"), F.col("fp")
    return s.select("score", (fp / F.lit(float(max(n0, 1)))).alias("fpr"), (tp / F.lit(float(max(n1, 1)))).alias("tpr"),
                    _ratio(tp, tp + fp).alias("precision"), (tp / F.lit(float(max(n1, 1)))).alias("recall"))


def ranking_metrics(df: DataFrame, label: str = "isFraud", score: str = "p") -> DataFrame:
    """ROC-AUC, step average precision and trapezoid PR area starting at (recall 0, precision 1); one row."""
    n1, n0 = _totals(df, label)
    s = score_table(df, label, score)
    return _ranking_row(s, n1, n0)


def _ranking_row(s: DataFrame, n1: int, n0: int) -> DataFrame:
    tp, fp, tb, fb = (F.col(x) for x in ("tp", "fp", "tp_before", "fp_before"))
    gain = F.col("n1") / F.lit(float(max(n1, 1)))
    prec = tp / (tp + fp)
    prev = F.when(tb + fb > 0, F.try_divide(tb.cast("double"), tb + fb)).otherwise(1.0)
    area = F.col("n0") * (tb + tp) / 2.0 / F.lit(float(max(n1, 1)) * max(n0, 1))
    return s.agg(F.sum(area).alias("auc_roc"), F.sum(gain * prec).alias("average_precision"), F.sum(gain * (prec + prev) / 2).alias("auc_pr"))


def average_precisions(df: DataFrame, group: str, label: str = "y", score: str = "p") -> DataFrame:
    """(group, average_precision) of many score lists at once: running totals over one order by group and falling score, from which each
    group's start is taken off. A group without positives has 0."""
    counts = df.groupBy(group, F.col(score).alias("score")).agg(F.sum(label).cast("bigint").alias("n1"), F.count("*").alias("n"))
    cum = running_totals(counts, [group, F.desc("score")], {"tp_before": F.col("n1"), "n_before": F.col("n")}, "score_groups")
    start = cum.groupBy(group).agg(F.min("tp_before").alias("tp0"), F.min("n_before").alias("n0"), F.sum("n1").alias("all1"))
    both = cum.join(F.broadcast(start), group)  # one row per group
    precision = (F.col("tp_before") + F.col("n1") - F.col("tp0")) / (F.col("n_before") + F.col("n") - F.col("n0"))
    gain = F.coalesce(F.try_divide(F.col("n1").cast("double"), F.col("all1")), F.lit(0.0))
    return both.groupBy(group).agg(F.sum(gain * precision).alias("average_precision"))


def best_threshold(df: DataFrame, label: str = "isFraud", score: str = "p") -> DataFrame:
    """(threshold, f1, precision, recall) with the best F1 over distinct scores; ties take the smallest score. Without
    rows the threshold is 0.5."""
    n1, _ = _totals(df, label)
    s = score_table(df, label, score)
    tp, fp = F.col("tp"), F.col("fp")
    p, r = tp / (tp + fp), tp / F.lit(float(max(n1, 1)))
    f1 = F.round(2 * p * r / F.greatest(p + r, F.lit(1e-9)), 12)
    row = s.select(F.struct(f1.alias("f1"), (-F.col("score")).alias("neg"), p.alias("precision"), r.alias("recall")).alias("b")).agg(F.max("b").alias("b"))
    return row.select(F.coalesce(-F.col("b.neg"), F.lit(0.5)).alias("threshold"), F.coalesce("b.f1", F.lit(0.0)).alias("f1"),
                      F.coalesce("b.precision", F.lit(0.0)).alias("precision"), F.coalesce("b.recall", F.lit(0.0)).alias("recall"))


# ---- regression, targets --------------------------------------------------------------------------------------------

def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """RMSE, MAE and R squared (0 when the actual values are constant)."""
    e = F.col(actual) - F.col(predicted)
    return df.agg(F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
                  F.coalesce(1 - F.try_divide(F.avg(e * e), F.var_pop(actual)), F.lit(0.0)).alias("r2"))


def target_gaps(metrics: DataFrame, method: str, warn_at: float = 0.05) -> DataFrame:
    """(metric, current, target, gap, gap_pct, large_gap) of a metrics row against the published values."""
    goal = dict(zip(TARGET_METRICS, TARGETS[method]))
    long = metrics.select(*TARGET_METRICS).unpivot([], TARGET_METRICS, "metric", "current")
    pick = F.coalesce(*[F.when(F.col("metric") == m, F.lit(v)) for m, v in goal.items()])
    gap = F.col("target") - F.coalesce("current", F.lit(0.0))
    return long.withColumn("target", pick).select("metric", "current", "target", gap.alias("gap"),
                                                   (gap / F.col("target") * 100).alias("gap_pct"), (F.abs(gap) > warn_at).cast("int").alias("large_gap"))


# ---- rank tests -----------------------------------------------------------------------------------------------------

def mid_ranks(df: DataFrame, value: str, label: str = "isFraud") -> DataFrame:
    """(value, n, n1, mid_rank): one row per distinct value with the average rank of its rows."""
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(
        F.count("*").alias("n"), F.sum(label).cast("bigint").alias("n1"))
    cum = running_totals(counts, ["value"], {"before": F.col("n")}, "ranks")
    return cum.withColumn("mid_rank", F.col("before") + (F.col("n") + 1) / 2.0)


def rank_test(df: DataFrame, columns: list[str], label: str = "isFraud") -> DataFrame:
    """(column, n1, n0, u, z) of the two-sided rank-sum test with tie and continuity correction, for all columns in one
    job: values are counted per (column, value) and ranked in one global order; the column start cancels out."""
    long = long_form(df, columns, [label]).where(F.col("value").isNotNull())
    counts = long.groupBy("column", "value").agg(F.count("*").alias("t"), F.sum(label).cast("bigint").alias("n1"))
    cum = running_totals(counts, ["column", "value"], {"before": F.col("t")}, "ranktest")
    t = F.col("t").cast("double")
    g = cum.groupBy("column").agg(
        F.sum("n1").alias("n1"), F.sum("t").alias("n"), F.min("before").alias("start"),
        F.sum(F.col("n1") * (F.col("before") + (F.col("t") + 1) / 2.0)).alias("r1"),
        F.sum(t * t * t - t).alias("ties"))
    n1, n = F.col("n1").cast("double"), F.col("n").cast("double")
    n0 = n - n1
    u = F.col("r1") - F.col("start") * n1 - n1 * (n1 + 1) / 2
    g = g.select("column", "n1", (F.col("n") - F.col("n1")).alias("n0"), u.alias("u"),
                 F.sqrt(n1 * n0 / 12 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1)))).alias("sigma"))
    m = F.col("n1").cast("double") * F.col("n0")
    z = F.try_divide(F.greatest(F.col("u"), m - F.col("u")) - m / 2 - 0.5, F.col("sigma"))
    return g.select("column", "n1", "n0", "u", z.alias("z"))


def rank_test_p(df: DataFrame, columns: list[str], label: str = "isFraud") -> DataFrame:
    """:func:`rank_test` with the two-sided p-value; the tail function is applied to the few result rows."""
    rows = rank_test(df, columns, label).collect()
    out = [(r["column"], r["u"], r["z"], min(1.0, math.erfc(r["z"] / math.sqrt(2))) if r["z"] is not None else None) for r in rows]
    return df.sparkSession.createDataFrame(out, "column string, u double, z double, p_value double")
