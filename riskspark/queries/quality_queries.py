"""Evaluation and monitoring."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.functions import scalars as S
from riskspark.operators import evaluate as E
from riskspark.operators import monitor, timeseries
from riskspark.queries.profile_queries import rounded
from riskspark.queries.registry import query
from riskspark.sources.views import scored, txn


def predicted(spark, d):
    return scored(spark, d).withColumn("prediction", S.predicted("p"))


_COUNTS = """c AS (SELECT count(*) FILTER (WHERE isFraud = 1 AND p > 0.5) AS tp, count(*) FILTER (WHERE isFraud = 0 AND p > 0.5) AS fp,
  count(*) FILTER (WHERE isFraud = 1 AND p <= 0.5) AS fn, count(*) FILTER (WHERE isFraud = 0 AND p <= 0.5) AS tn FROM scored)"""


@query("ev01_metrics", f"""WITH {_COUNTS} SELECT tp, fp, fn, tn, round((tp + tn)::DOUBLE / (tp + fp + fn + tn), 6) AS accuracy, round(tp::DOUBLE / (tp + fp), 6) AS precision,
  round(tp::DOUBLE / (tp + fn), 6) AS recall, round(2.0::DOUBLE * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""", "scored")
def ev01(spark, d):
    m = E.classification_metrics(predicted(spark, d)).select("tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f1")
    return rounded(m, "accuracy", "precision", "recall", "f1")


@query("ev01_class_report", f"""
WITH {_COUNTS}, r AS (
SELECT '0' AS class, tn::DOUBLE / (tn + fn) AS precision, tn::DOUBLE / (tn + fp) AS recall, 2.0::DOUBLE * tn / (2 * tn + fp + fn) AS f1, tn + fp AS support FROM c
UNION ALL SELECT '1', tp::DOUBLE / (tp + fp), tp::DOUBLE / (tp + fn), 2.0::DOUBLE * tp / (2 * tp + fp + fn), tp + fn FROM c),
a AS (SELECT * FROM r UNION ALL SELECT 'macro', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM r
UNION ALL SELECT 'weighted', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM r)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM a""", "scored")
def ev01_report(spark, d):
    return rounded(E.class_report(predicted(spark, d)), "precision", "recall", "f1")


@query("ev02_confusion_matrix", f"""WITH {_COUNTS} SELECT 0 AS label, 0 AS prediction, tn AS n FROM c UNION ALL SELECT 0, 1, fp FROM c
UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c""", "scored")
def ev02(spark, d):
    return E.confusion_matrix(predicted(spark, d))


_CURVE = """s AS (SELECT p, sum(isFraud) AS n1, sum(1 - isFraud) AS n0 FROM scored GROUP BY p),
t AS (SELECT (SELECT sum(n1) FROM s)::DOUBLE AS all1, (SELECT sum(n0) FROM s)::DOUBLE AS all0),
q AS (SELECT p, n1, n0, sum(n1) OVER w AS tp, sum(n0) OVER w AS fp FROM s WINDOW w AS (ORDER BY p DESC)),
z AS (SELECT *, tp::DOUBLE / (tp + fp) AS pr, tp / all1 AS rc, lag(tp::DOUBLE / (tp + fp), 1, 1.0::DOUBLE) OVER (ORDER BY p DESC) AS prev FROM q, t)"""


@query("ev03_roc_curve", f"WITH {_CURVE} SELECT p AS score, round(fp / all0, 6) AS fpr, round(rc, 6) AS tpr, round(pr, 6) AS precision, round(rc, 6) AS recall FROM z", "scored")
def ev03_curve(spark, d):
    return rounded(E.curve_points(scored(spark, d)), "fpr", "tpr", "precision", "recall")


@query("wn09_thinned_curve", f"""WITH {_CURVE}, r AS (SELECT *, row_number() OVER (ORDER BY p DESC) - 1 AS rn, count(*) OVER () AS n FROM z)
SELECT p AS score, round(fp / all0, 6) AS fpr, round(rc, 6) AS tpr, round(pr, 6) AS precision FROM r
WHERE rn IN (SELECT i * (n - 1) // 29 FROM (SELECT unnest(range(30)) AS i), (SELECT count(*) AS n FROM z))""", "scored")
def wn09_curve(spark, d):
    """The curves at 30 evenly spaced places by falling score."""
    curve = E.curve_points(scored(spark, d)).select("score", "fpr", "tpr", "precision")
    return rounded(timeseries.evenly_spaced(curve, 30, [F.desc("score")]), "fpr", "tpr", "precision")


@query("ev03_roc_auc", """
WITH g AS (SELECT p, count(*) AS n, sum(isFraud) AS n1 FROM scored GROUP BY p),
r AS (SELECT n1, sum(n) OVER (ORDER BY p) - n + (n + 1) / 2.0::DOUBLE AS mr FROM g)
SELECT round((sum(n1 * mr) - sum(n1) * (sum(n1) + 1) / 2.0::DOUBLE) / (sum(n1) * ((SELECT count(*) FROM scored) - sum(n1))), 6) AS auc_roc FROM r""", "scored")
def ev03(spark, d):
    return rounded(E.ranking_metrics(scored(spark, d)).select("auc_roc"), "auc_roc")


@query("ev04_pr_areas", f"""WITH {_CURVE} SELECT round(sum(n1 / all1 * pr), 6) AS average_precision, round(sum(n1 / all1 * (pr + prev) / 2), 6) AS auc_pr FROM z""", "scored")
def ev04(spark, d):
    return rounded(E.ranking_metrics(scored(spark, d)).select("average_precision", "auc_pr"), "average_precision", "auc_pr")


@query("ev05_best_threshold", f"""WITH {_CURVE}, f AS (SELECT *, round(2 * pr * rc / greatest(pr + rc, 1e-9), 12) AS f1 FROM z)
SELECT p AS threshold, round(f1, 6) AS f1, round(pr, 6) AS precision, round(rc, 6) AS recall FROM f ORDER BY f.f1 DESC, p LIMIT 1""", "scored")
def ev05(spark, d):
    return rounded(E.best_threshold(scored(spark, d)), "f1", "precision", "recall")


@query("ev06_balanced_metrics", f"""WITH {_COUNTS}, m AS (SELECT tp::DOUBLE / (tp + fn) AS sens, tn::DOUBLE / (tn + fp) AS spec FROM c)
SELECT round(spec, 6) AS specificity, round((sens + spec) / 2, 6) AS balanced_accuracy, round(sqrt(sens * spec), 6) AS g_mean FROM m""", "scored")
def ev06(spark, d):
    m = E.classification_metrics(predicted(spark, d)).select("specificity", "balanced_accuracy", "g_mean")
    return rounded(m, "specificity", "balanced_accuracy", "g_mean")


@query("ev07_regression_metrics", """
WITH l AS (SELECT total::DOUBLE AS a, lag(total) OVER (ORDER BY hour_window)::DOUBLE AS f FROM hourly), k AS (SELECT * FROM l WHERE f IS NOT NULL)
SELECT round(sqrt(avg((a - f) * (a - f))), 6) AS rmse, round(avg(abs(a - f)), 6) AS mae, round(1 - avg((a - f) * (a - f)) / var_pop(a), 6) AS r2 FROM k""", "hourly")
def ev07(spark, d):
    h = timeseries.hourly(txn(spark, d)).select(F.col("total").cast("double").alias("actual"), F.lag("total").over(Window.orderBy("hour_window")).cast("double").alias("forecast"))
    return rounded(E.regression_metrics(h.dropna(), "actual", "forecast"), "rmse", "mae", "r2")


@query("ev08_target_gap", f"""
WITH {_CURVE}, {_COUNTS}, m AS (SELECT tp::DOUBLE / (tp + fn) AS sens, tn::DOUBLE / (tn + fp) AS spec, 2.0::DOUBLE * tp / (2 * tp + fp + fn) AS f1 FROM c),
roc AS (SELECT sum(n0 * (2 * tp - n1) / 2.0::DOUBLE) / any_value(all1 * all0) AS auc_roc, sum(n1 / all1 * (pr + prev) / 2) AS auc_pr FROM z),
l AS (SELECT 'auc_roc' AS metric, auc_roc AS cur, 0.918::DOUBLE AS target FROM roc UNION ALL SELECT 'auc_pr', auc_pr, 0.891 FROM roc UNION ALL SELECT 'f1', f1, 0.856 FROM m
 UNION ALL SELECT 'bal_acc', (sens + spec) / 2, 0.810 FROM m UNION ALL SELECT 'g_mean', sqrt(sens * spec), 0.824 FROM m)
SELECT metric, round(cur, 6) AS "current", target, round(target - cur, 6) AS gap, round((target - cur) / target * 100, 6) AS gap_pct, CAST(abs(target - cur) > 0.05 AS INT) AS large_gap FROM l""", "scored")
def ev08(spark, d):
    s = predicted(spark, d)
    rank = E.ranking_metrics(s).first()
    m = E.classification_metrics(s).select(
        F.lit(rank["auc_roc"]).alias("auc_roc"), F.lit(rank["auc_pr"]).alias("auc_pr"), "f1", F.col("balanced_accuracy").alias("bal_acc"), "g_mean")
    return rounded(E.target_gaps(m, "Proposed Stacking"), "current", "gap", "gap_pct")


def _u_sql(c):
    return f"""SELECT '{c}' AS "column", n1, n0, r1 - n1 * (n1 + 1) / 2.0::DOUBLE AS u,
 sqrt(n1::DOUBLE * n0 / 12 * ((n1 + n0 + 1) - ties / ((n1 + n0)::DOUBLE * (n1 + n0 - 1)))) AS sigma FROM (
 SELECT CAST(sum(k1) AS BIGINT) AS n1, CAST(sum(t) - sum(k1) AS BIGINT) AS n0, sum(k1 * (cum - t + (t + 1) / 2.0::DOUBLE)) AS r1, sum(t::DOUBLE * t * t - t) AS ties FROM (
 SELECT count(*) AS t, sum(isFraud) AS k1, sum(count(*)) OVER (ORDER BY {c} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM txn WHERE {c} IS NOT NULL GROUP BY {c}))"""


_U_COLUMNS = ["TransactionAmt", "dist1", "addr1", "card1"]


@query("ev09_rank_test", "WITH x AS (" + " UNION ALL ".join(_u_sql(c) for c in _U_COLUMNS) + """)
SELECT "column", n1, n0, u, round((greatest(u, n1::DOUBLE * n0 - u) - n1::DOUBLE * n0 / 2 - 0.5::DOUBLE) / sigma, 6) AS z FROM x""", "txn")
def ev09(spark, d):
    return rounded(E.rank_test(txn(spark, d), _U_COLUMNS), "z")


@query("ev09_rank_test_p")
def ev09_p(spark, d):
    return E.rank_test_p(txn(spark, d), _U_COLUMNS)


_HALF = 15 * 86400


def halves(spark, d):
    s = predicted(spark, d)
    return s.where(F.col("TransactionDT") < _HALF), s.where(F.col("TransactionDT") >= _HALF)


_DRIFT = f"""
b0 AS (SELECT CASE WHEN TransactionDT < {_HALF} THEN 0 ELSE 1 END AS part, p, least(floor(p / (1.0::DOUBLE / 50)), 49) AS b FROM scored WHERE p BETWEEN 0 AND 1),
bb AS (SELECT part, b - CAST(p < b * (1.0::DOUBLE / 50) AS INT) + CAST(p >= (b + 1) * (1.0::DOUBLE / 50) AND b < 49 AS INT) AS bin FROM b0),
cc AS (SELECT bin, count(*) FILTER (WHERE part = 0) AS r, count(*) FILTER (WHERE part = 1) AS c FROM bb GROUP BY 1),
pq AS (SELECT r * 50.0::DOUBLE / (SELECT sum(r) FROM cc) + 1e-9 AS p, c * 50.0::DOUBLE / (SELECT sum(c) FROM cc) + 1e-9 AS q FROM cc),
dr AS (SELECT sum(p * ln(p / q)) AS drift FROM pq)"""


@query("mon01_score_drift", f"WITH {_DRIFT.strip()} SELECT round(drift, 6) AS drift FROM dr", "scored")
def mon01(spark, d):
    return rounded(monitor.score_drift(*halves(spark, d)), "drift")


@query("mon02_retrain_flag", f"WITH {_DRIFT.strip()} SELECT round(drift, 6) AS drift, CAST(drift > 0.1 AS INT) AS retrain FROM dr", "scored")
def mon02(spark, d):
    return rounded(monitor.retrain_flag(monitor.score_drift(*halves(spark, d))), "drift")


@query("mon03_data_quality", """
SELECT count(*) AS n_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT ProductCD, card1, addr1, P_emaildomain FROM txn)) AS duplicate_rows,
  CAST(sum(CAST(addr1 IS NULL AS INT) + CAST(P_emaildomain IS NULL AS INT)) AS BIGINT) AS missing_cells,
  round(sum(CAST(addr1 IS NULL AS INT) + CAST(P_emaildomain IS NULL AS INT))::DOUBLE / (count(*) * 4), 6) AS missing_share FROM txn""", "txn")
def mon03(spark, d):
    return rounded(monitor.data_quality(txn(spark, d), ["ProductCD", "card1", "addr1", "P_emaildomain"]), "missing_share")


def _ks_sql(c):
    return f"""SELECT '{c}' AS "column", max(abs(fr - fc)) AS statistic, max(nr) AS n_ref, max(nc) AS n_cur FROM (
 SELECT sum(r) OVER w / (sum(r) OVER ())::DOUBLE AS fr, sum(c) OVER w / (sum(c) OVER ())::DOUBLE AS fc, CAST(sum(r) OVER () AS BIGINT) AS nr, CAST(sum(c) OVER () AS BIGINT) AS nc FROM (
 SELECT {c} AS v, count(*) FILTER (WHERE TransactionDT < {_HALF}) AS r, count(*) FILTER (WHERE TransactionDT >= {_HALF}) AS c FROM txn WHERE {c} IS NOT NULL GROUP BY 1)
 WINDOW w AS (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


_NUM = ["TransactionAmt", "dist1", "card1", "addr1", "TransactionDT"]
_KS = "kk AS (" + " UNION ALL ".join(_ks_sql(c) for c in _NUM) + ")"


def txn_halves(spark, d):
    t = txn(spark, d)
    return t.where(F.col("TransactionDT") < _HALF), t.where(F.col("TransactionDT") >= _HALF)


@query("mon04_column_drift", f"""WITH {_KS} SELECT "column", round(statistic, 6) AS statistic, n_ref, n_cur,
  CAST(statistic > 1.358::DOUBLE * sqrt((n_ref + n_cur) / (n_ref::DOUBLE * n_cur)) AS INT) AS drifted FROM kk""", "txn")
def mon04(spark, d):
    return rounded(monitor.numeric_drift(*txn_halves(spark, d), _NUM), "statistic")


@query("mon04_drift_share", f"""WITH {_KS}, f AS (SELECT CAST(statistic > 1.358::DOUBLE * sqrt((n_ref + n_cur) / (n_ref::DOUBLE * n_cur)) AS INT) AS drifted FROM kk)
SELECT count(*) AS columns, CAST(sum(drifted) AS BIGINT) AS drifted, round(avg(drifted), 6) AS share, CAST(avg(drifted) < 0.5 AS INT) AS passes FROM f""", "txn")
def mon04_share(spark, d):
    return rounded(monitor.drift_share(monitor.numeric_drift(*txn_halves(spark, d), _NUM)), "share")


def _psi_sql(c):
    return f"""SELECT '{c}' AS "column", sum((q - p) * ln(q / p)) AS statistic FROM (SELECT
 greatest(count(*) FILTER (WHERE TransactionDT < {_HALF}) / (SELECT count(*) FROM txn WHERE TransactionDT < {_HALF})::DOUBLE, 1e-4) AS p,
 greatest(count(*) FILTER (WHERE TransactionDT >= {_HALF}) / (SELECT count(*) FROM txn WHERE TransactionDT >= {_HALF})::DOUBLE, 1e-4) AS q
 FROM txn GROUP BY coalesce({c}, 'missing'))"""


@query("mon04_category_drift", "WITH s AS (" + " UNION ALL ".join(_psi_sql(c) for c in ["ProductCD", "P_emaildomain"])
       + ') SELECT "column", round(statistic, 6) AS statistic, CAST(statistic > 0.2 AS INT) AS drifted FROM s', "txn")
def mon04_category(spark, d):
    return rounded(monitor.category_drift(*txn_halves(spark, d), ["ProductCD", "P_emaildomain"]), "statistic")


@query("mon05_quality_by_set", f"""
WITH c AS (SELECT CASE WHEN TransactionDT < {_HALF} THEN 0 ELSE 1 END AS is_current, count(*) FILTER (WHERE isFraud = 1 AND p > 0.5) AS tp, count(*) FILTER (WHERE isFraud = 0 AND p > 0.5) AS fp,
  count(*) FILTER (WHERE isFraud = 1 AND p <= 0.5) AS fn, count(*) FILTER (WHERE isFraud = 0 AND p <= 0.5) AS tn FROM scored GROUP BY 1)
SELECT is_current, round((tp + tn)::DOUBLE / (tp + fp + fn + tn), 6) AS accuracy, round(tp::DOUBLE / (tp + fp), 6) AS precision, round(tp::DOUBLE / (tp + fn), 6) AS recall FROM c""", "scored")
def mon05(spark, d):
    m = monitor.quality_by_set(*halves(spark, d), "isFraud", "prediction").select("is_current", "accuracy", "precision", "recall")
    return rounded(m, "accuracy", "precision", "recall")
