"""Window operators, ordering and top-k."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.functions import scalars as S
from riskspark.operators import behavior as B
from riskspark.operators import evaluate, io_checks, profile, selection, timeseries
from riskspark.plans.ranking import global_position
from riskspark.queries.profile_queries import TXN_DEVICE, _norm, txn_with_device
from riskspark.queries.registry import query
from riskspark.queries.scalar_queries import DOW, HOD
from riskspark.sources.views import V_COLUMNS, scored, txn, wide


def r6(c):
    return F.round(c, 6)


_LAGS = ", ".join(f"lag(fraud_count, {i}) OVER w AS lag_{i}" for i in range(1, 7))


@query("wn01_lags", f"""
WITH l AS (SELECT hour_window, fraud_count, {_LAGS},
  round(sin(2 * pi() * ((window_start // 3600) % 24) / 24.0), 6) + 0.0::DOUBLE AS hour_sin, round(cos(2 * pi() * ((window_start // 3600) % 24) / 24.0), 6) + 0.0::DOUBLE AS hour_cos FROM hourly WINDOW w AS (ORDER BY hour_window))
SELECT * FROM l WHERE lag_6 IS NOT NULL""", "hourly")
def wn01(spark, d):
    out = timeseries.lag_frame(timeseries.hourly(txn(spark, d)), 6, with_target=False)
    return out.select("hour_window", "fraud_count", *[f"lag_{i}" for i in range(1, 7)], *[(r6(c) + 0.0).alias(c) for c in ("hour_sin", "hour_cos")])


@query("wn02_lead_target", """
WITH l AS (SELECT hour_window, lag(fraud_count, 6) OVER w AS lag_6, lead(fraud_count) OVER w AS target FROM hourly WINDOW w AS (ORDER BY hour_window))
SELECT hour_window, target FROM l WHERE lag_6 IS NOT NULL AND target IS NOT NULL""", "hourly")
def wn02(spark, d):
    return timeseries.lag_frame(timeseries.hourly(txn(spark, d))).select("hour_window", "target")


@query("wn03_rolling_mean", """
SELECT hour_window, round(avg(fraud_rate) OVER (ORDER BY hour_window ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 6) AS rolling_avg FROM hourly""", "hourly")
def wn03(spark, d):
    return timeseries.rolling_mean(timeseries.hourly(txn(spark, d))).select("hour_window", r6("rolling_avg").alias("rolling_avg"))


@query("wn04_momentum", """
SELECT TransactionID, round(coalesce(avg(isFraud) OVER (ORDER BY TransactionDT, TransactionID ROWS BETWEEN 1000 PRECEDING AND 1 PRECEDING),
       (SELECT avg(isFraud) FROM txn)), 6) AS momentum FROM txn""", "txn")
def wn04(spark, d):
    t = txn(spark, d).select("TransactionID", "TransactionDT", "isFraud")
    return B.momentum(t, "TransactionDT", "TransactionID", "isFraud").select("TransactionID", r6("momentum").alias("momentum"))


@query("wn04_momentum_delayed", """
SELECT TransactionID, round(coalesce(avg(isFraud) OVER (ORDER BY TransactionDT, TransactionID ROWS BETWEEN 600 PRECEDING AND 101 PRECEDING),
       (SELECT avg(isFraud) FROM txn)), 6) AS momentum FROM txn""", "txn")
def wn04_delayed(spark, d):
    t = txn(spark, d).select("TransactionID", "TransactionDT", "isFraud")
    out = B.momentum(t, "TransactionDT", "TransactionID", "isFraud", rows=500, delay=100, chunk=2000)
    return out.select("TransactionID", r6("momentum").alias("momentum"))


def _vel(e):
    return "".join(
        f", count(*) OVER (PARTITION BY {_norm(e)} ORDER BY TransactionDT RANGE BETWEEN {w} PRECEDING AND CURRENT ROW) "
        f"- count(*) OVER (PARTITION BY {_norm(e)}, TransactionDT) + row_number() OVER (PARTITION BY {_norm(e)}, TransactionDT ORDER BY TransactionID) - 1 AS vel__{e}__cnt_{w}s"
        for w in B.VELOCITY_WINDOWS)


_VEL_SQL = f"WITH {TXN_DEVICE} SELECT TransactionID" + "".join(_vel(e) for e in B.VELOCITY_ENTITIES) + " FROM td"


@query("wn05_velocity", _VEL_SQL, "txn identity")
def wn05(spark, d):
    out = B.with_velocity(txn_with_device(spark, d), B.VELOCITY_ENTITIES, "TransactionDT", "TransactionID")
    return out.select("TransactionID", *[c for c in out.columns if c.startswith("vel__")])


@query("wn05_velocity_hot_keys", _VEL_SQL, "txn identity")
def wn05_hot(spark, d):
    out = B.with_velocity(txn_with_device(spark, d), B.VELOCITY_ENTITIES, "TransactionDT", "TransactionID", min_hot_rows=500)
    return out.select("TransactionID", *[c for c in out.columns if c.startswith("vel__")])


@query("wn06_mid_rank", """
SELECT TransactionAmt AS value, count(*) AS n, CAST(sum(isFraud) AS BIGINT) AS n1,
       sum(count(*)) OVER (ORDER BY TransactionAmt ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT - count(*) + (count(*) + 1) / 2.0::DOUBLE AS mid_rank FROM txn GROUP BY 1""", "txn")
def wn06(spark, d):
    return evaluate.mid_ranks(txn(spark, d), "TransactionAmt").select("value", "n", "n1", "mid_rank")


@query("wn07_cumulative_scores", """
SELECT p AS score, sum(sum(isFraud)) OVER w::BIGINT AS tp, sum(sum(1 - isFraud)) OVER w::BIGINT AS fp FROM scored GROUP BY p WINDOW w AS (ORDER BY p DESC)""", "scored")
def wn07(spark, d):
    return evaluate.score_table(scored(spark, d)).select("score", "tp", "fp")


@query("wn08_group_count", """
SELECT TransactionID, count(dist1) OVER (PARTITION BY card1, coalesce(CAST(addr1 AS VARCHAR), 'nan')) AS uid_rows FROM txn""", "txn")
def wn08(spark, d):
    return B.with_group_count(txn(spark, d), S.user_key(), "dist1", "uid_rows", "TransactionID").select("TransactionID", "uid_rows")


@query("wn09_every_nth", """
WITH r AS (SELECT *, row_number() OVER (ORDER BY hour_window) - 1 AS rn, count(*) OVER () AS n FROM hourly)
SELECT hour_window, total FROM r WHERE rn % greatest(1, n // 500) = 0""", "hourly")
def wn09(spark, d):
    return timeseries.every_nth(timeseries.hourly(txn(spark, d)), 500).select("hour_window", "total")


@query("wn09_evenly_spaced", """
WITH r AS (SELECT *, row_number() OVER (ORDER BY hour_window) - 1 AS rn, count(*) OVER () AS n FROM hourly)
SELECT hour_window, total FROM r WHERE rn IN (SELECT i * (n - 1) // 99 FROM (SELECT unnest(range(100)) AS i), (SELECT count(*) AS n FROM hourly))""", "hourly")
def wn09_spaced(spark, d):
    return timeseries.evenly_spaced(timeseries.hourly(txn(spark, d)), 100).select("hour_window", "total")


@query("wn10_window_anomalies", """
WITH h AS (SELECT *, round_even(fraud_rate, 4) AS rate4 FROM hourly), s AS (SELECT avg(rate4) AS mu, stddev_samp(rate4) AS sd FROM h)
SELECT hour_window, total, fraud_count, rate4, round(avg(fraud_rate) OVER (ORDER BY hour_window ROWS BETWEEN 5 PRECEDING AND CURRENT ROW), 6) AS rolling_avg,
       round_even((rate4 - mu) / (sd + 1e-9), 4) AS z_score, CAST(round_even((rate4 - mu) / (sd + 1e-9), 4) > 2.5 AS INT) AS is_anomaly FROM h, s""", "hourly")
def wn10(spark, d):
    h = timeseries.rolling_mean(timeseries.hourly(txn(spark, d)))
    return timeseries.anomalies(h).select("hour_window", "total", "fraud_count", "rate4", r6("rolling_avg").alias("rolling_avg"), "z_score", "is_anomaly")


# ---- order and top-k ------------------------------------------------------------------------------------------------

@query("st01_total_order", "SELECT TransactionID, row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS pos FROM txn", "txn")
def st01(spark, d):
    return global_position(txn(spark, d).select("TransactionID", "TransactionDT"), ["TransactionDT", "TransactionID"]).select("TransactionID", "pos")


_ABS_R = " UNION ALL ".join(f"SELECT 'V{i}' AS \"column\", {i} AS o, corr(V{i}, isFraud) AS r FROM wide" for i in range(1, 9) if i != 6)


@query("st02_largest_k", f"SELECT \"column\", round(abs(r), 6) AS score FROM ({_ABS_R}) ORDER BY round(abs(r), 12) DESC, o LIMIT 3", "wide")
def st02(spark, d):
    c = selection.label_correlations(wide(spark, d), V_COLUMNS).withColumn("score", F.abs("r"))
    return selection.top_by_score(c.where(F.col("score").isNotNull()), 3, "score").select("column", r6("score").alias("score"))


@query("st03_by_absolute", f"SELECT \"column\", row_number() OVER (ORDER BY round(abs(r), 9) DESC, o) AS place FROM ({_ABS_R})", "wide")
def st03(spark, d):
    c = selection.label_correlations(wide(spark, d), V_COLUMNS).where(F.col("r").isNotNull())
    # one row per column of the table
    order = Window.orderBy(F.desc(F.round(F.abs("r"), 9)), "ordinal")
    return c.select("column", F.row_number().over(order).cast("bigint").alias("place"))


@query("st04_best_key", f"""
WITH td AS (SELECT * FROM txn), h AS (SELECT {HOD} AS k, avg(isFraud) AS r FROM td GROUP BY 1), w AS (SELECT {DOW} AS k, avg(isFraud) AS r FROM td GROUP BY 1)
(SELECT 'hour' AS what, k, round(r, 6) AS rate FROM h ORDER BY r DESC, k LIMIT 1) UNION ALL (SELECT 'dow', k, round(r, 6) FROM w ORDER BY r DESC, k LIMIT 1)""", "txn")
def st04(spark, d):
    t = txn(spark, d)
    out = None
    for what, key in (("hour", S.hour_of_day("TransactionDT")), ("dow", S.day_of_week("TransactionDT"))):
        g = t.groupBy(key.alias("k")).agg(F.avg("isFraud").alias("r"))
        best = profile.best_key(g, "k", "r").select(F.lit(what).alias("what"), "k", r6("r").alias("rate"))
        out = best if out is None else out.unionByName(best)
    return out


@query("st06_leaderboard", f"SELECT version, rank() OVER (ORDER BY auc_pr DESC) AS place FROM ({io_checks.RUNS_SQL})")
def st06(spark, d):
    # one row per run
    return io_checks.runs_by_day(spark, d).select("version", F.rank().over(Window.orderBy(F.desc("auc_pr"))).cast("bigint").alias("place"))


@query("st07_paging", "SELECT TransactionID, p FROM scored ORDER BY TransactionDT DESC, TransactionID LIMIT 50 OFFSET 100", "scored")
def st07(spark, d):
    return scored(spark, d).orderBy(F.desc("TransactionDT"), "TransactionID").offset(100).limit(50).select("TransactionID", "p")
