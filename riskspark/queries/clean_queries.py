"""Projections, filters, casts and fills."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions import scalars as S
from riskspark.operators import clean as C
from riskspark.operators import io_checks
from riskspark.queries.registry import query
from riskspark.sources.views import scored, table, txn, wide


def r6(c):
    return F.round(c, 6)


@query("prj01_drop_columns", "SELECT * EXCLUDE (k, dist1) FROM txn", "txn")
def prj01(spark, d):
    df, _ = C.split_label(txn(spark, d), "isFraud", ["k", "dist1", "not_there"])
    return df


@query("prj02_rename", """SELECT event_id AS "id_event", event_type AS "id_type", value FROM events""")
def prj02(spark, d):
    e = table(spark, d, "events").select(F.col("event_id").alias("id-event"), F.col("event_type").alias("id-type"), "value")
    return C.rename_dashes(e)


@query("prj03_numeric_columns", "SELECT TransactionID, TransactionDT, TransactionAmt, card1, addr1, dist1, isFraud, k FROM txn", "txn")
def prj03(spark, d):
    t = txn(spark, d)
    return t.select(*C.columns_of_kind(t, "numeric"))


@query("prj04_column_family", "SELECT V1, V2, V3, V4, V5, V6, V7, V8 FROM wide", "wide")
def prj04(spark, d):
    w = wide(spark, d)
    return w.select(*C.columns_of_family(w, "V"))


@query("prj05_conform", """
SELECT coalesce(TRY_CAST(props AS DOUBLE), 0) AS TransactionAmt, user_id AS card1, CAST(0 AS BIGINT) AS addr1,
       coalesce(TRY_CAST(regexp_extract(props, '[0-9]+') AS BIGINT), 0) AS k, '' AS P_emaildomain FROM events""")
def prj05(spark, d):
    e = table(spark, d, "events")
    raw = e.select(F.col("props").alias("TransactionAmt"), F.col("user_id").alias("card1"),
                   F.regexp_extract("props", "[0-9]+", 0).alias("k"), F.col("event_type").alias("unseen_col"))
    fitted = T.StructType([T.StructField("TransactionAmt", T.DoubleType()), T.StructField("card1", T.LongType()),
                           T.StructField("addr1", T.LongType()), T.StructField("k", T.LongType()),
                           T.StructField("P_emaildomain", T.StringType())])
    return C.conform(raw, fitted)


@query("prj06_to_number", """SELECT event_id, TRY_CAST(CASE WHEN event_id % 3 = 0 THEN event_type ELSE CAST(value AS VARCHAR) END AS DOUBLE) AS num FROM events""")
def prj06(spark, d):
    mixed = F.when(F.col("event_id") % 3 == 0, F.col("event_type")).otherwise(F.col("value").cast("string"))
    return table(spark, d, "events").select("event_id", S.to_number(mixed).alias("num"))


@query("prj07_fill_chain", """
SELECT TransactionID, coalesce(dist1, (SELECT quantile_cont(dist1, 0.5) FROM txn)) AS dist1, coalesce(CAST(addr1 AS DOUBLE), -1) AS addr1 FROM txn""", "txn")
def prj07(spark, d):
    t = txn(spark, d).select("TransactionID", "dist1", F.col("addr1").cast("double").alias("addr1"))
    return C.fill(t, {**C.fit_medians(t, ["dist1"]), "addr1": None}, default=-1.0)


@query("prj08_non_finite", """SELECT event_id, CASE WHEN event_id % 5 IN (0, 1, 2) THEN 0.0 ELSE value END AS value FROM events""")
def prj08(spark, d):
    m = F.col("event_id") % 5
    odd = (F.when(m == 0, F.lit(float("inf"))).when(m == 1, F.lit(float("-inf"))).when(m == 2, F.lit(float("nan")))
           .otherwise(F.col("value")))
    return C.replace_non_finite(table(spark, d, "events").select("event_id", odd.alias("value")), ["value"], 0.0)


@query("prj09_median_impute", """
SELECT TransactionID, coalesce(dist1, (SELECT quantile_cont(dist1, 0.5) FROM txn)) AS dist1,
       coalesce(CAST(addr1 AS DOUBLE), (SELECT quantile_cont(addr1, 0.5) FROM txn)) AS addr1 FROM txn""", "txn")
def prj09(spark, d):
    t = txn(spark, d).select("TransactionID", "dist1", F.col("addr1").cast("double").alias("addr1"))
    return C.impute_median(t, ["dist1", "addr1"])


@query("prj10_fill_text", "SELECT TransactionID, coalesce(P_emaildomain, 'missing') AS P_emaildomain FROM txn", "txn")
def prj10(spark, d):
    return C.fill_text(txn(spark, d).select("TransactionID", "P_emaildomain"), ["P_emaildomain"])


@query("prj11_common_columns", """SELECT TransactionID, isFraud, 'fit' AS part FROM txn
UNION ALL SELECT TransactionID, isFraud, 'score' AS part FROM scored""", "txn scored")
def prj11(spark, d):
    a, b = C.common_columns(txn(spark, d).drop("TransactionDT", "TransactionAmt"), scored(spark, d))
    return a.withColumn("part", F.lit("fit")).unionByName(b.withColumn("part", F.lit("score")))


@query("flt01_class_slice", "SELECT dist1 FROM txn WHERE isFraud = 1 AND dist1 IS NOT NULL", "txn")
def flt01(spark, d):
    return C.class_slice(txn(spark, d), "dist1", 1)


@query("flt02_nonneg_log1p", "SELECT TransactionID, round(ln(1 + dist1), 6) AS log_dist FROM txn WHERE dist1 >= 0", "txn")
def flt02(spark, d):
    return C.nonneg_log1p(txn(spark, d).select("TransactionID", "dist1"), "dist1", "log_dist").select(
        "TransactionID", r6("log_dist").alias("log_dist"))


@query("flt03_prediction_filter", """
WITH q AS (SELECT *, CAST(p > 0.5 AS INT) AS prediction FROM scored)
SELECT 'all' AS mode, TransactionID FROM q UNION ALL SELECT 'fraud', TransactionID FROM q WHERE prediction = 1
UNION ALL SELECT 'safe', TransactionID FROM q WHERE prediction = 0
UNION ALL SELECT 'false-positives', TransactionID FROM q WHERE prediction = 1 AND isFraud = 0
UNION ALL SELECT 'false-negatives', TransactionID FROM q WHERE prediction = 0 AND isFraud = 1""", "scored")
def flt03(spark, d):
    s = scored(spark, d).withColumn("prediction", S.predicted("p"))
    out = None
    for mode in ["all", "fraud", "safe", "false-positives", "false-negatives"]:
        part = C.filter_predictions(s, mode).select(F.lit(mode).alias("mode"), "TransactionID")
        out = part if out is None else out.unionByName(part)
    return out


@query("flt04_risk_search", """
WITH q AS (SELECT 'TXN-' || (1000 + TransactionID) AS txn_code, CASE WHEN p > 0.5 THEN 'severe' WHEN p > 0.3 THEN 'suspicious' ELSE 'safe' END AS risk_level FROM scored)
SELECT 'Show FRAUD' AS term, txn_code, risk_level FROM q WHERE risk_level = 'severe'
UNION ALL SELECT 'suspicious', txn_code, risk_level FROM q WHERE risk_level = 'suspicious'
UNION ALL SELECT 'txn-12', txn_code, risk_level FROM q WHERE contains(lower(txn_code), 'txn-12')""", "scored")
def flt04(spark, d):
    s = scored(spark, d).select(F.concat(F.lit("TXN-"), (F.lit(1000) + F.col("TransactionID")).cast("string")).alias("txn_code"),
                                S.risk_band("p").alias("risk_level"))
    out = None
    for term in ["Show FRAUD", "suspicious", "txn-12"]:
        part = C.search_risk(s, term).select(F.lit(term).alias("term"), "txn_code", "risk_level")
        out = part if out is None else out.unionByName(part)
    return out


@query("flt05_run_search", f"SELECT version, model_type FROM ({io_checks.RUNS_SQL}) WHERE contains(lower(version), 'click') OR contains(lower(model_type), 'click')")
def flt05(spark, d):
    return C.search_runs(io_checks.runs_by_day(spark, d), "CLICK").select("version", "model_type")


@query("flt06_quantile_clip", """
WITH q AS (SELECT quantile_cont(TransactionAmt, 0.01) AS lo, quantile_cont(TransactionAmt, 0.99) AS hi, quantile_cont(dist1, 0.99) AS dhi FROM txn)
SELECT TransactionID, round(least(greatest(TransactionAmt, lo), hi), 6) AS TransactionAmt,
       CASE WHEN dist1 IS NOT NULL THEN round(least(dist1, dhi), 6) END AS dist1 FROM txn, q""", "txn")
def flt06(spark, d):
    t = txn(spark, d).select("TransactionID", "TransactionAmt", "dist1")
    out = C.clip_quantiles(t, {"TransactionAmt": (0.01, 0.99), "dist1": (None, 0.99)})
    return out.select("TransactionID", r6("TransactionAmt").alias("TransactionAmt"), r6("dist1").alias("dist1"))
