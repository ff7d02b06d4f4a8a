"""Aggregations and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.functions import scalars as S
from riskspark.operators import behavior as B
from riskspark.operators import joins, profile, selection, timeseries
from riskspark.plans.scratch import persist_table
from riskspark.queries.registry import query
from riskspark.queries.scalar_queries import DOW, HOD
from riskspark.sources.views import V_COLUMNS, identity, scored, txn, wide


def r6(c):
    return F.round(c, 6)


def rounded(df, *names):
    return df.select(*[r6(c).alias(c) if c in names else F.col(c) for c in df.columns])


def txn_with_device(spark, d):
    return joins.with_identity(txn(spark, d), identity(spark, d))


TXN_DEVICE = "td AS (SELECT txn.*, DeviceType, DeviceInfo FROM txn LEFT JOIN identity USING (TransactionID))"


def _rate_sql(key, expr=None):
    e = expr or key
    return (f"SELECT '{key}' AS key, CAST({e} AS VARCHAR) AS level, round(avg(isFraud), 6) AS rate, CAST(sum(isFraud) AS BIGINT) AS positives, "
            f"count(*) AS n FROM td WHERE {e} IS NOT NULL GROUP BY 2")


@query("ag01_rate_table", f"WITH {TXN_DEVICE} " + " UNION ALL ".join(
    [_rate_sql("hour", HOD), _rate_sql("dow", DOW), _rate_sql("ProductCD"), _rate_sql("card4"), _rate_sql("DeviceType")]), "txn identity")
def ag01(spark, d):
    t = txn_with_device(spark, d).withColumns({"hour": S.hour_of_day("TransactionDT"), "dow": S.day_of_week("TransactionDT")})
    return rounded(profile.rate_table(t, ["hour", "dow", "ProductCD", "card4", "DeviceType"]), "rate")


@query("ag02_class_balance", """
SELECT n0, n1, round(n1 * 100.0 / (n0 + n1), 6) AS pct1, round(n0::DOUBLE / n1, 6) AS ratio, round(n0::DOUBLE / n1, 6) AS pos_weight,
       round(n0::DOUBLE / n1, 6) AS pos_weight_guarded
FROM (SELECT count(*) FILTER (WHERE isFraud = 0) AS n0, count(*) FILTER (WHERE isFraud = 1) AS n1 FROM txn)""".replace("n1 * 100.0 /", "n1 * 100.0::DOUBLE /"), "txn")
def ag02(spark, d):
    return rounded(profile.class_balance(txn(spark, d)), "pct1", "ratio", "pos_weight", "pos_weight_guarded")


_NULLS = " UNION ALL ".join(f"SELECT 'V{i}' AS \"column\", round(100.0::DOUBLE * avg(CASE WHEN V{i} IS NULL THEN 1 ELSE 0 END), 6) AS null_pct FROM wide" for i in range(1, 9))


@query("ag03_null_profile", _NULLS, "wide")
def ag03(spark, d):
    return rounded(profile.null_profile(wide(spark, d), V_COLUMNS), "null_pct")


@query("ag03_null_summary", f"""SELECT count(*) FILTER (WHERE null_pct = 0) AS complete, count(*) FILTER (WHERE null_pct > 50) AS over_50,
       count(*) FILTER (WHERE null_pct > 95) AS over_95 FROM ({_NULLS})""", "wide")
def ag03_summary(spark, d):
    return profile.null_summary(profile.null_profile(wide(spark, d), V_COLUMNS))


def _describe_sql(col, extra=""):
    sel, grp = (f"{extra}, ", f"GROUP BY {extra}") if extra else ("", "")
    return (f"SELECT {sel}'{col}' AS \"column\", round(avg({col}), 6) AS mean, round(stddev_samp({col}), 6) AS std, round(skewness({col}), 6) AS skew, "
            f"round(min({col}), 6)::DOUBLE AS min, round(max({col}), 6)::DOUBLE AS max, count({col}) AS n, round(quantile_cont({col}, 0.25), 6)::DOUBLE AS q1, "
            f"round(quantile_cont({col}, 0.5), 6)::DOUBLE AS median, round(quantile_cont({col}, 0.75), 6)::DOUBLE AS q3 FROM txn {grp}")


_STATS = ["mean", "std", "skew", "min", "max", "q1", "median", "q3"]


@query("ag04_global_stats", " UNION ALL ".join(_describe_sql(c) for c in ["TransactionAmt", "dist1", "TransactionDT"]), "txn")
def ag04(spark, d):
    return rounded(profile.describe(txn(spark, d), ["TransactionAmt", "dist1", "TransactionDT"]), *_STATS)


@query("ag04_stats_by_class", " UNION ALL ".join(_describe_sql(c, "isFraud") for c in ["TransactionAmt", "dist1"]), "txn")
def ag04_by_class(spark, d):
    return rounded(profile.describe(txn(spark, d), ["TransactionAmt", "dist1"], "isFraud"), *_STATS)


@query("ag05_user_stats", """
SELECT card1::VARCHAR || '_' || coalesce(addr1::VARCHAR, 'nan') AS uid, count(*) AS user_count,
       round(avg(TransactionAmt), 6) AS user_mean, round(quantile_cont(TransactionAmt, 0.5), 6) AS user_median FROM txn GROUP BY 1""", "txn")
def ag05(spark, d):
    stats, _ = B.fit_users(txn(spark, d))
    return rounded(stats, "user_mean", "user_median")


def _block_sql(key):
    g = "".join(f", round(avg({v}) OVER w, 8) AS {key}_{v}_mean, round(stddev_samp({v}) OVER w, 8) AS {key}_{v}_std, count({v}) OVER w AS {key}_{v}_count"
                for v in ["TransactionAmt", "dist1"])
    return f"SELECT TransactionID{g} FROM txn WINDOW w AS (PARTITION BY {key})"


@query("ag06_group_block", f"SELECT * FROM ({_block_sql('card1')}) JOIN ({_block_sql('addr1')}) USING (TransactionID)", "txn")
def ag06(spark, d):
    t = txn(spark, d).select("TransactionID", "card1", "addr1", "TransactionAmt", "dist1")
    out = B.with_group_stats(t, ["card1", "addr1"], ["TransactionAmt", "dist1"], "TransactionID").drop("card1", "addr1", "TransactionAmt", "dist1")
    return out.select(*[F.round(c, 8).alias(c) if c.endswith(("_mean", "_std")) else F.col(c) for c in out.columns])


def _norm(c):
    return f"lower(trim(coalesce(CAST({c} AS VARCHAR), 'missing')))"


_DEGREES = [(x, y) for a, b in B.ENTITY_PAIRS for x, y in ((a, b), (b, a))]


@query("ag07_entity_degrees", f"WITH {TXN_DEVICE}, " + ", ".join(
    f"g{i} AS (SELECT {_norm(x)} AS kk, count(DISTINCT {_norm(y)}) AS dd FROM td GROUP BY 1)" for i, (x, y) in enumerate(_DEGREES))
    + " SELECT TransactionID" + "".join(f", g{i}.dd AS entity__{x}__unique_{y}" for i, (x, y) in enumerate(_DEGREES))
    + " FROM td" + "".join(f" JOIN g{i} ON g{i}.kk = {_norm('td.' + x)}" for i, (x, y) in enumerate(_DEGREES)), "txn identity")
def ag07(spark, d):
    out = B.with_entity_degrees(txn_with_device(spark, d), "TransactionID")
    return out.select("TransactionID", *[c for c in out.columns if c.startswith("entity__")])


_SETS = [["card1"], ["card1", "addr1"], ["card1", "P_emaildomain"], ["card1", "DeviceType"], ["card1", "DeviceInfo"], ["card1", "addr1", "P_emaildomain"]]


@query("ag08_key_set_features", f"WITH {TXN_DEVICE}, u AS (SELECT *, " + ", ".join(
    " || '|' || ".join(_norm(c) for c in ks) + f" AS s{i}" for i, ks in enumerate(_SETS)) + " FROM td), "
    + ", ".join(f"m{i} AS (SELECT s{i}, count(*) AS c, quantile_cont(TransactionAmt, 0.5) AS m FROM u GROUP BY 1)" for i in range(len(_SETS)))
    + " SELECT TransactionID" + "".join(
        f", m{i}.c AS {'__'.join(ks)}__count, round(m{i}.m, 6) AS {'__'.join(ks)}__amt_median, round(TransactionAmt / (m{i}.m + 1e-6), 6) AS {'__'.join(ks)}__amt_ratio"
        for i, ks in enumerate(_SETS)) + " FROM u" + "".join(f" JOIN m{i} USING (s{i})" for i in range(len(_SETS))), "txn identity")
def ag08(spark, d):
    t = txn_with_device(spark, d)
    sets = B.usable_key_sets(t)
    stats = persist_table(B.key_set_stats(t, sets), "keysets")
    overall = B.fit_amount(t)["median"]
    out = B.with_key_sets(t.select("TransactionID", "TransactionAmt", "card1", "addr1", "P_emaildomain", "DeviceType", "DeviceInfo"), stats, sets, overall, "TransactionID")
    cols = [c for c in out.columns if c.endswith(("__count", "__amt_median", "__amt_ratio"))]
    return rounded(out.select("TransactionID", *cols), *[c for c in cols if not c.endswith("__count")])


def _level_sql(c):
    return (f"SELECT '{c}' AS \"column\", (SELECT lev FROM (SELECT {_norm(c)} AS lev, count(*) AS n FROM td GROUP BY 1) ORDER BY n DESC, lev LIMIT 1) AS mode, "
            f"count(DISTINCT {_norm(c)}) AS n_levels, CASE WHEN count(DISTINCT {_norm(c)}) <= 12 THEN string_agg(DISTINCT {_norm(c)}, ';' ORDER BY {_norm(c)}) END AS levels FROM td")


@query("ag09_levels", f"WITH {TXN_DEVICE} " + " UNION ALL ".join(_level_sql(c) for c in ["ProductCD", "card4", "P_emaildomain", "DeviceInfo"]), "txn identity")
def ag09(spark, d):
    s = B.level_summary(txn_with_device(spark, d), ["ProductCD", "card4", "P_emaildomain", "DeviceInfo"])
    return s.select("column", "mode", "n_levels", F.array_join("levels", ";").alias("levels"))


@query("ag10_top_levels", """
WITH c AS (SELECT P_emaildomain AS e, count(*) AS n FROM txn WHERE P_emaildomain IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 6)
SELECT CASE WHEN P_emaildomain IN (SELECT e FROM c) THEN P_emaildomain ELSE 'other' END AS level, count(*) AS n FROM txn GROUP BY 1""", "txn")
def ag10(spark, d):
    return profile.top_n_levels(txn(spark, d), "P_emaildomain", 6)


@query("ag11_heat_map", f"""
WITH b AS (SELECT {DOW} AS dow, {HOD} AS hod, isFraud FROM txn),
g AS (SELECT x.dow, h.hod FROM (SELECT DISTINCT dow FROM b) x, (SELECT unnest(range(24)) AS hod) h)
SELECT g.dow, g.hod, round(coalesce(avg(isFraud), 0), 6) AS rate FROM g LEFT JOIN b USING (dow, hod) GROUP BY 1, 2""", "txn")
def ag11(spark, d):
    return rounded(timeseries.heat_map(txn(spark, d)), "rate")


@query("ag12_histogram", """
WITH v AS (SELECT isFraud, ln(1 + TransactionAmt) AS x FROM txn), r AS (SELECT min(x) AS lo, (max(x) - min(x)) / 50 AS w, max(x) AS hi FROM v WHERE isFraud = 0)
SELECT isFraud, CAST(least(floor((x - lo) / w), 49) AS BIGINT) AS bin, count(*) AS n FROM v, r WHERE x BETWEEN lo AND hi GROUP BY 1, 2""", "txn")
def ag12(spark, d):
    return profile.class_histogram(txn(spark, d), F.log(F.col("TransactionAmt") + 1))


@query("ag13_bucket_rates", """
SELECT CAST((TransactionAmt > 10) AS INT) + CAST((TransactionAmt > 50) AS INT) + CAST((TransactionAmt > 100) AS INT) + CAST((TransactionAmt > 250) AS INT)
     + CAST((TransactionAmt > 500) AS INT) + CAST((TransactionAmt > 1000) AS INT) + CAST((TransactionAmt > 5000) AS INT) AS bucket, count(*) AS n,
     CAST(sum(isFraud) AS BIGINT) AS positives, round(avg(isFraud), 6) AS rate FROM txn WHERE TransactionAmt > 0 GROUP BY 1""", "txn")
def ag13(spark, d):
    return rounded(profile.bucket_rates(txn(spark, d), "TransactionAmt"), "rate")


@query("ag14_cut_rates", """
WITH r AS (SELECT min(TransactionAmt) AS lo, (max(TransactionAmt) - min(TransactionAmt)) / 20 AS w FROM txn)
SELECT CAST(greatest(least(ceil((TransactionAmt - lo) / w) - 1, 19), 0) AS BIGINT) AS cut, count(*) AS n, round(avg(isFraud), 6) AS rate FROM txn, r GROUP BY 1""", "txn")
def ag14(spark, d):
    return rounded(profile.cut_rates(txn(spark, d), "TransactionAmt"), "rate")


def _corr_label(c, src="wide"):
    return f"SELECT '{c}' AS \"column\", CASE WHEN var_pop({c}) > 0 THEN round(corr({c}, isFraud), 6) END AS r FROM {src}"


_WIDE_POWERS = [(i, p) for i in range(64) for p in (1, 2, 3, 4)]


@query("ag15_wide_correlation", """
WITH long AS (SELECT vec_id, CAST(label = 0 AS INT) AS y, unnest(range(64)) AS i, x FROM vectors), cells AS (SELECT y, i, x[i + 1] AS v, unnest(range(1, 5)) AS p FROM long)
SELECT 'x' || i || '_' || p AS "column", round(corr(v ** p, y), 6) AS r FROM cells GROUP BY i, p""", "vectors")
def ag15_wide(spark, d):
    """256 columns in one pass."""
    from riskspark.sources.views import vectors

    v = vectors(spark, d).select((F.col("label") == 0).cast("int").alias("isFraud"), *[F.pow(F.get("x", F.lit(i)), F.lit(p)).alias(f"x{i}_{p}") for i, p in _WIDE_POWERS])
    return selection.label_correlations(v, [f"x{i}_{p}" for i, p in _WIDE_POWERS]).select("column", r6("r").alias("r"))


@query("ag15_label_correlation", " UNION ALL ".join(
    "SELECT 'V6' AS \"column\", CAST(NULL AS DOUBLE) AS r" if i == 6 else _corr_label(f"V{i}") for i in range(1, 9)), "wide")
def ag15(spark, d):
    return selection.label_correlations(wide(spark, d), V_COLUMNS).select("column", r6("r").alias("r"))


_REDUNDANT = " UNION ALL ".join(f"SELECT 'V{i}' AS a, 'V{j}' AS b, round(corr(V{i}, V{j}), 6) AS r FROM wide"
                                for i in range(1, 9) for j in range(i + 1, 9) if 6 not in (i, j))


@query("ag16_redundant_pairs", f"SELECT * FROM ({_REDUNDANT}) WHERE abs(r) > 0.98", "wide")
def ag16(spark, d):
    return selection.redundant_pairs(wide(spark, d), V_COLUMNS).select("a", "b", r6("r").alias("r"))


@query("ag17_missingness_correlation", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(corr(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END, isFraud), 6) AS r FROM txn" for c in ["addr1", "P_emaildomain", "dist1"]), "txn")
def ag17(spark, d):
    t = txn(spark, d).drop("k")
    shares = B.null_fractions(t)
    top = sorted((c for c in shares if shares[c] > 0), key=lambda c: (-shares[c], c))[:10]
    flags = t.select("isFraud", *[S.null_flag(c).alias(c) for c in sorted(top)])
    return selection.label_correlations(flags, sorted(top)).select("column", r6("r").alias("r"))


def _iqr_sql(c):
    return (f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} < q1 - 1.5::DOUBLE * (q3 - q1) OR {c} > q3 + 1.5::DOUBLE * (q3 - q1)) AS n_outliers, "
            f"round(100.0::DOUBLE * count(*) FILTER (WHERE {c} < q1 - 1.5::DOUBLE * (q3 - q1) OR {c} > q3 + 1.5::DOUBLE * (q3 - q1)) / count({c}), 6) AS pct, "
            f"round(avg(isFraud) FILTER (WHERE {c} < q1 - 1.5::DOUBLE * (q3 - q1) OR {c} > q3 + 1.5::DOUBLE * (q3 - q1)), 6) AS rate "
            f"FROM txn, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM txn)")


@query("ag18_iqr_outliers", " UNION ALL ".join(_iqr_sql(c) for c in ["TransactionAmt", "dist1"]), "txn")
def ag18(spark, d):
    return rounded(profile.iqr_outliers(txn(spark, d), ["TransactionAmt", "dist1"]), "pct", "rate")


@query("ag19_hourly", "SELECT hour_window, total, fraud_count, round(fraud_rate, 6) AS fraud_rate, window_start FROM hourly", "hourly")
def ag19(spark, d):
    return rounded(timeseries.hourly(txn(spark, d)), "fraud_rate")


@query("ag20_cluster_profile", """
WITH c AS (SELECT *, CASE WHEN card1 % 6 = 4 THEN 0 ELSE card1 % 6 END AS cl FROM txn), g AS (
SELECT cl, count(*) AS size, CAST(sum(isFraud) AS BIGINT) AS fraud_count, avg(isFraud) AS fraud_rate, avg(TransactionAmt) AS ma, avg(dist1) AS md FROM c GROUP BY 1)
SELECT i AS cluster, coalesce(size, 0) AS size, coalesce(fraud_count, 0) AS fraud_count, round(coalesce(fraud_rate, 0), 6) AS fraud_rate,
  round(coalesce(size, 0) * 100.0::DOUBLE / (SELECT count(*) FROM txn), 6) AS pct_of_data, round(ma, 6) AS mean_TransactionAmt, round(md, 6) AS mean_dist1
FROM (SELECT unnest(range((SELECT max(cl) + 1 FROM c))) AS i) LEFT JOIN g ON i = cl""", "txn")
def ag20(spark, d):
    m = F.col("card1") % 6
    t = txn(spark, d).withColumn("cluster_label", F.when(m == 4, 0).otherwise(m))
    return rounded(profile.cluster_profile(t, "cluster_label", ["TransactionAmt", "dist1"]), "fraud_rate", "pct_of_data", "mean_TransactionAmt", "mean_dist1")


@query("ag21_box_numbers", """
SELECT isFraud, count(TransactionAmt) AS n, round(min(TransactionAmt), 6) AS min, round(quantile_cont(TransactionAmt, 0.25), 6) AS q1,
 round(quantile_cont(TransactionAmt, 0.5), 6) AS median, round(quantile_cont(TransactionAmt, 0.75), 6) AS q3, round(max(TransactionAmt), 6) AS max FROM txn GROUP BY 1""", "txn")
def ag21(spark, d):
    return rounded(profile.box_numbers(txn(spark, d), "TransactionAmt", "isFraud"), *profile.FIVE_NUMBERS)


@query("ag22_kpis", """
SELECT count(*) AS total, count(*) FILTER (WHERE p > 0.5) AS fraud, count(*) FILTER (WHERE p <= 0.5) AS safe, round(avg(p) * 100, 6) AS avg_probability FROM scored""", "scored")
def ag22(spark, d):
    return rounded(profile.kpis(scored(spark, d)), "avg_probability")


@query("ag23_row_null_count", """
SELECT TransactionID, CAST(addr1 IS NULL AS INT) + CAST(P_emaildomain IS NULL AS INT) + CAST(dist1 IS NULL AS INT) + CAST(card4 IS NULL AS INT) AS missing_count FROM txn""", "txn")
def ag23(spark, d):
    return txn(spark, d).select("TransactionID", S.null_count(["addr1", "P_emaildomain", "dist1", "card4"]).alias("missing_count"))


@query("ag24_cardinality", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM txn" for c in ["card1", "addr1", "ProductCD", "P_emaildomain"]), "txn")
def ag24(spark, d):
    return profile.cardinality(txn(spark, d), ["card1", "addr1", "ProductCD", "P_emaildomain"])


@query("ag25_overview", """
SELECT count(*) AS n_rows, CAST(sum(CAST(V7 IS NULL AS INT) + CAST(V8 IS NULL AS INT)) AS BIGINT) AS missing_cells,
  CAST(9 AS BIGINT) AS n_columns, CAST(9 AS BIGINT) AS n_numeric, CAST(0 AS BIGINT) AS n_text, CAST(7 AS BIGINT) AS n_kept FROM wide""", "wide")
def ag25(spark, d):
    w = wide(spark, d)
    return profile.overview(w, [c for c in V_COLUMNS if c not in set(selection.constant_columns(w, V_COLUMNS))])
