"""Scalar expressions applied to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.functions import scalars as S
from riskspark.operators import behavior
from riskspark.queries.registry import query
from riskspark.sources.views import identity, scored, txn


def r6(c):
    return F.round(c, 6)


HOD = "CAST(floor(TransactionDT / 3600.0) AS BIGINT) % 24"
DOW = "CAST(floor(TransactionDT / 86400.0) AS BIGINT) % 7"


@query("sc01_time_parts", f"""
SELECT TransactionID, {HOD} AS hour, {DOW} AS dow,
       CAST(floor(TransactionDT / 86400.0) AS BIGINT) % 30 AS dom FROM txn""", "txn")
def sc01(spark, d):
    return txn(spark, d).select(
        "TransactionID", S.hour_of_day("TransactionDT").alias("hour"),
        S.day_of_week("TransactionDT").alias("dow"), S.day_of_month("TransactionDT").alias("dom"))


@query("sc02_legacy_day", """
SELECT TransactionID, CAST(floor(((TransactionDT / 86400.0 - 1) % 7 + 7) % 7) AS BIGINT) AS legacy_dow FROM txn""", "txn")
def sc02(spark, d):
    return txn(spark, d).select("TransactionID", S.legacy_day_of_week("TransactionDT").alias("legacy_dow"))


@query("sc03_cyclic", f"""
SELECT TransactionID, round(sin(2 * pi() * ({HOD}) / 24.0), 6) + 0.0::DOUBLE AS hour_sin, round(cos(2 * pi() * ({HOD}) / 24.0), 6) + 0.0::DOUBLE AS hour_cos,
       round(sin(2 * pi() * ({DOW}) / 7.0), 6) + 0.0::DOUBLE AS day_sin, round(cos(2 * pi() * ({DOW}) / 7.0), 6) + 0.0::DOUBLE AS day_cos FROM txn""", "txn")
def sc03(spark, d):
    hs, hc = S.cyclic(S.hour_of_day("TransactionDT"), 24.0)
    ds, dc = S.cyclic(S.day_of_week("TransactionDT"), 7.0)
    # adding zero turns a rounded -0.0 into 0.0
    return txn(spark, d).select("TransactionID", *[(r6(c) + 0.0).alias(n) for c, n in
                                                   [(hs, "hour_sin"), (hc, "hour_cos"), (ds, "day_sin"), (dc, "day_cos")]])


@query("sc04_amount_scaling", """
WITH s AS (SELECT avg(TransactionAmt) AS mu, stddev_pop(TransactionAmt) AS sd,
                  quantile_cont(TransactionAmt, 0.995) AS hi FROM txn)
SELECT TransactionID, round(ln(1 + greatest(TransactionAmt, 0)), 6) AS amt_log1p,
       round(sqrt(least(greatest(TransactionAmt, 0), hi)), 6) AS amt_sqrt,
       round(least(greatest(TransactionAmt, 0), hi), 6) AS amt_clipped,
       round((least(greatest(TransactionAmt, 0), hi) - mu) / (sd + 1e-6), 6) AS amt_z FROM txn, s""", "txn")
def sc04(spark, d):
    t = txn(spark, d)
    a = behavior.fit_amount(t)
    clipped = S.clip("TransactionAmt", 0.0, a["clip_high"])
    return t.select("TransactionID", r6(S.log1p_nonneg("TransactionAmt")).alias("amt_log1p"), r6(F.sqrt(clipped)).alias("amt_sqrt"),
                    r6(clipped).alias("amt_clipped"), r6(S.zscore(clipped, a["mean"], a["std"])).alias("amt_z"))


@query("sc05_clean_text", "SELECT TransactionID, lower(trim(coalesce(DeviceInfo, 'missing'))) AS device FROM identity", "identity")
def sc05(spark, d):
    return identity(spark, d).select("TransactionID", S.clean_text("DeviceInfo").alias("device"))


@query("sc06_composite_key", """
SELECT TransactionID, coalesce(CAST(card1 AS VARCHAR), 'nan') || '_' || coalesce(CAST(addr1 AS VARCHAR), 'nan') AS uid,
       CAST(card1 AS VARCHAR) || '|' || coalesce(CAST(addr1 AS VARCHAR), 'missing') || '|'
         || lower(trim(coalesce(P_emaildomain, 'missing'))) AS card_addr_email FROM txn""", "txn")
def sc06(spark, d):
    return txn(spark, d).select("TransactionID", S.user_key().alias("uid"),
                                S.composite_key(["card1", "addr1", "P_emaildomain"]).alias("card_addr_email"))


_DEV = "lower(trim(coalesce(DeviceInfo, 'missing')))"


@query("sc07_text_tokens", f"SELECT TransactionID, length({_DEV}) AS DeviceInfo_len, "
       + ", ".join(f"CAST(contains({_DEV}, '{t}') AS INT) AS DeviceInfo__has_{t}" for t in S.DEVICE_TOKENS) + " FROM identity", "identity")
def sc07(spark, d):
    i = identity(spark, d)
    return i.select("TransactionID", F.length(S.clean_text("DeviceInfo")).cast("bigint").alias("DeviceInfo_len"),
                    *S.token_flags("DeviceInfo", "DeviceInfo"))


@query("sc08_missing_flags", "SELECT TransactionID, CASE WHEN dist1 IS NULL THEN 1 ELSE 0 END AS dist1_null FROM txn", "txn")
def sc08(spark, d):
    t = txn(spark, d).drop("k", "isFraud")
    return t.select("TransactionID", *[S.null_flag(c).alias(f"{c}_null") for c in behavior.fit_null_columns(t, 0.20)])


@query("sc09_one_hot", """
SELECT TransactionID, CAST(card4 = 'AUTOMOBILE' AS INT) AS card4__automobile, CAST(card4 = 'BUILDING' AS INT) AS card4__building,
  CAST(card4 = 'FURNITURE' AS INT) AS card4__furniture, CAST(card4 = 'HOUSEHOLD' AS INT) AS card4__household,
  CAST(card4 = 'MACHINERY' AS INT) AS card4__machinery FROM txn""", "txn")
def sc09(spark, d):
    t = txn(spark, d)
    levels = behavior.fit_levels(t, ["card4"])["card4"]
    return t.select("TransactionID", *S.one_hot("card4", levels, "card4"))


_CUT = 15 * 86400  # the first half of the month is the fitting period


@query("sc10_category_codes", f"""
WITH lv AS (SELECT coalesce(P_emaildomain, 'missing') AS lev, min(TransactionID) AS f FROM txn
            WHERE TransactionDT < {_CUT} GROUP BY 1),
c AS (SELECT lev, row_number() OVER (ORDER BY f) - 1 AS code FROM lv)
SELECT TransactionID, coalesce(code, -1) AS email_code FROM txn
LEFT JOIN c ON coalesce(P_emaildomain, 'missing') = lev""", "txn")
def sc10(spark, d):
    t = txn(spark, d)
    codes = behavior.fit_codes(t.where(F.col("TransactionDT") < _CUT), "P_emaildomain", "TransactionID")
    return behavior.apply_codes(t, codes, "P_emaildomain", "email_code", "TransactionID").select("TransactionID", "email_code")


@query("sc11_frequency_encoding", f"""
WITH fit AS (SELECT * FROM txn WHERE TransactionDT < {_CUT}),
f AS (SELECT addr1 AS a, count(*) AS n, count(*) * 1.0 / (SELECT count(*) FROM fit) AS fr FROM fit GROUP BY 1)
SELECT TransactionID, round(coalesce(CAST(fr AS DOUBLE), 0), 6) AS addr1_freq, CAST(coalesce(n, 0) AS BIGINT) AS addr1_count
FROM txn LEFT JOIN f ON txn.addr1 IS NOT DISTINCT FROM f.a""", "txn")
def sc11(spark, d):
    t = txn(spark, d)
    f = behavior.fit_frequencies(t.where(F.col("TransactionDT") < _CUT), "addr1")
    out = behavior.apply_frequencies(t, f, "addr1", "TransactionID")
    return out.select("TransactionID", r6("addr1_freq").alias("addr1_freq"), "addr1_count")


_ITEMS = """
top6 AS (SELECT P_emaildomain AS e FROM txn WHERE P_emaildomain IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 6),
basket AS (SELECT TransactionID, isFraud, list_sort(list_distinct([
    'ProductCD=' || trim(ProductCD), 'card4=' || trim(card4),
    CASE WHEN P_emaildomain IN (SELECT e FROM top6) THEN 'email=' || P_emaildomain ELSE 'email=other' END,
    CASE WHEN TransactionAmt > 0 AND TransactionAmt <= 50 THEN 'Amt=Low' WHEN TransactionAmt > 50 AND TransactionAmt <= 200 THEN 'Amt=Mid'
         WHEN TransactionAmt > 200 THEN 'Amt=High' END])) AS items FROM txn)"""


@query("sc12_basket", f"WITH {_ITEMS.strip()}\nSELECT TransactionID, array_to_string(items, ';') AS items FROM basket", "txn")
def sc12(spark, d):
    from riskspark.operators import rules
    t = txn(spark, d)
    b = rules.to_basket(t, rules.fit_top_levels(t, "P_emaildomain", 6))
    return b.select("TransactionID", F.array_join("items", ";").alias("items"))


@query("sc13_amount_ratio", f"""
WITH fit AS (SELECT *, card1::VARCHAR || '_' || coalesce(addr1::VARCHAR, 'nan') AS uid FROM txn WHERE TransactionDT < {_CUT}),
m AS (SELECT uid, quantile_cont(TransactionAmt, 0.5) AS med FROM fit GROUP BY 1),
g AS (SELECT quantile_cont(TransactionAmt, 0.5) AS gm FROM fit)
SELECT TransactionID, round(TransactionAmt / CASE WHEN coalesce(med, gm) = 0 THEN 0.01 ELSE coalesce(med, gm) END, 6) AS Amt_to_Median_User
FROM g, txn LEFT JOIN m ON card1::VARCHAR || '_' || coalesce(addr1::VARCHAR, 'nan') = m.uid""", "txn")
def sc13(spark, d):
    t = txn(spark, d)
    stats = behavior.fit_users(t.where(F.col("TransactionDT") < _CUT))
    return behavior.apply_users(t, stats, "TransactionID").select("TransactionID", r6("Amt_to_Median_User").alias("Amt_to_Median_User"))


@query("sc14_product_risk", "SELECT ProductCD, CASE ProductCD WHEN 'C' THEN 1 WHEN 'H' THEN 1 ELSE 0 END AS high_risk, count(*) AS n FROM txn GROUP BY ALL", "txn")
def sc14(spark, d):
    return txn(spark, d).groupBy("ProductCD", S.product_risk("ProductCD").alias("high_risk")).agg(F.count("*").alias("n"))


@query("sc15_threshold", "SELECT TransactionID, CAST(p > 0.5 AS INT) AS strict, CAST(p >= 0.6 AS INT) AS ensemble FROM scored", "scored")
def sc15(spark, d):
    return scored(spark, d).select("TransactionID", S.predicted("p").alias("strict"),
                                   S.predicted("p", 0.6, inclusive=True).alias("ensemble"))


@query("sc16_risk_band", """SELECT TransactionID, CASE WHEN p > 0.5 THEN 'severe' WHEN p > 0.3 THEN 'suspicious'
       ELSE 'safe' END AS risk_level FROM scored""", "scored")
def sc16(spark, d):
    return scored(spark, d).select("TransactionID", S.risk_band("p").alias("risk_level"))


_AMT = "TransactionAmt * 10"


@query("sc17_amount_rules", f"""
SELECT TransactionID, CASE WHEN {_AMT} > 1500 THEN 'SEVERE' WHEN {_AMT} > 500 THEN 'SUSPICIOUS' ELSE 'SAFE' END AS level,
 CASE WHEN {_AMT} > 1500 THEN 92 WHEN {_AMT} > 500 THEN 64 ELSE 12 END AS score,
 CASE WHEN {_AMT} > 1500 THEN 'Block Immediately' WHEN {_AMT} > 500 THEN 'Verify User Identity' ELSE 'Allow Transaction' END AS action,
 round(CASE WHEN {_AMT} > 1500 THEN {_AMT} * 1.2::DOUBLE WHEN {_AMT} > 500 THEN {_AMT} * 0.5::DOUBLE ELSE 0 END, 6) AS impact,
 CASE WHEN {_AMT} > 1500 THEN greatest(CAST(floor(p * 100) AS BIGINT), 85) WHEN {_AMT} > 300 THEN 60
      ELSE least(CAST(floor(p * 100) AS BIGINT), 20) END AS case_score,
 CASE WHEN {_AMT} > 1500 THEN 'severe' WHEN {_AMT} > 300 THEN 'suspicious' ELSE 'safe' END AS case_level
FROM scored""", "scored")
def sc17(spark, d):
    a = F.col("TransactionAmt") * 10
    cols = S.amount_rule(a)
    cols["impact"] = r6(cols["impact"])
    cols.update(S.case_review(a, F.floor(F.col("p") * 100).cast("bigint")))
    return scored(spark, d).select("TransactionID", *[c.alias(n) for n, c in cols.items()])


@query("sc18_weighted_vote", """SELECT TransactionID, round(0.5 * p + 0.3 * (1 - p) + 0.2 * p * p, 6) AS vote,
       round((p + (1 - p) + p * p) / 3, 6) AS plain FROM scored""", "scored")
def sc18(spark, d):
    models = [F.col("p"), 1 - F.col("p"), F.col("p") * F.col("p")]
    return scored(spark, d).select("TransactionID", r6(S.weighted_vote(models, [5, 3, 2])).alias("vote"),
                                   r6(S.weighted_vote(models, [0, 0, -1])).alias("plain"))


@query("sc19_half_even_rounding", "SELECT TransactionID, round_even(TransactionAmt / 4, 2) AS quarter FROM txn", "txn")
def sc19(spark, d):
    return txn(spark, d).select("TransactionID", S.round_half_even(F.col("TransactionAmt") / 4, 2).alias("quarter"))


@query("sc20_params_json", """SELECT TransactionID, '{"product":"' || ProductCD || '","card":' || card1 || ',"label":' || isFraud || '}' AS params FROM txn""", "txn")
def sc20(spark, d):
    packed = F.to_json(F.struct(F.col("ProductCD").alias("product"), F.col("card1").alias("card"), F.col("isFraud").alias("label")))
    return txn(spark, d).select("TransactionID", packed.alias("params"))


@query("sc21_guarded_ratio", """SELECT card1, round(sum(isFraud) / greatest(count(dist1), 1)::DOUBLE, 6) AS rate FROM txn GROUP BY 1""", "txn")
def sc21(spark, d):
    return txn(spark, d).groupBy("card1").agg(r6(S.guarded_ratio(F.sum("isFraud"), F.count("dist1"))).alias("rate"))
