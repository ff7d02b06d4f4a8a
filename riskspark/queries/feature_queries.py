"""Column selection, representation, rules and fitted feature stages."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from riskspark.functions import scalars as S
from riskspark.operators import behavior as B, information
from riskspark.operators import represent, resample, rules, selection, stages
from riskspark.queries.profile_queries import TXN_DEVICE, _norm, rounded, txn_with_device
from riskspark.queries.registry import query
from riskspark.queries.scalar_queries import _CUT, _ITEMS, DOW, HOD
from riskspark.sources.views import V_COLUMNS, txn, vectors, wide


def r6(c):
    return F.round(c, 6)


def names(spark, values, column="column"):
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


# ---- selection ------------------------------------------------------------------------------------------------------

@query("fs01_high_null_drop", " UNION ALL ".join(
    f"SELECT 'V{i}' AS \"column\" FROM wide HAVING avg(CASE WHEN V{i} IS NULL THEN 1 ELSE 0 END) > 0.95" for i in range(1, 9)), "wide")
def fs01(spark, d):
    return names(spark, selection.high_null_columns(wide(spark, d), V_COLUMNS, 0.95))


@query("fs02_constant_drop", " UNION ALL ".join(
    f"SELECT 'V{i}' AS \"column\" FROM wide HAVING min(coalesce(V{i}, 0)) = max(coalesce(V{i}, 0))" for i in range(1, 9)), "wide")
def fs02(spark, d):
    return names(spark, selection.constant_columns(wide(spark, d), V_COLUMNS))


_PAIR_AB = " UNION ALL ".join(f"SELECT 'V{i}' AS a, 'V{j}' AS b, corr(V{i}, V{j}) AS r FROM wide" for i in range(1, 9) for j in range(i + 1, 9) if 6 not in (i, j))
_PAIR_R = " UNION ALL ".join(f"SELECT 'V{j}' AS b, corr(V{i}, V{j}) AS r FROM wide" for i in range(1, 9) for j in range(i + 1, 9) if 6 not in (i, j))


@query("fs03_correlation_prune", f"SELECT DISTINCT b AS \"column\" FROM ({_PAIR_R}) WHERE abs(r) > 0.98", "wide")
def fs03(spark, d):
    return names(spark, selection.correlated_columns(wide(spark, d), V_COLUMNS, 0.98))


def _mi_sql(c):
    cuts = ", ".join(f"quantile_cont(coalesce({c}, -1), {i}/10.0::DOUBLE) AS q{i}" for i in range(1, 10))
    bin_of = " + ".join(f"CAST(coalesce({c}, -1) > q{i} AS INT)" for i in range(1, 10))
    return f"""SELECT '{c}' AS "column", sum(n / tot * ln(n * tot / (nb * ny))) AS mi FROM (
 SELECT n::DOUBLE AS n, sum(n) OVER ()::DOUBLE AS tot, sum(n) OVER (PARTITION BY b)::DOUBLE AS nb, sum(n) OVER (PARTITION BY y)::DOUBLE AS ny FROM (
 SELECT {bin_of} AS b, isFraud AS y, count(*) AS n FROM wide, (SELECT {cuts} FROM wide) GROUP BY 1, 2))"""


_MI = " UNION ALL ".join(_mi_sql(c) for c in V_COLUMNS)


@query("fs04_mutual_information", f"SELECT \"column\", round(mi, 6) + 0.0::DOUBLE AS mi FROM ({_MI})", "wide")
def fs04(spark, d):
    return selection.mutual_information(wide(spark, d), V_COLUMNS).select("column", (r6("mi") + 0.0).alias("mi"))


_PRUNED = " UNION ALL ".join(
    f"SELECT 'V{i}' AS c FROM wide HAVING avg(CASE WHEN V{i} IS NULL THEN 1 ELSE 0 END) > 0.95 OR min(coalesce(V{i}, 0)) = max(coalesce(V{i}, 0))" for i in range(1, 9))
_LEFT = f"""gone AS ({_PRUNED}), pairs AS ({_PAIR_AB}),
left_over AS (SELECT "column", mi FROM ({_MI}) WHERE "column" NOT IN (SELECT c FROM gone)
  AND "column" NOT IN (SELECT b FROM pairs WHERE abs(r) > 0.98 AND a NOT IN (SELECT c FROM gone)))"""


def _digamma_sql(n):
    return (f"(ln({n} + 10.0::DOUBLE) - 1 / (2 * ({n} + 10.0::DOUBLE)) - 1 / (12 * ({n} + 10.0::DOUBLE) ** 2) + 1 / (120 * ({n} + 10.0::DOUBLE) ** 4) - 1 / (252 * ({n} + 10.0::DOUBLE) ** 6)"
            f" + 1 / (240 * ({n} + 10.0::DOUBLE) ** 8) - list_sum(list_transform(range(10), lambda i: 1.0::DOUBLE / ({n} + i))))")


_NEAR_COLUMNS = {"card1": "card1", "cents": "round(TransactionAmt * 100)", "dist": "round(dist1 * 100)", "addr1": "addr1"}


@query("fs04_neighbour_information", f"""
WITH l AS (SELECT isFraud AS y, unnest([{", ".join(f"'{c}'" for c in _NEAR_COLUMNS)}]) AS c, unnest([{", ".join(f"coalesce(({x})::DOUBLE, -1)" for x in _NEAR_COLUMNS.values())}]) AS v FROM txn),
r AS (SELECT *, count(*) OVER (PARTITION BY c, y) AS ny, count(*) OVER (PARTITION BY c) AS n,
  list_sort(list_filter([v - lag(v, 1) OVER w, v - lag(v, 2) OVER w, v - lag(v, 3) OVER w, lead(v, 1) OVER w - v, lead(v, 2) OVER w - v, lead(v, 3) OVER w - v], lambda d: d IS NOT NULL))[3] AS r
  FROM l WINDOW w AS (PARTITION BY c, y ORDER BY v)),
m AS (SELECT *, count(*) OVER (PARTITION BY c ORDER BY v RANGE BETWEEN r PRECEDING AND r FOLLOWING) - CASE WHEN r > 0 THEN
  count(*) OVER (PARTITION BY c ORDER BY v RANGE BETWEEN r PRECEDING AND r PRECEDING) + count(*) OVER (PARTITION BY c ORDER BY v RANGE BETWEEN r FOLLOWING AND r FOLLOWING) ELSE 0 END AS m FROM r)
SELECT c AS "column", round(greatest(0, any_value({_digamma_sql("n")}) + {_digamma_sql("3")} - avg({_digamma_sql("ny")}) - avg({_digamma_sql("m")})), 6) AS mi FROM m GROUP BY c""", "txn")
def fs04_near(spark, d):
    """Whole-numbered columns, so that both engines compare exact distances."""
    t = txn(spark, d).select("isFraud", *[F.expr(x).cast("double").alias(c) for c, x in _NEAR_COLUMNS.items()])
    return information.neighbour_information(t, list(_NEAR_COLUMNS)).select("column", r6("mi").alias("mi"))


@query("fs05_pruned_columns", f"""WITH {_LEFT} SELECT "column" FROM left_over ORDER BY round(mi, 12) DESC, "column" LIMIT 3""", "wide")
def fs05(spark, d):
    model = stages.ColumnPruner(keep=3).fit(wide(spark, d).withColumn("TransactionID", F.lit(0)))
    return names(spark, model.kept())


@query("fs05_pruned_table", "SELECT V1, V2, V3, V4, isFraud FROM wide", "wide")
def fs05_table(spark, d):
    w = wide(spark, d).withColumn("TransactionID", F.lit(0))
    return stages.ColumnPruner().fit(w).transform(w).select("V1", "V2", "V3", "V4", "isFraud")


@query("fs06_padded_columns", f"""WITH {_LEFT} SELECT "column" FROM left_over ORDER BY round(mi, 12) DESC, "column" LIMIT 4""", "wide")
def fs06(spark, d):
    w = wide(spark, d)
    return names(spark, selection.prune_columns(w, V_COLUMNS, min_score=0.001, keep=4))


# ---- representation -------------------------------------------------------------------------------------------------

_SCALED = ["TransactionAmt", "dist1", "card1"]


@query("tr01_standard_scaling", "SELECT TransactionID" + "".join(
    f", round((coalesce({c}, 0) - avg(coalesce({c}, 0)) OVER ()) / stddev_pop(coalesce({c}, 0)) OVER (), 6) AS {c}_scaled" for c in _SCALED) + " FROM txn", "txn")
def tr01(spark, d):
    t = txn(spark, d)
    out = represent.apply_scaler(t, represent.fit_scaler(t, _SCALED)).select("TransactionID", *[f"{c}_scaled" for c in _SCALED])
    return rounded(out, *[f"{c}_scaled" for c in _SCALED])


def flat_vectors(spark, d, n=64):
    return vectors(spark, d).select("vec_id", "label", *[F.col("x")[i].alias(f"x{i}") for i in range(n)])


@query("tr02_components")
def tr02(spark, d):
    v = flat_vectors(spark, d)
    pca = represent.fit_pca(v, [f"x{i}" for i in range(64)], 5)
    return rounded(represent.apply_pca(v, pca).select("vec_id", *[f"pca_comp_{i}" for i in range(1, 6)]), *[f"pca_comp_{i}" for i in range(1, 6)])


@query("tr02_variance_cut")
def tr02_variance(spark, d):
    w = wide(spark, d)
    pca = represent.fit_pca(w, ["V1", "V2", "V3", "V4", "V5", "V8"], variance=0.95)
    rows = [(i + 1, s) for i, s in enumerate(pca["shares"])]
    return spark.createDataFrame(rows, "component int, share double")


@query("tr02_component_variance", "SELECT round(sum(v), 4) AS total_variance FROM (" + " UNION ALL ".join(
    f"SELECT CASE WHEN max({c}) > min({c}) THEN 1.0::DOUBLE ELSE 0.0 END AS v FROM wide" for c in ["V1", "V2", "V3", "V4"]) + ")", "wide")
def tr02_check(spark, d):
    w = wide(spark, d)
    cols = ["V1", "V2", "V3", "V4"]
    out = represent.apply_pca(w, represent.fit_pca(w, cols, 4))
    total = F.lit(0.0)
    for i in range(1, 5):
        total = total + F.var_pop(f"pca_comp_{i}")
    return out.agg(F.round(total, 4).alias("total_variance"))


@query("tr03_component_report")
def tr03(spark, d):
    v = flat_vectors(spark, d)
    return represent.pca_report(v, represent.fit_pca(v, [f"x{i}" for i in range(64)], 10))


@query("tr03_component_scatter")
def tr03_scatter(spark, d):
    v = flat_vectors(spark, d).withColumn("is_zero", (F.col("label") == 0).cast("int"))
    pca = represent.fit_pca(v, [f"x{i}" for i in range(64)], 2)
    return represent.pca_scatter(v, pca, "vec_id", "is_zero", 300)


@query("tr04_clusters")
def tr04(spark, d):
    t = txn(spark, d)
    c = represent.fit_clusters(t, ["TransactionDT", "TransactionAmt", "card1", "addr1", "dist1"], 5)
    return represent.apply_clusters(t, c).groupBy("cluster_label").agg(F.count("*").alias("size"), F.avg("isFraud").alias("fraud_rate"))


@query("tr04_amount_hour_clusters")
def tr04_small(spark, d):
    t = txn(spark, d).withColumn("Transaction_Hour", S.hour_of_day("TransactionDT"))
    c = represent.fit_clusters(t, ["TransactionAmt", "Transaction_Hour"], 8)
    return represent.apply_clusters(t, c).groupBy("cluster_label").agg(F.count("*").alias("size"), F.avg("isFraud").alias("fraud_rate"))


@query("tr03_report_check", "SELECT 50 AS n_lines, 10 AS n_components, 1 AS falling, 1 AS sums")
def tr03_check(spark, d):
    """Ten components with five loadings each; shares fall and add up to the cumulative share."""
    report = tr03(spark, d)
    one = report.groupBy("component").agg(F.max("share").alias("share"), F.max("cumulative").alias("cumulative"), F.count("*").alias("n"))
    w = Window.orderBy("component")
    one = one.withColumn("falls", F.coalesce(F.col("share") <= F.lag("share").over(w) + 1e-12, F.lit(True)))
    one = one.withColumn("adds", F.abs(F.sum("share").over(w) - F.col("cumulative")) < 1e-9)
    return one.agg(F.sum("n").cast("int").alias("n_lines"), F.count("*").cast("int").alias("n_components"),
                   F.min(F.col("falls").cast("int")).alias("falling"), F.min(F.col("adds").cast("int")).alias("sums"))


@query("tr04_cluster_check", "SELECT 5 AS n_clusters, count(*) AS n_rows, round(avg(isFraud), 6) AS rate FROM txn", "txn")
def tr04_check(spark, d):
    """The clusters hold every row once."""
    return tr04(spark, d).agg(F.count("*").cast("int").alias("n_clusters"), F.sum("size").alias("n_rows"),
                              F.round(F.sum(F.col("size") * F.col("fraud_rate")) / F.sum("size"), 6).alias("rate"))


# ---- rules ----------------------------------------------------------------------------------------------------------

# a label that depends on items, so that there are rules to find
_RISK = "k < 4 OR ProductCD = 'purchase' AND k < 12 OR card4 = 'BUILDING' AND k < 15 OR ProductCD = 'view' AND card4 = 'MACHINERY' AND k < 50"
_LABELLED = f"""{_ITEMS.strip()},
risk AS (SELECT TransactionID, {_RISK} AS risky FROM txn),
lab AS (SELECT TransactionID, list_sort(list_concat(items, [CASE WHEN risky THEN 'isFraud=Yes' ELSE 'isFraud=No' END])) AS items FROM basket JOIN risk USING (TransactionID)),
bk AS (SELECT items, count(*) AS c FROM lab GROUP BY 1),
mask AS (SELECT unnest(range(1, 64)) AS m),
sub AS (SELECT list_sort(list_distinct([CASE WHEN m & 1 > 0 THEN items[1] END, CASE WHEN m & 2 > 0 THEN items[2] END, CASE WHEN m & 4 > 0 THEN items[3] END,
   CASE WHEN m & 8 > 0 THEN items[4] END, CASE WHEN m & 16 > 0 THEN items[5] END, CASE WHEN m & 32 > 0 THEN items[6] END])) AS s, c FROM bk, mask WHERE m < (1 << len(items))),
sets AS (SELECT array_to_string(s, ';') AS items, len(s) AS size, CAST(sum(c) AS BIGINT) AS freq, sum(c) / (SELECT count(*) FROM lab)::DOUBLE AS support, s AS l FROM sub GROUP BY s
  HAVING sum(c) / (SELECT count(*) FROM lab)::DOUBLE >= 0.01),
rl AS (SELECT a.items AS antecedent, b.items AS consequent, x.support, x.support / a.support AS confidence, x.support / a.support / b.support AS lift
  FROM sets x JOIN sets a ON a.size < x.size AND list_has_all(x.l, a.l) JOIN sets b ON b.size = x.size - a.size AND list_has_all(x.l, b.l) AND NOT list_has_any(a.l, b.l)),
fr AS (SELECT * FROM rl WHERE confidence >= 0.05 AND contains(consequent, 'isFraud=Yes'))"""


def risky(spark, d):
    return txn(spark, d).withColumn("isFraud", F.coalesce(F.expr(_RISK), F.lit(False)).cast("int"))


def labelled_baskets(spark, d):
    t = risky(spark, d)
    return rules.to_basket(t, rules.fit_top_levels(t, "P_emaildomain", 6), "isFraud")


@query("tr05_frequent_itemsets", f"WITH {_LABELLED} SELECT items, CAST(size AS INT) AS size, freq, round(support, 6) AS support FROM sets", "txn")
def tr05(spark, d):
    sets = rules.frequent_itemsets(labelled_baskets(spark, d), 0.01)
    return sets.select(F.array_join("items", ";").alias("items"), "size", "freq", r6("support").alias("support"))


@query("tr06_fraud_rules", f"WITH {_LABELLED} SELECT antecedent, consequent, round(support, 6) AS support, round(confidence, 6) AS confidence, round(lift, 6) AS lift FROM fr", "txn")
def tr06(spark, d):
    sets = rules.frequent_itemsets(labelled_baskets(spark, d), 0.01)
    found = rules.association_rules(sets, 0.05, "isFraud=Yes")
    return found.select(F.array_join("antecedent", ";").alias("antecedent"), F.array_join("consequent", ";").alias("consequent"),
                        *[r6(c).alias(c) for c in ("support", "confidence", "lift")])


@query("st05_top_rules", f"""WITH {_LABELLED} SELECT antecedent, consequent, round(lift, 6) AS lift FROM fr
ORDER BY round(fr.lift, 9) DESC, round(confidence, 9) DESC, antecedent, consequent LIMIT 10""", "txn")
def st05(spark, d):
    sets = rules.frequent_itemsets(labelled_baskets(spark, d), 0.01)
    top = rules.top_rules(rules.association_rules(sets, 0.05, "isFraud=Yes"), 10)
    return top.select(F.array_join("antecedent", ";").alias("antecedent"), F.array_join("consequent", ";").alias("consequent"), r6("lift").alias("lift"))


@query("tr07_rule_risk_score", f"""WITH {_LABELLED}, tp AS (SELECT antecedent FROM fr ORDER BY round(fr.lift, 9) DESC, round(confidence, 9) DESC, antecedent, consequent LIMIT 10)
SELECT TransactionID, CAST((SELECT count(*) FROM tp WHERE list_has_all(items, string_split(antecedent, ';'))) AS INT) AS association_risk_score FROM basket""", "txn")
def tr07(spark, d):
    t = risky(spark, d)
    return stages.RuleRiskScore().fit(t).transform(t).select("TransactionID", "association_risk_score")


# ---- fitted feature stages ------------------------------------------------------------------------------------------

_UID = "card1::VARCHAR || '_' || coalesce(addr1::VARCHAR, 'nan')"


@query("tr08_behavior_features", f"""
WITH fit AS (SELECT *, {_UID} AS uid FROM txn WHERE TransactionDT < {_CUT}),
m AS (SELECT uid, count(*) AS n, quantile_cont(TransactionAmt, 0.5) AS med FROM fit GROUP BY 1),
g AS (SELECT quantile_cont(TransactionAmt, 0.5) AS gm, quantile_cont(addr1, 0.5) AS ga, quantile_cont(dist1, 0.5) AS gd FROM fit)
SELECT TransactionID, CAST(dist1 IS NULL AS INT) AS dist1_null, {HOD} AS hour, {DOW} AS dow, CAST(floor(TransactionDT / 86400.0) AS BIGINT) % 30 AS day_of_month,
 coalesce(m.n, 1) AS user_count, round(TransactionAmt / CASE WHEN coalesce(med, gm) = 0 THEN 0.01 ELSE coalesce(med, gm) END, 6) AS Amt_to_Median_User,
 coalesce(addr1::DOUBLE, ga) AS addr1, round(coalesce(dist1, gd), 6) AS dist1
FROM g, txn LEFT JOIN m ON {_UID} = m.uid""", "txn")
def tr08(spark, d):
    t = txn(spark, d).drop("k").withColumn("addr1", F.col("addr1").cast("int"))
    model = stages.BehaviorFeatures().fit(t.where(F.col("TransactionDT") < _CUT))
    out = model.transform(t).select("TransactionID", "dist1_null", "hour", "dow", "day_of_month", "user_count", "Amt_to_Median_User", F.col("addr1").cast("double").alias("addr1"), "dist1")
    return rounded(out, "Amt_to_Median_User", "dist1")


def _ensemble_sql():
    texts = ["ProductCD", "card4", "P_emaildomain", "DeviceType", "DeviceInfo"]
    levels = {"ProductCD": ["click", "error", "purchase", "signup", "view"]}
    sel, joins, ctes = [], [], [TXN_DEVICE, "n AS (SELECT count(*)::DOUBLE AS n FROM td)"]
    ctes.append("am AS (SELECT avg(TransactionAmt) AS mu, stddev_pop(TransactionAmt) AS sd, quantile_cont(TransactionAmt, 0.995) AS hi, "
                "quantile_cont(addr1, 0.5) AS ma, quantile_cont(dist1, 0.5) AS md FROM td)")
    amt = "least(greatest(TransactionAmt, 0), hi)"
    sel += [f"CAST(TransactionDT AS DOUBLE) AS TransactionDT", f"round(ln(1 + TransactionDT), 6) AS TransactionDT_log1p", f"round({amt}, 6) AS TransactionAmt",
            f"round(ln(1 + {amt}), 6) AS TransactionAmt_log1p", f"round(sqrt({amt}), 6) AS TransactionAmt_sqrt", f"round(({amt} - mu) / (sd + 1e-6), 6) AS TransactionAmt_zscore",
            f"{HOD} AS tx_hour", f"{DOW} AS tx_day", "coalesce(addr1::DOUBLE, ma) AS addr1", "round(coalesce(dist1, md), 6) AS dist1", "card1::DOUBLE AS card1",
            "CAST(dist1 IS NULL AS INT) AS dist1_missing"]
    for i, c in enumerate(texts):
        ctes.append(f"f{i} AS (SELECT {_norm(c)} AS k{i}, count(*) / any_value(n.n) AS fr FROM td, n GROUP BY 1)")
        sel += [f"round(f{i}.fr, 6) AS {c}_freq", f"CAST(length({_norm('td.' + c)}) AS DOUBLE) AS {c}_len", f"CAST({_norm('td.' + c)} = 'missing' AS INT) AS {c}_missing"]
        joins.append(f"JOIN f{i} ON f{i}.k{i} = {_norm('td.' + c)}")
    return ctes, sel, joins


_EC, _ES, _EJ = _ensemble_sql()


@query("tr09_ensemble_features", "WITH " + ", ".join(_EC) + ", kc AS (SELECT lower(trim(card1::VARCHAR)) AS kk, count(*) AS c, quantile_cont(TransactionAmt, 0.5) AS m FROM td GROUP BY 1), "
       "eg AS (SELECT card1 AS ek, count(DISTINCT " + _norm("P_emaildomain") + ") AS dd FROM td GROUP BY 1), "
       "vl AS (SELECT TransactionID AS vid, count(*) OVER (PARTITION BY card1 ORDER BY TransactionDT RANGE BETWEEN 3600 PRECEDING AND CURRENT ROW) "
       "- count(*) OVER (PARTITION BY card1, TransactionDT) + row_number() OVER (PARTITION BY card1, TransactionDT ORDER BY TransactionID) - 1 AS v FROM td) "
       "SELECT TransactionID, " + ", ".join(_ES) + ", kc.c AS card1__count, round(kc.m, 6) AS card1__amt_median, round(least(greatest(TransactionAmt, 0), hi) / (kc.m + 1e-6), 6) AS card1__amt_ratio, "
       "eg.dd AS entity__card1__unique_P_emaildomain, vl.v AS vel__card1__cnt_3600s FROM td " + " ".join(_EJ)
       + " JOIN kc ON kc.kk = td.card1::VARCHAR JOIN eg ON eg.ek = td.card1 JOIN vl ON vl.vid = td.TransactionID, am", "txn identity")
def tr09(spark, d):
    t = txn_with_device(spark, d).drop("k")
    out = stages.EnsembleFeatures().fit(t).transform(t)
    texts = ["ProductCD", "card4", "P_emaildomain", "DeviceType", "DeviceInfo"]
    cols = ["TransactionDT", "TransactionDT_log1p", "TransactionAmt", "TransactionAmt_log1p", "TransactionAmt_sqrt", "TransactionAmt_zscore", "tx_hour", "tx_day", "addr1", "dist1",
            "card1", "dist1_missing", *[f"{c}_{m}" for c in texts for m in ("freq", "len", "missing")], "card1__count", "card1__amt_median", "card1__amt_ratio",
            "entity__card1__unique_P_emaildomain", "vel__card1__cnt_3600s"]
    doubles = ["TransactionDT_log1p", "TransactionAmt", "TransactionAmt_log1p", "TransactionAmt_sqrt", "TransactionAmt_zscore", "dist1", *[f"{c}_freq" for c in texts],
               "card1__amt_median", "card1__amt_ratio"]
    return rounded(out.select("TransactionID", *cols), *doubles)


@query("tr10_block_features", """
WITH g AS (SELECT card1 AS gk, avg(TransactionAmt) AS m, count(dist1) AS c FROM txn GROUP BY 1),
lv AS (SELECT ProductCD AS l, count(*) AS n, row_number() OVER (ORDER BY min(TransactionID)) - 1 AS code FROM txn GROUP BY 1)
SELECT TransactionID, round(ln(1 + TransactionAmt), 6) AS amt_log, CAST(dist1 IS NULL AS INT) AS dist1_missing, lv.code AS ProductCD_code, lv.n AS ProductCD_count,
  round(g.m, 8) AS card1_TransactionAmt_mean, g.c AS card1_dist1_count, CAST(addr1 IS NULL AS INT) + CAST(P_emaildomain IS NULL AS INT) + CAST(dist1 IS NULL AS INT) AS missing_count
FROM txn JOIN g ON card1 = gk JOIN lv ON ProductCD = l""", "txn")
def tr10(spark, d):
    t = txn(spark, d).drop("k")
    out = stages.BlockFeatures().fit(t).transform(t)
    return out.select("TransactionID", r6("amt_log").alias("amt_log"), "dist1_missing", "ProductCD_code", "ProductCD_count",
                      F.round("card1_TransactionAmt_mean", 8).alias("card1_TransactionAmt_mean"), "card1_dist1_count", "missing_count")


@query("tr11_mean_variant", f"""
WITH fit AS (SELECT *, {_UID} AS uid FROM txn WHERE TransactionDT < {_CUT}),
m AS (SELECT uid, avg(TransactionAmt) AS mean FROM fit GROUP BY 1), c AS (SELECT card1 AS ck, count(*) AS n FROM fit GROUP BY 1), g AS (SELECT quantile_cont(TransactionAmt, 0.5) AS gm FROM fit)
SELECT TransactionID, {HOD} AS hour, round(ln(1 + TransactionAmt), 6) AS Amt_Log, coalesce(c.n, 0) AS card1_count,
  round(TransactionAmt / coalesce(m.mean, gm), 6) AS Amt_to_Mean_User, round(coalesce(dist1, -1), 6) AS dist1 FROM g, txn LEFT JOIN m ON {_UID} = m.uid LEFT JOIN c ON card1 = ck""", "txn")
def tr11(spark, d):
    t = txn(spark, d).drop("k")
    model = stages.BehaviorFeatures(variant="mean").fit(t.where(F.col("TransactionDT") < _CUT))
    out = model.transform(t).select("TransactionID", "hour", "Amt_Log", "card1_count", "Amt_to_Mean_User", "dist1")
    return rounded(out, "Amt_Log", "Amt_to_Mean_User", "dist1")


@query("tr12_fusion_features", """
SELECT TransactionID, part, round(coalesce(avg(isFraud) OVER (ORDER BY TransactionDT, TransactionID ROWS BETWEEN 1000 PRECEDING AND 1 PRECEDING), (SELECT avg(isFraud) FROM txn)), 6) AS momentum,
  CASE ProductCD WHEN 'C' THEN 1 WHEN 'H' THEN 1 ELSE 0 END AS is_high_risk_product, 3 AS components
FROM (SELECT *, CASE WHEN row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 < floor(0.7::DOUBLE * count(*) OVER ()) THEN 'train' ELSE 'test' END AS part FROM txn)""", "txn")
def tr12(spark, d):
    t = txn(spark, d).drop("k")
    parts = resample.chronological_split(t, "TransactionDT", "TransactionID", 0.7, 0.0)
    out = B.momentum(parts, "TransactionDT", "TransactionID", "isFraud").withColumn("is_high_risk_product", S.product_risk("ProductCD"))
    numeric = ["TransactionDT", "TransactionAmt", "card1", "addr1", "dist1", "momentum"]
    out = stages.PcaFeatures(columns=numeric, k=3, prefix="pca_").fit(out).transform(out)
    n_comp = F.size(F.array_compact(F.array("pca_1", "pca_2", "pca_3")))
    return out.select("TransactionID", "part", r6("momentum").alias("momentum"), "is_high_risk_product", n_comp.alias("components"))
