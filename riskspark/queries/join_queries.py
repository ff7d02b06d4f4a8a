"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import io_checks, joins, neighbours, patterns, rules, selection
from riskspark.plans.scratch import persist_table
from riskspark.queries.registry import query
from riskspark.queries.scalar_queries import _CUT, _ITEMS
from riskspark.sources.views import V_COLUMNS, identity, scored, table, txn, vectors, wide


def r6(c):
    return F.round(c, 6)


@query("jn01_identity_join", "SELECT txn.*, DeviceType, DeviceInfo FROM txn LEFT JOIN identity USING (TransactionID)", "txn identity")
def jn01(spark, d):
    return joins.with_identity(txn(spark, d), identity(spark, d))


@query("jn02_lookup_default", f"""
WITH m AS (SELECT card1 AS c, count(*) AS n, avg(TransactionAmt) AS a FROM txn WHERE TransactionDT < {_CUT} GROUP BY 1)
SELECT TransactionID, coalesce(n, 0) AS card_rows, round(coalesce(a, -1), 6) AS card_mean FROM txn LEFT JOIN m ON card1 = c""", "txn")
def jn02(spark, d):
    from riskspark.plans.skew import lookup_join
    t = txn(spark, d)
    m = t.where(F.col("TransactionDT") < _CUT).groupBy("card1").agg(F.count("*").alias("card_rows"), F.avg("TransactionAmt").alias("card_mean"))
    out = lookup_join(t, m, ["card1"], "card_rows", F.col("TransactionID"))
    return out.select("TransactionID", F.coalesce("card_rows", F.lit(0)).alias("card_rows"), r6(F.coalesce("card_mean", F.lit(-1.0))).alias("card_mean"))


@query("jn03_null_safe_stats", """
WITH g AS (SELECT addr1 AS a, count(*) AS n, avg(TransactionAmt) AS m FROM txn GROUP BY 1)
SELECT TransactionID, n AS addr_rows, round(m, 6) AS addr_mean FROM txn LEFT JOIN g ON addr1 IS NOT DISTINCT FROM a""", "txn")
def jn03(spark, d):
    from riskspark.plans.skew import lookup_join
    t = txn(spark, d)
    g = t.groupBy("addr1").agg(F.count("*").alias("addr_rows"), F.avg("TransactionAmt").alias("addr_mean"))
    out = lookup_join(t, g, ["addr1"], "addr_rows", F.col("TransactionID"), broadcast_rows=0)
    return out.select("TransactionID", "addr_rows", r6("addr_mean").alias("addr_mean"))


@query("jn04_semi_join", "SELECT TransactionID, TransactionAmt FROM txn WHERE TransactionID IN (SELECT TransactionID FROM identity WHERE DeviceType = 'mobile')", "txn identity")
def jn04(spark, d):
    part = identity(spark, d).where(F.col("DeviceType") == "mobile")
    return joins.split_back(txn(spark, d), part).select("TransactionID", "TransactionAmt")


@query("jn05_align_by_key", "SELECT TransactionID, txn.isFraud, p FROM txn JOIN (SELECT TransactionID, p FROM scored) s USING (TransactionID)", "txn scored")
def jn05(spark, d):
    return joins.align_by_key(txn(spark, d).select("TransactionID", "isFraud"), scored(spark, d).select("TransactionID", "p"), "TransactionID")


def models_by_day(spark, d, errors=False):
    """Model files derived from the events: one per day and event type; without errors, some runs have no file."""
    e = table(spark, d, "events").where(F.lit(errors) | (F.col("event_type") != "error"))
    name = F.concat(F.lit("model_v_"), F.date_format("ts", "yyyyMMdd"), F.lit("_"), "event_type", F.lit(".pkl"))
    return e.groupBy(name.alias("name")).agg(F.max("event_id").alias("created_at"))


@query("jn06_model_metrics", f"""
WITH m AS (SELECT 'model_v_' || strftime(ts, '%Y%m%d') || '_' || event_type || '.pkl' AS name, max(event_id) AS created_at
           FROM events WHERE event_type <> 'error' GROUP BY 1), r AS ({io_checks.RUNS_SQL})
SELECT name, created_at, model_type, recall FROM m LEFT JOIN r ON replace(replace(name, 'model_', ''), '.pkl', '') = r.version""")
def jn06(spark, d):
    return joins.model_metrics(models_by_day(spark, d), io_checks.runs_by_day(spark, d)).select("name", "created_at", "model_type", "recall")


_KNN = """
WITH p AS (SELECT a.vec_id AS q, b.vec_id AS nn, b.label AS nn_label, list_distance(a.x, b.x) AS dist FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY dist, nn) AS place FROM p)"""


@query("jn07_nearest_neighbours", _KNN + " SELECT q, nn, place, round(dist, 6) AS dist FROM r WHERE place <= 5", "vectors")
def jn07(spark, d):
    v = vectors(spark, d)
    out = neighbours.knn_join(v, v, 5, "vec_id", "x", exclude_self=True)
    return out.select("q", "nn", "place", r6("dist").alias("dist"))


@query("jn07_hashed_recall", "SELECT count(*) * 5 AS n_pairs, 1 AS recall_reached FROM vectors", "vectors")
def jn07_hashed(spark, d):
    """Share of the exact distances that the hashed search reaches, at least 0.9."""
    v = vectors(spark, d)
    exact, hashed = (neighbours.knn_join(v, v, 5, "vec_id", "x", exclude_self=True, **o).select("q", "place", F.round("dist", 9).alias(n))
                     for n, o in (("exact", {}), ("hashed", {"method": "hashed"})))
    both = exact.join(hashed, ["q", "place"])
    return both.agg(F.count("*").alias("n_pairs"), (F.avg((F.col("exact") == F.col("hashed")).cast("int")) >= 0.9).cast("int").alias("recall_reached"))


_PAIRS = " UNION ALL ".join(
    f"SELECT 'V{i}' AS a, 'V{j}' AS b, CASE WHEN 'V{i}' = 'V6' OR 'V{j}' = 'V6' THEN NULL ELSE round(corr(V{i}, V{j}), 6) END AS r FROM wide"
    for i in range(1, 9) for j in range(i + 1, 9) if 6 not in (i, j))


@query("jn08_column_pairs", _PAIRS, "wide")
def jn08(spark, d):
    out = selection.pair_correlations(wide(spark, d), V_COLUMNS)
    return out.where(F.col("r").isNotNull()).select("a", "b", r6("r").alias("r"))


@query("jn09_rule_match", f"""
WITH {_ITEMS.strip()}
SELECT TransactionID, CAST(list_contains(items, 'Amt=Low') AND list_contains(items, 'email=other') AS INT)
  + CAST(list_contains(items, 'Amt=High') AS INT) + CAST(list_contains(items, 'card4=BUILDING') AND list_contains(items, 'Amt=Mid') AS INT) AS score
FROM basket""", "txn")
def jn09(spark, d):
    t = txn(spark, d)
    b = rules.to_basket(t, rules.fit_top_levels(t, "P_emaildomain", 6))
    return b.select("TransactionID", rules.rule_score([["Amt=Low", "email=other"], ["Amt=High"], ["card4=BUILDING", "Amt=Mid"]]).alias("score"))


@query("jn09_many_rules", f"""
WITH {_ITEMS.strip()},
r AS (SELECT DISTINCT list_sort([a, b]) AS needed FROM (SELECT unnest(items) AS a, items FROM basket) x, unnest(x.items) AS t(b))
SELECT TransactionID, CAST((SELECT count(*) FROM r WHERE list_has_all(basket.items, needed)) AS INT) AS score FROM basket""", "txn")
def jn09_many(spark, d):
    """Every single item and every pair of items that occurs together as a rule of its own, matched by the item index."""
    t = txn(spark, d)
    b = persist_table(rules.to_basket(t, rules.fit_top_levels(t, "P_emaildomain", 6)).select("TransactionID", "items"), "rule_baskets")
    pairs = b.select("items").distinct().select(F.explode("items").alias("a"), "items").select("a", F.explode("items").alias("b"))
    made = pairs.select(F.array_distinct(F.sort_array(F.array("a", "b"))).alias("antecedent")).distinct()
    made = made.withColumn("rule", F.array_join("antecedent", ";"))
    return patterns.rule_scores(b, made, "TransactionID").select("TransactionID", "score")
