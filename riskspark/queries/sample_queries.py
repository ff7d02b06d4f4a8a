"""Union, splits, samples, balancing and folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import neighbours, resample, timeseries
from riskspark.queries.registry import query
from riskspark.sources.views import identity, scored, txn, vectors


def r6(c):
    return F.round(c, 6)


@query("sp01_union_all", """SELECT TransactionID, isFraud, p, CAST(NULL AS VARCHAR) AS DeviceType FROM scored
UNION ALL SELECT TransactionID, NULL, NULL, DeviceType FROM identity""", "scored identity")
def sp01(spark, d):
    return resample.union_all([scored(spark, d).select("TransactionID", "isFraud", "p"), identity(spark, d).select("TransactionID", "DeviceType")])


def _chrono(second):
    return f"""WITH r AS (SELECT TransactionID, row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS pos, count(*) OVER () AS n FROM txn)
SELECT TransactionID, CASE WHEN pos < floor(0.7::DOUBLE * n) THEN 'train' WHEN pos < {second} THEN 'val' ELSE 'test' END AS part FROM r"""


@query("sp02_chronological_split", _chrono("floor(0.85::DOUBLE * n)"), "txn")
def sp02(spark, d):
    t = txn(spark, d).select("TransactionID", "TransactionDT")
    return resample.chronological_split(t, "TransactionDT", "TransactionID").select("TransactionID", "part")


@query("sp02_chronological_split_sum", _chrono("floor(0.7::DOUBLE * n) + floor(0.15::DOUBLE * n)"), "txn")
def sp02_sum(spark, d):
    t = txn(spark, d).select("TransactionID", "TransactionDT")
    return resample.chronological_split(t, "TransactionDT", "TransactionID", variant="sum").select("TransactionID", "part")


_HASHED = """h AS (SELECT TransactionID, isFraud, row_number() OVER (PARTITION BY isFraud ORDER BY md5('42:' || TransactionID), TransactionID) - 1 AS rk,
  count(*) OVER (PARTITION BY isFraud) AS nc, row_number() OVER (ORDER BY md5('42:' || TransactionID), TransactionID) - 1 AS rk_all, count(*) OVER () AS n FROM txn)"""


def _ids(spark, d):
    return txn(spark, d).select("TransactionID", "isFraud")


_THREE = "CASE WHEN TransactionID % 11 = 5 THEN NULL WHEN TransactionID % 7 = 2 THEN 2 ELSE isFraud END"
_CLASSES = f"""c AS (SELECT TransactionID, {_THREE} AS y FROM txn),
r AS (SELECT TransactionID, y, row_number() OVER (PARTITION BY y ORDER BY md5('42:' || TransactionID), TransactionID) - 1 AS rk, count(*) OVER (PARTITION BY y) AS nc FROM c)"""


def _three(spark, d):
    """Ids with three classes and rows without label."""
    three = F.when(F.col("TransactionID") % 11 == 5, F.lit(None).cast("int")).when(F.col("TransactionID") % 7 == 2, F.lit(2)).otherwise(F.col("isFraud"))
    return txn(spark, d).select("TransactionID", three.alias("y"))


@query("sp03_stratified_split", f"WITH {_HASHED} SELECT TransactionID, isFraud, CASE WHEN rk < floor(0.8::DOUBLE * nc) THEN 'train' ELSE 'test' END AS part FROM h", "txn")
def sp03(spark, d):
    return resample.stratified_split(_ids(spark, d), "TransactionID", "isFraud")


@query("sp03_split_without_label", f"WITH {_CLASSES} SELECT TransactionID, y, CASE WHEN rk < floor(0.8::DOUBLE * nc) THEN 'train' ELSE 'test' END AS part FROM r", "txn")
def sp03_null(spark, d):
    return resample.stratified_split(_three(spark, d), "TransactionID", "y")


@query("sp04_series_split", """SELECT hour_window, CASE WHEN row_number() OVER (ORDER BY hour_window) <= floor(0.8::DOUBLE * count(*) OVER ()) THEN 'train' ELSE 'test' END AS part FROM hourly""", "hourly")
def sp04(spark, d):
    return resample.series_split(timeseries.hourly(txn(spark, d)), "hour_window").select("hour_window", "part")


@query("sp05_sample_rows", f"WITH {_HASHED} SELECT TransactionID, isFraud FROM h WHERE rk_all < 2000", "txn")
def sp05(spark, d):
    return resample.sample_rows(_ids(spark, d), "TransactionID", 2000)


@query("sp05_sample_fraction", f"WITH {_HASHED} SELECT TransactionID, isFraud FROM h WHERE rk_all < floor(0.05::DOUBLE * n)", "txn")
def sp05_fraction(spark, d):
    return resample.sample_fraction(_ids(spark, d), "TransactionID", 0.05)


@query("sp06_stratified_sample", f"""WITH {_CLASSES}, s AS (SELECT y, count(*) AS nc, sum(count(*)) OVER () AS n FROM c GROUP BY y),
q AS (SELECT y, 2501 * nc // n AS f, row_number() OVER (ORDER BY 2501 * nc % n DESC, y NULLS LAST) AS place, 2501 - sum(2501 * nc // n) OVER () AS spare FROM s)
SELECT TransactionID, r.y FROM r JOIN q ON r.y IS NOT DISTINCT FROM q.y WHERE rk < f + CAST(place <= spare AS INT)""", "txn")
def sp06(spark, d):
    return resample.stratified_sample(_three(spark, d), "TransactionID", "y", 2501)


@query("sp07_capped_sample", f"""WITH {_HASHED}, t AS (SELECT least(count(*) FILTER (WHERE isFraud = 1), 300) AS k FROM h)
SELECT TransactionID, isFraud FROM h, t WHERE rk < CASE WHEN isFraud = 1 THEN k ELSE 1500 - k END""", "txn")
def sp07(spark, d):
    return resample.capped_sample(_ids(spark, d), "TransactionID", "isFraud", 1500)


@query("sp08_smote", """
WITH m AS (SELECT vec_id AS id, x FROM vectors WHERE label = 0), c AS (SELECT count(*) AS n FROM m),
nw AS (SELECT CAST(floor(0.5::DOUBLE * ((SELECT count(*) FROM vectors) - n)) AS BIGINT) - n AS n_new, n FROM c),
ex AS (SELECT id, row_number() OVER (ORDER BY md5('0:' || id), id) AS rk FROM m),
tm AS (SELECT id, n_new // n + CAST(rk <= n_new % n AS INT) AS times FROM ex, nw),
g AS (SELECT id, unnest(range(1, times + 1)) AS copy FROM tm),
p AS (SELECT a.id AS q, b.id AS nn, row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.x, b.x), b.id) AS place FROM m a JOIN m b ON a.id <> b.id),
u AS (SELECT id, copy, ('0x' || substr(md5('1:' || id || '-' || copy), 1, 12))::BIGINT::DOUBLE / 281474976710656 AS u1,
             ('0x' || substr(md5('2:' || id || '-' || copy), 1, 12))::BIGINT::DOUBLE / 281474976710656 AS u2 FROM g)
SELECT u.id, copy, p.nn, round(m.x[1] + u2 * (o.x[1] - m.x[1]), 6) AS first_value, round(list_sum(m.x) + u2 * (list_sum(o.x) - list_sum(m.x)), 6) AS total
FROM u JOIN p ON p.q = u.id AND p.place = CAST(floor(u1 * 5) AS BIGINT) + 1 JOIN m ON m.id = u.id JOIN m o ON o.id = p.nn""", "vectors")
def sp08(spark, d):
    made = neighbours.smote(vectors(spark, d), "vec_id", "x", F.col("label") == 0, 0.5)
    total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    return made.select("id", "copy", "nn", r6(F.col("x")[0]).alias("first_value"), r6(total).alias("total"))


@query("sp09_undersample", f"""WITH {_HASHED}, t AS (SELECT floor(count(*) FILTER (WHERE isFraud = 1) / 0.5::DOUBLE) AS k FROM h)
SELECT TransactionID, isFraud FROM h, t WHERE isFraud = 1 OR rk < k""", "txn")
def sp09(spark, d):
    return resample.undersample(_ids(spark, d), "TransactionID", "isFraud")


@query("sp10_stratified_folds", f"WITH {_HASHED} SELECT TransactionID, isFraud, CAST(rk % 5 AS INT) AS fold FROM h", "txn")
def sp10(spark, d):
    return resample.assign_folds(_ids(spark, d), "TransactionID", 5, "isFraud")


@query("sp10_folds_without_label", f"WITH {_CLASSES} SELECT TransactionID, y, CAST(rk % 5 AS INT) AS fold FROM r", "txn")
def sp10_null(spark, d):
    return resample.assign_folds(_three(spark, d), "TransactionID", 5, "y")


@query("sp10_plain_folds", f"WITH {_HASHED} SELECT TransactionID, isFraud, CAST(rk_all % 3 AS INT) AS fold FROM h", "txn")
def sp10_plain(spark, d):
    return resample.assign_folds(_ids(spark, d), "TransactionID", 3)
