"""A run-history table derived from the events: one evaluation row per (day, event type)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.sources.views import table

RUNS_SQL = """
SELECT 'v_' || strftime(ts, '%Y%m%d') || '_' || event_type AS version,
       CASE WHEN event_type IN ('click', 'view') THEN 'GBT-' || event_type ELSE 'LogisticRegression' END AS model_type,
       '{"rows":' || count(*) || '}' AS hyperparameters,
       round(avg(CASE WHEN CAST(json_extract_string(props, '$.k') AS INT) < 50 THEN 1.0 ELSE 0.0 END), 6) AS "precision",
       round(avg(value) / max(value), 6) AS recall,
       CASE WHEN count(*) % 3 <> 0 THEN round(count(*) / 1000.0::DOUBLE, 6) END AS auc_roc,
       round(min(value) / max(value), 6) AS auc_pr
FROM events GROUP BY strftime(ts, '%Y%m%d'), event_type"""


def runs_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    day = F.date_format("ts", "yyyyMMdd")
    g = e.groupBy(day.alias("day"), "event_type").agg(
        F.count("*").alias("n"),
        F.round(F.avg(F.when(k < 50, 1.0).otherwise(0.0)), 6).alias("precision"),
        F.round(F.avg("value") / F.max("value"), 6).alias("recall"),
        F.round(F.min("value") / F.max("value"), 6).alias("auc_pr"),
    )
    kind = F.when(F.col("event_type").isin("click", "view"), F.concat(F.lit("GBT-"), "event_type")).otherwise("LogisticRegression")
    return g.select(
        F.concat_ws("_", F.lit("v"), "day", "event_type").alias("version"),
        kind.alias("model_type"),
        F.to_json(F.struct(F.col("n").alias("rows"))).alias("hyperparameters"),
        "precision", "recall",
        F.when(F.col("n") % 3 != 0, F.round(F.col("n") / 1000.0, 6)).alias("auc_roc"),
        "auc_pr",
    )
