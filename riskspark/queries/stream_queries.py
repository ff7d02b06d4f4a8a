"""Streaming operators over the event table read as a file stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import models as M
from riskspark.operators import timeseries
from riskspark.queries.profile_queries import rounded
from riskspark.queries.registry import query
from riskspark.sources.views import ORIGIN, table, txn
from riskspark.streaming import keyed, streams


def event_stream(spark, d):
    """Events with label, score and a zoned time stamp."""
    schema = table(spark, d, "events").schema
    e = spark.readStream.schema(schema).parquet(f"{d}/events.parquet*")
    k = F.get_json_object("props", "$.k").cast("int")
    i = F.col("event_id")
    e = e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.expr(f"timestampdiff(SECOND, timestamp_ntz'{ORIGIN}', ts)").alias("t"),
                 "user_id", "event_type", "value", F.when(k < 4, 1).otherwise(0).alias("isFraud"))
    return e.withColumn("p", F.when(F.col("isFraud") == 1, (F.lit(50) + i % 50) / F.lit(100.0)).otherwise((i % 80) / F.lit(100.0)))


def window_number():
    return (F.expr(f"timestampdiff(SECOND, timestamp_ntz'{ORIGIN}', cast(window_start as timestamp_ntz))") / 3600).cast("bigint").alias("hour_window")


@query("str01_hourly_stream", "SELECT hour_window, total, fraud_count, round(fraud_rate, 6) AS fraud_rate FROM hourly", "hourly")
def str01(spark, d):
    out = streams.run_latest(streams.hourly_stream(event_stream(spark, d)), ["window_start"], "hourly")
    return rounded(out.select(window_number(), "total", "fraud_count", "fraud_rate"), "fraud_rate")


_VELOCITY = "".join(
    f", count(*) OVER (PARTITION BY k ORDER BY t RANGE BETWEEN {w} PRECEDING AND CURRENT ROW) - count(*) OVER (PARTITION BY k, t) "
    f"+ row_number() OVER (PARTITION BY k, t ORDER BY id) - 1 AS cnt_{w}s" for w in streams.VELOCITY_WINDOWS)


@query("str02_velocity_stream", " UNION ALL ".join(
    f"SELECT '{e}' AS entity, id{_VELOCITY} FROM (SELECT event_id AS id, date_diff('second', TIMESTAMP '{ORIGIN}', ts) AS t, CAST({e} AS VARCHAR) AS k FROM events)"
    for e in ("user_id", "event_type")))
def str02(spark, d):
    entities = ["user_id", "event_type"]
    history = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    salts, buckets = keyed.crowded_values(history, entities, "ts"), keyed.bucket_count(history, "ts")
    out = keyed.velocity_counts(keyed.velocity_stream(event_stream(spark, d), entities, "ts", "event_id", salts=salts, buckets=buckets))
    return out.select("entity", "id", *[f"cnt_{w}s" for w in streams.VELOCITY_WINDOWS])


@query("str03_stream_scoring")
def str03(spark, d):
    t = M.assemble(txn(spark, d).select("isFraud", F.col("TransactionAmt").alias("value"), F.col("card1").alias("user_id")), ["value", "user_id"])
    model = M.logistic(t)
    sink = streams.scoring_sink(model, ["event_id", "probability_1"], lambda m, df: M.score(m, M.assemble(df, ["value", "user_id"]), "probability_1"))
    out = streams.run_available(event_stream(spark, d), tag="scoring", sink=sink)
    return out.select("event_id", "probability_1")


@query("str03_scoring_check", "SELECT count(*) AS n_rows, count(DISTINCT event_id) AS n_events, 1 AS in_range FROM events")
def str03_check(spark, d):
    """Every event is scored once."""
    return str03(spark, d).agg(F.count("*").alias("n_rows"), F.countDistinct("event_id").alias("n_events"), F.min(F.col("probability_1").between(0, 1).cast("int")).alias("in_range"))


@query("str04_live_kpis", """SELECT CASE WHEN p > 0.5 THEN 'severe' WHEN p > 0.3 THEN 'suspicious' ELSE 'safe' END AS risk_level, count(*) AS n, round(avg(p), 6) AS avg_p FROM scored GROUP BY 1""", "scored")
def str04(spark, d):
    out = streams.run_available(streams.kpi_stream(event_stream(spark, d)), "complete", "kpis", streams.overwrite_sink)
    return rounded(out, "avg_p")


@query("str05_stream_anomalies", """
WITH h AS (SELECT *, round_even(fraud_rate, 4) AS rate4 FROM hourly), s AS (SELECT avg(rate4) AS mu, stddev_samp(rate4) AS sd FROM h)
SELECT hour_window, round_even((rate4 - mu) / (sd + 1e-9), 4) AS z_score, CAST(round_even((rate4 - mu) / (sd + 1e-9), 4) > 2.5 AS INT) AS is_anomaly FROM h, s""", "hourly")
def str05(spark, d):
    baseline = timeseries.rate_baseline(timeseries.hourly(txn(spark, d)))
    out = streams.run_latest(streams.anomaly_stream(streams.hourly_stream(event_stream(spark, d)), baseline), ["window_start"], "anomalies")
    return out.select(window_number(), "z_score", "is_anomaly")
