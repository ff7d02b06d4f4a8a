"""Scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import io_checks, timeseries
from riskspark.plans.scratch import scratch_path
from riskspark.queries.registry import query
from riskspark.sources import tables as IO
from riskspark.sources.views import identity, scored, table, txn

_TXN_COLS = "TransactionID, TransactionDT, TransactionAmt, ProductCD, card1, addr1, card4, P_emaildomain, dist1, isFraud, k"


@query("src01_csv_scan", f"SELECT {_TXN_COLS} FROM txn", "txn")
def src01(spark, d):
    t = txn(spark, d)
    path = scratch_path(spark, "csv")
    IO.write_table(t, path, "csv")
    return IO.read_csv(spark, path, t.schema)


@query("src02_first_rows", "SELECT * FROM txn ORDER BY TransactionID LIMIT 100", "txn")
def src02(spark, d):
    return IO.first_rows(txn(spark, d), "TransactionID", 100)


@query("src03_scoring_input", """SELECT 'labelled' AS file, TransactionID, TransactionAmt, 1 AS has_label FROM txn
UNION ALL SELECT 'unlabelled', TransactionID, TransactionAmt, 0 FROM txn""", "txn")
def src03(spark, d):
    """The same rows from a CSV file with and from one without a label."""
    t, out = txn(spark, d), None
    for name, rows in (("labelled", t), ("unlabelled", t.drop("isFraud"))):
        path = scratch_path(spark, name)
        IO.write_table(rows, path, "csv")
        batch, labelled = IO.read_scoring_csv(spark, path, t.schema)
        part = batch.select(F.lit(name).alias("file"), "TransactionID", "TransactionAmt", F.lit(int(labelled)).alias("has_label"))
        out = part if out is None else out.unionByName(part)
    return out


@query("src04_record_input", """
SELECT event_id, value AS TransactionAmt, CASE WHEN event_id % 2 = 0 THEN CAST(user_id AS DOUBLE) ELSE 0.0 END AS card1,
       CAST(0 AS DOUBLE) AS addr1, CAST(0 AS DOUBLE) AS TransactionDT,
       CASE WHEN event_id % 2 = 0 THEN event_type ELSE '' END AS P_emaildomain
FROM events WHERE event_id % 5 <> 4""")
def src04(spark, d):
    even = F.col("event_id") % 2 == 0
    rec = F.to_json(F.struct(
        F.when(F.col("event_id") % 5 != 4, F.col("value")).alias("TransactionAmt"),
        F.when(even, F.col("user_id")).alias("card1"),
        F.when(even, F.col("event_type")).alias("P_emaildomain"),
        F.col("props").alias("extra")))
    lines = table(spark, d, "events").select("event_id", rec.alias("line"))
    return IO.parse_records(lines, "line", ["event_id"])


@query("src05_table_check", """
SELECT count(*) AS n_rows, CAST(sum(isFraud) AS BIGINT) AS positives, round(avg(isFraud), 6) AS label_rate,
       CAST(8 AS BIGINT) AS n_features, 1 AS features_ok, 1 AS rate_ok FROM txn""", "txn")
def src05(spark, d):
    out = IO.check_table(txn(spark, d), ["TransactionID", "TransactionDT", "isFraud"], 8, rate_range=(0.01, 0.2))
    return out.withColumn("label_rate", F.round("label_rate", 6))


@query("src06_run_history", f"""
SELECT version, model_type, hyperparameters, coalesce(CAST(auc_roc AS VARCHAR), '') AS auc_roc FROM ({io_checks.RUNS_SQL})""")
def src06(spark, d):
    path = scratch_path(spark, "runs")
    runs = io_checks.runs_by_day(spark, d).withColumn("timestamp", F.lit(None).cast("string"))
    runs.select(*[f.name for f in IO.RUN_SCHEMA.fields]).write.mode("append").parquet(path)
    return IO.read_runs(spark, path).select("version", "model_type", "hyperparameters", "auc_roc")


_MODELS_SQL = """
SELECT 'model_v_' || strftime(ts, '%Y%m%d') || '_' || event_type || '.pkl' AS name, max(event_id) AS created_at
FROM events GROUP BY 1"""


@query("src07_model_listing", f"SELECT name, created_at, row_number() OVER (ORDER BY created_at DESC) AS place FROM ({_MODELS_SQL})")
def src07(spark, d):
    from pyspark.sql import Window
    from riskspark.queries.join_queries import models_by_day
    # one row per model version, so ranking in one task is fine
    return models_by_day(spark, d, errors=True).withColumn("place", F.row_number().over(Window.orderBy(F.desc("created_at"))).cast("bigint"))


@query("snk01_write_table", "SELECT ProductCD, count(*) AS n, round(sum(TransactionAmt), 2) AS amount FROM txn GROUP BY 1", "txn")
def snk01(spark, d):
    path = scratch_path(spark, "table")
    IO.write_table(txn(spark, d), path, partition_by=["ProductCD"])
    back = spark.read.parquet(path)
    return back.groupBy("ProductCD").agg(F.count("*").alias("n"), F.round(F.sum("TransactionAmt"), 2).alias("amount"))


@query("snk02_append_run", """
SELECT 'v_first' AS version, 'GBT' AS model_type, '{"depth":5}' AS hyperparameters, round(avg(isFraud), 6) AS auc_pr FROM txn
UNION ALL SELECT 'v_second', 'LogisticRegression', '{"depth":5}', round(avg(p), 6) FROM scored""", "txn scored")
def snk02(spark, d):
    path = scratch_path(spark, "runlog")
    rate = txn(spark, d).agg(F.round(F.avg("isFraud"), 6)).first()[0]
    mean = scored(spark, d).agg(F.round(F.avg("p"), 6)).first()[0]
    IO.append_run(spark, path, {"version": "v_first", "model_type": "GBT", "hyperparameters": '{"depth":5}', "auc_pr": rate})
    IO.append_run(spark, path, {"version": "v_second", "model_type": "LogisticRegression", "hyperparameters": '{"depth":5}', "auc_pr": mean})
    return spark.read.schema(IO.RUN_SCHEMA).parquet(path).select("version", "model_type", "hyperparameters", "auc_pr")


@query("snk03_result_document", """
SELECT day, '{"items":[' || string_agg('{"hour_window":' || hour_window || ',"total":' || total || ',"fraud_count":' || fraud_count || '}', ',' ORDER BY hour_window) || ']}' AS document
FROM (SELECT CAST(floor(hour_window / 24.0) AS BIGINT) AS day, * FROM hourly) GROUP BY 1""", "hourly")
def snk03(spark, d):
    h = timeseries.hourly(txn(spark, d)).withColumn("day", F.floor(F.col("hour_window") / 24).cast("bigint"))
    return IO.to_document(h, ["day"], ["hour_window", "total", "fraud_count"])


@query("snk03_result_file", """
SELECT CAST(floor(hour_window / 24.0) AS BIGINT) AS day, count(*) AS n_windows, max(total) AS most, CAST(sum(fraud_count) AS BIGINT) AS positives FROM hourly GROUP BY 1""", "hourly")
def snk03_file(spark, d):
    """Nested result documents written as JSON lines and read back."""
    h = timeseries.hourly(txn(spark, d)).withColumn("day", F.floor(F.col("hour_window") / 24).cast("bigint"))
    path = scratch_path(spark, "documents")
    IO.write_documents(h, ["day"], {"windows": ["hour_window", "total", "fraud_count"]}, path)
    back = spark.read.schema("day bigint, windows array<struct<hour_window: bigint, total: bigint, fraud_count: bigint>>").json(path)
    return back.select("day", F.size("windows").cast("bigint").alias("n_windows"), F.array_max(F.col("windows.total")).alias("most"),
                       F.aggregate(F.col("windows.fraud_count"), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("positives"))


@query("snk05_text_report", """
SELECT 1 AS section_no, 'SIZE' AS section, 'rows' AS key, 'rows: ' || count(*) AS text FROM txn
UNION ALL SELECT 2, 'PRODUCTS', ProductCD, ProductCD || ': ' || count(*) FROM txn GROUP BY ProductCD
UNION ALL SELECT 3, 'DEVICES', DeviceType, DeviceType || ': ' || count(*) FROM identity GROUP BY DeviceType""", "txn identity")
def snk05(spark, d):
    t = txn(spark, d)
    size = t.agg(F.count("*").alias("n")).select(F.lit("rows").alias("key"), F.concat(F.lit("rows: "), F.col("n").cast("string")).alias("text"))

    def lines(df, c):
        g = df.groupBy(F.col(c).alias("key")).agg(F.count("*").alias("n"))
        return g.select("key", F.concat("key", F.lit(": "), F.col("n").cast("string")).alias("text"))

    return IO.report_lines([("SIZE", size), ("PRODUCTS", lines(t, "ProductCD")), ("DEVICES", lines(identity(spark, d), "DeviceType"))])
