"""Card-transaction views over the general test tables, each with the same definition as SQL text for the checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORIGIN = "2024-01-01 00:00:00"
HOUR = 3600
DAY = 86400


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is looked up in the files once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event, shaped as a card transaction. ``k`` decides the label and is never a feature."""
    e = table(spark, sf_dir, "events")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    k = F.get_json_object("props", "$.k").cast("int")
    joined = e.join(c, F.col("user_id") == F.col("c_custkey"), "left").join(
        n, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return joined.select(
        F.col("event_id").alias("TransactionID"),
        F.expr(f"timestampdiff(SECOND, timestamp_ntz'{ORIGIN}', ts)").alias("TransactionDT"),
        F.col("value").alias("TransactionAmt"),
        F.col("event_type").alias("ProductCD"),
        F.col("user_id").alias("card1"),
        F.when(F.col("event_id") % 10 != 3, F.col("c_nationkey")).alias("addr1"),
        F.col("c_mktsegment").alias("card4"),
        F.when(F.col("event_id") % 7 != 2, F.col("n_name")).alias("P_emaildomain"),
        F.when(F.col("event_id") % 4 != 0, F.col("c_acctbal")).alias("dist1"),
        F.when(k < 4, 1).otherwise(0).alias("isFraud"),
        k.alias("k"),
    )


def identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device rows for three quarters of the transactions."""
    e = table(spark, sf_dir, "events").where(F.col("event_id") % 4 != 1)
    m = F.col("event_id") % 5
    return e.select(
        F.col("event_id").alias("TransactionID"),
        F.when(F.col("event_id") % 2 == 0, "mobile").otherwise("desktop").alias("DeviceType"),
        F.when(m == 0, "Windows 10 Chrome").when(m == 1, " iOS Safari ").when(m == 2, "SAMSUNG Android")
        .when(m == 4, "MacOS Firefox").alias("DeviceInfo"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with a fixed score column that has many ties."""
    t = txn(spark, sf_dir)
    i = F.col("TransactionID")
    return t.select(
        "TransactionID", "TransactionDT", "TransactionAmt", "isFraud",
        F.when(F.col("isFraud") == 1, (F.lit(50) + i % 50) / F.lit(100.0)).otherwise((i % 80) / F.lit(100.0)).alias("p"),
    )


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numeric columns V1..V8: redundant, constant and mostly-null ones among them."""
    li = table(spark, sf_dir, "lineitem")
    label = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F") & (F.col("l_suppkey") % 4 == 0)
    return li.select(
        F.col("l_quantity").alias("V1"),
        F.col("l_extendedprice").alias("V2"),
        F.col("l_discount").alias("V3"),
        F.col("l_tax").alias("V4"),
        (F.col("l_extendedprice") * 2 + 1).alias("V5"),
        F.lit(0.0).alias("V6"),
        F.when(F.col("l_orderkey") % 50 == 0, F.col("l_tax")).alias("V7"),
        F.when(F.col("l_partkey") % 3 != 0, F.col("l_discount")).alias("V8"),
        F.when(label, 1).otherwise(0).alias("isFraud"),
    )


V_COLUMNS = [f"V{i}" for i in range(1, 9)]


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("x"), "label"
    )


# The same views as SQL text.
SQL_VIEWS = {
    "txn": f"""
SELECT e.event_id AS TransactionID,
       date_diff('second', TIMESTAMP '{ORIGIN}', e.ts) AS TransactionDT,
       e.value AS TransactionAmt, e.event_type AS ProductCD, e.user_id AS card1,
       CASE WHEN e.event_id % 10 = 3 THEN NULL ELSE c.c_nationkey END AS addr1,
       c.c_mktsegment AS card4,
       CASE WHEN e.event_id % 7 = 2 THEN NULL ELSE n.n_name END AS P_emaildomain,
       CASE WHEN e.event_id % 4 = 0 THEN NULL ELSE c.c_acctbal END AS dist1,
       CASE WHEN CAST(json_extract_string(e.props, '$.k') AS INT) < 4 THEN 1 ELSE 0 END AS isFraud,
       CAST(json_extract_string(e.props, '$.k') AS INT) AS k
FROM events e LEFT JOIN customer c ON e.user_id = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "identity": """
SELECT event_id AS TransactionID,
       CASE WHEN event_id % 2 = 0 THEN 'mobile' ELSE 'desktop' END AS DeviceType,
       CASE event_id % 5 WHEN 0 THEN 'Windows 10 Chrome' WHEN 1 THEN ' iOS Safari '
            WHEN 2 THEN 'SAMSUNG Android' WHEN 4 THEN 'MacOS Firefox' END AS DeviceInfo
FROM events WHERE event_id % 4 <> 1""",
    "scored": """
SELECT TransactionID, TransactionDT, TransactionAmt, isFraud,
       CAST(CASE WHEN isFraud = 1 THEN (50 + TransactionID % 50) / 100.0
                 ELSE (TransactionID % 80) / 100.0 END AS DOUBLE) AS p FROM txn""",
    "wide": """
SELECT l_quantity AS V1, l_extendedprice AS V2, l_discount AS V3, l_tax AS V4,
       l_extendedprice * 2 + 1 AS V5, CAST(0.0 AS DOUBLE) AS V6,
       CASE WHEN l_orderkey % 50 = 0 THEN l_tax END AS V7,
       CASE WHEN l_partkey % 3 <> 0 THEN l_discount END AS V8,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND l_suppkey % 4 = 0 THEN 1 ELSE 0 END AS isFraud
FROM lineitem""",
    "hourly": """
SELECT CAST(floor(TransactionDT / 3600.0) AS BIGINT) AS hour_window, count(*) AS total,
       CAST(sum(isFraud) AS BIGINT) AS fraud_count,
       CAST(sum(isFraud) AS DOUBLE) / greatest(count(*), 1) AS fraud_rate,
       CAST(floor(TransactionDT / 3600.0) AS BIGINT) * 3600 AS window_start
FROM txn GROUP BY 1""",
    "vectors": "SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x, label FROM embeddings",
}

_NEEDS = {"scored": ["txn"], "hourly": ["txn"]}


def with_views(names: str, body: str) -> str:
    """Prefix ``body`` with the named views (and what they need) as common table expressions."""
    wanted: list[str] = []
    for n in names.split():
        for m in [*_NEEDS.get(n, []), n]:
            if m not in wanted:
                wanted.append(m)
    ctes = ",\n".join(f"{n} AS ({SQL_VIEWS[n]})" for n in wanted)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
