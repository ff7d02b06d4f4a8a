"""Reading and writing: tables, records, run log, model registry, reports, result documents."""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators.clean import require

# The record accepted for scoring, with its defaults; other fields are ignored.
RECORD_DEFAULTS = {"TransactionAmt": None, "card1": 0.0, "addr1": 0.0, "TransactionDT": 0.0, "P_emaildomain": ""}
RECORD_SCHEMA = "TransactionAmt double, card1 double, addr1 double, TransactionDT double, P_emaildomain string"

RUN_SCHEMA = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("model_type", T.StringType()),
    T.StructField("hyperparameters", T.StringType()),
    T.StructField("precision", T.DoubleType()),
    T.StructField("recall", T.DoubleType()),
    T.StructField("auc_roc", T.DoubleType()),
    T.StructField("auc_pr", T.DoubleType()),
])
REGISTRY_SCHEMA = T.StructType([
    T.StructField("version", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("created_at", T.LongType()),
    T.StructField("event", T.StringType()),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Headered CSV with a stated schema, so that no pass is spent on inference."""
    return spark.read.schema(schema).option("header", True).csv(path)


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows by ``key``; a scan has no order of its own."""
    return df.orderBy(key).limit(n)


def scoring_input(df: DataFrame, label: str = "isFraud") -> tuple[DataFrame, bool]:
    """The batch and whether it carries labels."""
    return df, label in df.columns


def read_scoring_csv(spark: SparkSession, path: str, schema: T.StructType | str, label: str = "isFraud") -> tuple[DataFrame, bool]:
    """A headered CSV to score, with the stated types for the columns it has, and whether it carries labels.

    The header alone decides which columns there are; a column that the schema does not name stays text.
    """
    stated = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    names = spark.read.option("header", True).csv(path).columns
    kinds = {f.name: f.dataType for f in stated.fields}
    typed = T.StructType([T.StructField(n, kinds.get(n, T.StringType())) for n in names])
    return scoring_input(spark.read.schema(typed).option("header", True).csv(path), label)


def parse_records(lines: DataFrame, column: str, keep: list[str] = ()) -> DataFrame:
    """JSON records to typed rows with defaults; a record without an amount is dropped, extra fields are ignored."""
    parsed = lines.select(*keep, F.from_json(column, RECORD_SCHEMA).alias("r"))
    cols = []
    for name, default in RECORD_DEFAULTS.items():
        c = F.col(f"r.{name}")
        cols.append((c if default is None else F.coalesce(c, F.lit(default))).alias(name))
    return parsed.select(*keep, *cols).where(F.col("TransactionAmt").isNotNull())


def check_table(df: DataFrame, required: list[str], n_features: int | None, label: str = "isFraud",
                rate_range: tuple[float, float] = (0.0, 1.0)) -> DataFrame:
    """One row: counts, label rate, and whether feature count and rate are as expected. Absent columns raise."""
    require(df, required)
    features = len([c for c in df.columns if c not in required])
    row = df.agg(F.count("*").alias("n_rows"), F.sum(label).cast("bigint").alias("positives"), F.avg(label).alias("label_rate"))
    return row.select(
        "n_rows", "positives", "label_rate",
        F.lit(features).cast("bigint").alias("n_features"),
        F.lit(int(n_features is None or features == n_features)).alias("features_ok"),
        F.col("label_rate").between(*rate_range).cast("int").alias("rate_ok"),
    )


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] = ()) -> None:
    """Overwrite a table; partitioned by columns when asked."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def append_run(spark: SparkSession, path: str, run: dict) -> None:
    """Append one evaluation row to the run log."""
    spark.createDataFrame([tuple(run.get(f.name) for f in RUN_SCHEMA.fields)], RUN_SCHEMA).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """Run history with blanks for missing text and metrics as text, as a display wants them."""
    runs = spark.read.schema(RUN_SCHEMA).parquet(path)
    return blank_nulls(runs)


def blank_nulls(df: DataFrame) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


#: Items that one document may hold.
MOST_ITEMS = 100_000


def _require_short(df: DataFrame, by: list[str], most: int) -> None:
    """Raise if a key has more than ``most`` items: a document is one row, so its group must fit in a task."""
    long = df.groupBy(*by).agg(F.count("*").alias("_n")).where(F.col("_n") > most).select("_n").first()
    if long is not None:
        raise ValueError(f"a document would hold {long[0]} items; at most {most} are allowed")


def to_document(df: DataFrame, by: list[str], items: list[str], out: str = "document", most: int = MOST_ITEMS) -> DataFrame:
    """One JSON text per row of keys: an array of the items, sorted by the first item.

    Meant for result tables, whose groups are short (hours, rules, features); more than ``most`` items of a key raise an error.
    """
    _require_short(df, by, most)
    body = F.array_sort(F.collect_list(F.struct(*items)))
    return df.groupBy(*by).agg(F.to_json(F.struct(body.alias("items"))).alias(out))


def write_documents(df: DataFrame, by: list[str], lists: dict[str, list[str]], path: str, most: int = MOST_ITEMS) -> None:
    """One nested JSON document per key: under each name of ``lists`` an array of its columns, sorted by the first of them.

    Meant for result tables, whose groups are short (hours, rules, features); more than ``most`` items of a key raise an error.
    """
    _require_short(df, by, most)
    bodies = [F.array_sort(F.collect_list(F.struct(*columns))).alias(name) for name, columns in lists.items()]
    df.groupBy(*by).agg(*bodies).write.mode("overwrite").json(path)


def report_lines(sections: list[tuple[str, DataFrame]]) -> DataFrame:
    """(section, line_no, text) from titled result tables; each table has columns ``key`` and ``text``."""
    out = None
    for i, (title, df) in enumerate(sections, 1):
        part = df.select(F.lit(i).alias("section_no"), F.lit(title).alias("section"), F.col("key"), F.col("text"))
        out = part if out is None else out.unionByName(part)
    return out


# ---- models ---------------------------------------------------------------------------------------------------------

def _register(spark, root: str, version: str, path: str, event: str) -> None:
    try:
        last = spark.read.schema(REGISTRY_SCHEMA).parquet(f"{root}/registry").agg(F.max("created_at")).first()[0] or 0
    except AnalysisException:  # the first entry
        last = 0
    row = [(version, path, max(int(time.time() * 1000), last + 1), event)]  # later entries sort later, also within a millisecond
    spark.createDataFrame(row, REGISTRY_SCHEMA).write.mode("append").parquet(f"{root}/registry")


def save_model(spark: SparkSession, model, root: str, version: str) -> str:
    """Save under the version and make it the active one."""
    path = f"{root}/models/{version}"
    model.write().overwrite().save(path)
    _register(spark, root, version, path, "saved")
    _register(spark, root, version, path, "activated")
    return path


def list_models(spark: SparkSession, root: str) -> DataFrame:
    """Saved models, newest first."""
    reg = spark.read.schema(REGISTRY_SCHEMA).parquet(f"{root}/registry")
    return reg.where(F.col("event") == "saved").groupBy("version", "path").agg(F.max("created_at").alias("created_at")).orderBy(
        F.desc("created_at"), F.desc("version"))


def activate_model(spark: SparkSession, root: str, version: str) -> None:
    found = list_models(spark, root).where(F.col("version") == version).first()
    if found is None:
        raise ValueError(f"no saved model {version}")
    _register(spark, root, version, found["path"], "activated")


def active_version(spark: SparkSession, root: str) -> str | None:
    reg = spark.read.schema(REGISTRY_SCHEMA).parquet(f"{root}/registry").where(F.col("event") == "activated")
    row = reg.orderBy(F.desc("created_at")).first()
    return row["version"] if row else None


def load_active(spark: SparkSession, root: str):
    """Reload the active model."""
    from pyspark.ml import PipelineModel

    return PipelineModel.load(f"{root}/models/{active_version(spark, root)}")


