"""Profiles: rate tables, balance, nulls, descriptive statistics, histograms, correlations, outliers, clusters.

Each profile is one pass of built-in aggregates over the rows; exact quantiles come from :mod:`riskspark.plans.quantiles`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.plans.quantiles import column_quantiles, grouped_quantiles, long_form

# Right-closed amount buckets of the rate report.
AMOUNT_EDGES = [0.0, 10.0, 50.0, 100.0, 250.0, 500.0, 1000.0, 5000.0]
FIVE_NUMBERS = {"min": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1.0}


def rate_table(df: DataFrame, keys: list[str], label: str = "isFraud") -> DataFrame:
    """(key, level, rate, positives, n) for each key column, NULL levels left out; one aggregation for all keys."""
    long = df.select(label, F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("level")) for k in keys])).alias("s"))
    g = long.select("s.*", label).where(F.col("level").isNotNull()).groupBy("key", "level")
    return g.agg(F.avg(label).alias("rate"), F.sum(label).cast("bigint").alias("positives"), F.count(label).alias("n"))


def class_balance(df: DataFrame, label: str = "isFraud") -> DataFrame:
    """Counts, percentages, ratio and both positive-class weights (1 without positives; both sides at least 1)."""
    g = df.agg(F.count_if(F.col(label) == 0).alias("n0"), F.count_if(F.col(label) == 1).alias("n1"))
    n0, n1 = F.col("n0"), F.col("n1")
    return g.select(
        "n0", "n1",
        (n1 * 100 / (n0 + n1)).alias("pct1"),
        F.try_divide(n0.cast("double"), n1).alias("ratio"),
        F.when(n1 > 0, n0 / n1).otherwise(1.0).alias("pos_weight"),
        (F.greatest(n0, F.lit(1)) / F.greatest(n1, F.lit(1))).alias("pos_weight_guarded"),
    )


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, null_pct) for all columns in one aggregation."""
    columns = columns or df.columns
    wide = df.agg(*[(F.avg(F.col(c).isNull().cast("int")) * 100).alias(c) for c in columns])
    return wide.unpivot([], columns, "column", "null_pct")


def null_summary(profile: DataFrame) -> DataFrame:
    p = F.col("null_pct")
    return profile.agg(F.count_if(p == 0).alias("complete"), F.count_if(p > 50).alias("over_50"), F.count_if(p > 95).alias("over_95"))


def corrected_skew(c) -> Column:
    """Bias-corrected skewness; 0 for a constant column, NULL below three values."""
    n = F.count(c).cast("double")
    g1 = F.when(F.var_pop(c) > 0, F.skewness(c)).otherwise(0.0)
    return F.when(F.count(c) >= 3, g1 * F.sqrt(n * (n - 1)) / (n - 2))


def describe(df: DataFrame, columns: list[str], by: str | None = None) -> DataFrame:
    """(column, [by], n, mean, std, skew, min, q1, median, q3, max) over non-null values."""
    keep = [by] if by else []
    long = long_form(df, columns, keep)
    groups = [*keep, "column"]
    base = long.where(F.col("value").isNotNull()).groupBy(*groups).agg(
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), corrected_skew(F.col("value")).alias("skew"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    if by is None:
        q = column_quantiles(df, columns, {"q1": 0.25, "median": 0.5, "q3": 0.75})
        rows = [(r["column"], r["n"], r["q1"], r["median"], r["q3"]) for r in q]
        quart = df.sparkSession.createDataFrame(rows, "column string, n bigint, q1 double, median double, q3 double")
    else:
        quart = grouped_quantiles(long, groups, "value", {"q1": 0.25, "median": 0.5, "q3": 0.75})
    return base.join(F.broadcast(quart), groups)


def box_numbers(df: DataFrame, column: str, by: str) -> DataFrame:
    """Five numbers of a column per class or cluster."""
    return grouped_quantiles(df.select(by, column), [by], column, FIVE_NUMBERS, "box")


def top_n_levels(df: DataFrame, column: str, n: int, label: str | None = None) -> DataFrame:
    """(level, n): the most frequent levels by (count, name) and all others together as ``other``."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("level")).agg(F.count("*").alias("n"))
    top = [r["level"] for r in counts.orderBy(F.desc("n"), "level").limit(n).collect()]
    named = F.when(F.col(column).isin(top), F.col(column)).otherwise("other")
    return df.groupBy(named.alias("level")).agg(F.count("*").alias("n"))


def value_range(df: DataFrame, column) -> tuple[float | None, float | None]:
    c = F.col(column) if isinstance(column, str) else column
    return tuple(df.agg(F.min(c), F.max(c)).first())


def histogram_bin(c: Column, low: float, high: float, bins: int) -> Column:
    """Equal-width bin number; the last bin is closed; NULL outside the range.

    The division alone can miss an edge by a rounding error, so the number is set right against the edges themselves.
    """
    if high == low:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    n = F.least(F.floor((c - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("bigint")
    edge = lambda i: F.lit(low) + i * F.lit(width)
    down = (c < edge(n)).cast("int")
    up = ((c >= edge(n + 1)) & (n < bins - 1)).cast("int")
    return F.when((c >= low) & (c <= high), n - down + up)


def class_histogram(df: DataFrame, value: Column, label: str = "isFraud", bins: int = 50, edges_from: int = 0) -> DataFrame:
    """(label, bin, n): both classes on the edges of class ``edges_from``; values outside them are dropped."""
    low, high = value_range(df.where(F.col(label) == edges_from), value)
    binned = df.select(label, histogram_bin(value, low, high, bins).alias("bin")).where(F.col("bin").isNotNull())
    return binned.groupBy(label, "bin").agg(F.count("*").alias("n"))


def edge_bucket(c, edges: list[float]) -> Column:
    """Number of the right-closed bucket (edge i, edge i+1]; NULL at or below the first edge."""
    x = F.col(c) if isinstance(c, str) else c
    out = F.lit(0)
    for e in edges[1:]:
        out = out + (x > e).cast("int")
    return F.when(x > edges[0], out)


def bucket_rates(df: DataFrame, column: str, edges: list[float] = AMOUNT_EDGES, label: str = "isFraud") -> DataFrame:
    """(bucket, n, positives, rate); empty buckets are left out."""
    b = df.select(edge_bucket(column, edges).alias("bucket"), label).where(F.col("bucket").isNotNull())
    return b.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(label).cast("bigint").alias("positives"), F.avg(label).alias("rate"))


def cut_rates(df: DataFrame, column: str, bins: int = 20, label: str = "isFraud") -> DataFrame:
    """Rates over equal-width right-closed cuts; the lowest cut holds the minimum."""
    low, high = value_range(df, column)
    width = (high - low) / bins or 1.0
    at = F.ceil((F.col(column) - F.lit(low)) / F.lit(width)) - 1
    cut = F.when(F.col(column).isNotNull(), F.greatest(F.least(at, F.lit(bins - 1)), F.lit(0)))
    b = df.select(cut.alias("cut"), label).where(F.col("cut").isNotNull())
    return b.groupBy("cut").agg(F.count("*").alias("n"), F.avg(label).alias("rate"))


def iqr_outliers(df: DataFrame, columns: list[str], label: str = "isFraud", reach: float = 1.5) -> DataFrame:
    """(column, n_outliers, pct, rate) outside the quartile fences, for all columns in one pass after the quartiles."""
    q = {r["column"]: r for r in column_quantiles(df, columns, {"q1": 0.25, "q3": 0.75})}
    cells = []
    for c in columns:
        q1, q3 = q[c]["q1"], q[c]["q3"]
        if q1 is None:
            continue
        span = reach * (q3 - q1)
        out = (F.col(c) < F.lit(q1 - span)) | (F.col(c) > F.lit(q3 + span))
        cells.append(F.struct(F.lit(c).alias("column"), F.coalesce(out, F.lit(False)).cast("int").alias("out"), F.col(c).isNotNull().cast("int").alias("present")))
    long = df.select(F.explode(F.array(*cells)).alias("s"), label).select("s.*", label)
    return long.groupBy("column").agg(
        F.sum("out").cast("bigint").alias("n_outliers"),
        F.try_divide(F.sum("out") * 100.0, F.sum("present")).alias("pct"),
        F.avg(F.when(F.col("out") == 1, F.col(label))).alias("rate"))


def cluster_profile(df: DataFrame, cluster: str, features: list[str], label: str = "isFraud") -> DataFrame:
    """Size, positives, rate, share of all rows and feature means per cluster; missing ids up to the largest have size 0."""
    g = df.groupBy(F.col(cluster).cast("bigint").alias("cluster")).agg(
        F.count("*").alias("size"), F.sum(label).cast("bigint").alias("fraud_count"), F.avg(label).alias("fraud_rate"),
        *[F.avg(f).alias(f"mean_{f}") for f in features])
    ids = df.agg(F.max(cluster).alias("_m")).select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_m").cast("bigint"))).alias("cluster"))
    full = ids.join(F.broadcast(g), "cluster", "left")
    total = F.sum("size").over(Window.partitionBy())
    return full.select(
        "cluster", F.coalesce("size", F.lit(0)).alias("size"), F.coalesce("fraud_count", F.lit(0)).alias("fraud_count"),
        F.coalesce("fraud_rate", F.lit(0.0)).alias("fraud_rate"),
        (F.coalesce("size", F.lit(0)) * 100 / total).alias("pct_of_data"), *[f"mean_{f}" for f in features])


def kpis(df: DataFrame, p: str = "p", threshold: float = 0.5) -> DataFrame:
    hit = (F.col(p) > threshold).cast("int")
    g = df.agg(F.count("*").alias("total"), F.coalesce(F.sum(hit), F.lit(0)).cast("bigint").alias("fraud"), F.avg(p).alias("avg_p"))
    return g.select("total", "fraud", (F.col("total") - F.col("fraud")).alias("safe"), (F.col("avg_p") * 100).alias("avg_probability"))


def cardinality(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, n_distinct) of non-null values: one groupBy(column, level), then a count."""
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "column", "level")
    levels = texts.where(F.col("level").isNotNull()).groupBy("column", "level").agg(F.lit(1).alias("one"))
    return levels.groupBy("column").agg(F.count("*").alias("n_distinct"))


def overview(df: DataFrame, kept: list[str] | None = None) -> DataFrame:
    """Rows, columns, numeric and text columns, columns kept after selection and missing cells."""
    numeric = sum(isinstance(f.dataType, T.NumericType) for f in df.schema.fields)
    texts = sum(isinstance(f.dataType, T.StringType) for f in df.schema.fields)
    missing = F.lit(0)
    for c in df.columns:
        missing = missing + F.col(c).isNull().cast("int")
    n_kept = len(kept if kept is not None else df.columns)
    return df.agg(F.count("*").alias("n_rows"), F.sum(missing).cast("bigint").alias("missing_cells")).select(
        "n_rows", "missing_cells", F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.lit(numeric).cast("bigint").alias("n_numeric"), F.lit(texts).cast("bigint").alias("n_text"),
        F.lit(n_kept).cast("bigint").alias("n_kept"))


def best_key(table: DataFrame, key: str, value: str, smallest_key_first: bool = True) -> DataFrame:
    """Key with the largest value; ties go to the smallest key."""
    order = [F.desc(value), F.asc(key) if smallest_key_first else F.desc(key)]
    return table.orderBy(*order).limit(1)
