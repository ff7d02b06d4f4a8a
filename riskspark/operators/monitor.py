"""Drift, data quality and classification quality between a reference and a current table."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.evaluate import classification_metrics
from riskspark.operators.profile import histogram_bin
from riskspark.plans.quantiles import long_form
from riskspark.plans.ranking import running_totals

KS_CRITICAL = {0.10: 1.224, 0.05: 1.358, 0.01: 1.628}  # fixed values: two-sample limits by level


def tag_sets(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Union with ``is_current`` 0/1."""
    return reference.withColumn("is_current", F.lit(0)).unionByName(current.withColumn("is_current", F.lit(1)))


def score_drift(reference: DataFrame, current: DataFrame, score: str = "p", bins: int = 50, eps: float = 1e-9) -> DataFrame:
    """One row: divergence of the two score densities on [0, 1], summed over bins (densities, not masses)."""
    both = tag_sets(reference.select(score), current.select(score))
    b = both.select("is_current", histogram_bin(F.col(score), 0.0, 1.0, bins).alias("bin")).where(F.col("bin").isNotNull())
    cells = b.groupBy("bin").agg(F.count_if(F.col("is_current") == 0).alias("r"), F.count_if(F.col("is_current") == 1).alias("c"))
    n = cells.agg(F.coalesce(F.sum("r"), F.lit(0)), F.coalesce(F.sum("c"), F.lit(0))).first()
    p = F.col("r") * F.lit(float(bins)) / F.lit(float(max(n[0], 1))) + eps
    q = F.col("c") * F.lit(float(bins)) / F.lit(float(max(n[1], 1))) + eps
    return cells.agg(F.coalesce(F.sum(p * F.log(p / q)), F.lit(0.0)).alias("drift"))


def retrain_flag(drift: DataFrame, limit: float = 0.1) -> DataFrame:
    return drift.withColumn("retrain", (F.col("drift") > limit).cast("int"))


def data_quality(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows, duplicate rows, missing cells and their share; duplicates are counted by grouping whole rows."""
    columns = columns or df.columns
    missing = F.lit(0)
    for c in columns:
        missing = missing + F.col(c).isNull().cast("int")
    rows = df.groupBy(*columns).agg(F.count("*").alias("n"))
    return rows.agg(
        F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).cast("bigint").alias("duplicate_rows"),
        F.sum(missing * F.col("n")).cast("bigint").alias("missing_cells"),
    ).withColumn("missing_share", F.try_divide(F.col("missing_cells").cast("double"), F.col("n_rows") * len(columns)))


def numeric_drift(reference: DataFrame, current: DataFrame, columns: list[str], alpha: float = 0.05) -> DataFrame:
    """(column, statistic, n_ref, n_cur, drifted): two-sample Kolmogorov-Smirnov for all columns in one job."""
    long = long_form(tag_sets(reference.select(*columns), current.select(*columns)), columns, ["is_current"])
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count_if(F.col("is_current") == 0).alias("r"), F.count_if(F.col("is_current") == 1).alias("c"))
    cum = running_totals(counts, ["column", "value"], {"r0": F.col("r"), "c0": F.col("c")}, "ks")
    sizes = cum.groupBy("column").agg(F.sum("r").alias("n_ref"), F.sum("c").alias("n_cur"), F.min("r0").alias("r_start"), F.min("c0").alias("c_start"))
    # one row per column of the table
    at = cum.join(F.broadcast(sizes), "column")
    share = lambda before, own, start, n: F.try_divide((F.col(before) + F.col(own) - F.col(start)).cast("double"), F.col(n))
    gap = F.abs(share("r0", "r", "r_start", "n_ref") - share("c0", "c", "c_start", "n_cur"))
    g = at.groupBy("column").agg(F.max(gap).alias("statistic"), F.max("n_ref").alias("n_ref"), F.max("n_cur").alias("n_cur"))
    n, m = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    limit = F.lit(KS_CRITICAL[alpha]) * F.sqrt(F.try_divide(n + m, n * m))
    return g.withColumn("drifted", F.coalesce(F.col("statistic") > limit, F.lit(False)).cast("int"))


def category_drift(reference: DataFrame, current: DataFrame, columns: list[str], limit: float = 0.2, eps: float = 1e-4) -> DataFrame:
    """(column, statistic, drifted): population stability index over levels (NULL is a level)."""
    both = tag_sets(reference.select(*columns), current.select(*columns))
    texts = both.select("is_current", *[F.coalesce(F.col(c).cast("string"), F.lit("missing")).alias(c) for c in columns])
    cells = texts.unpivot(["is_current"], columns, "column", "level").groupBy("column", "level").agg(
        F.count_if(F.col("is_current") == 0).alias("r"), F.count_if(F.col("is_current") == 1).alias("c"))
    n, m = reference.count(), current.count()
    p = F.greatest(F.col("r") / F.lit(float(max(n, 1))), F.lit(eps))
    q = F.greatest(F.col("c") / F.lit(float(max(m, 1))), F.lit(eps))
    g = cells.groupBy("column").agg(F.sum((q - p) * F.log(q / p)).alias("statistic"))
    return g.withColumn("drifted", (F.col("statistic") > limit).cast("int"))


def drift_share(report: DataFrame, limit: float = 0.5) -> DataFrame:
    """(columns, drifted, share, passes): passes while the share stays below the limit."""
    return report.agg(F.count("*").alias("columns"), F.sum("drifted").cast("bigint").alias("drifted"), F.avg("drifted").alias("share")).withColumn(
        "passes", (F.col("share") < limit).cast("int"))


def quality_by_set(reference: DataFrame, current: DataFrame, label: str, prediction: str) -> DataFrame:
    """Classification metrics of both sets side by side."""
    both = tag_sets(reference.select(label, prediction), current.select(label, prediction))
    return classification_metrics(both, label, prediction, ["is_current"])


def ks_limit(n: int, m: int, alpha: float = 0.05) -> float:
    return KS_CRITICAL[alpha] * math.sqrt((n + m) / (n * m))
