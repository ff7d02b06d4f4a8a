"""Column selection: null share, variance, correlation, binned mutual information, and the fitted pruner."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.behavior import null_fractions
from riskspark.plans.quantiles import column_quantiles, indexed_long_form, per_column

FLAT = 1e-12  # a column counts as constant when its variance is at most this share of its mean square around the centre


#: Up to so many columns meet the label in one plain aggregation; more go through one line per cell.
FEW_COLUMNS = 100


def _numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns as doubles; NaN counts as missing."""
    cells = {f"_{i}": F.col(c).cast("double") for i, c in enumerate(columns)}
    return df.select(*[F.when(~F.isnan(x), x).alias(n) for n, x in cells.items()])


def _centres(typed: DataFrame) -> np.ndarray:
    """Means of the finite values of every column; 0 for a column without any."""
    row = typed.agg(*[F.avg(F.when(F.abs(c) < float("inf"), F.col(c))) for c in typed.columns]).first()
    return np.array([v or 0.0 for v in row])


def _few_with_label(df: DataFrame, columns: list[str], label: str) -> list[float | None]:
    """r of each column with the label, as in ``_moment_correlations``, in one aggregation."""
    typed = _numbers(df, [*columns, label])
    y = F.col(f"_{len(columns)}")
    sums = []
    for i in range(len(columns)):
        x = F.col(f"_{i}")
        sums += [F.covar_pop(x, y), F.var_pop(F.when(y.isNotNull(), x)), F.var_pop(F.when(x.isNotNull(), y))]
    row = typed.agg(*sums).first()
    found = []
    for cov, vx, vy in zip(row[::3], row[1::3], row[2::3]):
        known = None not in (cov, vx, vy) and np.isfinite([cov, vx, vy]).all() and vx > 0 and vy > 0
        found.append(float(cov / (np.sqrt(vx) * np.sqrt(vy))) if known else None)
    return found


def _moment_correlations(df: DataFrame, left: list[str], right: list[str] | None = None) -> DataFrame:
    """(i, j, r) of the pairs i < j of ``left``, or of every ``left`` with every ``right`` column.

    Each pair counts the rows where both sides are present; NaN is missing. r is NULL when a side is constant on them or
    holds an infinite value. Every task adds up matrices of products around common centres and gives out one line per column;
    grouped sums add them up.
    """
    import pyarrow as pa

    p, columns = len(left), left + (right or [])
    typed = _numbers(df, columns)
    centre = _centres(typed)

    def sums(batches):
        total, seen = 0.0, False
        for batch in batches:
            raw = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            here = ~np.isnan(raw)
            with np.errstate(invalid="ignore", over="ignore"):
                x = np.where(here, raw - centre, 0.0)
                mask, sq = here.astype(float), x * x
                a, b = slice(0, p), slice(p, None) if right else slice(0, p)
                total = total + np.stack([
                    mask[:, a].T @ mask[:, b], x[:, a].T @ mask[:, b], mask[:, a].T @ x[:, b], sq[:, a].T @ mask[:, b], mask[:, a].T @ sq[:, b], x[:, a].T @ x[:, b],
                ])
            seen = True
        if seen:
            lines = [pa.array(list(total[t]), pa.list_(pa.float64())) for t in range(6)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(p, dtype=np.int32)), *lines], ["i", *[f"m{t}" for t in range(6)]])

    parts = typed.mapInArrow(sums, "i int, " + ", ".join(f"m{t} array<double>" for t in range(6)))
    cells = parts.select("i", F.posexplode(F.arrays_zip(*[f"m{t}" for t in range(6)])).alias("j", "m"))
    if not right:
        cells = cells.where(F.col("j") > F.col("i"))
    m = cells.groupBy("i", "j").agg(*[F.sum(f"m.m{t}").alias(f"m{t}") for t in range(6)])
    n = F.col("m0")
    vx = F.col("m3") - F.try_divide(F.col("m1") * F.col("m1"), n)
    vy = F.col("m4") - F.try_divide(F.col("m2") * F.col("m2"), n)
    cov = F.col("m5") - F.try_divide(F.col("m1") * F.col("m2"), n)
    varies = (vx > FLAT * F.col("m3")) & (vy > FLAT * F.col("m4"))
    r = F.when(varies, F.try_divide(cov, F.sqrt(vx) * F.sqrt(vy)))
    return m.select("i", "j", F.when(~F.isnan(r), r).alias("r"))


def label_correlations(df: DataFrame, columns: list[str], label: str = "isFraud") -> DataFrame:
    """(column, ordinal, r) for all columns with the label in one aggregation, of a few columns or of one line per cell."""
    if len(columns) <= FEW_COLUMNS:
        found = _few_with_label(df, columns, label)
        return df.sparkSession.createDataFrame([(c, i + 1, r) for i, (c, r) in enumerate(zip(columns, found))], "column string, ordinal bigint, r double")
    y = F.col(label).cast("double")
    long = indexed_long_form(df.select(*columns, F.when(~F.isnan(y), y).alias("_y")), [F.col(c) for c in columns], ["_y"])
    long = long.where(~F.isnan("v") & F.col("_y").isNotNull())
    sums = long.groupBy(F.col("ci").alias("i")).agg(F.covar_pop("v", "_y").alias("c"), F.var_pop("v").alias("vx"), F.var_pop("_y").alias("vy"))
    r = F.when((F.col("vx") > 0) & (F.col("vy") > 0), F.try_divide(F.col("c"), F.sqrt("vx") * F.sqrt("vy")))
    long = sums.select("i", F.when(~F.isnan(r), r).alias("r"))
    lines = df.sparkSession.createDataFrame(list(enumerate(columns)), "i int, column string")
    return lines.join(long, "i", "left").select("column", (F.col("i") + 1).cast("bigint").alias("ordinal"), "r")


def _with_ordinal(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumn("ordinal", F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column")))


def pair_correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """(i, j, a, b, r) for all column pairs i < j, each over the rows where both are present; one pass over the rows."""
    names = F.array(*[F.lit(c) for c in columns])
    long = _moment_correlations(df, columns)
    if len(columns) > 1 and df.isEmpty():
        pairs = [(i, j, None) for i, j in itertools.combinations(range(len(columns)), 2)]
        long = df.sparkSession.createDataFrame(pairs, "i int, j int, r double")
    return long.select("i", "j", F.get(names, F.col("i")).alias("a"), F.get(names, F.col("j")).alias("b"), "r")


def redundant_pairs(df: DataFrame, columns: list[str], threshold: float = 0.98) -> DataFrame:
    return pair_correlations(df, columns).where(F.abs("r") > threshold).orderBy(F.desc(F.abs("r")), "i", "j")


# ---- selectors ------------------------------------------------------------------------------------------------------

def high_null_columns(df: DataFrame, columns: list[str], threshold: float) -> list[str]:
    shares = null_fractions(df, columns)
    return [c for c in columns if shares[c] > threshold]


def constant_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """Columns with a single value once NULL is 0."""
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns]
    row = df.agg(*[F.min(x) for x in filled], *[F.max(x) for x in filled]).first()
    return [c for i, c in enumerate(columns) if row[i] == row[i + len(columns)]]


def correlated_columns(df: DataFrame, columns: list[str], threshold: float) -> list[str]:
    """Later columns of any pair above the threshold, even when the earlier one goes too."""
    rows = pair_correlations(df, columns).where(F.abs("r") > threshold).select("b").distinct().collect()
    gone = {r["b"] for r in rows}
    return [c for c in columns if c in gone]


def mutual_information(df: DataFrame, columns: list[str], label: str = "isFraud", bins: int = 10, fill: float = -1.0) -> DataFrame:
    """(column, ordinal, mi) in nats over quantile bins; equal values share a bin, NULL is filled first.

    All columns are counted in one groupBy(column, bin, label), whose size is columns x bins x classes.
    """
    inputs = [F.coalesce(F.col(c).cast("double"), F.lit(float(fill))) for c in columns]
    filled = df.select(F.col(label).alias("_y"), *[x.alias(c) for x, c in zip(inputs, columns)])
    probs = {f"q{i}": i / bins for i in range(1, bins)}
    cuts = column_quantiles(filled, columns, probs)
    top = float("inf")
    at = F.lit(0)
    for q in probs:
        at = at + (F.col("v") > per_column([top if r[q] is None else r[q] for r in cuts])).cast("int")
    long = indexed_long_form(filled, [F.col(c) for c in columns], ["_y"])
    cells = long.groupBy("ci", at.alias("bin"), "_y").agg(F.count("*").alias("n"))
    cells = cells.withColumn("column", F.get(F.array(*[F.lit(c) for c in columns]), F.col("ci")))
    by = Window.partitionBy
    n, all_n = F.col("n"), F.sum("n").over(by("column"))
    term = n / all_n * F.log(n * all_n / (F.sum("n").over(by("column", "bin")) * F.sum("n").over(by("column", "_y"))))
    mi = cells.select("column", term.alias("t")).groupBy("column").agg(F.sum("t").alias("mi"))
    return _with_ordinal(mi, columns)


def top_by_score(scores: DataFrame, k: int, score: str) -> DataFrame:
    """Highest scores; ties keep the first column order."""
    return scores.orderBy(F.desc(F.round(score, 12)), "ordinal").limit(k)


def prune_columns(df: DataFrame, columns: list[str], label: str = "isFraud", *, null_threshold: float = 0.95,
                  corr_threshold: float = 0.98, keep: int = 167, bins: int = 10, fill: float = -1.0,
                  min_score: float | None = None) -> list[str]:
    """Null share, then constants, then redundant columns, then the ``keep`` best by mutual information, in column order.

    ``min_score`` first keeps columns with at least that score and pads with the best others up to ``keep``.
    """
    gone = set(high_null_columns(df, columns, null_threshold))
    left = [c for c in columns if c not in gone]
    gone = set(constant_columns(df, left)) if left else set()
    left = [c for c in left if c not in gone]
    gone = set(correlated_columns(df, left, corr_threshold)) if len(left) > 1 else set()
    left = [c for c in left if c not in gone]
    if not left:
        return []
    scores = [(r["column"], r["mi"]) for r in top_by_score(mutual_information(df, left, label, bins, fill), len(left), "mi").collect()]
    if min_score is not None:
        strong = [c for c, s in scores if s >= min_score]
        weak = [c for c, s in scores if s < min_score]
        scores = [(c, 0.0) for c in strong + weak]
    chosen = {c for c, _ in scores[:keep]}
    return [c for c in left if c in chosen]
