"""Splits, samples, class balancing and folds. Random order is a seeded hash of the row id: exact sizes, same on reruns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.plans.hashing import hash_cut, hash_rank, hash_take
from riskspark.plans.ranking import global_position


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def chronological_split(df: DataFrame, time: str, id_col: str, train: float = 0.70, val: float = 0.15, variant: str = "cumulative", out: str = "part") -> DataFrame:
    """Mark rows train / val / test by their position in time.

    ``cumulative`` cuts at int((train + val) * n), ``sum`` at int(train * n) + int(val * n).
    """
    n = df.count()
    first = int(train * n)
    second = int(round(train + val, 10) * n) if variant == "cumulative" else first + int(val * n)
    # only time and id are sorted; the rows are then marked by comparing with the two rows at the cuts
    placed = global_position(df.select(time, id_col), [time, id_col], "_pos", "split")
    cuts = {r["_pos"]: r for r in placed.where(F.col("_pos").isin(first, second)).collect()}

    def before(pos):
        if pos not in cuts:  # the cut lies after the last row
            return F.lit(True)
        here = F.struct(F.col(time).alias("t"), F.col(id_col).alias("i"))
        return here < F.struct(F.lit(cuts[pos][time]).cast(df.schema[time].dataType).alias("t"), F.lit(cuts[pos][id_col]).cast(df.schema[id_col].dataType).alias("i"))

    return df.withColumn(out, F.when(before(first), "train").when(before(second), "val").otherwise("test"))


def stratified_split(df: DataFrame, id_col: str, label: str, train: float = 0.8, seed: int = 42, out: str = "part") -> DataFrame:
    """Mark the first floor(train * n_class) rows of each class in hash order as train, the others as test; NULL is a class."""
    inside = hash_cut(df, id_col, lambda total: F.floor(F.lit(train) * total), [label], seed)
    return df.withColumn(out, F.when(inside, "train").otherwise("test"))


def series_split(series: DataFrame, order: str, train: float = 0.8, out: str = "part") -> DataFrame:
    """Mark the first int(train * n) rows of an aggregated series as train."""
    from pyspark.sql import Window

    n = series.count()
    rn = F.row_number().over(Window.orderBy(order))
    return series.withColumn(out, F.when(rn <= int(train * n), "train").otherwise("test"))


def sample_rows(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all when there are fewer)."""
    return hash_take(df, id_col, lambda total: F.least(F.lit(n), total), seed=seed)


def sample_fraction(df: DataFrame, id_col: str, fraction: float, seed: int = 42) -> DataFrame:
    return hash_take(df, id_col, lambda total: F.floor(F.lit(fraction) * total), seed=seed)


def stratified_sample(df: DataFrame, id_col: str, label: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all when there are fewer) with the class shares of the table; NULL is a class of its own.

    Each class gets floor(n * n_class / n_all) rows; those that are missing then go to the largest remainders, equal ones in
    the order of the class, NULL last.
    """
    counts = [(r[0], r[1]) for r in df.groupBy(label).agg(F.count(F.lit(1))).collect()]
    rows = sum(c for _, c in counts)
    take = min(n, rows)
    quotas = {k: take * c // rows for k, c in counts}
    late = sorted(counts, key=lambda kc: (-(take * kc[1] % rows), kc[0] is None, kc[0] if kc[0] is not None else 0))
    for k, _ in late[: take - sum(quotas.values())]:
        quotas[k] += 1

    def quota(_):
        out = F.lit(0)
        for k, q in quotas.items():
            out = F.when(F.col(label).eqNullSafe(F.lit(k)), F.lit(q)).otherwise(out)
        return out

    return hash_take(df, id_col, quota, [label], seed) if counts else df


def capped_sample(df: DataFrame, id_col: str, label: str, n: int, seed: int = 42) -> DataFrame:
    """At most n/5 positives; negatives fill up to ``n``."""
    pos = df.where(F.col(label) == 1).count()
    take = min(pos, n // 5)
    return hash_take(df, id_col, lambda total: F.least(total, F.when(F.col(label) == 1, F.lit(take)).otherwise(F.lit(n - take))), [label], seed)


def undersample(df: DataFrame, id_col: str, label: str, ratio: float = 0.5, seed: int = 42) -> DataFrame:
    """All positives and floor(n1 / ratio) negatives."""
    pos = df.where(F.col(label) == 1).count()
    keep = int(pos / ratio)
    return hash_take(df, id_col, lambda total: F.when(F.col(label) == 1, total).otherwise(F.least(total, F.lit(keep))), [label], seed)


def assign_folds(df: DataFrame, id_col: str, k: int, label: str | None = None, seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold 0..k-1 in hash order, per class when ``label`` is given; rows without label are a class of their own."""
    ranked = hash_rank(df, id_col, [label] if label else [], seed, out="_rank")
    return ranked.select(*df.columns, (F.col("_rank") % k).cast("int").alias(out))
