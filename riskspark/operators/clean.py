"""Column selection, schema conformance, number coercion and missing-value rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.scalars import clip, finite
from riskspark.plans.quantiles import column_quantiles


def split_label(df: DataFrame, label: str = "isFraud", drop: list[str] = ()) -> tuple[DataFrame, str]:
    """Drop columns, ignoring absent ones; the label stays in the row."""
    return df.drop(*drop), label


def rename_dashes(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace("-", "_") for c in df.columns])


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    numeric = kind == "numeric"
    want = T.NumericType if numeric else T.StringType
    return [f.name for f in df.schema.fields if isinstance(f.dataType, want)]


def columns_of_family(df: DataFrame, family: str) -> list[str]:
    """Columns named by one letter and digits, so ``DeviceType`` is no ``D`` column."""
    return [c for c in df.columns if re.fullmatch(rf"{family}\d+", c)]


def common_columns(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    both = [c for c in left.columns if c in set(right.columns)]
    return left.select(*both), right.select(*both)


def conform(df: DataFrame, schema: T.StructType, *, zero_fill: bool = True) -> DataFrame:
    """Give ``df`` exactly ``schema``: absent columns become 0 or "", bad cells 0, unknown columns go.

    Bad cells are set to 0 one by one; a cell that was NULL and casts cleanly stays NULL unless ``zero_fill``.
    """
    out = []
    for f in schema.fields:
        text = isinstance(f.dataType, T.StringType)
        empty = F.lit("") if text else F.lit(0).cast(f.dataType)
        if f.name not in df.columns:
            out.append(empty.alias(f.name))
        elif text:
            out.append(F.col(f.name).cast("string").alias(f.name))
        else:
            cell = F.col(f.name).try_cast(f.dataType)
            bad = cell.isNull() if zero_fill else cell.isNull() & F.col(f.name).isNotNull()
            out.append(F.when(bad, empty).otherwise(cell).alias(f.name))
    return df.select(*out)


def require(df: DataFrame, columns: list[str]) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"absent columns: {', '.join(absent)}")
    return df


def fill(df: DataFrame, values: dict[str, float], default: float | None = None) -> DataFrame:
    """Replace NULL by the fitted value of the column, else by ``default``."""
    def one(c):
        options: list[Column] = [F.col(c)]
        if values.get(c) is not None:
            options.append(F.lit(values[c]))
        elif default is not None:
            options.append(F.lit(default).cast(df.schema[c].dataType))
        return F.coalesce(*options).alias(c)

    touched = set(values) | ({f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)} if default is not None else set())
    return df.select(*[one(c) if c in touched else F.col(c) for c in df.columns])


def fit_medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    return {r["column"]: r["median"] for r in column_quantiles(df, columns, {"median": 0.5})}


def impute_median(df: DataFrame, columns: list[str], medians: dict | None = None, default: float = 0.0) -> DataFrame:
    """Median fill, then ``default`` where a column has no value at all."""
    medians = fit_medians(df, columns) if medians is None else medians
    return fill(df, {c: (default if medians.get(c) is None else medians[c]) for c in columns})


def replace_non_finite(df: DataFrame, columns: list[str], fill_value: float | None = None) -> DataFrame:
    return df.withColumns({c: finite(c, fill_value) for c in columns})


def fill_text(df: DataFrame, columns: list[str], word: str = "missing") -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(word)) for c in columns})


def clip_quantiles(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Clip each column to its own (low, high) quantile pair; None leaves that side open."""
    probs = sorted({p for pair in bounds.values() for p in pair if p is not None})
    rows = {r["column"]: r for r in column_quantiles(df, list(bounds), {str(p): p for p in probs})}
    side = lambda c, p: None if p is None else rows[c][str(p)]
    return df.withColumns({c: clip(c, side(c, lo), side(c, hi)) for c, (lo, hi) in bounds.items()})


def class_slice(df: DataFrame, column: str, klass: int, label: str = "isFraud") -> DataFrame:
    return df.where((F.col(label) == klass) & F.col(column).isNotNull()).select(column)


def nonneg_log1p(df: DataFrame, column: str, out: str) -> DataFrame:
    return df.where(F.col(column) >= 0).withColumn(out, F.log1p(column))


def filter_predictions(df: DataFrame, mode: str, label: str = "isFraud", prediction: str = "prediction") -> DataFrame:
    """all | fraud | safe | false-positives | false-negatives"""
    p, y = F.col(prediction), F.col(label)
    tests = {
        "fraud": p == 1,
        "safe": p == 0,
        "false-positives": (p == 1) & (y == 0),
        "false-negatives": (p == 0) & (y == 1),
    }
    if mode == "all":
        return df
    return df.where(tests[mode])


def search_risk(df: DataFrame, term: str, level: str = "risk_level", key: str = "txn_code") -> DataFrame:
    """A risk word selects that level; any other term is looked for in the id, whatever the case."""
    t = term.lower()
    for words, value in [(("fraud", "severe"), "severe"), (("suspicious",), "suspicious"), (("safe",), "safe")]:
        if any(w in t for w in words):
            return df.where(F.col(level) == value)
    return df.where(F.lower(key).contains(t))


def search_runs(df: DataFrame, term: str) -> DataFrame:
    t = term.lower()
    return df.where(F.lower("version").contains(t) | F.lower("model_type").contains(t))
