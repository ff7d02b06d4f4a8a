"""Hourly tables and the windows over them. An hourly table has one row per hour with data, so its size is set by the
calendar and not by the rows; windows over it may use one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.scalars import cyclic, day_of_week, guarded_ratio, hour_of_day, round_half_even
from riskspark.plans.ranking import global_position


def hourly(df: DataFrame, time: str = "TransactionDT", label: str = "isFraud", seconds: int = 3600) -> DataFrame:
    """Tumbling windows: rows with a time, labels, rate and start. A NULL time falls into window 0 and is not counted.
    Windows without rows are not added."""
    window = F.floor(F.coalesce(F.col(time), F.lit(0)) / seconds).cast("bigint")
    g = df.groupBy(window.alias("hour_window")).agg(
        F.count(time).alias("total"), F.coalesce(F.sum(label), F.lit(0)).cast("bigint").alias("fraud_count"))
    return g.select("*", guarded_ratio("fraud_count", "total").alias("fraud_rate"),
                    (F.col("hour_window") * seconds).alias("window_start"))


def _in_order():
    return Window.orderBy("hour_window")


def lag_frame(series: DataFrame, lags: int = 6, value: str = "fraud_count", with_target: bool = True) -> DataFrame:
    """Lags 1..n and cyclic time columns; ``target`` is the next value. Rows that lack a lag or a target are dropped."""
    w = _in_order()
    out = series.withColumns({f"lag_{i}": F.lag(value, i).over(w) for i in range(1, lags + 1)})
    hs, hc = cyclic(hour_of_day("window_start"), 24.0)
    ds, dc = cyclic(day_of_week("window_start"), 7.0)
    out = out.withColumns({"hour_sin": hs, "hour_cos": hc, "day_sin": ds, "day_cos": dc})
    need = [f"lag_{i}" for i in range(1, lags + 1)]
    if with_target:
        out = out.withColumn("target", F.lead(value, 1).over(w))
        need.append("target")
    return out.dropna(subset=need)


def rolling_mean(series: DataFrame, rows: int = 6, value: str = "fraud_rate", out: str = "rolling_avg") -> DataFrame:
    return series.withColumn(out, F.avg(value).over(_in_order().rowsBetween(1 - rows, 0)))


def rate_baseline(series: DataFrame, value: str = "fraud_rate") -> tuple[float, float]:
    """Mean and sample deviation of the rate rounded to 4 digits."""
    x = round_half_even(value, 4)
    row = series.agg(F.avg(x), F.stddev_samp(x)).first()
    return row[0] or 0.0, row[1] or 0.0


def anomalies(series: DataFrame, baseline: tuple[float, float] | None = None, threshold: float = 2.5, value: str = "fraud_rate") -> DataFrame:
    """``z_score`` of the rounded rate and a one-sided ``is_anomaly`` flag."""
    mean, std = rate_baseline(series, value) if baseline is None else baseline
    x = round_half_even(value, 4)
    z = round_half_even((x - F.lit(mean)) / F.lit(std + 1e-9), 4)
    return series.withColumns({"rate4": x, "z_score": z, "is_anomaly": (z > threshold).cast("int")})


def every_nth(series: DataFrame, points: int = 500) -> DataFrame:
    """Keep every nth row by time so that about ``points`` remain."""
    n = series.count()
    step = max(1, n // points)
    return series.withColumn("_rn", F.row_number().over(_in_order()) - 1).where(F.col("_rn") % step == 0).drop("_rn")


def evenly_spaced(series: DataFrame, points: int = 100, order: list | tuple = ("hour_window",)) -> DataFrame:
    """Rows at ``points`` evenly spaced positions from first to last in ``order``, which must end in a unique column.

    Positions come from a range partitioning, so a curve may have as many points as the table has scores.
    """
    n = series.count()
    spots = sorted({i * (n - 1) // max(points - 1, 1) for i in range(points)}) if n else []
    return global_position(series, list(order), "_rn", "spaced").where(F.col("_rn").isin(spots)).drop("_rn")


def heat_map(df: DataFrame, time: str = "TransactionDT", label: str = "isFraud") -> DataFrame:
    """(dow, hod, rate) for the days present and all 24 hours; an hour without rows has rate 0."""
    base = df.select(day_of_week(time).alias("dow"), hour_of_day(time).alias("hod"), label)
    wide = base.groupBy("dow").pivot("hod", list(range(24))).agg(F.avg(label)).fillna(0.0)
    long = wide.unpivot(["dow"], [str(h) for h in range(24)], "hod", "rate")
    return long.select("dow", F.col("hod").cast("bigint").alias("hod"), "rate")
