"""Structured Streaming forms of the hourly rate, velocity, scoring, KPI and anomaly operators."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.scalars import guarded_ratio, risk_band, round_half_even
from riskspark.operators.behavior import VELOCITY_WINDOWS, velocity
from riskspark.plans.scratch import scratch_path


def run_available(stream: DataFrame, mode: str = "append", tag: str = "stream", sink=None, schema=None) -> DataFrame:
    """Process all data that is there, then stop; returns what was written as a table (empty if nothing was)."""
    spark = stream.sparkSession
    base = scratch_path(spark, tag)
    out = f"{base}/out"
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/progress").trigger(availableNow=True)
    if sink is None:
        query = writer.format("parquet").option("path", out).start()
    else:
        query = writer.foreachBatch(lambda df, batch: sink(df, batch, out)).start()
    query.awaitTermination()
    try:
        return spark.read.parquet(out)
    except AnalysisException:
        return spark.createDataFrame([], schema or stream.schema)


def run_latest(stream: DataFrame, keys: list[str], tag: str = "stream", by: list[str] | None = None) -> DataFrame:
    """As ``run_available``, with the last state of every key: windows that are still open at the end come out too.

    Each batch writes the rows that it changed; a batch that is run again replaces its own. ``by`` names the keys by which
    the result is grouped again, so that its rows move once.
    """
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])

    def write(df: DataFrame, batch: int, out: str) -> None:
        df.write.mode("overwrite").parquet(_batch_path(out, batch))

    changed = run_available(stream, "update", tag, write, schema)
    rest = [c for c in stream.columns if c not in keys]
    last = (changed.repartition(*by) if by else changed).groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_last"))
    return last.select(*keys, "_last.*").select(*stream.columns)


def _batch_path(out: str, batch: int) -> str:
    return f"{out}/batch={batch}"


def hourly_stream(events: DataFrame, time: str = "ts", label: str = "isFraud", late: str = "1 hour", seconds: int = 3600) -> DataFrame:
    """Tumbling windows; rows that come after the watermark has passed the end of their window are dropped.

    In append mode a window is given out once it has closed, in update mode whenever it has changed.
    """
    w = events.withWatermark(time, late).groupBy(F.window(time, f"{seconds} seconds").alias("w")).agg(
        F.count("*").alias("total"), F.sum(label).cast("bigint").alias("fraud_count"))
    return w.select(F.col("w.start").alias("window_start"), "total", "fraud_count", guarded_ratio("fraud_count", "total").alias("fraud_rate"))


def anomaly_stream(windows: DataFrame, baseline: tuple[float, float], threshold: float = 2.5) -> DataFrame:
    """Flag windows against a mean and deviation frozen beforehand."""
    mean, std = baseline
    rate = round_half_even("fraud_rate", 4)
    z = round_half_even((rate - F.lit(mean)) / F.lit(std + 1e-9), 4)
    return windows.withColumns({"z_score": z, "is_anomaly": (z > threshold).cast("int")})


def kpi_stream(scored: DataFrame, p: str = "p") -> DataFrame:
    """Running counts and mean probability per risk band (complete mode)."""
    return scored.groupBy(risk_band(p).alias("risk_level")).agg(F.count("*").alias("n"), F.avg(p).alias("avg_p"))


def overwrite_sink(df: DataFrame, batch: int, out: str) -> None:
    """Keep only the latest complete result."""
    df.write.mode("overwrite").parquet(out)


def scoring_sink(model, keep: list[str], score):
    """Sink that scores each batch; a batch that is run again overwrites its own folder."""

    def write(df: DataFrame, batch: int, out: str) -> None:
        scored = score(model, df)
        scored.select(*keep).write.mode("overwrite").parquet(_batch_path(out, batch))

    return write


class VelocityStream:
    """Velocity counts per micro-batch with the recent rows kept as a table in the shared folder.

    Kept rows are partitioned by hour and batch: a batch reads the hours of the last ``max(windows)`` seconds only, and a
    batch that is run again replaces what it wrote. Hours that no later batch can need (older than the longest window and
    the lateness before the newest row of the batch before) are deleted. Counting uses the batch operator, which splits hot
    values. Rows older than the newest earlier row by more than ``lateness`` seconds are not counted but written to the
    ``late`` table. A row that comes later, but within the lateness, is counted by itself and by rows of its own and later
    batches; counts that were written before it came stay as they are. With ``ahead``, rows more than so many seconds after
    the newest earlier row go to the ``wild`` table and do not move the clock. Times are whole seconds.
    """

    def __init__(self, spark: SparkSession, entities: list[str], time: str, id_col: str, windows: list[int] = VELOCITY_WINDOWS,
                 lateness: int = 3600, base: str | None = None, ahead: int | None = None, **velocity_options):
        self.spark, self.entities, self.time, self.id_col = spark, entities, time, id_col
        self.windows, self.lateness, self.options = windows, lateness, velocity_options
        base = base or scratch_path(spark, "velocity-state")
        self.state, self.late, self.newest, self.wild, self.ahead = f"{base}/rows", f"{base}/late", f"{base}/newest", f"{base}/wild", ahead

    def _read(self, path: str, schema: T.StructType | str, root: str | None = None) -> DataFrame | None:
        reader = self.spark.read.schema(schema)
        if root:
            reader = reader.option("basePath", root)
        try:
            return reader.parquet(path)
        except AnalysisException:
            return None

    def _history(self, rows: DataFrame, batch: int, first: int, last: int) -> DataFrame | None:
        """Kept rows of earlier batches in the hours ``first`` to ``last``."""
        schema = T.StructType([*rows.schema.fields, T.StructField("hour", T.LongType()), T.StructField("batch", T.LongType())])
        kept = self._read(self.state, schema)
        return None if kept is None else kept.where(F.col("hour").between(first, last) & (F.col("batch") < batch)).select(*rows.columns)

    def _forget(self, before: int) -> None:
        """Delete the kept rows of hours below ``before``."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.state)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if files.exists(root):
            for entry in files.listStatus(root):
                name = entry.getPath().getName()
                if name.startswith("hour=") and int(name[5:]) < before:
                    files.delete(entry.getPath(), True)

    def __call__(self, df: DataFrame, batch: int, out: str) -> None:
        t = F.col(self.time)
        rows = df.select(self.id_col, t.cast("bigint").alias(self.time), *self.entities)
        before = self._read(_batch_path(self.newest, batch - 1), "newest bigint") if batch else None
        newest = before.first()["newest"] if before is not None else None
        fresh = rows
        if newest is not None:
            limit = F.lit(newest - self.lateness)
            rows.where(t < limit).write.mode("overwrite").parquet(_batch_path(self.late, batch))
            fresh = rows.where(t >= limit)
            if self.ahead is not None:
                top = F.lit(newest + self.ahead)
                fresh.where(t > top).write.mode("overwrite").parquet(_batch_path(self.wild, batch))
                fresh = fresh.where(t <= top)
            self._forget((newest - self.lateness - max(self.windows)) // 3600)
        low, high = fresh.agg(F.min(t), F.max(t)).first()
        top = max((x for x in (newest, high) if x is not None), default=None)
        self.spark.createDataFrame([(top,)], "newest bigint").write.mode("overwrite").parquet(_batch_path(self.newest, batch))
        if low is None:
            return
        kept = fresh.withColumns({"hour": F.floor(t / 3600).cast("bigint"), "batch": F.lit(batch).cast("bigint")})
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("hour", "batch").parquet(self.state)
        start = low - max(self.windows)
        past = self._history(rows, batch, start // 3600, high // 3600) if batch else None
        seen = fresh if past is None else past.where(t >= start).unionByName(fresh)
        counts = velocity(seen, self.entities, self.time, self.id_col, self.windows, **self.options)
        mine = fresh.select(F.col(self.id_col).alias("id"))
        counts.join(mine, "id", "left_semi").write.mode("overwrite").parquet(_batch_path(out, batch))

    def _rows(self, path: str) -> int:
        rows = self._read(path, "batch bigint")
        return rows.count() if rows is not None else 0

    def late_rows(self) -> int:
        return self._rows(self.late)

    def wild_rows(self) -> int:
        return self._rows(self.wild)
