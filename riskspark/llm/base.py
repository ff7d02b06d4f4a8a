"""Helpers shared by the operators of this subpackage: row keys, stored tables, packed texts, digests."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.plans.scratch import scratch_path

ROW = "_row"
DOC = "_doc"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back; shuffle files of the finished job may then be dropped."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{tag}")
    df.write.parquet(path)
    spark._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete stored tables that no later step reads."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def keyed(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(_row, _doc, text): one line per row of ``docs`` with a unique long ``_row``; null texts become empty.

    Where ``key`` is unique and never null it serves as the row id itself. Otherwise numbered rows are stored first, so
    that repeated and null ids keep their own line and a lost executor cannot number them anew.
    """
    slim = docs.select(F.col(key).cast("long").alias(DOC), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if unique(slim.select(DOC)):
        return slim.select(F.col(DOC).alias(ROW), DOC, "text")
    return stored(slim.select(F.monotonically_increasing_id().alias(ROW), DOC, "text"), "rows")


def carried(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(_row, _doc, text, rest): as ``keyed``, with all columns of ``docs`` in the struct ``rest``, whatever their names."""
    slim = docs.select(F.col(key).cast("long").alias(DOC), F.coalesce(F.col(text), F.lit("")).alias("text"), F.struct("*").alias("rest"))
    if unique(slim.select(DOC)):
        return slim.select(F.col(DOC).alias(ROW), DOC, "text", "rest")
    return stored(slim.select(F.monotonically_increasing_id().alias(ROW), DOC, "text", "rest"), "rows")


def unique(ids: DataFrame) -> bool:
    """Whether the one column has neither null nor equal values."""
    name = ids.columns[0]
    clash = ids.groupBy(name).agg(F.count(F.lit(1)).alias("n")).where(F.col(name).isNull() | (F.col("n") > 1))
    return clash.limit(1).count() == 0


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The UTF-8 bytes of a text column without nulls."""
    i = batch.schema.get_field_index(column)
    col = batch.column(i)
    return col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()


def tidy(scan):
    """``scan`` as a task function that gives its memory back at the end: workers live on and would keep what they freed."""

    def run(batches):
        try:
            yield from scan(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return run


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


_PACKED = T.StructType([T.StructField(ROW, T.LongType()), T.StructField(DOC, T.LongType()), T.StructField("z", T.BinaryType())])


def packed(rows: DataFrame) -> DataFrame:
    """(_row, _doc, z), and ``rest`` where there is one: compressed texts, so that a join on the row id moves a third of the bytes."""
    also = ["rest"] if "rest" in rows.columns else []
    schema = T.StructType(_PACKED.fields + [rows.schema[c] for c in also])

    def pack(batches):
        import zstandard

        press = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [column(b, ROW), column(b, DOC), pa.array([press(t) for t in texts(b)], pa.binary()), *[column(b, c) for c in also]],
                [ROW, DOC, "z", *also],
            )

    return rows.select(ROW, DOC, "text", *also).mapInArrow(tidy(pack), schema)
