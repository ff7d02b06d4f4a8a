"""Streams give what the batch operators give."""

from pyspark.sql import functions as F

from riskspark.operators.behavior import velocity
from riskspark.sources.views import txn
from riskspark.streaming import streams


def write_parts(df, path, cuts):
    """One file per time slice, oldest first, so that a stream of one file per batch sees them in order."""
    edges = [None, *cuts, None]
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        part = df
        if lo is not None:
            part = part.where(F.col("t") >= lo)
        if hi is not None:
            part = part.where(F.col("t") < hi)
        part.coalesce(1).write.mode("append").parquet(path)


def test_velocity_stream_over_batches(spark, sf_dir, tmp_path):
    df = txn(spark, sf_dir).select(F.col("TransactionID").alias("id"), F.col("TransactionDT").alias("t"), "card1", "ProductCD")
    path = str(tmp_path / "in")
    write_parts(df, path, [86400 * 8, 86400 * 9, 86400 * 20])
    source = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    sink = streams.VelocityStream(spark, ["card1", "ProductCD"], "t", "id")
    got = streams.run_available(source, tag="velocity-test", sink=sink)
    want = velocity(df, ["card1", "ProductCD"], "t", "id")
    cols = want.columns
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.collect()))
    assert got.select("batch").distinct().count() == 4 and sink.late_rows() == 0


def test_late_rows_are_set_aside(spark, tmp_path):
    path = str(tmp_path / "late")
    schema = "id bigint, t bigint, card string"
    spark.createDataFrame([(1, 10_000, "a"), (2, 20_000, "a")], schema).coalesce(1).write.parquet(path)
    spark.createDataFrame([(3, 100, "a"), (4, 20_500, "a")], schema).coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    sink = streams.VelocityStream(spark, ["card"], "t", "id", [1000], lateness=3600)
    got = {r["id"]: r["cnt_1000s"] for r in streams.run_available(source, tag="late-test", sink=sink).collect()}
    assert got == {1: 0, 2: 0, 4: 1} and sink.late_rows() == 1


def test_open_windows_come_out_at_the_end(spark, tmp_path):
    path = str(tmp_path / "hours")
    schema = "ts timestamp, isFraud int"
    rows = spark.range(50).select((F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 900)).alias("ts"), (F.col("id") % 2).cast("int").alias("isFraud"))
    rows.where("minute(ts) < 30").coalesce(1).write.parquet(path)
    rows.where("minute(ts) >= 30").coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = streams.run_latest(streams.hourly_stream(source, late="30 days"), ["window_start"], "open-test").collect()
    assert sum(r["total"] for r in got) == 50 and len({r["window_start"] for r in got}) == len(got)


def test_empty_stream_gives_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.createDataFrame([], "ts timestamp, isFraud int").write.parquet(path)
    source = spark.readStream.schema("ts timestamp, isFraud int").parquet(path)
    assert streams.run_latest(streams.hourly_stream(source), ["window_start"], "none-test").count() == 0
    assert streams.run_available(source, tag="none-test").count() == 0


def test_wild_times_do_not_move_the_clock(spark, tmp_path):
    path = str(tmp_path / "wild")
    schema = "id bigint, t bigint, card string"
    for part in ([(1, 10_000, "a")], [(2, 10_500, "a"), (3, 9_000_000, "a")], [(4, 10_700, "a")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    sink = streams.VelocityStream(spark, ["card"], "t", "id", [1000], lateness=3600, ahead=86_400)
    got = {r["id"]: r["cnt_1000s"] for r in streams.run_available(source, tag="wild-test", sink=sink).collect()}
    assert got == {1: 0, 2: 1, 4: 2} and (sink.late_rows(), sink.wild_rows()) == (0, 1)


def test_old_hours_are_dropped(spark, tmp_path):
    path = str(tmp_path / "old")
    schema = "id bigint, t bigint, card string"
    for i in range(4):
        spark.createDataFrame([(i, i * 100_000, "a")], schema).coalesce(1).write.mode("append").parquet(path)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    sink = streams.VelocityStream(spark, ["card"], "t", "id", [1000], lateness=3600, base=str(tmp_path / "state"))
    assert streams.run_available(source, tag="old-test", sink=sink).count() == 4
    hours = {p.name for p in (tmp_path / "state" / "rows").iterdir() if p.name.startswith("hour=")}
    assert hours == {"hour=55", "hour=83"}
