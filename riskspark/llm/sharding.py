"""Sharding by extendible hashing, with JVM functions only.

Rows are placed by the leading bits of a hash. The directory starts with one bucket; only a bucket over the byte limit is
split on one more bit, until every shard fits. Bytes are added up per bucket before they move, several bits to a pass, and
only rows of buckets still too large take part in the next pass. Rows that share all their bits (equal rows) cannot be told
apart by bits; their bucket is cut by running size into overflow shards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.base import forget, stored

BITS = 60


def bits(*parts: Column) -> Column:
    """The first 60 bits of the md5 of the parts as text."""
    return F.conv(F.substring(F.md5(F.concat_ws("\t", *[F.coalesce(p.cast("string"), F.lit("\\N")) for p in parts])), 1, 15), 16, 10).cast("long")


def directory(sized: DataFrame, limit: int, step: int = 8) -> tuple[DataFrame, DataFrame]:
    """Leaves (prefix, depth, bytes, rows) and overfull full-depth hashes (h, bytes, rows), from ``sized`` (h, size).

    A pass adds up ``step`` more bits, gives each split its total by rolling the sums up, and goes on with the buckets that
    are too large at the last bit of the pass.
    """
    leaves, open_, depth = [], None, 0
    while depth < BITS:
        last = min(BITS, depth + step)
        rows = sized if open_ is None else sized.join(open_, F.shiftright("h", BITS - depth) == F.col("prefix"), "left_semi")
        cells = stored(
            rows.groupBy(F.shiftright("h", BITS - last).alias("cell")).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")), "cells"
        )
        depths = F.explode(F.sequence(F.lit(depth + (0 if open_ is None else 1)), F.lit(last))).alias("depth")
        rolled = cells.select("*", depths).select("depth", F.expr(f"shiftright(cell, {last} - depth)").alias("prefix"), "bytes", "rows")
        sums = stored(rolled.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows")), "sums")
        full = sums.where(F.col("bytes") > limit)
        up = full.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("_up"))
        first = depth + (0 if open_ is None else 1)
        fits = sums.where(F.col("bytes") <= limit).withColumn("_up", F.shiftright("prefix", 1))
        leaves.append(fits.where(F.col("depth") == first).drop("_up").unionByName(fits.where(F.col("depth") > first).join(up, ["depth", "_up"], "left_semi").drop("_up")))
        forget(cells)
        if open_ is not None:
            forget(open_)
        depth = last
        open_ = stored(full.where(F.col("depth") == last).select("prefix"), "open")
        if open_.limit(1).count() == 0:
            break
    overfull = sums.where((F.col("depth") == BITS) & (F.col("bytes") > limit)).select(F.col("prefix").alias("h"), "bytes", "rows")
    return reduce(DataFrame.unionByName, leaves).select("prefix", F.col("depth").cast("int").alias("depth"), "bytes", "rows"), overfull


def assign(df: DataFrame, limit: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``df``'s key with (n_bytes, shard, depth, shard_bytes, shard_rows): the shard of every row.

    ``shard`` is the bit string of the leaf, empty for the one shard of a table that fits as a whole; overflow shards append
    ``+k``. ``depth`` is its number of bits. No shard holds more than ``limit`` bytes, but for a single row that alone is
    larger. A row counts with the bytes of its text, null and empty texts with 0.

    Null keys and repeated rows are placed by key and text like all others; equal rows share a hash, and if together they
    pass the limit they go to overflow shards in running order, never to one task as a group of rows. An empty table gives
    an empty table; other columns are not looked at.
    """
    both = _placed(_sized(df, F.col(key), text, key), limit)
    return both.select(F.col("k").alias(key), F.col("size").alias("n_bytes"), "shard", "depth", "shard_bytes", "shard_rows")


def _sized(df: DataFrame, k: Column, text: str, key: str) -> DataFrame:
    """(k, size, h) of every row; ``k`` stays with the row."""
    return df.select(k.alias("k"), F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long").alias("size"), bits(F.col(key), F.col(text)).alias("h"))


def _placed(slim: DataFrame, limit: int) -> DataFrame:
    """(k, size, shard, depth, shard_bytes, shard_rows) of (k, size, h)."""
    sized = stored(slim, "sized")
    leaves, overfull = directory(sized.select("h", "size"), limit)
    leaves, overfull = stored(leaves, "leaves"), stored(overfull, "overfull")
    # a row belongs to the leaf whose prefix it has: one equality per depth that occurs, found through the deepest prefix
    depths = sorted(r["depth"] for r in leaves.select("depth").distinct().collect())
    at = F.explode(F.array(*[F.lit(d) for d in depths])) if depths else F.lit(None).cast("int")
    probes = sized.withColumn("depth", at).withColumn("prefix", F.expr(f"shiftright(h, {BITS} - depth)"))
    name = F.when(F.col("depth") == 0, F.lit("")).otherwise(F.expr("substring(lpad(bin(prefix), 60, '0'), 61 - depth, depth)"))
    placed = probes.join(leaves, ["depth", "prefix"]).select(
        "k", "size", name.alias("shard"), "depth", F.col("bytes").alias("shard_bytes"), F.col("rows").alias("shard_rows")
    )
    rest = _overflow(sized, overfull, limit)
    return placed.unionByName(rest)


def _overflow(sized: DataFrame, overfull: DataFrame, limit: int) -> DataFrame:
    """Rows of overfull hashes, dealt into shards of at most ``limit`` bytes; equal hashes mean rows of one size.

    Rows are numbered inside the part of a hash that a stored partition holds, and the parts get their first numbers from a
    table with one line per part, so that a hash with very many rows is numbered by many tasks.
    """
    rows = sized.join(overfull.select("h"), "h", "left_semi").withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(4096)))
    rows = stored(rows, "overflow")
    parts = rows.groupBy("h", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("h").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = parts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).select("h", "part", "first")
    inside = F.row_number().over(Window.partitionBy("h", "part").orderBy("k")) - 1
    per = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("size", F.lit(1))))
    cut = rows.withColumn("i", inside).join(first, ["h", "part"]).withColumn("shard_no", F.floor((F.col("first") + F.col("i")) / per))
    total = cut.groupBy("h", "shard_no").agg(F.sum("size").alias("shard_bytes"), F.count(F.lit(1)).alias("shard_rows"))
    name = F.concat(F.expr(f"lpad(bin(h), {BITS}, '0')"), F.lit("+"), F.col("shard_no").cast("string"))
    return cut.join(total, ["h", "shard_no"]).select("k", "size", name.alias("shard"), F.lit(BITS).alias("depth"), "shard_bytes", "shard_rows")


def write_shards(df: DataFrame, path: str, limit: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Write every row of ``df`` once, as one parquet folder per shard, and return the shards (shard, rows).

    Rows are numbered and stored before they are placed, so that null and repeated keys each keep their own line.
    """
    numbered = stored(df.select(F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("_rest")), "numbered")
    slim = numbered.select("_row", F.col("_rest")[text].alias("_text"), F.col("_rest")[key].alias("_key"))
    placed = _placed(_sized(slim, F.col("_row"), "_text", "_key"), limit).select(F.col("k").alias("_row"), F.col("shard").alias("_shard"))
    out = numbered.join(placed, "_row").select("_rest.*", "_shard")
    out.repartition("_shard").write.partitionBy("_shard").parquet(path)
    # names are bit strings, not numbers; the one shard without bits is stored as null
    written = df.sparkSession.read.schema(out.schema).parquet(path)
    return written.groupBy(F.coalesce("_shard", F.lit("")).alias("shard")).agg(F.count(F.lit(1)).alias("rows"))
