"""Lookup join of a fact table with per-key statistics, safe when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.plans.scratch import persist_table

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20  # of the stored files
HOT_SHARE = 10_000  # a key is hot when it holds more than 1/HOT_SHARE of all rows
HOT_ROWS = 1_000_000  # or more rows than one task should hold


def lookup_join(
    fact: DataFrame,
    stats: DataFrame,
    keys: list[str],
    rows: str,
    spread_by: Column,
    *,
    broadcast_rows: int = BROADCAST_ROWS,
    hot_share: int = HOT_SHARE,
    hot_rows: int = HOT_ROWS,
    salts: int | None = None,
    stored: bool = False,
    sizes: tuple[int, int] | None = None,
    tag: str = "lookup",
) -> DataFrame:
    """Left join on ``keys`` (NULL matches NULL). ``rows`` names the per-key row count in ``stats``.

    Statistics of at most ``broadcast_rows`` rows and ``BROADCAST_BYTES`` bytes are broadcast after both are checked. Larger
    ones are shuffled; a key is hot beyond a share of all rows or beyond ``hot_rows``, and its rows are spread by a hash of
    ``spread_by`` over as many salts as it needs to stay below that, up to ``salts``. Only hot statistics are repeated.
    ``stored`` says that ``stats`` is a stored table already, ``sizes`` (keys, rows) that its size is known as well.
    """
    if salts is None:  # enough to spread one key over all reduce tasks
        salts = min(max(64, int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))), 1024)
    table = stats if stored or sizes is not None else persist_table(stats, tag)
    if sizes is None:
        sizes = tuple(table.agg(F.count("*"), F.coalesce(F.sum(rows), F.lit(0))).first())
    size, total = sizes
    renamed = {k: f"_k_{i}" for i, k in enumerate(keys)}
    side = table.withColumnsRenamed(renamed)
    on = None
    for k, r in renamed.items():
        part = F.col(k).eqNullSafe(F.col(r))
        on = part if on is None else on & part
    extra = [c for c in stats.columns if c not in keys]
    if size <= broadcast_rows and file_bytes(table) <= BROADCAST_BYTES:
        return fact.join(F.broadcast(side), on, "left").select(*fact.columns, *extra)
    limit = max(1.0, min(total / hot_share, float(hot_rows)))
    needed = F.least(F.lit(salts), F.ceil(F.col(rows) / F.lit(limit))).cast("int")
    hot_keys = side.where(F.col(rows) > limit).select(*renamed.values(), needed.alias("_salts"))
    salt = F.coalesce(F.pmod(F.xxhash64(spread_by), F.col("_salts")).cast("int"), F.lit(0))
    if salts <= 1:
        salt = F.lit(0)
    small = F.broadcast(hot_keys) if total / limit <= broadcast_rows else hot_keys
    salted_fact = fact.join(small, on, "left").withColumn("_salt", salt).select(*fact.columns, "_salt")
    copies = F.when(F.col(rows) > limit, F.sequence(F.lit(0), needed - 1)).otherwise(F.array(F.lit(0)))
    salted_side = side.withColumn("_side_salt", F.explode(copies))
    return (
        salted_fact.join(salted_side, on & (F.col("_salt") == F.col("_side_salt")), "left")
        .select(*fact.columns, *extra)
    )


def file_bytes(df: DataFrame) -> int:
    """Size of the files that a stored table reads, as the planner knows it."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def stored_sizes(stored: DataFrame, part: str, rows: str) -> dict[str, tuple[int, int]]:
    """(keys, rows) of each part of one stored table that holds several lookups, in one job."""
    g = stored.groupBy(part).agg(F.count("*").alias("keys"), F.sum(rows).alias("rows")).collect()
    return {r[0]: (r["keys"], r["rows"]) for r in g}
