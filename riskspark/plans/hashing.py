"""Seeded pseudo-random order that is the same on every run and every engine, and exact picks by it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Strata of a cut: each is one line on the driver and one term of a filter.
MOST_STRATA = 1000


def hash_order(key: Column, seed: int = 0) -> Column:
    """Hex digest of seed and key: uniform, so its prefix cuts any set of distinct keys into even buckets."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_unit(key: Column, seed: int = 0) -> Column:
    """A number in [0, 1) made from the first 12 hex digits of the digest."""
    return F.conv(F.substring(hash_order(key, seed), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def _null_safe_join(left: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join with a small table on keys in which NULL equals NULL: NULL is a stratum like any other."""
    side = small.withColumnsRenamed({c: f"_s_{i}" for i, c in enumerate(keys)})
    on = F.lit(True)
    for i, c in enumerate(keys):
        on = on & F.col(c).eqNullSafe(F.col(f"_s_{i}"))
    return left.join(F.broadcast(side), on).drop(*[f"_s_{i}" for i in range(len(keys))])


def hash_rank(df: DataFrame, key: str, strata: list[str] = (), seed: int = 0, digits: int = 4, out: str = "hash_rank") -> DataFrame:
    """Add the 0-based rank of each row in hash order inside its stratum.

    Rows are bucketed by the first ``digits`` hex digits of the digest. Buckets are even whatever the strata are, bucket
    sizes form a small table (16**digits rows per stratum), and only one bucket at a time is sorted by a task. ``key``
    must be unique. Strata must be few (classes), never entity keys.
    """
    strata = list(strata)
    hashed = df.withColumn("_h", hash_order(F.col(key), seed)).withColumn("_b", F.substring("_h", 1, digits))
    sizes = hashed.groupBy(*strata, "_b").agg(F.count("*").alias("_c"))
    before = Window.partitionBy(*strata).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*strata, "_b", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy(*strata, "_b").orderBy("_h", key)
    ranked = hashed.withColumn("_rn", F.row_number().over(inside) - 1)
    return _null_safe_join(ranked, offsets, [*strata, "_b"]).select(*df.columns, (F.col("_off") + F.col("_rn")).alias(out))


def hash_cut(df: DataFrame, key: str, quota, strata: list[str] = (), seed: int = 0, digits: int = 4) -> Column:
    """Condition that holds for exactly the first ``quota`` rows of each stratum in hash order.

    ``quota`` maps the stratum size Column to a count. Only key and strata are read: bucket sizes show where the cut lies,
    and only the bucket at the cut is ranked. One cut per stratum comes to the driver; the rows themselves never move.
    """
    strata = list(strata)
    hashed = df.select(*strata, key).withColumn("_h", hash_order(F.col(key), seed)).withColumn("_b", F.substring("_h", 1, digits))
    sizes = hashed.groupBy(*strata, "_b").agg(F.count("*").alias("_c"))
    whole = Window.partitionBy(*strata)
    before = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("_c").over(whole)
    border = sizes.select(
        *strata, "_b", "_c",
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"),
        F.least(quota(total).cast("bigint"), total).alias("_quota"),
    ).where((F.col("_off") < F.col("_quota")) & (F.col("_quota") <= F.col("_off") + F.col("_c")))
    near = _null_safe_join(hashed, border.drop("_c"), [*strata, "_b"])
    order = Window.partitionBy(*strata, "_b").orderBy("_h", key)
    last = near.withColumn("_rn", F.row_number().over(order)).where(F.col("_off") + F.col("_rn") == F.col("_quota"))
    keep = F.lit(False)
    h = hash_order(F.col(key), seed)
    cuts = last.select(*strata, "_h", key).limit(MOST_STRATA + 1).collect()
    if len(cuts) > MOST_STRATA:
        raise ValueError(f"more than {MOST_STRATA} strata; strata are classes, not entity keys")
    for cut in cuts:
        mine = (h < cut["_h"]) | ((h == cut["_h"]) & (F.col(key) <= F.lit(cut[key])))
        for c in strata:
            mine = mine & F.col(c).eqNullSafe(F.lit(cut[c]))
        keep = keep | mine
    return keep


def hash_take(df: DataFrame, key: str, quota, strata: list[str] = (), seed: int = 0, digits: int = 4) -> DataFrame:
    """Exactly ``quota`` rows per stratum (all when there are fewer): the first in hash order, as a plain filter."""
    return df.where(hash_cut(df, key, quota, strata, seed, digits))
