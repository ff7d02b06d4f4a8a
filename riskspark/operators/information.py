"""Mutual information of a column with a class by nearest neighbours, over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.plans.quantiles import indexed_long_form
from riskspark.plans.ranking import _part_offsets, ranged, running_totals
from riskspark.plans.scratch import persist_table


def digamma(n: Column) -> Column:
    """Of a whole number of at least 1: ten steps of the recurrence, then the asymptotic series."""
    x = n.cast("double") + 10
    series = F.log(x) - 1 / (2 * x) - 1 / (12 * x**2) + 1 / (120 * x**4) - 1 / (252 * x**6) + 1 / (240 * x**8) - 1 / (132 * x**10)
    return series - sum((1 / (n.cast("double") + i) for i in range(10)), F.lit(0.0))


def _with_borders(rows: DataFrame, k: int) -> DataFrame:
    """Rows of a ``ranged`` table, and copies of the ``k`` rows before and after each part under that part's number (``copy`` is 1)."""
    sizes = persist_table(rows.groupBy("_part").agg(F.count("*").alias("_t_n")), "parts")
    starts = _part_offsets(sizes, ["n"]).join(sizes, "_part").select("_part", F.col("_o_n").alias("_start"), (F.col("_o_n") + F.col("_t_n")).alias("_end"))
    numbered = rows.join(F.broadcast(starts), "_part").withColumn("_pos", F.col("_start") + F.col("_seq"))  # one row per part
    edge = numbered.where((F.col("_seq") < k) | (F.col("_pos") >= F.col("_end") - k)).drop("_start", "_end", "_part")
    at = F.col("_pos")
    before, after = (at < F.col("_start")) & (at >= F.col("_start") - k), (at >= F.col("_end")) & (at < F.col("_end") + k)
    copies = edge.join(F.broadcast(starts), before | after)  # 2 k rows of each part against one row per part
    names = [c for c in rows.columns if c not in ("_part", "_seq")]
    return numbered.select(*names, "_part", F.lit(0).alias("copy")).unionByName(copies.select(*names, "_part", F.lit(1).alias("copy")))


def neighbour_information(df: DataFrame, columns: list[str], label: str = "isFraud", k: int = 3, fill: float = -1.0) -> DataFrame:
    """(column, ordinal, mi) in nats between each column and the class, by the distances to the ``k``-th neighbour of the own class.

    With n rows, n_y of the own class and k_y = min(k, n_y - 1): digamma(n) + mean digamma(k_y) - mean digamma(n_y) - mean digamma(m),
    at least 0. m counts the rows, itself included, that are nearer than the k_y-th neighbour among the rows of the class; where
    that distance is 0, the rows of equal value. NULL, NaN and infinite cells are ``fill``, rows without a class and classes with
    a single row take no part, and no noise is added to ties. A column of an empty table has no line.

    Equal values of a class are one row with its count. One range partitioning by column, class and value, with the k rows on either
    side of a part copied to it, gives the distances; a second one by column and value turns the ends of the intervals into
    running counts, whose difference is m. No task holds a column or a class.
    """
    spark = df.sparkSession
    kept = [r for r in df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("y")).agg(F.count("*").alias("n")).collect() if r["n"] > 1]  # classes are few
    schema = "column string, ordinal bigint, mi double"
    if not kept:
        return spark.createDataFrame([], schema)
    total = sum(r["n"] for r in kept)
    classes = F.broadcast(spark.createDataFrame([(r["y"], min(k, r["n"] - 1)) for r in kept], f"_y {df.schema[label].dataType.simpleString()}, need int"))
    cells = [F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double")).otherwise(F.lit(float(fill))) for c in columns]
    long = indexed_long_form(df.select(F.col(label).alias("_y"), *[x.alias(f"_{i}") for i, x in enumerate(cells)]), [F.col(f"_{i}") for i in range(len(columns))], ["_y"])
    counts = long.join(classes, "_y").groupBy("ci", "_y", "need", F.col("v")).agg(F.count("*").alias("c"))
    rows = _with_borders(ranged(counts, ["ci", "_y", "v"], "neighbours"), k)
    order = Window.partitionBy("_part", "ci", "_y").orderBy("v")
    near = []
    for i in range(1, k + 1):
        for step in (F.lag, F.lead):
            x, n = step("v", i).over(order), step("c", i).over(order)
            near.append(F.when(x.isNotNull(), F.struct(F.abs(x - F.col("v")).alias("d"), x.alias("x"), n.alias("c"))))
    rows = rows.withColumn("near", F.array_sort(F.array_compact(F.array(*near)))).where("copy = 0")
    start = F.struct((F.col("need") - F.col("c") + 1).cast("bigint").alias("left"), F.lit(0.0).alias("d"), F.col("v").alias("x"))
    found = F.aggregate("near", start, lambda a, b: F.when(a["left"] <= 0, a).otherwise(F.struct((a["left"] - b["c"]).alias("left"), b["d"].alias("d"), b["x"].alias("x"))))
    rows = rows.select("ci", "_y", "v", "c", found.alias("f")).select("ci", "_y", "v", "c", F.col("f.d").alias("d"), F.col("f.x").alias("x"))
    rows = persist_table(rows, "radius")
    v, d, x = F.col("v"), F.col("d"), F.col("x")
    zero = d == 0
    low = F.when(x < v, x).otherwise(v - d)  # the neighbour itself ends its side exactly
    high = F.when(x > v, x).otherwise(v + d)
    # place: before (0) or behind (2) the rows (1) of equal value
    ends = [F.struct(low.alias("at"), F.when(zero, 0).otherwise(2).alias("place"), F.lit(0).cast("bigint").alias("w"), F.lit(-1).alias("sign")),
            F.struct(v.alias("at"), F.lit(1).alias("place"), F.col("c").alias("w"), F.lit(0).alias("sign")),
            F.struct(high.alias("at"), F.when(zero, 2).otherwise(0).alias("place"), F.lit(0).cast("bigint").alias("w"), F.lit(1).alias("sign"))]
    events = rows.select("ci", "_y", "v", "c", F.explode(F.array(*ends)).alias("e")).select("ci", "_y", "v", "c", "e.*")
    ranks = running_totals(events, ["ci", "at", "place"], {"before": F.col("w")}, "ranks").where("sign <> 0")
    m = ranks.groupBy("ci", "_y", "v", "c").agg(F.sum(F.col("before") * F.col("sign")).alias("m"))
    mean = m.groupBy("ci").agg((F.sum(F.col("c") * digamma(F.col("m"))) / F.lit(float(total))).alias("mean"))
    lines = spark.createDataFrame([(min(k, r["n"] - 1), r["n"]) for r in kept], "need int, n bigint")
    fixed = lines.agg(F.sum(F.col("n") * (digamma(F.col("need")) - digamma(F.col("n")))) / F.lit(float(total)) + F.max(digamma(F.lit(total)))).first()[0]
    names = F.array(*[F.lit(c) for c in columns])
    return mean.select(F.get(names, F.col("ci")).alias("column"), (F.col("ci") + 1).cast("bigint").alias("ordinal"), F.greatest(F.lit(0.0), F.lit(fixed) - F.col("mean")).alias("mi"))
