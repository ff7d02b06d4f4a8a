"""Exact, linearly interpolated quantiles that never hold an unbounded group in one task.

Inputs of at most ``SMALL_VALUES`` values (counted first), and groups in hash cells of at most ``CELL_VALUES`` rows, use Spark's exact
``percentile`` aggregate. Beyond that, values are counted per (group, value) with map-side combine and range-partitioned on (group, value), so a hot group spreads over
many partitions, and only the parts and groups that hold a wanted rank are looked at again.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.plans.ranking import ranged


SMALL_VALUES = 4_000_000
#: Groups are counted by hash cells first; those in a cell with more rows may be too large for one aggregate.
GROUP_CELLS, CELL_VALUES = 65_536, 200_000


def _select_ranks(counts: DataFrame, groups: list[str], wanted, tag: str) -> DataFrame:
    """Values at wanted ranks. ``counts``: groups, ``_v``, ``_c``. ``wanted``: total Column -> array of 0-based ranks.

    Returns groups, ``_n`` (rows in the group), ``_rank``, ``_v``.
    """
    rows = ranged(counts, [*groups, "_v"], tag)
    pieces = rows.groupBy("_part", *groups).agg(F.sum("_c").alias("_rows"))
    # One row per (part, group): at most one row per part for any group, however hot.
    of_group = Window.partitionBy(*groups)
    earlier = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "*",
        F.sum("_rows").over(of_group).alias("_n"),
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_base"),
    )
    pieces = pieces.withColumn(
        "_want",
        F.filter(wanted(F.col("_n")), lambda r: (r >= F.col("_base")) & (r < F.col("_base") + F.col("_rows"))),
    ).where(F.size("_want") > 0)
    keyed = [F.col(f"r.{g}").eqNullSafe(F.col(f"p.{g}")) for g in groups]
    on = F.col("r._part") == F.col("p._part")
    for k in keyed:
        on = on & k
    hit = (
        rows.alias("r")
        .join(pieces.alias("p"), on)
        .select("r._part", *[f"r.{g}" for g in groups], "r._v", "r._c", "p._n", "p._base", "p._want")
    )
    local = Window.partitionBy("_part", *groups).orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    hit = hit.withColumn("_at", F.col("_base") + F.coalesce(F.sum("_c").over(local), F.lit(0)))
    found = F.filter("_want", lambda r: (r >= F.col("_at")) & (r < F.col("_at") + F.col("_c")))
    return hit.select(*groups, "_n", F.explode(found).alias("_rank"), "_v")


def grouped_quantiles(df: DataFrame, groups: list[str], value: str, probs: dict[str, float], tag: str = "quant",
                      small_values: int = SMALL_VALUES, cell_values: int = CELL_VALUES) -> DataFrame:
    """One row per group: ``n`` non-null values and the quantiles named in ``probs``. NULL is a group of its own.

    Of a larger input, only the groups in full cells are ranked value by value; all others take one exchange.
    """
    present = df.where(F.col(value).isNotNull())
    return _quick(present, groups, value, probs, []) if present.count() <= small_values else _by_cells(present, groups, value, probs, tag, cell_values, [])


def counted_quantiles(df: DataFrame, groups: list[str], value: str, probs: dict[str, float], rows: str, tag: str = "quant",
                      small_values: int = SMALL_VALUES, cell_values: int = CELL_VALUES) -> DataFrame:
    """As :func:`grouped_quantiles` for every group, also those without a value, with the number of all its rows as ``rows``."""
    counted = [F.count("*").alias(rows)]
    return _quick(df, groups, value, probs, counted) if df.count() <= small_values else _by_cells(df, groups, value, probs, tag, cell_values, counted)


def _quick(df: DataFrame, groups: list[str], value: str, probs: dict[str, float], counted: list[Column]) -> DataFrame:
    at = F.percentile(F.col(value).cast("double"), F.array(*[F.lit(float(p)) for p in probs.values()]))
    quick = df.groupBy(*groups).agg(*counted, F.count(value).alias("n"), at.alias("_q"))
    return quick.select(*[c for c in quick.columns if c != "_q"], *[F.col("_q")[i].alias(name) for i, name in enumerate(probs)])


def _by_cells(df: DataFrame, groups: list[str], value: str, probs: dict[str, float], tag: str, cell_values: int, counted: list[Column]) -> DataFrame:
    celled = df.withColumn("_cell", F.pmod(F.xxhash64(*groups), F.lit(GROUP_CELLS)))
    full = [r["_cell"] for r in celled.groupBy("_cell").agg(F.count("*").alias("n")).where(F.col("n") > cell_values).collect()]  # at most GROUP_CELLS
    if not full:
        return _quick(df, groups, value, probs, counted)
    cells = F.broadcast(df.sparkSession.createDataFrame([(c,) for c in full], "_cell bigint"))
    quick = _quick(celled.join(cells, "_cell", "left_anti"), groups, value, probs, counted)
    large = celled.join(cells, "_cell", "left_semi").drop("_cell")
    ranked = _by_ranks(large.where(F.col(value).isNotNull()), groups, value, probs, tag)
    if counted:
        sizes = large.groupBy(*groups).agg(*counted)
        on = F.lit(True)
        for g in groups:
            on = on & F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
        ranked = sizes.alias("a").join(ranked.alias("b"), on, "left").select("a.*", F.coalesce("b.n", F.lit(0)).alias("n"), *[f"b.{name}" for name in probs])
    return quick.unionByName(ranked)


def _by_ranks(present: DataFrame, groups: list[str], value: str, probs: dict[str, float], tag: str) -> DataFrame:
    counts = (
        present.groupBy(*groups, F.col(value).cast("double").alias("_v"))
        .agg(F.count("*").alias("_c"))
    )

    def spot(n, p):
        return F.lit(float(p)) * (n - 1)

    def wanted(n):
        ranks = []
        for p in probs.values():
            ranks += [F.floor(spot(n, p)), F.ceil(spot(n, p))]
        return F.array_distinct(F.array(*[r.cast("bigint") for r in ranks]))

    picked = _select_ranks(counts, groups, wanted, tag)
    n = F.col("_n")
    outs = []
    for name, p in probs.items():
        at = lambda r: F.max(F.when(F.col("_rank") == r.cast("bigint"), F.col("_v")))
        low, high = at(F.floor(spot(n, p))), at(F.ceil(spot(n, p)))
        frac = F.max(spot(n, p) - F.floor(spot(n, p)))
        outs.append((low + (high - low) * frac).alias(name))
    return picked.groupBy(*groups).agg(F.max("_n").alias("n"), *outs)


def long_form(df: DataFrame, columns: list[str], keep: list[str] = (), name: str = "column", value: str = "value") -> DataFrame:
    """Unpivot numeric columns to (keep..., column, value) as doubles in one pass."""
    typed = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in columns])
    return typed.unpivot(list(keep), columns, name, value)


def indexed_long_form(df: DataFrame, columns: list[Column], keep: list[str] = ()) -> DataFrame:
    """(keep..., ``ci``, ``v``): non-null doubles with the position of their column. One small expression per output row, so
    generated code stays small however wide the table is."""
    names = [str(i) for i in range(len(columns))]
    typed = df.select(*keep, *[c.cast("double").alias(n) for n, c in zip(names, columns)])
    long = typed.unpivot(list(keep), names, "_name", "v").where(F.col("v").isNotNull())
    return long.select(*keep, F.col("_name").cast("int").alias("ci"), "v")


def per_column(values: list[float]) -> Column:
    """The entry of a driver list that belongs to the column ``ci``."""
    return F.get(F.array(*[F.lit(float(v)) for v in values]), F.col("ci"))


def column_quantiles(df: DataFrame, columns: list[str], probs: dict[str, float], cells: int = 20_000,
                     small_values: int = SMALL_VALUES) -> list[dict]:
    """Exact quantiles of whole columns, as driver rows ``{"column", "n", <name>...}``.

    Beyond ``small_values`` values an equal-width histogram of each column (one row per non-empty cell) shows which cells
    hold the wanted ranks; only the values of those cells are counted and ranked.
    """
    val = [F.col(c).cast("double") for c in columns]
    points = [float(p) for p in probs.values()]
    row = df.agg(*[F.count(v) for v in val], *[F.min(v) for v in val], *[F.max(v) for v in val]).first()
    k = len(columns)
    sizes, lows, highs = row[:k], row[k : 2 * k], row[2 * k :]
    if sum(sizes) <= small_values:
        found = df.agg(*[F.percentile(v, F.array(*[F.lit(p) for p in points])) for v in val]).first()
        return [{"column": c, "n": sizes[i], **dict(zip(probs, found[i] or [None] * len(points)))} for i, c in enumerate(columns)]
    ranks = {}  # column -> wanted 0-based ranks
    for i, n in enumerate(sizes):
        spots = [p * (n - 1) for p in points] if n else []
        ranks[i] = sorted({r for s in spots for r in (int(s), int(s) + (1 if s > int(s) else 0))})
    base = [low if n and math.isfinite(low) and math.isfinite(high) else 0.0 for n, low, high in zip(sizes, lows, highs)]
    scale = [cells / (high - low) if n and math.isfinite(high - low) and high > low else 0.0 for n, low, high in zip(sizes, lows, highs)]
    at = F.least(F.floor((F.col("v") - per_column(base)) * per_column(scale)), F.lit(cells - 1))
    long = indexed_long_form(df, val).withColumn("cell", at)
    histogram = long.groupBy("ci", "cell").agg(F.count("*").alias("n"))
    order = Window.partitionBy("ci").orderBy("cell")  # at most ``cells`` rows per column
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    asked = F.get(F.array(*[F.array(*[F.lit(r).cast("bigint") for r in ranks[i]]) for i in range(k)]), F.col("ci"))
    hits = histogram.withColumn("b", before).withColumn(
        "r", F.filter(asked, lambda r: (r >= F.col("b")) & (r < F.col("b") + F.col("n")))).where(F.size("r") > 0)
    places = hits.select("ci", "cell", "b", "r").collect()  # at most two cells per column and quantile
    chosen = F.broadcast(df.sparkSession.createDataFrame([(p["ci"], p["cell"]) for p in places], "ci int, cell bigint"))
    inside = long.join(chosen, ["ci", "cell"]).groupBy("ci", "cell", F.col("v").alias("_v")).agg(F.count("*").alias("_c"))
    local = {(p["ci"], p["cell"]): [r - p["b"] for r in p["r"]] for p in places}
    want = F.create_map(*[x for (ci, cell), rs in local.items() for x in (
        F.lit(f"{ci}:{cell}"), F.array(*[F.lit(r).cast("bigint") for r in rs]))])
    key = F.concat_ws(":", F.col("ci").cast("string"), F.col("cell").cast("string"))
    start = {(p["ci"], p["cell"]): p["b"] for p in places}
    value = {(r["ci"], r["_rank"] + start[(r["ci"], r["cell"])]): r["_v"]
             for r in _select_ranks(inside, ["ci", "cell"], lambda n: F.element_at(want, key), "colq").collect()}
    out = []
    for i, c in enumerate(columns):
        line = {"column": c, "n": sizes[i]}
        for name, p in zip(probs, points):
            spot = p * (sizes[i] - 1)
            if not sizes[i]:
                line[name] = None
                continue
            low, high = value[(i, int(spot))], value[(i, int(spot) + (1 if spot > int(spot) else 0))]
            line[name] = low + (high - low) * (spot - int(spot))
        out.append(line)
    return out
