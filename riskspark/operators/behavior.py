"""Behavioural features: fitted levels, frequencies, user statistics, group blocks, entity degrees, velocity, momentum.

Fitted state is always a small dict or a lookup table frozen at fit time; applying it is a projection or a lookup join
that stays even when one card or device holds a large share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.scalars import clean_text, composite_key, user_key
from riskspark.plans.quantiles import column_quantiles, counted_quantiles, grouped_quantiles
from riskspark.plans.ranking import global_position, running_totals
from riskspark.plans.scratch import persist_table
from riskspark.plans.skew import BROADCAST_ROWS, HOT_SHARE, lookup_join, stored_sizes

# Key sets whose row count and median amount become features.
GROUP_KEYS = [
    ["card1"],
    ["card1", "addr1"],
    ["card1", "card2"],
    ["card1", "card3"],
    ["card1", "card5"],
    ["card1", "card6"],
    ["card1", "P_emaildomain"],
    ["card1", "R_emaildomain"],
    ["card1", "DeviceType"],
    ["card1", "DeviceInfo"],
    ["card1", "id_30"],
    ["card1", "id_31"],
    ["card1", "addr1", "P_emaildomain"],
]
# Entity pairs whose distinct counts become features; each pair is counted both ways.
ENTITY_PAIRS = [("card1", "P_emaildomain"), ("card1", "DeviceInfo"), ("card1", "addr1")]
VELOCITY_ENTITIES = ["card1", "DeviceInfo", "addr1", "P_emaildomain"]
VELOCITY_WINDOWS = [3600, 6 * 3600, 24 * 3600]


# ---- fitted scalars -------------------------------------------------------------------------------------------------

def fit_amount(df: DataFrame, amount: str = "TransactionAmt") -> dict[str, float]:
    """Mean, population deviation (1 when 0), median and the 99.5 % point of the amount."""
    m = df.agg(F.avg(amount).alias("m"), F.stddev_pop(amount).alias("s")).first()
    q = column_quantiles(df, [amount], {"median": 0.5, "clip_high": 0.995})[0]
    return {"mean": m["m"] or 0.0, "std": m["s"] or 1.0, "median": q["median"] or 0.0, "clip_high": q["clip_high"] or 0.0}


def null_fractions(df: DataFrame, columns: list[str] | None = None) -> dict[str, float]:
    columns = columns or df.columns
    row = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(f"f{i}") for i, c in enumerate(columns)]).first()
    return {c: row[i] or 0.0 for i, c in enumerate(columns)}


def fit_null_columns(df: DataFrame, threshold: float, inclusive: bool = False) -> list[str]:
    """Columns whose null share exceeds the threshold, decided once at fit time."""
    return [c for c, f in null_fractions(df).items() if f > threshold or (inclusive and f == threshold)]


def level_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, level, n) of cleaned text for all columns in one pass."""
    texts = df.select(*[clean_text(c).alias(c) for c in columns])
    return texts.unpivot([], columns, "column", "level").groupBy("column", "level").agg(F.count("*").alias("n"))


def level_summary(df: DataFrame, columns: list[str], max_levels: int = 12) -> DataFrame:
    """Mode (ties: smallest), number of levels, and the sorted levels when there are at most ``max_levels``."""
    counts = level_counts(df, columns)
    sizes = counts.groupBy("column").agg(
        F.count("*").alias("n_levels"),
        F.max("n").alias("_best"),
    )
    few = sizes.where(F.col("n_levels") <= max_levels).select("column")
    listed = counts.join(F.broadcast(few), "column").groupBy("column").agg(F.array_sort(F.collect_list("level")).alias("levels"))
    modes = (
        counts.join(F.broadcast(sizes.select("column", "_best")), "column")
        .where(F.col("n") == F.col("_best"))
        .groupBy("column")
        .agg(F.min("level").alias("mode"))
    )
    return sizes.join(modes, "column").join(listed, "column", "left").select("column", "mode", "n_levels", "levels")


def fit_levels(df: DataFrame, columns: list[str], max_levels: int = 12) -> dict[str, list[str]]:
    """Sorted levels of the columns with at most ``max_levels`` of them."""
    return {r["column"]: r["levels"] for r in level_summary(df, columns, max_levels).collect() if r["levels"] is not None}


# ---- lookup tables --------------------------------------------------------------------------------------------------

def fit_codes(df: DataFrame, column: str, order_key: str) -> DataFrame:
    """(level, code, n): codes in order of first appearance by ``order_key``; NULL is the level ``missing``. A stored table."""
    levels = df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("missing")).alias("level")).agg(
        F.min(order_key).alias("_first"), F.count("*").alias("n")
    )
    return persist_table(global_position(levels, ["_first", "level"], "code", "codes").select("level", "code", "n"), "codes")


def apply_codes(df: DataFrame, codes: DataFrame, column: str, out: str, id_col: str) -> DataFrame:
    keyed = df.withColumn("level", F.coalesce(F.col(column).cast("string"), F.lit("missing")))
    found = lookup_join(keyed, codes.withColumnRenamed("n", "_n"), ["level"], "_n", F.col(id_col), stored=True)
    return found.withColumn(out, F.coalesce("code", F.lit(-1)).cast("bigint")).select(*df.columns, out)


def fit_frequencies(df: DataFrame, column: str) -> DataFrame:
    """(column, count, share) with NULL as a level of its own. A stored table."""
    n = df.count()
    levels = df.groupBy(column).agg(
        F.count("*").alias(f"{column}_count"), (F.count("*") / F.lit(float(max(n, 1)))).alias(f"{column}_freq")
    )
    return persist_table(levels, "frequencies")


def apply_frequencies(df: DataFrame, freq: DataFrame, column: str, id_col: str) -> DataFrame:
    """Share and count of the level at fit time, 0 for a level not seen then."""
    out = lookup_join(df, freq, [column], f"{column}_count", F.col(id_col), stored=True)
    return out.fillna(0, [f"{column}_count"]).fillna(0.0, [f"{column}_freq"])


def fit_users(df: DataFrame, amount: str = "TransactionAmt", card: str = "card1", addr: str = "addr1") -> tuple[DataFrame, float]:
    """Per ``card_addr`` user (a stored table): rows, mean and exact median of the amount; and the median over all rows."""
    keyed = df.select(user_key(card, addr).alias("uid"), F.col(amount).alias("_a"))
    medians = grouped_quantiles(keyed, ["uid"], "_a", {"user_median": 0.5}).drop("n")
    base = keyed.groupBy("uid").agg(F.count("*").alias("user_count"), F.avg("_a").alias("user_mean"))
    overall = column_quantiles(df, [amount], {"median": 0.5})[0]["median"]
    return persist_table(base.join(medians, "uid", "left"), "users"), overall


def apply_users(df: DataFrame, users: tuple[DataFrame, float], id_col: str, amount: str = "TransactionAmt",
                card: str = "card1", addr: str = "addr1", unseen_count: int = 1) -> DataFrame:
    """``user_count`` (unseen: 1) and amount over the user's median; a zero median counts as 0.01, an unseen user as the
    overall median frozen at fit time."""
    stats, overall = users
    keyed = df.withColumn("uid", user_key(card, addr))
    found = lookup_join(keyed, stats, ["uid"], "user_count", F.col(id_col), stored=True)
    median = F.coalesce("user_median", F.lit(overall))
    mean = F.coalesce("user_mean", F.lit(overall))
    floor0 = lambda c: F.when(c == 0, F.lit(0.01)).otherwise(c)
    return found.select(
        *df.columns,
        F.coalesce("user_count", F.lit(unseen_count)).cast("bigint").alias("user_count"),
        (F.col(amount) / floor0(median)).alias("Amt_to_Median_User"),
        (F.col(amount) / floor0(mean)).alias("Amt_to_Mean_User"),
    )


def with_group_count(df: DataFrame, key: Column, counted: str, out: str, id_col: str) -> DataFrame:
    """Non-null count of ``counted`` over the rows of the same key, put on each row."""
    keyed = df.withColumn("_key", key)
    stats = keyed.groupBy("_key").agg(F.count("*").alias("_rows"), F.count(counted).alias(out))
    return lookup_join(keyed, stats, ["_key"], "_rows", F.col(id_col)).select(*df.columns, out)


def group_stats(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Mean, sample deviation and count of each value per key, for every key in one aggregation over (name, level)."""
    long = df.select(*values, F.explode(F.array(*[
        F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("level")) for k in keys])).alias("s"))
    aggs = [F.count("*").alias("n")]
    for v in values:
        aggs += [F.avg(v).alias(f"{v}_mean"), F.stddev_samp(v).alias(f"{v}_std"), F.count(v).alias(f"{v}_count")]
    return long.groupBy("s.key", "s.level").agg(*aggs)


def with_group_stats(df: DataFrame, keys: list[str], values: list[str], id_col: str) -> DataFrame:
    """Join the block of :func:`group_stats` back, one lookup per key; a NULL key matches the NULL group."""
    return join_group_stats(df, persist_table(group_stats(df, keys, values), "groupstats"), keys, id_col)


def join_group_stats(df: DataFrame, stats: DataFrame, keys: list[str], id_col: str) -> DataFrame:
    """Add the stored block: ``<key>_<value>_<statistic>`` columns."""
    sizes = stored_sizes(stats, "key", "n")
    out = df
    for k in keys:
        cols = [c for c in stats.columns if c not in ("key", "level")]
        mine = stats.where(F.col("key") == k).select(F.col("level").alias("_lev"), *[F.col(c).alias(f"{k}_{c}") for c in cols])
        keyed = out.withColumn("_lev", F.col(k).cast("string"))
        out = lookup_join(keyed, mine, ["_lev"], f"{k}_n", F.col(id_col), sizes=sizes[k]).drop("_lev", f"{k}_n")
    return out


def key_set_stats(df: DataFrame, key_sets: list[list[str]], amount: str = "TransactionAmt") -> DataFrame:
    """(key_set, key, n, amt_median) for every key set in one exact-median job."""
    long = df.select(amount, F.explode(F.array(*[
        F.struct(F.lit("__".join(ks)).alias("key_set"), composite_key(ks).alias("key")) for ks in key_sets])).alias("s"))
    long = long.select("s.key_set", "s.key", amount)
    return counted_quantiles(long, ["key_set", "key"], amount, {"amt_median": 0.5}, "rows").drop("n")


def _lookup_parts(df: DataFrame, stats: DataFrame, part: str, keys: dict, values: list[str], id_col: str, rows: str, sizes: dict) -> DataFrame:
    """``<name>|<value>`` columns for every named key, with three exchanges of the table however many keys there are.

    Each row sends one narrow line per key, all lines are looked up in one salted join on (name, key), come together again
    by the id, which must be unique, and meet the wide row once.
    """
    lines = F.explode(F.array(*[F.struct(F.lit(name).alias(part), key.cast("string").alias("_key")) for name, key in keys.items()]))
    narrow = df.select(F.col(id_col).alias("_id"), lines.alias("_s")).select("_id", f"_s.{part}", "_s._key")
    side = stats.where(F.col(part).isin(list(keys))).select(part, F.col("key").alias("_key"), F.col(rows).alias("_rows"), *[F.col(v).alias(f"_v_{v}") for v in values])
    known = [sizes[k] for k in keys if k in sizes]
    found = lookup_join(narrow, side, [part, "_key"], "_rows", F.xxhash64("_id", part), sizes=(sum(k for k, _ in known), sum(n for _, n in known)))
    picked = [F.max(F.when(F.col(part) == name, F.col(f"_v_{v}"))).alias(f"{name}|{v}") for name in keys for v in values]
    return df.join(found.groupBy("_id").agg(*picked), F.col(id_col) == F.col("_id")).drop("_id")


def usable_key_sets(df: DataFrame, key_sets: list[list[str]] = GROUP_KEYS) -> list[list[str]]:
    return [ks for ks in key_sets if all(c in df.columns for c in ks)]


def with_key_sets(df: DataFrame, stats: DataFrame, key_sets: list[list[str]], overall: float, id_col: str,
                  amount: str = "TransactionAmt", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``<set>__count``, ``<set>__amt_median``, ``<set>__amt_ratio`` from the stored table of :func:`key_set_stats`; an unseen
    key has count 0 and the overall median. Sets small enough are broadcast, all larger ones share three exchanges."""
    sizes = stored_sizes(stats, "key_set", "rows")
    names = {"__".join(ks): ks for ks in key_sets}
    large = {n: composite_key(ks) for n, ks in names.items() if sizes.get(n, (0, 0))[0] > broadcast_rows}
    out = df
    if large:
        wide = _lookup_parts(df, stats.withColumn("_n", F.col("rows")), "key_set", large, ["_n", "amt_median"], id_col, "rows", sizes)
        out = wide.select(*df.columns, *[F.col(f"`{n}|_n`").alias(f"_rows|{n}") for n in large], *[F.col(f"`{n}|amt_median`").alias(f"_med|{n}") for n in large])
    for name, ks in names.items():
        if name in large:
            found = out.withColumn("_rows", F.col(f"`_rows|{name}`")).withColumn("_med", F.col(f"`_med|{name}`"))
        else:
            mine = stats.where(F.col("key_set") == name).select(
                F.col("key").alias("_key"), F.col("rows").alias("_rows"), F.col("amt_median").alias("_med"))
            found = lookup_join(out.withColumn("_key", composite_key(ks)), mine, ["_key"], "_rows", F.col(id_col), sizes=sizes.get(name, (0, 0)))
        median = F.coalesce("_med", F.lit(overall))
        out = found.select(
            *[F.col(f"`{c}`") for c in out.columns],
            F.coalesce("_rows", F.lit(0)).cast("bigint").alias(f"{name}__count"),
            median.alias(f"{name}__amt_median"),
            (F.col(amount) / (median + 1e-6)).alias(f"{name}__amt_ratio"),
        )
    return out.drop(*[f"_rows|{n}" for n in large], *[f"_med|{n}" for n in large])


def entity_degrees(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """(pair, key, rows, degree): distinct cleaned ``b`` per cleaned ``a`` for every pair (a, b) in one job; the pairs of
    values are made distinct before they are counted."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(f"{a}>{b}").alias("pair"), clean_text(a).alias("key"), clean_text(b).alias("other")) for a, b in pairs])).alias("s"))
    seen = long.groupBy("s.pair", "s.key", "s.other").agg(F.count("*").alias("_n"))
    return seen.groupBy("pair", "key").agg(F.sum("_n").alias("rows"), F.count("*").alias("degree"))


def with_entity_degrees(df: DataFrame, id_col: str, pairs: list[tuple[str, str]] = ENTITY_PAIRS, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Both degrees of each pair on every row; small tables are broadcast, all larger ones share three exchanges."""
    both = [p for a, b in pairs if a in df.columns and b in df.columns for p in ((a, b), (b, a))]
    if not both:
        return df
    stats = persist_table(entity_degrees(df, both), "degrees")
    sizes = stored_sizes(stats, "pair", "rows")
    large = {f"{a}>{b}": clean_text(a) for a, b in both if sizes.get(f"{a}>{b}", (0, 0))[0] > broadcast_rows}
    out = _lookup_parts(df, stats, "pair", large, ["degree"], id_col, "rows", sizes) if large else df
    for a, b in both:
        pair, name = f"{a}>{b}", f"entity__{a}__unique_{b}"
        if pair in large:
            out = out.withColumnRenamed(f"{pair}|degree", name)
            continue
        mine = stats.where(F.col("pair") == pair).select(F.col("key").alias("_key"), F.col("rows").alias("_rows"), F.col("degree").alias(name))
        keyed = out.withColumn("_key", clean_text(a))
        out = lookup_join(keyed, mine, ["_key"], "_rows", F.col(id_col), sizes=sizes.get(pair, (0, 0))).drop("_key", "_rows")
    names = [f"entity__{a}__unique_{b}" for a, b in both]
    return out.select(*df.columns, *names)


# ---- velocity and momentum ------------------------------------------------------------------------------------------

def _velocity_by_frames(rows: DataFrame, windows: list[int]) -> DataFrame:
    """Counts by range frames, for keys of moderate size: rows before this one less the rows older than t - w. All frames
    share one partitioning and one sort."""
    own = Window.partitionBy("entity", "key")
    earlier = F.row_number().over(own.orderBy("t", "id")) - 1
    older = lambda w: F.count("*").over(own.orderBy("t").rangeBetween(Window.unboundedPreceding, -w - 1))
    return rows.select("entity", "id", *[(earlier - older(w)).cast("bigint").alias(f"cnt_{w}s") for w in windows])


#: Points of one range when counts are differences of global ranks.
RANGE_POINTS = 1_000_000


def _velocity_by_rank(rows: DataFrame, hot: DataFrame, n_rows: int, windows: list[int]) -> DataFrame:
    """Counts as differences of global ranks for the (entity, key) numbered in ``hot``; any key may hold any share of the rows.

    Each row also sends one probe per window to (key, t - w). In one range-partitioned order the running count of rows at
    the probe is subtracted from the running count at the row itself.
    """
    marks = F.array(
        F.struct(F.col("t").alias("at"), F.lit(1).alias("is_row"), F.lit(0).alias("w")),
        *[F.struct((F.col("t") - w).alias("at"), F.lit(0).alias("is_row"), F.lit(w).alias("w")) for w in windows],
    )
    numbered = rows.join(F.broadcast(hot), ["entity", "key"])
    points = numbered.select("number", "id", F.explode(marks).alias("m")).select("number", "id", "m.*")
    n_points, usual = n_rows * (len(windows) + 1), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, -(-n_points // RANGE_POINTS), min(usual, n_points // (RANGE_POINTS // 20)))
    counted = running_totals(points, ["number", "at", "is_row", "id", "w"], {"seen": F.col("is_row")}, "velocity", parts)
    counted = counted.join(F.broadcast(hot.select("number", "entity")), "number")
    here = F.max(F.when(F.col("is_row") == 1, F.col("seen")))
    there = lambda w: F.max(F.when((F.col("is_row") == 0) & (F.col("w") == w), F.col("seen")))
    return counted.groupBy("entity", "id").agg(*[(here - there(w)).alias(f"cnt_{w}s") for w in windows])


def velocity(df: DataFrame, entities: list[str], time: str, id_col: str, windows: list[int] = VELOCITY_WINDOWS,
             min_hot_rows: int = 1_000_000, hot_share: int = HOT_SHARE) -> DataFrame:
    """(entity, id, cnt_<w>s): earlier rows of the same entity value with time at least t - w; ties ordered by id. Times are
    whole seconds.

    Values of moderate size use range frames. A value with at least ``min_hot_rows`` rows and more than 1/``hot_share``
    of all rows is counted by global ranks, so no task ever holds a hot value whole.
    """
    long = df.select(F.col(time).cast("bigint").alias("t"), F.col(id_col).alias("id"), F.explode(F.array(*[
        F.struct(F.lit(e).alias("entity"), clean_text(e).alias("key")) for e in entities])).alias("s"))
    rows = long.select("s.entity", "s.key", "t", "id")
    sizes = rows.groupBy("entity", "key").agg(F.count("*").alias("_n"))
    n_rows, n_big = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count_if(F.col("_n") >= min_hot_rows)).first()
    per_entity = n_rows // max(len(entities), 1)
    if n_big == 0:
        return _velocity_by_frames(rows, windows)
    # fewer than hot_share values per entity
    is_hot = (F.col("_n") >= min_hot_rows) & (F.col("_n") * hot_share > per_entity)
    hot = persist_table(sizes.where(is_hot).select("entity", "key", "_n", F.monotonically_increasing_id().alias("number")), "hotkeys")
    n_hot = hot.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    hot = hot.drop("_n")
    cold_rows = rows.join(F.broadcast(hot), ["entity", "key"], "left_anti")
    return _velocity_by_frames(cold_rows, windows).unionByName(_velocity_by_rank(rows, hot, n_hot, windows))


def with_velocity(df: DataFrame, entities: list[str], time: str, id_col: str, windows: list[int] = VELOCITY_WINDOWS, **kw) -> DataFrame:
    """``vel__<entity>__cnt_<w>s`` columns for every entity; one join on the unique row id."""
    counts = velocity(df, entities, time, id_col, windows, **kw)
    wide = counts.groupBy("id").agg(*[
        F.max(F.when(F.col("entity") == e, F.col(f"cnt_{w}s"))).alias(f"vel__{e}__cnt_{w}s") for e in entities for w in windows])
    return df.join(wide, df[id_col] == wide["id"], "left").drop("id")


def momentum(df: DataFrame, time: str, id_col: str, label: str, rows: int = 1000, delay: int = 0, chunk: int = 100_000,
             out: str = "momentum") -> DataFrame:
    """Mean label of the ``rows`` rows before this one by (time, id); the first row gets the overall mean.

    ``delay`` leaves out that many latest rows, whose labels are not known yet. Positions are cut into chunks and the rows
    just before a chunk are copied into it, so each task sees at most ``chunk + rows + delay`` rows. The mean is a
    difference of two running sums, whatever the length of the frame.
    """
    reach = rows + delay
    if reach > chunk:
        raise ValueError("rows + delay must not exceed chunk")
    narrow = list(dict.fromkeys([id_col, time, label]))  # only these are sorted; a wide table is joined back by its id
    placed = global_position(df.select(*narrow), [time, id_col], "_pos", "momentum")
    last = F.col("_pos") % chunk >= chunk - reach
    copied = placed.withColumn("_own", F.floor(F.col("_pos") / chunk)).withColumn(
        "_chunk", F.explode(F.when(last, F.array(F.col("_own"), F.col("_own") + 1)).otherwise(F.array(F.col("_own")))))
    order = Window.partitionBy("_chunk").orderBy("_pos")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    sums = copied.withColumns({"_s": F.coalesce(F.sum(label).over(before), zero), "_n": F.coalesce(F.count(label).over(before), zero)})
    far, near = (lambda c: F.coalesce(F.lag(c, reach).over(order), zero)), (lambda c: F.coalesce(F.lag(c, delay).over(order), zero))
    sums = sums.withColumns({"_total": near("_s") - far("_s"), "_seen": near("_n") - far("_n")})
    overall = df.agg(F.avg(label)).first()[0]
    mean = F.coalesce(F.try_divide(F.col("_total").cast("double"), F.col("_seen")), F.lit(overall))
    own = sums.where(F.col("_chunk") == F.col("_own"))
    if set(df.columns) <= set(narrow):
        return own.select(*df.columns, mean.alias(out))
    return df.join(own.select(id_col, mean.alias(out)), id_col).select(*df.columns, out)
