"""Velocity counts as a keyed, stateful stream with corrections for rows that come late."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.scalars import clean_text
from riskspark.operators.behavior import VELOCITY_WINDOWS
from riskspark.streaming.streams import run_latest

#: A time slice is so many times the longest window long, a state should hold so many rows, and a value needs salts beyond so many in a slice.
SLICE_WINDOWS, STATE_ROWS, CROWDED_ROWS = 4, 100_000, 2_000_000


def hot_values(df: DataFrame, entities: list[str], share: float = 0.01, salts: int = 8) -> dict[tuple[str, str | None], int]:
    """(entity, value) -> ``salts`` for values with more than ``share`` of the rows of a history: fewer than 1/share per entity."""
    n = df.count()
    found = {}
    for e in entities:
        rows = df.groupBy(clean_text(e).alias("v")).agg(F.count("*").alias("n")).where(F.col("n") > share * n).collect()
        found |= {(e, r["v"]): salts for r in rows}
    return found


def slice_number(seconds, windows: list[int]):
    """Number of the time slice: only rows of the last longest window of a slice count for rows of the next one."""
    return F.floor(seconds / F.lit(SLICE_WINDOWS * max(windows)))


def crowded_values(df: DataFrame, entities: list[str], time: str, windows: list[int] = VELOCITY_WINDOWS, most_rows: int = CROWDED_ROWS) -> dict[tuple[str, str | None], int]:
    """(entity, value) -> number of salts for values with more than ``most_rows`` rows in a slice of a history: fewer than rows / most_rows per entity."""
    found = {}
    for e in entities:
        big = [r["v"] for r in df.groupBy(clean_text(e).alias("v")).agg(F.count("*").alias("n")).where(F.col("n") > most_rows).collect()]
        if big:
            parts = df.where(clean_text(e).isin(big)).groupBy(clean_text(e).alias("v"), slice_number(F.unix_seconds(time), windows).alias("s")).agg(F.count("*").alias("n"))
            found |= {(e, r["v"]): -(-r["n"] // most_rows) for r in parts.groupBy("v").agg(F.max("n").alias("n")).where(F.col("n") > most_rows).collect()}
    return found


def bucket_count(df: DataFrame, time: str, windows: list[int] = VELOCITY_WINDOWS, most_rows: int = STATE_ROWS) -> int:
    """Buckets of values with which a state holds about ``most_rows`` rows of a history, by its fullest slice."""
    fullest = df.groupBy(slice_number(F.unix_seconds(time), windows).alias("s")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    return max(1, -(-(fullest or 0) // most_rows))


def earlier(key: np.ndarray, t: np.ndarray, ids: np.ndarray, own: np.ndarray, windows: list[int]) -> np.ndarray:
    """(rows, windows): how many own rows of the same key (a small number) come before each row by (t, id) and not before t - window."""
    counts = np.zeros((len(t), len(windows)), dtype=np.int64)
    if not len(t):
        return counts
    order = np.lexsort((ids, t, key))
    k, u, i, o = key[order].astype(np.int64), t[order], ids[order], own[order].astype(np.int64)
    first = np.ones(len(order), dtype=bool)  # rows equal in time and id do not come before each other
    first[1:] = (k[1:] != k[:-1]) | (u[1:] != u[:-1]) | (i[1:] != i[:-1])
    seen = np.concatenate(([0], np.cumsum(o)))
    before = seen[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
    u = u - u.min()
    span = int(u.max()) + 1
    for w, window in enumerate(windows):
        begin = np.searchsorted(k * span + u, k * span + np.maximum(u - window, 0), side="left")
        counts[order, w] = before - seen[begin]
    return counts


def velocity_stream(events: DataFrame, entities: list[str], time: str, id_col: str, windows: list[int] = VELOCITY_WINDOWS, lateness: str = "1 hour",
                    salts: dict[tuple[str, str | None], int] | None = None, buckets: int = 1) -> DataFrame:
    """(entity, id, salt, cnt_<w>s...) in update mode: per salt the earlier rows of the same entity value with time at least t - w; ties
    ordered by id, which must be unique. The sum over the salts of the latest line of each is the count (``velocity_counts``).

    A state belongs to a bucket of values (one of ``buckets`` by hash, see ``bucket_count``) and a time slice. It holds the rows of the slice, and those of the last longest
    window of the slice before, which are counted but not answered; of these, the rows of the longest
    window before the watermark, and those after it that a late row could still
    change. A row that comes late, but within ``lateness``, is counted itself, and the counts of the rows after it are given out again;
    so the counts do not depend on how the stream was cut into batches. Rows older than the watermark of the batch before are dropped. A timer
    removes a state when the watermark has passed the end of its slice.

    A value in ``salts`` (see ``crowded_values`` and ``hot_values``) keeps its rows in so many states: each row is stored in one and counted against all. Times are
    whole seconds of the time stamp ``time``; NULL is a value like any other.
    """
    names = [f"cnt_{w}s" for w in windows]
    out = T.StructType([T.StructField("entity", T.StringType()), T.StructField("id", T.LongType()), T.StructField("salt", T.IntegerType()),
                        *[T.StructField(n, T.LongType()) for n in names]])
    parts_ = {"code": np.int32, "t": np.int64, "id": np.int64, "own": np.bool_, "ask": np.bool_}  # a state: the distinct keys, and rows as bytes
    held = T.StructType([T.StructField("keys", T.ArrayType(T.StringType())), *[T.StructField(n, T.BinaryType()) for n in parts_]])
    longest = max(windows)
    length = SLICE_WINDOWS * longest

    def step(key, parts, state):
        if state.hasTimedOut:
            state.remove()
            return
        got = pd.concat(list(parts), ignore_index=True)
        keys, *old = state.get if state.exists else ([], *[b""] * len(parts_))
        old = {n: np.frombuffer(v, dtype=k) for (n, k), v in zip(parts_.items(), old)}
        code, values = pd.factorize(np.concatenate((np.array(keys, dtype=object), got["key"].to_numpy(dtype=object))))
        new = {n: got[n].to_numpy() for n in ("t", "id", "own", "ask")} | {"code": code[len(keys):]}
        every = {n: np.concatenate((old[n], new[n])).astype(k) for n, k in parts_.items()}
        answer = every["ask"].copy()
        answer[: len(old["t"])] = False
        if new["own"].any():  # rows answered before that the new ones come in front of
            t, fresh = new["t"][new["own"]], np.bincount(new["code"][new["own"]], minlength=len(values)) > 0
            answer[: len(old["t"])] = old["ask"] & fresh[old["code"]] & (old["t"] >= t.min()) & (old["t"] <= t.max() + longest)
        counts = earlier(every["code"], every["t"], every["id"], every["own"], windows)[answer]
        clock = state.getCurrentWatermarkMs() // 1000
        ids = every["id"][answer]
        every["ask"] &= every["t"] >= clock
        kept = every["ask"] | every["own"] & (every["t"] >= clock - longest)
        state.update(([str(v) for v in values], *[every[n][kept].tobytes() for n in parts_]))
        state.setTimeoutTimestamp((max((int(key[2]) + 1) * length, clock) + 1) * 1000)
        yield pd.DataFrame({"entity": key[0], "id": ids, "salt": np.int32(key[3])} | {n: counts[:, i] for i, n in enumerate(names)})

    pairs = [(F.concat_ws("=", F.lit(e), F.coalesce(F.lit(v), F.lit("\0"))), F.lit(n)) for (e, v), n in (salts or {}).items()]
    number = F.element_at(F.create_map(*[x for p in pairs for x in p]), F.concat_ws("=", "s.entity", F.coalesce("s.key", F.lit("\0")))) if pairs else F.lit(None).cast("int")
    marked = events.select(F.col(time).alias("at"), F.unix_seconds(time).alias("t"), F.col(id_col).cast("bigint").alias("id"), F.explode(F.array(*[
        F.struct(F.lit(e).alias("entity"), clean_text(e).alias("key")) for e in entities])).alias("s")).withWatermark("at", lateness)
    n, own_slice = F.coalesce(number, F.lit(1)), slice_number(F.col("t"), windows)
    tail = F.col("t") >= (own_slice + 1) * length - longest
    places = F.filter(F.array(F.struct(own_slice.alias("slice"), F.lit(True).alias("ask")), F.when(tail, F.struct((own_slice + 1).alias("slice"), F.lit(False).alias("ask")))), lambda p: p.isNotNull())
    rows = marked.select("at", "t", "id", "s.entity", "s.key", F.pmod(F.xxhash64("s.key"), F.lit(buckets)).alias("bucket"), n.alias("n"), F.explode(places).alias("p"))
    rows = rows.select("at", "t", "id", "entity", "key", "bucket", "n", "p.slice", "p.ask", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("salt"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.col("n")) == F.col("salt")).where(F.col("own") | F.col("ask")).drop("n")
    return rows.groupBy("entity", "bucket", "slice", "salt").applyInPandasWithState(step, out, held, "update", "EventTimeTimeout")


def velocity_counts(stream: DataFrame, tag: str = "velocity") -> DataFrame:
    """(entity, id, cnt_<w>s...): runs a ``velocity_stream`` over what is there; late corrections replace what was given out before."""
    names = [c for c in stream.columns if c.startswith("cnt_")]
    last = run_latest(stream, ["entity", "id", "salt"], tag, ["entity", "id"])
    return last.groupBy("entity", "id").agg(*[F.sum(n).alias(n) for n in names])
