"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut into two halves, each quantised by its own centroids; a pair of centroids is a cell. A query walks through the cells by the
sum of its squared distances to the two centroids, smallest first, with a heap over pairs of ranks. Rows of the cells
it visits are ranked by their exact distance.

The walk has two legs. The first one ends once the visited cells hold ``first`` rows; their k-th best distance bounds the
answer. The second one goes on up to the summed distance beyond which a row could come below that bound only if its residual
pointed to the query by more than ``deviations`` standard deviations, measured on the residuals of the fitted sample. So close
clusters end the walk soon, and vectors without structure make it visit what recall needs.

Every row is indexed. Cells are packed into shards of bounded size, a cell beyond that size into several, and a visit asks all shards of
its cell. Of equal vectors only the k + 1 smallest ids are entered: the rest can never be among the k nearest, as ties go to the smaller id.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.base import column, forget, stored, tidy, unique

#: Rows that fit the centroids: the first ones in hash order of the row id.
SAMPLE = 16_384
#: Entries of a shard, and queries that meet a copy of it.
SHARD, ASKERS = 2048, 4096

_LONG, _INTS = T.LongType(), T.ArrayType(T.IntegerType())
_CELL = T.StructType([T.StructField("cell", T.IntegerType())])
_ASK = T.StructType([T.StructField("row", _LONG), T.StructField("shard", T.IntegerType()), T.StructField("cells", _INTS)])
_HIT = T.StructType([T.StructField("query", _LONG), T.StructField("row", _LONG), T.StructField("id", _LONG), T.StructField("score", T.DoubleType())])


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None], 0)


def _centroids(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    """Lloyd's algorithm from distinct rows; a centroid that loses all its rows takes the row that is farthest from its own."""
    rng = np.random.default_rng(seed)
    different = np.unique(x, axis=0)
    c = different[rng.choice(len(different), min(k, len(different)), replace=False)].copy()
    for _ in range(rounds):
        gap = _squares(x, c)
        near = gap.argmin(1)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        size = np.bincount(near, minlength=len(c))
        far = iter(np.argsort(-gap[np.arange(len(x)), near]))
        for i in range(len(c)):
            c[i] = sums[i] / size[i] if size[i] else x[next(far)]
    return c


class Index:
    """The two codebooks, and what the residuals of the sample say about how far the walk has to go."""

    def __init__(self, sample: np.ndarray, k: int, rounds: int = 10, seed: int = 0):
        self.scale = float(np.abs(sample).max()) or 1.0  # keeps squares of very large components finite
        sample = sample / self.scale
        self.cut = max(1, sample.shape[1] // 2)
        self.books = [_centroids(h, k, rounds, seed) for h in self.halves(sample)]
        rest, self.spread = np.zeros(len(sample)), 0.0
        for h, book in zip(self.halves(sample), self.books):
            e = h - book[_squares(h, book).argmin(1)] if h.shape[1] else h
            rest += (e * e).sum(1)
            if h.shape[1]:
                self.spread = max(self.spread, float(np.linalg.eigvalsh(e.T @ e / len(e))[-1]))
        self.rest = float(np.quantile(rest, 0.05))

    def halves(self, x: np.ndarray):
        return x[:, : self.cut], x[:, self.cut :]

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = (_squares(h, book).argmin(1) for h, book in zip(self.halves(x / self.scale), self.books))
        return (a * len(self.books[1]) + b).astype(np.int32)

    def reach(self, bound: np.ndarray, deviations: float) -> np.ndarray:
        """The summed squared distance at which a walk ends that looks for rows nearer than ``bound``; it may be below zero."""
        tilt = deviations * math.sqrt(self.spread)
        room = (bound / self.scale) ** 2 - self.rest + tilt * tilt
        return np.where(room < 0, -1.0, (tilt + np.sqrt(np.maximum(room, 0))) ** 2)


def walk(first: np.ndarray, second: np.ndarray):
    """(summed distance, cell) of all pairs of centroids by rising sum: a heap over pairs of ranks, each pushed once its row or column
    predecessor has come out."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    x, y = first[a].tolist(), second[b].tolist()
    heap, width = [(x[0] + y[0], 0, 0)], len(y)
    while heap:
        s, i, j = heapq.heappop(heap)
        yield s, int(a[i]) * width + int(b[j])
        if j + 1 < width:
            heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))


def _pack(sizes: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(first shard, number of shards) of every cell: neighbouring cells share a shard, a cell above ``most`` has several alone."""
    first, number = np.zeros(len(sizes), dtype=np.int64), np.ones(len(sizes), dtype=np.int64)
    shard = held = 0
    for cell, n in enumerate(sizes.tolist()):
        if held and held + n > most:
            shard, held = shard + 1, 0
        first[cell] = shard
        held += n
        if n > most:
            number[cell] = -(-n // most)
            shard, held = shard + int(number[cell]), 0
    return first, number


def _matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def _asked(queries: DataFrame, index, sizes, shards, first: int, k: int, deviations: float, second: bool) -> DataFrame:
    """(row, shard, cells): what each query visits on the first leg, or between the first and the end of the second."""

    def scan(batches):
        m, n = index.value, sizes.value
        start, number = shards.value
        for b in batches:
            x, rows = _matrix(column(b, "v")) / m.scale, column(b, "row").to_pylist()
            near = [_squares(h, book) for h, book in zip(m.halves(x), m.books)]
            ends = m.reach(column(b, "bound").fill_null(math.inf).to_numpy(zero_copy_only=False), deviations) if second else None
            out = []
            for i, row in enumerate(rows):
                held, visits = 0, {}
                for s, cell in walk(near[0][i], near[1][i]):
                    early = held < first
                    if not early and (not second or s > ends[i]):
                        break
                    held += int(n[cell])
                    if n[cell] and early != second:
                        for shard in range(start[cell], start[cell] + number[cell]):
                            visits.setdefault(shard, []).append(cell)
                out += [(row, shard, cells) for shard, cells in visits.items()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.list_(pa.int32())))], _ASK.fieldNames())

    return queries.mapInArrow(tidy(scan), _ASK)


def _nearest(asked: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """(query, row, id, score): of every asked shard the ``k`` nearest rows in the asked cells; a row is never its own neighbour."""
    copies = asked.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(ASKERS)).cast("int").alias("n"))
    data = entries.join(copies.withColumnsRenamed({"shard": "_s", "n": "_n"}), F.col("shard") == F.col("_s"))
    data = data.select("row", "id", "v", "cell", "shard", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("copy"))
    ask = asked.join(copies.withColumnsRenamed({"shard": "_t", "n": "_m"}), F.col("shard") == F.col("_t"))
    ask = ask.select("row", "v", "cells", "shard", F.pmod(F.xxhash64("row"), F.col("_m")).cast("int").alias("copy"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.float64())], names=_HIT.fieldNames())
        if not left.num_rows or not right.num_rows:
            return empty
        cell = right.column("cell").to_numpy()
        order = np.argsort(cell, kind="stable")
        cell, rows, ids = cell[order], right.column("row").to_numpy()[order], right.column("id").to_numpy()[order]
        x, q = _matrix(right.column("v").combine_chunks())[order], _matrix(left.column("v").combine_chunks())
        scale = max(float(np.abs(x).max()), float(np.abs(q).max())) or 1.0
        y, p = x / scale, q / scale
        length = (y * y).sum(1)
        found = []
        for i, (row, cells) in enumerate(zip(left.column("row").to_pylist(), left.column("cells").to_pylist())):
            cells = np.sort(np.array(cells))
            a, b = np.searchsorted(cell, cells), np.searchsorted(cell, cells, side="right")
            at = np.concatenate([np.arange(s, e) for s, e in zip(a, b)])
            at = at[rows[at] != row]
            if not len(at):
                continue
            rough = length[at] - 2 * (y[at] @ p[i])  # up to the query's own length and rounding
            if len(at) > k:
                slack = 1e-12 * (length[at].max() + float(p[i] @ p[i]) + 1e-300)
                at = at[rough <= np.partition(rough, k - 1)[k - 1] + 4 * slack]
            gap = y[at] - p[i]
            score = scale * np.sqrt((gap * gap).sum(1))
            best = np.lexsort((rows[at], ids[at], score))[:k]
            found.append((np.full(len(best), row), rows[at][best], ids[at][best], score[best]))
        return pa.table([np.concatenate(c) for c in zip(*found)], names=_HIT.fieldNames()) if found else empty

    keys = ["shard", "copy"]
    left, right = (t.select(*t.columns) for t in (ask, data))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, _HIT)


def _best(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy("score", "id", "row")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(
    vectors: DataFrame, is_query, k: int = 10, key: str = "vec_id", vector: str = "embedding", centroids: int | None = None,
    first: int = 1024, deviations: float = 2.8, sample: int = SAMPLE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for every query row by Euclidean distance, in doubles.

    ``is_query`` maps the key column to a condition. Candidates are all rows but the query's own row, equal distances go to
    the smaller id. ``centroids`` per half is a quarter of the root of the number of rows if not given, 512 at most.

    Rows whose id or vector is null, or whose vector is empty, zero or holds null or non-finite components, take no part. Vectors of
    different lengths are not compared: each length has an index of its own. Repeated rows are rows of their own: a query finds
    its copies, and equal ids each get their ranks. Fewer than ``k`` candidates are all returned. An empty table or one without
    queries gives an empty table; further columns are not looked at.
    """
    spark = vectors.sparkSession
    slim = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("v", lambda x: x != 0)
    slim = slim.where(good)
    number = F.col("id") if unique(slim.select("id")) else F.monotonically_increasing_id()
    rows = stored(slim.select(number.alias("row"), "id", "v", F.size("v").alias("dim")), "vectors")
    copies = Window.partitionBy(F.xxhash64("v"), "v").orderBy("id", "row")
    entered = rows.withColumn("place", F.row_number().over(copies)).where(F.col("place") <= k + 1).drop("place")
    entered = stored(entered, "entered")
    out = None
    for line in entered.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).orderBy("dim").collect():
        mine, n = entered.where(F.col("dim") == line["dim"]), line["n"]
        queries = rows.where((F.col("dim") == line["dim"]) & is_query(F.col("id"))).select("row", F.col("id").alias("query_id"), "v")
        best = _searched(spark, mine, queries, n, k, centroids, first, deviations, sample)
        out = best if out is None else out.unionByName(best)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return out


def _searched(spark, entered: DataFrame, queries: DataFrame, n: int, k: int, centroids, first: int, deviations: float, sample: int) -> DataFrame:
    fit = entered.select(F.xxhash64("row", F.lit(7)).alias("h"), "row", "v").orderBy("h", "row").limit(sample).select("v").toArrow()
    size = centroids or max(1, min(512, int(math.sqrt(n) / 4)))
    index = spark.sparkContext.broadcast(Index(_matrix(fit.column("v").combine_chunks()), size))

    def place(batches):
        for b in batches:
            cell = pa.array(index.value.cells(_matrix(column(b, "v"))))
            yield pa.RecordBatch.from_arrays([*b.columns, cell], [*b.schema.names, "cell"])

    schema = T.StructType(entered.schema.fields + _CELL.fields)
    celled = stored(entered.mapInArrow(tidy(place), schema), "cells")
    books = index.value.books
    sizes = np.zeros(len(books[0]) * len(books[1]), dtype=np.int64)
    for r in celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():  # at most the square of the centroids
        sizes[r["cell"]] = r["n"]
    first_shard, number = _pack(sizes, SHARD)
    at = spark.createDataFrame([(c, int(first_shard[c]), int(number[c])) for c in np.flatnonzero(sizes).tolist()], "cell int, base int, parts int")
    entries = celled.join(F.broadcast(at), "cell")
    entries = entries.select("row", "id", "v", "cell", (F.col("base") + F.pmod(F.xxhash64("row"), F.col("parts"))).cast("int").alias("shard"))
    shared = [spark.sparkContext.broadcast(x) for x in (sizes, (first_shard, number))]
    full = queries.select("row", "v")

    def leg(asking: DataFrame, second: bool) -> DataFrame:
        visits = _asked(asking, index, *shared, first, k, deviations, second)
        asked = stored(visits, "visits")
        hits = stored(_nearest(asked.join(full, "row"), entries, k), "hits")
        forget(asked)
        return hits

    one = leg(full, False)
    bounds = _best(one, k).groupBy("query").agg(F.when(F.count(F.lit(1)) == k, F.max("score")).alias("bound"))
    two = leg(full.join(bounds, full["row"] == bounds["query"], "left").select("row", "v", "bound"), True)
    best = _best(one.unionByName(two), k)
    return best.join(queries.select(F.col("row").alias("query"), "query_id"), "query").select("query_id", "rank", F.col("id").alias("vec_id"), "score")
