"""Exact top-k inner products by dual-tree search over cover trees.

Queries and data are both indexed: a node has a centre, a covering radius over everything below it, and children whose
centres are farther apart than their own radius. For a query node and a data node no inner product can exceed
``<q, d> + |q| r_d + |d| r_q + r_q r_d`` (centres q and d, radii r); the pair is dropped if that is below the worst k-th score
of the query node's queries. What remains at the leaves is multiplied out.

Rows are dealt into blocks of bounded size, and each pair of a query block and a data block is one group, so nothing grows
with the table but the number of groups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.base import stored, unique

LEAF = 64


class Node:
    __slots__ = ("centre", "norm", "radius", "points", "children")

    def __init__(self, centre, radius, points, children):
        self.centre, self.radius, self.points, self.children = centre, radius, points, children
        self.norm = float(np.sqrt(centre @ centre))


def build(x: np.ndarray, points: np.ndarray | None = None, centre: int | None = None) -> Node:
    """Cover tree of the rows of ``x`` (float64): children lie within half the radius of their centres, centres farther apart.

    A node of few points, of equal points, or whose points are so evenly apart that a cover would not thin them out, is a leaf.
    """
    points = np.arange(len(x)) if points is None else points
    centre = int(points[0]) if centre is None else centre
    gap = np.sqrt(np.maximum(((x[points] - x[centre]) ** 2).sum(1), 0))
    radius = float(gap.max()) if len(points) else 0.0
    if len(points) <= LEAF or radius == 0:
        return Node(x[centre], radius, points, [])
    left, groups = points, []
    first = centre
    while len(left):
        if len(groups) * 8 > len(points):
            return Node(x[centre], radius, points, [])
        near = np.sqrt(np.maximum(((x[left] - x[first]) ** 2).sum(1), 0)) <= radius / 2
        groups.append((first, left[near]))
        left = left[~near]
        first = int(left[0]) if len(left) else first
    if len(groups) == 1:
        return Node(x[centre], radius, points, [])
    return Node(x[centre], radius, points, [build(x, p, c) for c, p in groups])


class Search:
    """Best ``k`` data rows of every query row, by (score descending, id ascending, row)."""

    def __init__(self, queries: np.ndarray, own: np.ndarray, data: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
        self.q, self.own, self.d, self.ids, self.rows, self.k = queries, own, data, ids, rows, k
        self.score = np.full((len(queries), k), -np.inf)
        self.at = np.full((len(queries), k), -1)
        self.pairs = 0

    def run(self) -> "Search":
        if len(self.q) and len(self.d):
            self._visit(build(self.q), build(self.d))
        return self

    @staticmethod
    def _most(q: Node, d: Node) -> float:
        top = float(q.centre @ d.centre) + q.norm * d.radius + d.norm * q.radius + q.radius * d.radius
        return top + 1e-9 * (abs(top) + 1)

    def _visit(self, q: Node, d: Node) -> None:
        if self._most(q, d) < self.score[q.points, -1].min():
            return
        if not q.children and not d.children:
            self._leaves(q.points, d.points)
        elif d.children and (not q.children or d.radius >= q.radius):
            for c in sorted(d.children, key=lambda c: -self._most(q, c)):
                self._visit(q, c)
        else:
            for c in q.children:
                self._visit(c, d)

    def _leaves(self, qs: np.ndarray, ds: np.ndarray) -> None:
        """Scores of all pairs of two leaves, a piece of the queries at a time; a row is never its own candidate."""
        step = max(1, 2_000_000 // max(1, len(ds)))
        for s in range(0, len(qs), step):
            part = qs[s : s + step]
            score = self.q[part] @ self.d[ds].T
            self.pairs += score.size
            score[self.own[part][:, None] == self.rows[ds][None]] = -np.inf
            worst = self.score[part, -1]
            for i in np.flatnonzero((score >= worst[:, None]).any(1)):
                row = part[i]
                good = np.flatnonzero((score[i] >= worst[i]) & (score[i] > -np.inf))
                both = np.concatenate((self.score[row], score[i, good]))
                at = np.concatenate((self.at[row], ds[good]))
                known = at >= 0
                order = np.lexsort((np.where(known, self.rows[at], 0), np.where(known, self.ids[at], np.iinfo(np.int64).max), -both))[: self.k]
                self.score[row], self.at[row] = both[order], at[order]


def _whole(batch_column: pa.ListArray, scale: float) -> np.ndarray:
    """Rows of floor(scale * x) as float64; exact while sums of products stay below 2**53."""
    flat = batch_column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(scale * flat).reshape(len(batch_column), -1)


_FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("query_row", "query_id", "vec_row", "vec_id", "score")])


def top_k(
    vectors: DataFrame, is_query, k: int = 5, scale: float = 256.0, key: str = "vec_id", vector: str = "embedding",
    query_block: int = 8192, data_block: int = 8192,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the largest integer inner product for every query row.

    Components become floor(scale * x). ``is_query`` maps the key column to a condition. Candidates are all rows but the
    query's own row, all of them if they are fewer than ``k``; equal scores go to the smaller id.

    Rows whose vector or id is null, or whose vector is empty or holds null or non-finite components, take no part; vectors
    of different lengths are not compared. Repeated rows are rows of their own: a query finds its copy, and equal ids each
    get their ranks. An empty table or one without queries gives an empty table; other columns are not looked at. Sums of products beyond
    2**53 are rounded like doubles, and scores beyond the range of a long end at its ends; ranks then follow the rounded sums.
    """
    slim = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull())
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    slim = slim.where((F.size("v") > 0) & good)
    if unique(slim.select("id")):
        rows = slim.select(F.col("id").alias("row"), "id", "v", F.size("v").alias("dim"))
    else:
        rows = stored(slim.select(F.monotonically_increasing_id().alias("row"), "id", "v", F.size("v").alias("dim")), "vectors")
    asked = rows.where(is_query(F.col("id")))
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query(F.col("id")), F.lit(1))).alias("q")).first()
    d_blocks, q_blocks = max(1, -(-sizes["n"] // data_block)), max(1, -(-sizes["q"] // query_block))
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    data = rows.select("row", "id", "v", "dim", block(d_blocks).alias("d"), every(q_blocks).alias("q"))
    ask = asked.select("row", "id", "v", "dim", every(d_blocks).alias("d"), block(q_blocks).alias("q"))

    def pair(queries: pa.Table, blocks: pa.Table) -> pa.Table:
        empty = pa.table({n: pa.array([], pa.int64()) for n in _FOUND.fieldNames()})
        if not queries.num_rows or not blocks.num_rows:
            return empty
        get = lambda t, c: t.column(c).to_numpy().astype(np.int64)
        vec = lambda t: _whole(t.column("v").combine_chunks(), scale)
        ids, own = get(blocks, "id"), get(blocks, "row")
        found = Search(vec(queries), get(queries, "row"), vec(blocks), ids, own, k).run()
        hit = found.at >= 0
        which = np.repeat(np.arange(queries.num_rows), hit.sum(1))
        at = found.at[hit]
        columns = get(queries, "row")[which], get(queries, "id")[which], own[at], ids[at], np.clip(found.score[hit], -(2.0**63), 2.0**63 - 1024).astype(np.int64)
        return pa.table({n: pa.array(c) for n, c in zip(_FOUND.fieldNames(), columns)})

    keys = ["dim", "d", "q"]
    near = ask.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInArrow(pair, _FOUND)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    best = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
