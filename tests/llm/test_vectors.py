"""Exact top-k search against brute force."""

import numpy as np
from rows import ordered

from riskspark.llm import cover_tree


def brute(rows, k, every):
    x = {i: np.floor(256 * np.array(v, float)) for i, (d, v) in enumerate(rows) if d is not None and v and all(c is not None and np.isfinite(c) for c in v)}
    out = []
    for i in x:
        if rows[i][0] % every == 0:
            found = sorted((-int(x[i] @ x[j]), rows[j][0], j) for j in x if j != i and len(x[i]) == len(x[j]))[:k]
            out += [(rows[i][0], n + 1, d, -s) for n, (s, d, _) in enumerate(found)]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame([(d, v, 1, 2) for d, v in rows], "vec_id long, embedding array<float>, row int, score int").repartition(3)


def test_clustered_vectors_with_ties(spark):
    r = np.random.default_rng(0)
    centres = r.normal(0, 1, (6, 8))
    rows = [(i, (centres[r.integers(6)] + r.normal(0, 0.01, 8)).astype("f4").tolist()) for i in range(700)]
    rows += [(700 + i, rows[3][1]) for i in range(20)]
    got = ordered(cover_tree.top_k(table(spark, rows), lambda i: i % 10 == 0, 5, query_block=40, data_block=100))
    assert got == brute(rows, 5, 10)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (10, [0.5, -1.0]), (10, [0.5, -1.0]), (3, None), (20, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, []),
            (30, [1.0, 2.0, 3.0]), (7, [1.0, 1.0, 1.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0]), (9, [1.0, 2.0])]
    assert ordered(cover_tree.top_k(table(spark, rows), lambda i: i % 10 == 0, 5)) == brute(rows, 5, 10)
    assert cover_tree.top_k(table(spark, rows).limit(0), lambda i: i % 10 == 0, 5).count() == 0


def test_huge_components_end_at_the_range_of_a_long(spark):
    rows = [(0, [3e37, 0.0]), (1, [3e37, 1.0]), (2, [-3e37, 1.0]), (3, [1.0, 1.0])]
    got = ordered(cover_tree.top_k(table(spark, rows), lambda i: i == 0, 5))
    assert [r[:3] for r in got] == [(0, 1, 1), (0, 2, 3), (0, 3, 2)]
    assert got[0][3] > 9e18 and got[1][3] > 9e18 and got[2][3] == -(2**63)


def test_pairs_are_pruned():
    r = np.random.default_rng(1)
    centres = np.floor(r.normal(0, 1000, (40, 16)))
    data = np.floor(centres[r.integers(40, size=6000)] + r.normal(0, 3, (6000, 16)))
    queries = data[:500]
    ids = np.arange(6000)
    s = cover_tree.Search(queries, ids[:500], data, ids, ids, 5).run()
    score = queries @ data.T
    score[np.arange(500), np.arange(500)] = -np.inf
    best = np.lexsort((np.broadcast_to(ids, score.shape), -score), axis=1)[:, :5]
    assert (np.take_along_axis(score, best, 1) == s.score).all() and (best == s.at).all()
    assert s.pairs < 0.5 * score.size
