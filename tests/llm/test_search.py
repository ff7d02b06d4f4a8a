"""Lexical search, inverted multi-index and whitening against brute force."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from rows import clashing, key, ordered

from riskspark.llm import lexical, multi_index, whitening

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def score_all(docs, items, k):
    """Every score by the formula, in whole numbers; ``docs`` and ``items`` are (id, text)."""
    held = [(d, terms(t)) for d, t in docs]
    held = [(d, w) for d, w in held if w]
    n, size = len(held), sum(len(w) for _, w in held)
    out = []
    for item, text in items:
        found = []
        for at, (d, w) in enumerate(held):
            total = 0
            for t in set(terms(text)):
                df = sum(t in x for _, x in held)
                tf, m = w.count(t), 50 + (50 * len(w) * n) // size
                if tf:
                    total += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * ((10**9 * tf) // (1000 * tf + 20 * m))
            if total > 0:
                found.append((-total, d is None, d or 0, d))
        out += [(item, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:k])]
    return sorted(out, key=key)


def prose(n, seed=3):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdeÉß9") for _ in range(r.randrange(1, 5))) for _ in range(60)]
    pick = lambda: vocabulary[min(int(r.expovariate(0.08)), 59)]
    docs = []
    for i in range(n):
        t = r.choice(["", " ", "_"]) + r.choice([" ", "-", "\n", "@"]).join(r.choice([str.upper, str.title, str])(pick()) for _ in range(r.choice([0, 1, 5, 30, 80])))
        t = docs[r.randrange(len(docs))][1] if docs and r.random() < 0.3 else t
        docs.append((r.choice([i, i, i, None, 7]), r.choice([t, t, t, t, t, None])))
    items = [(r.choice([i, i, None, 2]), " ".join(pick() for _ in range(r.choice([0, 1, 3, 12, 40])))) for i in range(14)] + [(90, None), (91, "zzzz")]
    return docs, items


def items_of(spark, items):
    return spark.createDataFrame([(i, t, "x", 5) for i, t in items], "item_id long, text string, terms string, score long").repartition(2)


@pytest.mark.parametrize("k,block", [(50, 200_000), (5, 30)])
def test_lexical_search_against_all_scores(spark, k, block):
    docs, items = prose(260)
    got = lexical.ranked(clashing(spark, docs), items_of(spark, items), k, block_terms=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert ordered(got) == score_all(docs, items, k)


def test_lexical_search_of_nothing(spark):
    docs, items = prose(20)
    some, asked = clashing(spark, docs), items_of(spark, items)
    assert lexical.ranked(some.limit(0), asked).count() == 0
    assert lexical.ranked(some, asked.limit(0)).count() == 0
    assert lexical.ranked(clashing(spark, [(1, None), (2, "--")]), asked).count() == 0


def test_long_text_and_pieces():
    texts = pa.array(["a b " * 60_000, "", "b", None, "c A"])
    vocabulary = pa.array(["a", "b"])
    parts = [lexical.term_counts(texts.slice(a, s).fill_null(""), vocabulary) for a, s in lexical._pieces(texts, 1000)]
    assert len(parts) > 1
    assert np.concatenate([p[0] for p in parts]).tolist() == [120_000, 0, 1, 0, 2]
    assert [p[3].tolist() for p in parts if len(p[3])] == [[60_000, 60_000], [1, 1]]


def test_search_stops_early_with_the_best_rows():
    """A shard with a few outstanding documents: the best are those of all scores, and most documents are never scored."""
    r = np.random.default_rng(0)
    n_docs, n_terms = 6000, 6
    offsets = np.arange(0, n_docs * n_terms + 1, n_terms)
    words = np.tile(np.arange(n_terms, dtype=np.int32), n_docs)
    counts = np.ones(n_docs * n_terms, dtype=np.int32)
    for d in range(20):
        counts[d * 300 * n_terms : (d * 300 + 1) * n_terms] = 5 + d
    size = np.full(n_docs, 50, dtype=np.int64) + r.integers(0, 50, n_docs)
    shard = lexical.Shard(size, offsets, words, counts, np.full(n_terms, 900), n_docs, int(size.sum()))
    ids = np.arange(n_docs)
    best = lexical.Best(10)
    touched = lexical.search(shard, np.arange(n_terms), best, np.zeros(n_docs, bool), ids, ids, 0)
    total = shard.impact.reshape(n_docs, n_terms).sum(1)
    want = np.lexsort((ids, -total))[:10]
    assert best.row.tolist() == want.tolist() and best.score.tolist() == total[want].tolist()
    assert touched < n_docs / 4


# ---- vector index -----------------------------------------------------------------------------------------------------------

def vectors(spark, rows):
    return spark.createDataFrame([(d, v, 1, 2, 3) for d, v in rows], "vec_id long, embedding array<float>, row int, score int, cell int").repartition(3)


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def nearest_rows(rows, k, every):
    x = {i: np.array(v, "f4").astype(float) for i, (d, v) in enumerate(rows) if d is not None and usable(v) and any(v)}
    out = []
    for i in x:
        if rows[i][0] % every == 0:
            same = [j for j in x if j != i and len(x[i]) == len(x[j])]
            found = sorted((float(np.sqrt(((x[i] - x[j]) ** 2).sum())), rows[j][0], j) for j in same)[:k]
            out += [(rows[i][0], n + 1, d, s) for n, (s, d, _) in enumerate(found)]
    return sorted(out)


def same_rows(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], rel=1e-12)


def test_index_finds_the_neighbours_of_clusters_and_copies(spark):
    """Clusters, and one vector in a third of the rows: all copies count, ties go to the smaller id."""
    r = np.random.default_rng(0)
    centres = r.normal(0, 1, (30, 12))
    rows = [(i, (centres[r.integers(30)] + r.normal(0, 0.05, 12)).astype("f4").tolist()) for i in range(1200)]
    rows += [(1200 + i, rows[3][1]) for i in range(600)]
    got = ordered(multi_index.nearest(vectors(spark, rows), lambda i: i % 40 == 0, 7, first=64))
    want = nearest_rows(rows, 7, 40)
    assert len(got) == len(want) and {r[:2] for r in got} == {r[:2] for r in want}
    hit = {(r[0], r[2]) for r in got} & {(r[0], r[2]) for r in want}
    assert len(hit) >= 0.97 * len(want)
    copies = [r for r in got if r[0] >= 1200]
    assert copies == [r for r in want if r[0] >= 1200] and copies


def test_index_recall_on_the_given_vectors(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir.replace('0.001', '0.1')}/embeddings.parquet")
    got = ordered(multi_index.nearest(table, lambda i: i % 100 == 0, 10))
    want = nearest_rows([(r["vec_id"], r["embedding"]) for r in table.orderBy("vec_id").collect()], 10, 100)
    hit = {(r[0], r[2]) for r in got} & {(r[0], r[2]) for r in want}
    assert len(got) == len(want) and len(hit) >= 0.9 * len(want)
    exact = {(r[0], r[2]): r[3] for r in want}
    assert all(abs(exact[r[0], r[2]] - r[3]) < 1e-12 for r in got if (r[0], r[2]) in exact)


def test_index_of_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (10, [0.5, -1.0]), (10, [0.5, -1.0]), (3, None), (20, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, []),
            (30, [1.0, 2.0, 3.0]), (7, [1.0, 1.0, 1.0]), (None, [1.0, 1.0]), (8, [1.0, 2.0]), (9, [0.0, 0.0]), (40, [3e37, -3e37]), (50, [5.0]), (60, [4.0]), (11, [1e-30, 0.0])]
    same_rows(ordered(multi_index.nearest(vectors(spark, rows), lambda i: i % 10 == 0, 5)), nearest_rows(rows, 5, 10))
    assert multi_index.nearest(vectors(spark, rows).limit(0), lambda i: i % 10 == 0, 5).count() == 0
    assert multi_index.nearest(vectors(spark, rows), lambda i: i < 0, 5).count() == 0


def test_walk_rises_and_visits_every_pair():
    r = np.random.default_rng(4)
    a, b = r.random(7), np.round(r.random(5), 1)
    out = list(multi_index.walk(a, b))
    assert sorted(c for _, c in out) == list(range(35))
    assert [s for s, _ in out] == sorted(s for s, _ in out)
    assert all(abs(s - a[c // 5] - b[c % 5]) < 1e-15 for s, c in out)


def test_cells_above_the_shard_size_are_split():
    first, number = multi_index._pack(np.array([3, 0, 25, 4, 5, 2, 10]), 10)
    assert number.tolist() == [1, 1, 3, 1, 1, 1, 1]
    assert first.tolist() == [0, 0, 1, 4, 4, 5, 6]
    used = [s for f, n in zip(first, number) for s in range(f, f + n)]
    assert sorted(set(used)) == list(range(7))


# ---- whitening --------------------------------------------------------------------------------------------------------------

def check_whitening(spark, rows, top=8):
    """Against numpy's eigenvectors; equal variances are compared by what they span."""
    kept = [(d, v) for d, v in rows if usable(v)]
    dims = [len(v) for _, v in kept]
    dim = max(sorted(set(dims)), key=dims.count)
    kept = [(d, v) for d, v in kept if len(v) == dim]
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in kept], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    c = np.array([[float(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    values, vectors_ = np.linalg.eigh(c.T @ c / n)
    values, vectors_ = values[::-1], vectors_[:, ::-1]
    k = min(top, int((values > 1e-20 * values[0]).sum())) if values[0] > 0 else 0
    got = whitening.whiten(vectors(spark, rows), top).collect()
    real = [j for j in range(k) if math.sqrt(max(values[j], 0)) > 1e-6 * math.sqrt(values[0])]
    assert len(got) == n * len(real)
    deviation = {}
    for (d, v), gap in zip(kept, x):
        spread = sum(int(n * a - s) ** 2 for a, s in zip(gap, sums))
        deviation.setdefault(d, []).append(spread if spread < 2**63 else None)
    order = lambda xs: sorted(xs, key=lambda v: (v is None, v or 0))
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
        assert r["n"] == n and r["identity_error"] <= 1e-4
    for j in real:
        rows_ = by[j + 1]
        assert rows_[0]["explained"] == pytest.approx(values[j] / values.sum(), rel=1e-6)
        alone = all(abs(values[j] - values[i]) > 1e-6 * values[0] for i in range(dim) if i != j)
        if alone:
            want = c @ vectors_[:, j] / math.sqrt(values[j])
            have = [r["whitened"] for r in rows_]
            assert sorted(np.abs(have)) == pytest.approx(sorted(np.abs(want)), rel=1e-6, abs=1e-6)
        for d in deviation:
            assert order(r["deviation"] for r in rows_ if r["vec_id"] == d) == order(deviation[d])
    return got


def test_whitening_of_random_rows(spark):
    r = np.random.default_rng(0)
    x = (r.normal(size=(300, 12)) * np.linspace(2, 0.1, 12)) @ np.linalg.qr(r.normal(size=(12, 12)))[0] + 3
    check_whitening(spark, [(i, v.astype("f4").tolist()) for i, v in enumerate(x)])


def test_whitening_of_dependent_constant_and_repeated_rows(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(120, 3))
    x = np.column_stack((x, np.zeros(120), x[:, 0], np.ones(120)))  # copies and constants: three components only at full length
    rows = [(i % 7 or None, v.astype("f4").tolist()) for i, v in enumerate(x)] + [(5, x[0].astype("f4").tolist())] * 90
    got = check_whitening(spark, rows)
    assert {r["component"] for r in got} == {1, 2, 3}


def test_whitening_of_equal_variances(spark):
    rows = [(i, [float((i >> j) & 1) for j in range(4)]) for i in range(16)]
    got = check_whitening(spark, rows)
    assert len(got) == 64 and {round(r["explained"], 9) for r in got} == {0.25}


def test_whitening_of_odd_tables(spark):
    odd = [(1, None), (2, []), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]), (6, [1.0])]
    assert whitening.whiten(vectors(spark, odd)).count() == 0
    assert whitening.whiten(vectors(spark, odd).limit(0)).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0])] * 5)).count() == 0
    check_whitening(spark, odd + [(7, [1.0, 2.0]), (8, [2.0, 2.5]), (9, [0.0, 7.0]), (9, [-3.0, 7.0])])
    check_whitening(spark, [(1, [3e3, 1.0]), (2, [-3e3, 2.0]), (3, [3e3, 4.0]), (None, [1.0, 1.0])])
    huge = whitening.whiten(vectors(spark, [(1, [3e37, 1.0]), (2, [-3e37, 2.0]), (3, [0.0, 4.0])])).collect()
    assert huge and all(np.isfinite(r["whitened"]) for r in huge) and any(r["deviation"] is None for r in huge)
