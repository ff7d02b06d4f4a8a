"""Suffix, phrase and SimHash dedup against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from rows import clashing, ordered, passages

import __spark_entry__ as entry
from riskspark.llm import components, phrase_dedup, repeats, simhash, suffix_dedup
from riskspark.llm.base import table
from riskspark.llm.queries_dedup import digested


def brute_suffix(docs, length):
    seen, out, key = defaultdict(int), [], xxhash.xxh3_128_digest
    bodies = [(d, (t or "").encode()) for d, t in docs]
    for _, b in bodies:
        for i in range(len(b) - length + 1):
            seen[key(b[i : i + length])] += 1
    for d, b in bodies:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[key(b[i : i + length])] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def brute_phrases(docs, length):
    first, out = {}, []
    split = [(d, (t or "").encode().split()) for d, t in docs]
    for d, w in split:
        for i in range(len(w) - length + 1):
            if d is not None:
                k = tuple(w[i : i + length])
                first[k] = min(first.get(k, d), d)
    for d, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if d is not None and first[tuple(w[i : i + length])] < d:
                gone[i : i + length] = [True] * length
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def by_key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, "" if x is None else x) for x in r))


@pytest.mark.parametrize("seed,length", [(5, 24), (6, 40)])
def test_suffix_dedup(spark, seed, length):
    docs = passages(seed)
    got = ordered(digested(suffix_dedup.remove_repeats(clashing(spark, docs), length)))
    want = by_key(brute_suffix(docs, length))
    assert got == want
    assert sum(r[2] for r in want) > 0 and sum(r[1] - r[2] for r in want) > 0


def test_suffix_dedup_at_the_threshold_of_the_query(spark):
    r = random.Random(1)
    word = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    shared, nearly = word(700), word(399)
    docs = [(1, word(300) + shared + word(50)), (2, shared[100:620] + word(500)), (3, word(600) + nearly), (4, nearly + word(10)),
            (5, "é" * 450), (6, "ab" * 5000), (7, shared), (8, shared), (9, ""), (10, None)]
    got = ordered(digested(suffix_dedup.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), 400)))
    assert got == by_key(brute_suffix(docs, 400))


def test_queries_over_whole_documents(spark):
    """The registered queries without SQL, over every document of a test table."""
    folder = "/root/testdata/sf0.01"
    docs = [(r["doc_id"], r["text"]) for r in table(spark, folder, "documents").collect()]
    assert ordered(entry.queries()["op3_suffix_dedup"](spark, folder)) == by_key(brute_suffix(docs, 400))
    assert ordered(entry.queries()["op6_simhash"](spark, folder)) == by_key(brute_groups(docs))


def test_suffix_dedup_keeps_bytes(spark):
    docs = spark.createDataFrame([(1, "x" * 30 + "unique"), (2, "x" * 30)], "doc_id long, text string")
    kept = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.remove_repeats(docs, 24).collect()}
    assert kept == {1: b"unique", 2: b""}


@pytest.mark.parametrize("seed,length", [(5, 6), (7, 13)])
def test_phrase_dedup(spark, seed, length):
    docs = passages(seed)
    got = ordered(digested(phrase_dedup.remove_passages(clashing(spark, docs), length)))
    want = by_key(brute_phrases(docs, length))
    assert got == want
    assert sum(r[2] for r in want) > 0


def test_phrase_dedup_with_tiny_automata(spark):
    docs = [(i, t) for i, (_, t) in enumerate(passages(9))]
    got = ordered(digested(phrase_dedup.remove_passages(clashing(spark, docs), 6, automaton_chars=50)))
    assert got == by_key(brute_phrases(docs, 6))


def test_phrase_stage_returns_the_columns_of_documents(spark):
    docs = [(i, t) for i, (_, t) in enumerate(passages(9))]
    df = clashing(spark, docs)
    out = phrase_dedup.without_passages(df, 6)
    assert out.columns == df.columns
    want = {d: (n, h) for d, _, n, h in brute_phrases(docs, 6)}
    for r in out.collect():
        n, digest = want[r["doc_id"]]
        text = dict(docs)[r["doc_id"]]
        if n:
            assert hashlib.sha256(r["text"].encode()).hexdigest() == digest and r["n_chars"] == len(r["text"])
        else:
            assert r["text"] == text and r["n_chars"] == len(text or "")


def test_runs_do_not_depend_on_pieces(monkeypatch):
    order = np.random.default_rng(0).integers(0, 1 << 62, 5000).astype(np.uint64)
    order[1000:1400] = 7
    whole = repeats.runs(lambda a, b: order[a:b], 4900, 32)
    monkeypatch.setattr(repeats, "_STEP", 100)
    assert all((x == y).all() for x, y in zip(whole, repeats.runs(lambda a, b: order[a:b], 4900, 32)))


def near_copies(n=300, seed=5):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(50)]
    base = [[r.choice(words) for _ in range(200)] for _ in range(20)]
    out = []
    for i in range(n):
        b = list(r.choice(base))
        for _ in range(r.randrange(4)):
            b[r.randrange(200)] = r.choice(words)
        out.append((i, r.choice([None, "", " ", "a b", "One"]) if i % 40 == 0 else " ".join(b)))
    return out


def brute_print(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def brute_groups(docs, roots=False):
    prints, root = [brute_print(t) for _, t in docs], list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[max(find(i), find(j))] = min(find(i), find(j))
    if roots:
        return {find(i) for i in range(len(docs))}
    members = defaultdict(list)
    for i, (d, _) in enumerate(docs):
        members[find(i)].append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in members.items()}
    return [(d, f"{prints[i]:016x}", least[find(i)]) for i, (d, _) in enumerate(docs)]


def test_simhash_groups(spark):
    docs = near_copies()
    got = ordered(simhash.near_duplicates(clashing(spark, docs)))
    want = by_key(brute_groups(docs))
    assert got == want and len({r[2] for r in want}) < len({r[1] for r in want}) < len(docs)
    kept = simhash.keep_first(clashing(spark, docs))
    assert kept.columns == clashing(spark, docs).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r[2] for r in want})


def test_simhash_with_null_and_equal_ids(spark):
    docs = [(None if i % 7 == 0 else i // 2, t) for i, t in near_copies(80)] + [(None, "quite alone here today")] * 2
    assert ordered(simhash.near_duplicates(clashing(spark, docs))) == by_key(brute_groups(docs))
    assert simhash.keep_first(clashing(spark, docs)).count() == len(brute_groups(docs, roots=True))


def test_covering_masks_meet_every_pair_within_the_radius():
    masks = [m % (1 << 64) for m in simhash.covering_masks(2)]
    for i in range(64):
        for j in range(64):
            assert any((1 << i | 1 << j) & m == 0 for m in masks)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (300, 300)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}


@pytest.mark.parametrize("call", [suffix_dedup.remove_repeats, phrase_dedup.remove_passages, simhash.near_duplicates])
def test_empty_tables(spark, call):
    assert call(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("name,module,operator", [("op3_suffix_dedup", suffix_dedup, "remove_repeats"), ("op9_substring_dedup", phrase_dedup, "remove_passages")])
def test_queries_digest_the_text_that_the_operator_returns(spark, monkeypatch, name, module, operator):
    """The operator is asked for its whole output, and the digest is that of the text in it."""
    made, run = [], getattr(module, operator)

    def whole(*args, **kwargs):
        made.append(run(*args, **kwargs))
        return made[-1]

    monkeypatch.setattr(module, operator, whole)
    got = entry.queries()[name](spark, "/root/testdata/sf0.001")
    kept = {r["doc_id"]: bytes(r["kept"]) if name.startswith("op3") else r["kept"].encode() for r in made[0].collect()}
    assert {r["doc_id"]: r["kept_sha256"] for r in got.collect()} == {k: hashlib.sha256(t).hexdigest() for k, t in kept.items()}
    assert [c for c in made[0].columns if c != "kept"] + ["kept_sha256"] == got.columns
