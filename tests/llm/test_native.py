"""Decontamination, sharding and licence scan against SQL, and their odd cases."""

import random

import pytest
from oracle_check import compare, connect
from rows import clashing, ordered

import __spark_entry__ as entry
from riskspark.llm import decontaminate, licenses, phrases, sharding
from riskspark.llm.base import keyed

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_query_equals_sql(spark, name):
    assert compare(entry.queries()[name](spark, SF), connect(SF).sql(entry.oracle_sql()[name])) is None


def brute_hits(docs, items, length):
    import hashlib
    import re

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    out = []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for item, it in items:
            v = words(it)
            for s in range(max(len(v) - length, 0) + 1) if v else ():
                win = v[s : s + length]
                for i in range(len(w) - len(win) + 1):
                    if w[i : i + len(win)] == win:
                        hit.update(range(i, i + len(win)))
                        if item is not None:
                            ids.add(str(item))
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("most_bytes", [1 << 24, 0])
def test_contamination(spark, most_bytes):
    r = random.Random(3)
    w = [f"w{i}" for i in range(6)] + ["É", "é", "K", "o'b"]
    text = lambda n: r.choice([" ", ", ", "--"]).join(r.choice(w) for _ in range(n))
    items = [(i, text(r.choice([1, 2, 4, 5, 9]))) for i in range(12)] + [(20, None), (21, ""), (3, "w1 w2 w3"), (None, "w0 w0 w0 w0"), (22, "W1 w2 W3")]
    docs = [(i, text(r.randrange(40))) for i in range(40)] + [(None, "w1 w2 w3 w4"), (5, None), (5, ""), (5, "..."), (7, "w1 w2 w3"), (7, "w1 w2 w3")]
    got = ordered(decontaminate.contamination(clashing(spark, docs), spark.createDataFrame(items, "item_id long, text string"), 4, most_bytes=most_bytes))
    assert got == sorted(brute_hits(docs, items, 4), key=lambda x: tuple((v is None, "" if v is None else v) for v in x))


def test_contamination_without_rows(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    docs = clashing(spark, [(1, "a b c d"), (2, "x"), (None, "a b c"), (2, "x")])
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert [r["n_hit"] for r in decontaminate.contamination(docs, items.limit(0)).collect()] == [0] * 4
    kept = decontaminate.uncontaminated(docs, items)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [2, 2]


def test_licences(spark):
    grant = "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"
    docs = [(1, "Released under the MIT License. See MIT-license, or mit  license"), (2, None), (2, ""), (None, "GNU General\nPublic License; Apache License"),
            (3, grant + " etc"), (4, "x permission is hereby granted free of charge to nobody"), (5, "CC BY 4.0"), (5, "CC BY 4.0"), (6, "mit licenses permission is hereby")]
    got = {(r["doc_id"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"]): r["score"] for r in licenses.scan(clashing(spark, docs)).collect()}
    assert got[(1, 3, 3, 9, "mit", "mit")] == 1.0
    assert got[(None, 2, 0, 4, "apache,gpl", "apache,gpl")] == 1.0
    assert got[(3, 0, None, None, "", "mit")] == 1.0
    assert got[(4, 0, None, None, "", "mit")] == pytest.approx(8 / 20)
    assert got[(5, 1, 0, 0, "cc-by", "cc-by")] == 1.0 and got[(6, 0, None, None, "", "")] == 0.0 and got[(2, 0, None, None, "", "")] == 0.0
    assert licenses.scan(clashing(spark, docs).limit(0)).count() == 0


def test_the_rarest_word_is_in_the_fewest_texts(spark):
    docs = spark.createDataFrame([(1, "often often often often seldom"), (2, "seldom"), (3, "seldom")], "doc_id long, text string")
    wanted = spark.createDataFrame([(0, ["seldom", "often"])], "id long, arr array<string>")
    assert [(r["token"], r["off"]) for r in phrases.rarest_words(wanted, keyed(docs)).collect()] == [("often", 1)]


def check_shards(rows, limit, sizes):
    total, count = {}, {}
    for r in rows:
        total[r["shard"]] = total.get(r["shard"], 0) + r["n_bytes"]
        count[r["shard"]] = count.get(r["shard"], 0) + 1
    for r in rows:
        assert (total[r["shard"]], count[r["shard"]]) == (r["shard_bytes"], r["shard_rows"])
        assert r["shard_bytes"] <= limit or r["shard_rows"] == 1
    assert sorted(r["n_bytes"] for r in rows) == sorted(sizes)
    leaves = {s for s in total if "+" not in s}
    assert not any(a != b and b.startswith(a) for a in leaves for b in leaves)


def test_shards_with_equal_rows_and_large_rows(spark):
    r = random.Random(4)
    docs = [(i, "x" * r.randrange(60)) for i in range(200)] + [(None, "copy of a row")] * 50 + [(7, None), (7, "")] + [(900, "é" * 300)]
    rows = sharding.assign(clashing(spark, docs), 100).collect()
    check_shards(rows, 100, [len((t or "").encode()) for _, t in docs])
    assert any("+" in x["shard"] for x in rows) and max(x["depth"] for x in rows if "+" not in x["shard"]) > 8


def test_shards_of_small_and_empty_tables(spark):
    docs = clashing(spark, [(1, "ab"), (2, "c")])
    assert {(r["shard"], r["depth"], r["shard_bytes"]) for r in sharding.assign(docs, 100).collect()} == {("", 0, 3)}
    assert sharding.assign(docs.limit(0), 100).count() == 0


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, "y" * 10) for i in range(100)], "doc_id long, text string")
    shards = sharding.write_shards(docs, str(tmp_path / "s"), 200).collect()
    assert sum(r["rows"] for r in shards) == 100 and max(r["rows"] for r in shards) <= 20


def test_written_shards_keep_null_and_repeated_ids(spark, tmp_path):
    docs = [(i, f"{i} " + "y" * 8) for i in range(60)] + [(None, "no id at all")] * 5 + [(None, None), (7, "z" * 9), (7, None)] + [(8, f"{i} of one id") for i in range(40)]
    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(docs)], "doc_id long, text string, n int").repartition(4)
    path = str(tmp_path / "s")
    shards = {r["shard"]: r["rows"] for r in sharding.write_shards(df, path, 60).collect()}
    rows = spark.read.schema("doc_id long, text string, n int, _shard string").parquet(path).collect()
    assert sorted((r["n"], r["doc_id"], r["text"]) for r in rows if r["doc_id"] is not None and r["text"] is not None) == [
        (i, k, t) for i, (k, t) in enumerate(docs) if k is not None and t is not None]
    assert sorted(r["n"] for r in rows) == list(range(len(docs)))
    held = {}
    for r in rows:
        held.setdefault(r["_shard"], []).append(len((r["text"] or "").encode()))
    assert shards == {s: len(v) for s, v in held.items()} and all(sum(v) <= 60 for v in held.values())


def test_written_shards_of_small_and_empty_tables(spark, tmp_path):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id long, text string")
    assert [tuple(r) for r in sharding.write_shards(df, str(tmp_path / "one"), 100).collect()] == [("", 3)]
    assert sharding.write_shards(df.limit(0), str(tmp_path / "none"), 100).collect() == []

