"""Pattern growth and the rule index against brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from riskspark.operators import patterns


def table(spark, lists):
    return spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "id bigint, items array<string>").repartition(4)


def naive(lists, least):
    """Level by level over all candidate sets."""
    sets = [set(x) for x in lists if x]
    found, level = {}, [(i,) for i in sorted(set().union(*sets))] if sets else []
    while level:
        kept = []
        for c in level:
            n = sum(s.issuperset(c) for s in sets)
            if n >= least:
                found[c] = n
                kept.append(c)
        level = sorted({tuple(sorted({*a, *b})) for a, b in itertools.combinations(kept, 2) if len({*a, *b}) == len(a) + 1})
        level = [c for c in level if all(tuple(x for x in c if x != y) in found for y in c)]
    return found


def baskets_of_forty(seed=1, n=300):
    """Forty items a basket out of 300, with a few groups of items that often come together, and copies."""
    r = random.Random(seed)
    names = [f"i{k:03d}" for k in range(300)]
    groups = [r.sample(names, 6) for _ in range(5)]
    out = []
    for _ in range(n):
        mine = set(r.choice(groups)) | set(r.choice(groups))
        mine |= set(r.sample(names, 40 - len(mine)))
        out.append(sorted(mine))
    return out + [out[0]] * 60 + [None, []]


@pytest.mark.parametrize("shard", [10**6, 50, 1])
def test_itemsets_of_long_baskets(spark, shard):
    lists = baskets_of_forty()
    got = patterns.frequent_itemsets(table(spark, lists), 0.2, shard_prefixes=shard).collect()
    least = patterns.least_count(len(lists), 0.2)
    want = naive(lists, least) if shard > 100 else None
    mine = {tuple(r["items"]): r["freq"] for r in got}
    assert len(mine) == len(got) and all(r["size"] == len(r["items"]) and r["support"] == r["freq"] / len(lists) for r in got)
    if want is not None:
        assert max(map(len, want)) >= 5
        test_itemsets_of_long_baskets.want = want
    assert mine == test_itemsets_of_long_baskets.want


def test_odd_baskets(spark):
    assert patterns.frequent_itemsets(table(spark, [None, []]), 0.1).count() == 0
    assert patterns.frequent_itemsets(table(spark, [["a"]]).limit(0), 0.1).count() == 0
    got = {tuple(r["items"]): r["freq"] for r in patterns.frequent_itemsets(table(spark, [["a", "a", None], ["b", "a"], None]), 0.5).collect()}
    assert got == {("a",): 2}


def test_least_count_is_the_border():
    for n in (1, 3, 7, 100, 999):
        for s in (0.0, 0.01, 0.1, 1 / 3, 0.5, 1.0):
            c = patterns.least_count(n, s)
            assert c >= 1 and c / n >= s and (c == 1 or (c - 1) / n < s)


@pytest.mark.parametrize("most_bytes", [64 << 20, 0])
def test_many_rules_against_every_pair(spark, most_bytes):
    r = random.Random(2)
    lists = baskets_of_forty(3, 60) + [["x"], []]
    rules = [r.sample(r.choice(lists[:60]), r.choice([1, 1, 2, 3])) for _ in range(3000)] + [["x"], ["x", "nowhere"], [], ["x", "x"]]
    made = spark.createDataFrame(list(enumerate(rules)), "rule int, antecedent array<string>").repartition(3)
    got = patterns.rule_matches(table(spark, lists), made, most_bytes=most_bytes).collect()
    mine = sorted((tuple(x["items"]), x["rule"]) for x in got)
    different = {tuple(x) for x in lists if x is not None}
    assert mine == sorted((b, i) for b in different for i, a in enumerate(rules) if set(a) <= set(b))


def test_a_hundred_thousand_rules_are_one_plan(spark):
    lists = baskets_of_forty(4, 40)
    made = spark.range(100_000).select(F.col("id").alias("rule"), F.array(*[F.format_string("i%03d", F.pmod(F.xxhash64("id", F.lit(s)), F.lit(300))) for s in (1, 2)]).alias("antecedent"))
    scores = patterns.rule_scores(table(spark, lists), made, "id").select("id", "score").collect()
    rules = [set(x["antecedent"]) for x in made.collect()]
    assert len(scores) == len(lists)
    for x in sorted(scores, key=lambda x: x["id"])[::9]:
        assert x["score"] == (sum(a <= set(lists[x["id"]]) for a in rules) if lists[x["id"]] is not None else 0)
