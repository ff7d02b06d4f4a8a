"""Frequent itemsets by pattern growth over shards, and matching of many rules by an inverted item index."""

from __future__ import annotations

import math
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.plans.scratch import persist_table
from riskspark.plans.skew import BROADCAST_BYTES, file_bytes, lookup_join

#: Distinct prefixes of a shard that one task may hold.
SHARD_PREFIXES = 50_000


# ---- frequent itemsets ----------------------------------------------------------------------------------------------

def least_count(n: int, min_support: float) -> int:
    """The smallest count c of at least 1 with c / n >= min_support."""
    c = max(1, math.ceil(min_support * n) - 1)
    while c / max(n, 1) < min_support:
        c += 1
    return c


class PrefixTree:
    """Weighted item lists merged along equal beginnings; ``header`` has the nodes of each item."""

    def __init__(self, lists, least: int):
        total: dict = defaultdict(int)
        for items, c in lists:
            for i in items:
                total[i] += c
        self.total = {i: c for i, c in total.items() if c >= least}
        self.parent, self.item, self.count, self.header = [-1], [None], [0], defaultdict(list)
        children: dict = {}
        for items, c in lists:
            node = 0
            for i in sorted((i for i in items if i in self.total), key=lambda i: (-self.total[i], i)):
                nxt = children.get((node, i))
                if nxt is None:
                    nxt = children[node, i] = len(self.item)
                    self.parent.append(node), self.item.append(i), self.count.append(0)
                    self.header[i].append(nxt)
                self.count[nxt] += c
                node = nxt

    def beginnings(self, item):
        """The lists above each node of ``item``, with its count."""
        for node in self.header[item]:
            above, at = [], self.parent[node]
            while at:
                above.append(self.item[at])
                at = self.parent[at]
            if above:
                yield above, self.count[node]


def grow(lists, least: int, suffix: tuple = ()):
    """(items, count) of every non-empty item set with enough count in weighted lists, each with ``suffix`` added."""
    open_ = [(list(lists), suffix)]
    while open_:
        part, tail = open_.pop()
        tree = PrefixTree(part, least)
        for item, count in tree.total.items():
            yield (item, *tail), count
            above = list(tree.beginnings(item))
            if above:
                open_.append((above, (item, *tail)))


def frequent_itemsets(baskets: DataFrame, min_support: float, shard_prefixes: int = SHARD_PREFIXES) -> DataFrame:
    """(items, size, freq, support) of all itemsets with enough support; ``items`` of a basket are distinct, their order does not matter.

    Items are numbered by falling count, and a basket becomes its frequent numbers in rising order. The shard of a suffix holds the
    distinct beginnings before it with their counts: a set is found in exactly one shard, that of its largest number. A shard of at most
    ``shard_prefixes`` beginnings is mined in one task with conditional prefix trees; a larger one is split by every number
    that can be added to its suffix, until all are small. The first shard is that of the empty suffix, all distinct baskets. A NULL or empty basket counts as a row without items. At most (mean basket
    size / min_support) items are frequent, so the item table is small whatever the number of rows.
    """
    spark = baskets.sparkSession
    schema = "items array<string>, size int, freq bigint, support double"
    counts = persist_table(baskets.groupBy(F.array_distinct(F.array_compact("items")).alias("items")).agg(F.count("*").alias("c")), "baskets")
    n, lists_ = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.size("items") > 0)).first()
    least = least_count(n, min_support)
    counts = counts.where(F.size("items") > 0)
    share = (F.col("freq") / F.lit(float(max(n, 1)))).alias("support")

    def whole(table):
        sets = list(grow(list(zip(table.column("items").to_pylist(), table.column("c").to_pylist())), least))
        return pa.table([pa.array([sorted(s) for s, _ in sets], pa.list_(pa.string())), pa.array([c for _, c in sets], pa.int64())], names=["items", "freq"])

    if lists_ <= shard_prefixes:  # the shard of the empty suffix is small already
        sets = counts.withColumn("shard", F.lit("")).groupBy("shard").applyInArrow(whole, "items array<string>, freq bigint")
        return sets.select("items", F.size("items").alias("size"), "freq", share)
    items = counts.select(F.explode("items").alias("item"), "c").groupBy("item").agg(F.sum("c").alias("c"))
    names = [r["item"] for r in items.where(F.col("c") >= least).orderBy(F.desc("c"), "item").collect()]
    if not names:
        return spark.createDataFrame([], schema)
    number = spark.sparkContext.broadcast({v: i for i, v in enumerate(names)})

    def numbered(batches):
        known = number.value
        for b in batches:
            lists = [sorted({known[x] for x in v if x in known}) for v in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32())), b.column(1)], ["prefix", "c"])

    rows = counts.select("items", "c").mapInArrow(numbered, "prefix array<int>, c bigint").where(F.size("prefix") > 0)
    rows = rows.groupBy("prefix").agg(F.sum("c").alias("c")).select(F.array().cast("array<int>").alias("suffix"), "prefix", "c")
    found, small = [], []
    while rows is not None:
        at = F.posexplode("prefix").alias("at", "item")
        grown = rows.select("suffix", "prefix", "c", at)
        grown = grown.select(F.concat(F.array("item"), "suffix").alias("suffix"), F.expr("slice(prefix, 1, at)").alias("prefix"), "c")
        grown = persist_table(grown.groupBy("suffix", "prefix").agg(F.sum("c").alias("c")), "shards")
        sizes = grown.groupBy("suffix").agg(F.sum("c").alias("freq"), F.count_if(F.size("prefix") > 0).alias("prefixes")).where(F.col("freq") >= least)
        sizes = persist_table(sizes, "suffixes")
        found.append(sizes.select("suffix", "freq"))
        ahead = grown.where(F.size("prefix") > 0)
        small.append(ahead.join(sizes.where((F.col("prefixes") <= shard_prefixes) & (F.col("prefixes") > 0)).select("suffix"), "suffix", "left_semi"))
        large = sizes.where(F.col("prefixes") > shard_prefixes).select("suffix")
        rows = None if large.limit(1).count() == 0 else ahead.join(large, "suffix", "left_semi")

    def mine(key, table):
        tail = tuple(key[0].as_py())
        lists = zip(table.column("prefix").to_pylist(), table.column("c").to_pylist())
        sets = list(grow(lists, least, tail))
        return pa.table([pa.array([list(s) for s, _ in sets], pa.list_(pa.int32())), pa.array([c for _, c in sets], pa.int64())], names=["suffix", "freq"])

    for part in small:
        found.append(part.groupBy("suffix").applyInArrow(mine, "suffix array<int>, freq bigint"))
    sets = found[0]
    for part in found[1:]:
        sets = sets.unionByName(part)
    label = F.array(*[F.lit(v) for v in names])
    named = F.sort_array(F.transform("suffix", lambda i: F.element_at(label, i + 1)))
    return sets.select(named.alias("items"), F.size("suffix").alias("size"), "freq", share)


# ---- rule match -----------------------------------------------------------------------------------------------------

def rule_matches(baskets: DataFrame, rules: DataFrame, rule: str = "rule", antecedent: str = "antecedent", most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(items, rule): every distinct basket of ``baskets`` with each rule whose items it holds all; a rule without items matches every basket.

    Each rule is posted under the one of its items that the fewest baskets hold, so a basket meets only the rules posted under its own
    items. The postings are broadcast if their stored size allows, else joined by a shuffle; a candidate is then checked in its row.
    """
    distinct = persist_table(baskets.where(F.col("items").isNotNull()).groupBy("items").agg(F.count("*").alias("n")), "distinct")
    listed = rules.select(F.col(rule).alias("rule"), F.array_distinct(F.array_compact(antecedent)).alias("needed")).where(F.col("needed").isNotNull())
    place = lambda c: F.transform(F.array_compact(c), lambda i: F.concat(F.lit("="), i))
    held = distinct.select(F.explode(F.array_distinct(place("items"))).alias("item"), "n").groupBy("item").agg(F.sum("n").alias("n"))
    each = listed.where(F.size("needed") > 0).select("rule", "needed", F.explode(place("needed")).alias("item"))
    rarest = each.join(held, "item", "left").groupBy("rule", "needed").agg(
        F.min(F.struct("n", "item")).alias("first"), F.count("n").alias("known"), F.count("*").alias("all"))
    empty = listed.where(F.size("needed") == 0).select("rule", "needed", F.lit("").alias("item"))
    postings = persist_table(rarest.where("known = all").select("rule", "needed", F.col("first.item").alias("item")).unionByName(empty), "postings")
    side = F.broadcast(postings) if file_bytes(postings) <= most_bytes else postings
    met = distinct.select("items", F.explode(F.concat(F.array_distinct(place("items")), F.array(F.lit("")))).alias("item")).join(side, "item")
    return met.where(F.size(F.array_except("needed", "items")) == 0).select("items", "rule")


def rule_scores(baskets: DataFrame, rules: DataFrame, spread_by: str, rule: str = "rule", antecedent: str = "antecedent", out: str = "score") -> DataFrame:
    """``baskets`` with the number of rules that each row satisfies (0 for a NULL basket): distinct baskets are matched once and looked up."""
    matched = rule_matches(baskets, rules, rule, antecedent).groupBy("items").agg(F.count("*").cast("int").alias("_matched"))
    counts = baskets.groupBy("items").agg(F.count("*").alias("_rows"))
    stats = counts.join(matched, "items").select("items", "_rows", "_matched")
    return lookup_join(baskets, stats, ["items"], "_rows", F.col(spread_by)).withColumn(out, F.coalesce("_matched", F.lit(0))).drop("_rows", "_matched")
