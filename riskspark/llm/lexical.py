"""Ranked lexical search: the best documents of every query text by a term-weight score, with the Best Position Algorithm.

Documents are read once into a forward index of the terms that the queries hold. Each Arrow batch of that index is a shard with an
impact list per term, highest impact first. A query reads its lists in parallel; every document that it meets is scored at once
by direct accesses to all its lists, and these accesses mark its place in each of them. The best position of a list is the end of
its unbroken run of seen places. No unseen document can score more than the sum of the impacts at the best positions, so
the query stops as soon as that sum is strictly below its k-th score so far; at equality it goes on, since ties are
decided by the document id. The k-th score goes from shard to shard of a task; the best of all tasks are merged by a window.

Queries are taken in blocks of bounded vocabulary, so that what is sent to all tasks does not grow with the number of queries.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.base import DOC, ROW, column, forget, keyed, stored, tidy
from riskspark.llm.words import APART, words

#: Distinct terms of all queries of one block, in expectation: what a block broadcasts.
BLOCK_TERMS = 200_000
#: Postings of one shard, and bytes of text that are cut into words at a time.
SHARD_POSTINGS, TEXT_BYTES = 2_000_000, 8 << 20

_INDEX = T.StructType([T.StructField(ROW, T.LongType()), T.StructField(DOC, T.LongType()), T.StructField("n", T.LongType()),
                       T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])
_FOUND = T.StructType([T.StructField(n, T.LongType()) for n in ("item", ROW, DOC, "score")])


def _pieces(text: pa.Array, most: int):
    """(start, length) of consecutive runs of a string array, each of at most ``most`` bytes or one text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(text):
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield at, stop - at
        at = stop


def term_counts(text: pa.Array, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, offsets, term numbers, occurrences): the terms of each text that the vocabulary has, by number."""
    parts = pc.split_pattern_regex(pc.ascii_lower(text), APART)
    flat = parts.flatten()
    owner = np.repeat(np.arange(len(text)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    n = np.bincount(owner[full], minlength=len(text)).astype(np.int64)
    number = pc.fill_null(pc.index_in(flat, value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    known = number >= 0
    both, counts = np.unique(owner[known] * max(1, len(vocabulary)) + number[known], return_counts=True)
    holder, term = np.divmod(both, max(1, len(vocabulary)))
    offsets = np.zeros(len(text) + 1, dtype=np.int32)
    offsets[1:] = np.cumsum(np.bincount(holder, minlength=len(text)))
    return n, offsets, term.astype(np.int32), counts.astype(np.int32)


def forward_index(rows: DataFrame, vocabulary) -> DataFrame:
    """(_row, _doc, n, terms, counts) of every keyed row with at least one term; ``vocabulary`` is a broadcast list of terms."""

    def scan(batches):
        known = pa.array(vocabulary.value, pa.string())
        for b in batches:
            text = column(b, "text").cast(pa.string())
            for at, size in _pieces(text, TEXT_BYTES):
                n, offsets, terms, counts = term_counts(text.slice(at, size), known)
                lists = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (terms, counts)]
                out = pa.RecordBatch.from_arrays([column(b, ROW).slice(at, size), column(b, DOC).slice(at, size), pa.array(n), *lists], _INDEX.fieldNames())
                yield out.filter(pa.array(n > 0))

    return rows.select(ROW, DOC, "text").mapInArrow(tidy(scan), _INDEX)


class Shard:
    """Impact lists over some documents: for each term the postings by falling impact, for each document its postings."""

    def __init__(self, n: np.ndarray, offsets: np.ndarray, terms: np.ndarray, counts: np.ndarray, weights: np.ndarray, total: int, words: int):
        size = np.diff(offsets)
        m = 100 - 50 + (50 * n.astype(np.int64) * total) // words
        tf = counts.astype(np.int64)
        self.offsets, self.terms = offsets, terms
        self.impact = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, size)))
        holder = np.repeat(np.arange(len(n)), size)
        by_list = np.lexsort((-self.impact, terms))
        self.doc, self.falling = holder[by_list], self.impact[by_list]
        self.place = np.empty(len(terms), dtype=np.int64)
        self.place[by_list] = np.arange(len(terms))
        self.start = np.searchsorted(terms[by_list], np.arange(len(weights) + 1))
        self.seen = np.full(len(terms), -1, dtype=np.int64)
        self.scored = np.full(len(n), -1, dtype=np.int64)
        self.wanted = np.zeros(len(weights), dtype=bool)

    def direct(self, docs: np.ndarray, stamp: int) -> np.ndarray:
        """Scores of ``docs`` from all wanted lists; their places there count as seen."""
        size = self.offsets[docs + 1] - self.offsets[docs]
        first = np.cumsum(size) - size
        at = np.arange(size.sum()) - np.repeat(first - self.offsets[docs], size)
        mine = self.wanted[self.terms[at]]
        self.seen[self.place[at[mine]]] = stamp
        return np.add.reduceat(np.where(mine, self.impact[at], 0), first)

    def best_position(self, at: int, end: int, stamp: int) -> int:
        """The first place from ``at`` on that is not seen."""
        while at < end:
            run = self.seen[at : min(end, at + 1024)] == stamp
            if not run.all():
                return at + int(run.argmin())
            at += len(run)
        return end


class Best:
    """The k best (score, document) of one query so far: score descending, then id ascending with null last, then row."""

    def __init__(self, k: int):
        self.k, self.score, self.id, self.row = k, np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)
        self.none = np.zeros(0, dtype=bool)

    def kth(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else -1

    def add(self, score: np.ndarray, none: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        good = score >= max(1, self.kth())
        if good.any():
            self.score, self.none = np.concatenate((self.score, score[good])), np.concatenate((self.none, none[good]))
            self.id, self.row = np.concatenate((self.id, ids[good])).astype(np.int64), np.concatenate((self.row, rows[good]))
            order = np.lexsort((self.row, self.id, self.none, -self.score))[: self.k]
            self.score, self.none, self.id, self.row = self.score[order], self.none[order], self.id[order], self.row[order]


def search(shard: Shard, query: np.ndarray, best: Best, none: np.ndarray, ids: np.ndarray, rows: np.ndarray, stamp: int, step: int = 64) -> int:
    """Best Position Algorithm for one query over one shard; returns how many documents were scored."""
    query = query[shard.start[query + 1] > shard.start[query]]
    if not len(query):
        return 0
    shard.wanted[:] = False
    shard.wanted[query] = True
    at, end = shard.start[query].copy(), shard.start[query + 1]  # at: the first place of each list that is not known to be seen
    read, touched = at.copy(), 0
    limit = int(shard.falling[at].sum())  # nothing is seen yet: no document can have more than the heads of all lists
    while limit >= max(1, best.kth()):
        upto = np.minimum(read + step, end)
        docs = np.unique(np.concatenate([shard.doc[a:b] for a, b in zip(read, upto)]))
        docs = docs[shard.scored[docs] != stamp]
        if len(docs):
            shard.scored[docs] = stamp
            touched += len(docs)
            best.add(shard.direct(docs, stamp), none[docs], ids[docs], rows[docs])
        read, step = upto, step * 2
        at = np.array([shard.best_position(int(a), int(e), stamp) for a, e in zip(np.maximum(at, read), end)])
        still = at < end
        if not still.any():
            break
        limit = int(shard.falling[at[still] - 1].sum())
    return touched


def _searched(index: DataFrame, queries, weights, total: int, words_: int, k: int) -> DataFrame:
    """(item, _row, _doc, score): the best ``k`` of each task for every query of the broadcast list (item, term numbers)."""

    def scan(batches):
        asked, w = queries.value, weights.value
        best = [Best(k) for _ in asked]
        stamp = 0
        for b in batches:
            lists, more = column(b, "terms"), column(b, "counts")
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < b.num_rows:
                before = ends[at - 1] if at else 0
                stop = max(at + 1, int(np.searchsorted(ends, before + SHARD_POSTINGS, side="right")))
                offsets = np.concatenate(([0], ends[at:stop] - before))
                flat = [x.slice(at, stop - at).flatten().to_numpy(zero_copy_only=False) for x in (lists, more)]
                take = lambda c: column(b, c).slice(at, stop - at)
                shard = Shard(take("n").to_numpy(), offsets, *flat, w, total, words_)
                none = take(DOC).is_null().to_numpy(zero_copy_only=False)
                ids, rows = take(DOC).fill_null(0).to_numpy(), take(ROW).to_numpy()
                for found, (_, terms) in zip(best, asked):
                    search(shard, terms, found, none, ids, rows, stamp)
                    stamp += 1
                at = stop
        for found, (item, _) in zip(best, asked):
            if len(found.score):
                same = pa.array(np.full(len(found.score), item)), pa.array(found.row), pa.array(found.id, mask=found.none), pa.array(found.score)
                yield pa.RecordBatch.from_arrays(list(same), _FOUND.fieldNames())

    return index.mapInArrow(tidy(scan), _FOUND)


def ranked(docs: DataFrame, items: DataFrame, k: int = 50, text: str = "text", key: str = "doc_id", item_text: str = "text",
           item_key: str = "item_id", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents with the highest score above 0 for each item, all if they are fewer.

    Terms are words lower-cased in A-Z. With N documents that have a term and L terms in all, a term that df of them hold weighs
    floor(1000 ln((2N+2)/(2df+1))); a document of n terms has m = 50 + 50 n N div L, and an item's term that it holds tf times
    adds weight * (10**9 tf div (1000 tf + 20 m)). Equal scores go by ascending id, null ids last.

    A null or empty text has no terms: such a document is neither counted nor found, such an item has no rows. Every row
    of either table is a document or an item of its own, whatever its id; null and repeated ids keep their own ranks. An empty
    table gives an empty table; further columns are not looked at. Texts are read whole, however long.
    """
    spark = docs.sparkSession
    rows = keyed(docs, text, key)
    asked = keyed(items, item_text, item_key).select(F.col(ROW).alias("item"), F.col(DOC).alias("item_id"), F.array_distinct(words(F.col("text"))).alias("terms"))
    asked = stored(asked.where(F.size("terms") > 0), "items")
    blocks = max(1, math.ceil((asked.agg(F.sum(F.size("terms"))).first()[0] or 0) / block_terms))
    found = None
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).select("item", "terms").collect()  # bounded by block_terms
        vocabulary = sorted({t for r in mine for t in r["terms"]})
        number = {t: i for i, t in enumerate(vocabulary)}
        index = stored(forward_index(rows, spark.sparkContext.broadcast(vocabulary)), "index")
        total, all_words = index.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(1))).first()
        held = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
        weights = np.zeros(len(vocabulary), dtype=np.int64)
        for r in held.collect():  # one line per term of the block
            weights[r["term"]] = math.floor(1000 * math.log((2 * total + 2) / (2 * r["df"] + 1)))
        queries = [(r["item"], np.array([number[t] for t in r["terms"]], dtype=np.int64)) for r in mine]
        best = stored(_searched(index, spark.sparkContext.broadcast(queries), spark.sparkContext.broadcast(weights), total, all_words, k), "best")
        forget(index)
        found = best if found is None else found.unionByName(best)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last(DOC), ROW)
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.join(F.broadcast(asked.select("item", "item_id")) if blocks == 1 else asked.select("item", "item_id"), "item").select(
        "item_id", "rank", F.col(DOC).alias("doc_id"), "score")
