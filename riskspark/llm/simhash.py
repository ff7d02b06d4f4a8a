"""SimHash near-dedup with covering locality-sensitive hashing.

Every bit position gets a non-zero vector over GF(2) of radius + 1 bits; each non-zero vector v gives a table whose mask
keeps the positions not orthogonal to v. The vectors of up to ``radius`` differing positions leave some v orthogonal to all
of them, so every pair within the radius agrees on the mask of some table: recall is one by construction.

Fingerprints that collide are linked without listing pairs: each goes to the points within half the radius that a
colliding table allows, and two fingerprints that meet in a point are within the radius. A point is met by a bounded number
of fingerprints, however many copies a group has.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.base import DOC, ROW, carried, column, forget, keyed, stored, texts, tidy
from riskspark.llm.components import components

BITS = 64
_BLOCK = 1 << 15


def fingerprint(text: bytes, size: int = 3, seed: int = 42) -> int:
    """64 bits: bit i is set if it is set in more than half of the shingle hashes; 0 for a text without words."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - size + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    stops = np.cumsum(lengths + 1) - 1
    begin = (stops - lengths)[:n].tolist()
    end = stops[min(size, len(words)) - 1 :][:n].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for s in range(0, n, _BLOCK):
        h = np.array([digest(line[a:b], seed) for a, b in zip(begin[s : s + _BLOCK], end[s : s + _BLOCK])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


_PRINT = T.StructType([T.StructField(ROW, T.LongType()), T.StructField(DOC, T.LongType()), T.StructField("fp", T.LongType())])


def fingerprints(rows: DataFrame, size: int = 3) -> DataFrame:
    """(_row, _doc, fp) with the fingerprint as a signed long."""

    def scan(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t, size) for t in texts(b)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([column(b, ROW), column(b, DOC), pa.array(fp.view(np.int64))], [ROW, DOC, "fp"])

    return rows.select(ROW, DOC, "text").mapInArrow(tidy(scan), _PRINT)


def covering_masks(radius: int) -> list[int]:
    """One mask per non-zero vector of radius + 1 bits, as signed longs."""
    count = (1 << (radius + 1)) - 1
    masks = []
    for v in range(1, count + 1):
        mask = sum(1 << i for i in range(BITS) if ((1 + i % count) & v).bit_count() % 2)
        masks.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return masks


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(a, b): links between different fingerprints of the column ``fp`` that connect exactly those within ``radius`` bits.

    Not every pair is listed: fingerprints that meet in a point are linked to the smallest of them.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    masks = covering_masks(radius)
    distinct = stored(prints.select("fp").distinct(), "prints")
    keyed_ = distinct.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("t", "key"))
    shared = stored(keyed_.groupBy("t", "key").count().where("count > 1").select("t", "key"), "shared")
    tables = keyed_.join(shared, ["t", "key"], "left_semi").groupBy("fp").agg(F.collect_set("t").alias("ts"))

    def flips(m: int) -> list[int]:
        free = [i for i in range(BITS) if not (m >> i) & 1]
        out = [sum(1 << i for i in c) for k in range(radius // 2 + 1) for c in combinations(free, k)]
        return [x - (1 << BITS) if x >> (BITS - 1) else x for x in out]

    by_table = F.array(*[F.array(*[F.lit(x).cast("long") for x in flips(m)]) for m in masks])
    flip = F.array_distinct(F.flatten(F.transform("ts", lambda t: F.element_at(by_table, t + 1))))
    points = tables.select("fp", F.explode(flip).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("x"))
    met = points.groupBy("x").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    out = stored(
        met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b").distinct(), "links"
    )
    forget(distinct, shared)
    return out


def near_groups(rows: DataFrame, size: int = 3, radius: int = 2) -> DataFrame:
    """(_row, _doc, fp, component_id, keeper) for keyed rows: smallest id of the component, and the one row that stays."""
    prints = stored(fingerprints(rows, size), "fingerprints")
    linked = stored(components(links(prints, radius)), "components")
    least = prints.groupBy("fp").agg(F.min(F.struct(F.col(DOC).isNull().alias("none"), DOC, ROW)).alias("first"))
    rooted = least.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    best = stored(rooted.groupBy("root").agg(F.min("first").alias("best")), "best")
    named = stored(rooted.join(best, "root").select("fp", F.col(f"best.{DOC}").alias("component_id"), F.col(f"best.{ROW}").alias("keeper")), "named")
    forget(linked, best)
    return prints.join(named, "fp").select(ROW, DOC, "fp", "component_id", "keeper")


def near_duplicates(docs: DataFrame, size: int = 3, radius: int = 2, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fingerprint, component_id): 16 hex digits and the smallest id reachable over links of ``radius`` bits or fewer.

    Texts are lower-cased in A-Z and cut at ASCII white space into shingles of ``size`` words; a text with fewer words is
    one shingle. Texts that are null, empty or only white space have fingerprint zero and are linked like any other. Rows
    with equal texts share a component, whatever their ids; null ids are members but never the smallest id, so a component
    of null ids alone has a null ``component_id``. Repeated rows each get a line; an empty table gives an empty table; other
    columns are not looked at.
    """
    found = near_groups(keyed(docs, text, key), size, radius)
    return found.select(F.col(DOC).alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, size: int = 3, radius: int = 2, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id (any one of equal ids, null ids last)."""
    whole = carried(docs, text, key)
    found = near_groups(whole.select(ROW, DOC, "text"), size, radius)
    gone = found.where(F.col(ROW) != F.col("keeper")).select(ROW)
    return whole.select(ROW, "rest").join(gone, ROW, "left_anti").select("rest.*")
