"""Spark side of the search for repeated windows: passes of grouping, judging and splitting nodes (see ``repeats``)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm import repeats
from riskspark.llm.base import DOC, ROW, column, forget, packed, stored, texts, tidy


@dataclass(frozen=True)
class Search:
    """What repeats: windows of ``length`` units. ``sizes`` are the offset ranges of the passes, the first being the width.

    ``earlier``: a window counts as repeated where it also starts in a document with a smaller id; otherwise where it
    starts at any other place, in the same document too.
    """

    unit: str
    length: int
    sizes: tuple[int, ...]
    earlier: bool

    def sequence(self, text: bytes):
        return repeats.Bytes(text) if self.unit == "bytes" else repeats.Words(text.split())


_NODE = T.StructType(
    [T.StructField(n, t()) for n, t in (
        ("core", T.LongType), ("full1", T.LongType), ("full2", T.LongType), ("whole", T.BooleanType),
        (ROW, T.LongType), (DOC, T.LongType), ("at", T.IntegerType), ("off", T.LongType),
    )]
)
_CORE = T.StructType([T.StructField("core", T.LongType()), T.StructField(DOC, T.LongType())])
_FLUSH = 200_000


def _anchor_cores(search: Search, rows: DataFrame) -> DataFrame:
    """(core, _doc) for every anchor of every text: the first digit."""

    def scan(batches):
        for b in batches:
            cores, docs, held = [], [], 0
            for doc, text in zip(column(b, DOC).to_pylist(), texts(b)):
                seq = search.sequence(text)
                at, _, _ = repeats.runs(seq.order, max(0, seq.n - search.length + 1), search.sizes[0])
                if not at.size:
                    continue
                core = seq.keys(at, at + search.length - search.sizes[0] + 1)[:, 0].copy().view(np.int64)
                cores.append(core)
                docs.append(np.full(core.size, doc if doc is not None else 0, np.int64))
                held += core.size
                if held >= _FLUSH:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cores)), pa.array(np.concatenate(docs))], ["core", DOC])
                    cores, docs, held = [], [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cores)), pa.array(np.concatenate(docs))], ["core", DOC])

    return rows.select(DOC, "text").mapInArrow(tidy(scan), _CORE)


def _nodes(search: Search, rows: DataFrame, size: int, parent: int | None = None) -> DataFrame:
    """Nodes of one pass. ``rows`` holds texts, or packed texts with the ``picks`` of the pass before."""

    def flush(held):
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*held)], _NODE.fieldNames())

    def scan(batches):
        import zstandard

        unpress = zstandard.ZstdDecompressor().decompress
        for b in batches:
            some, n = [], 0
            bodies = map(unpress, texts(b, "z")) if parent else texts(b)
            picks = column(b, "picks") if parent else None
            for i, (row, doc, text) in enumerate(zip(column(b, ROW).to_pylist(), column(b, DOC).to_pylist(), bodies)):
                pick = None
                if parent:
                    p = picks[i].values
                    at, off = p.field(0).to_numpy().astype(np.int64), p.field(1).to_numpy().astype(np.int64)
                    pick = at, off, parent
                x = repeats.nodes(search.sequence(text), search.length, search.sizes[0], size, pick)
                m = x["at"].size
                if m:
                    some.append((x["core"], x["full1"], x["full2"], x["whole"], np.full(m, row, np.int64),
                                 np.full(m, doc if doc is not None else 0, np.int64), x["at"].astype(np.int32), x["off"]))
                    n += m
                if n >= _FLUSH:
                    yield flush(some)
                    some, n = [], 0
            if n:
                yield flush(some)

    return rows.mapInArrow(tidy(scan), _NODE)


def _repeated(search: Search, nodes: DataFrame, keys: list[str], first: str) -> DataFrame:
    """The keys that more than one node has (in more than one document), each with its smallest document id."""
    seen = nodes.groupBy(*keys).agg(F.min(DOC).alias(first), (F.max(DOC) if search.earlier else F.count(F.lit(1))).alias("_n"))
    return seen.where(F.col("_n") > (F.col(first) if search.earlier else F.lit(1))).drop("_n")


def repeated_regions(rows: DataFrame, search: Search) -> DataFrame:
    """(_row, begin, end, first): regions whose windows of ``search.length`` units all repeat in the sense of ``search``.

    ``rows`` is (_row, _doc, text). Each unit covered by a repeated window lies in some region, and no other unit does.
    ``first`` is the smallest document id that holds the region. Tables between the passes are stored, so a lost executor
    costs tasks, never a pass; frequent keys are counted before they are moved and their join partitions can be split.
    Joins hash the side of distinct keys, of which no key is frequent, so the many nodes need no sorting.
    """
    if search.earlier:
        rows = rows.where(F.col(DOC).isNotNull())
    found, parent, picks = [], None, None
    for size in search.sizes:
        last = size == 1
        if parent is None:
            cores = stored(_repeated(search, _anchor_cores(search, rows), ["core"], "_first_core"), "cores")
            nodes = stored(_nodes(search, rows.select(ROW, DOC, "text"), size).join(cores.hint("shuffle_hash"), "core"), "nodes")
        else:
            texts_and_picks = packed(rows).join(picks.groupBy(ROW).agg(F.collect_list(F.struct("at", "off")).alias("picks")), ROW)
            nodes = stored(_nodes(search, texts_and_picks.select(ROW, DOC, "z", "picks"), size, parent), "nodes")
            cores = None
            if not last:
                cores = stored(_repeated(search, nodes, ["core"], "_first_core"), "cores")
        fulls = stored(_repeated(search, nodes.where("whole"), ["full1", "full2"], "first"), "fulls")
        judged = nodes if last or parent is None else nodes.join(cores.hint("shuffle_hash"), "core")
        judged = judged.join(fulls.withColumn("whole", F.lit(True)).hint("shuffle_hash"), ["full1", "full2", "whole"], "left")
        done = (F.col("first") < F.col(DOC)) if search.earlier else F.col("first").isNotNull()
        judged = judged.withColumn("done", F.coalesce(done, F.lit(False)))
        if not last:
            open_ = ~F.col("done") & ((F.col("_first_core") < F.col(DOC)) if search.earlier else F.lit(True))
            judged = judged.withColumn("open", open_)
        else:
            judged = judged.where("done")
        old = [nodes, fulls, *([cores] if cores is not None else [])]
        judged = stored(judged, "judged")
        forget(*old)
        if picks is not None:
            forget(picks)
        start = F.col("at") - F.col("off").bitwiseAND(0xFFFF)
        region = F.struct((start - (size - 1)).alias("begin"), (start + search.length).alias("end"))
        found.append(stored(judged.where("done").select(ROW, region.alias("r"), "first").select(ROW, "r.begin", "r.end", "first"), "regions"))
        if last:
            forget(judged)
            break
        waiting = stored(judged.where("open").select("core").distinct(), "waiting")
        others = judged.where(~F.col("open")).join(waiting.hint("shuffle_hash"), "core", "left_semi")
        place = F.struct(DOC, ROW, "at", "off")
        witness = others.where("whole").groupBy("full1", "full2").agg(F.min(place).alias("p")).select("p.*")
        picks = stored(
            judged.where("open").select(ROW, "at", "off")
            .unionByName(witness.select(ROW, "at", "off"))
            .unionByName(others.where(~F.col("whole")).select(ROW, "at", "off")),
            "picks",
        )
        forget(judged, waiting)
        parent = size
    return reduce(DataFrame.unionByName, found)
