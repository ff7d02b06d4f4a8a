"""Suffix-array dedup: repeated byte strings of a threshold length, by radix passes over suffixes.

Suffixes are ordered only as far as the threshold, most significant digit first. The first digit is the stretch that all
windows around an anchor share; suffixes alone in their group drop out, groups equal through the whole reach are repeated
windows, and the rest goes to the next pass with a finer digit until single windows remain (``repeats``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm import repeats
from riskspark.llm.base import DOC, ROW, column, keyed, packed, texts, tidy
from riskspark.llm.repeat_jobs import Search, repeated_regions


def byte_search(length: int) -> Search:
    """Passes for a threshold of ``length`` bytes: the widest offset range is a power of two and leaves a core of a third."""
    if not 24 <= length <= 90_000:
        raise ValueError("the threshold must be from 24 to 90,000 bytes")
    width = 1 << ((length * 2 // 3).bit_length() - 1)
    sizes = [width]
    while sizes[-1] > 1:
        sizes.append(max(1, sizes[-1] // 8))
    return Search("bytes", length, tuple(sizes), earlier=False)


def spans(rows: DataFrame, length: int = 400) -> DataFrame:
    """(_row, begin, end): stretches of bytes to remove; they may overlap."""
    return repeated_regions(rows, byte_search(length)).select(ROW, "begin", "end")


_KEPT = T.StructType(
    [T.StructField(DOC, T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
     T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())]
)


def remove_repeats(docs: DataFrame, length: int = 400, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept): each text without the bytes of repeated ``length``-byte strings.

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in the same text too; strings are
    judged on the input. ``n_spans`` counts maximal removed stretches, ``kept`` are the other bytes in order.

    Null texts count as empty. Rows with equal or null keys are texts of their own: two equal rows of ``length`` bytes or
    more remove each other. Texts shorter than ``length`` stay whole. An empty table gives an empty table. Columns other
    than ``key`` and ``text`` are not looked at, whatever their names.
    """
    rows = keyed(docs, text, key)
    gone = spans(rows, length)
    each = gone.groupBy(ROW).agg(F.collect_list(F.struct("begin", "end")).alias("gone"))

    def cut(batches):
        import zstandard

        unpress = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = []
            removed = column(b, "gone")
            for i, (doc, z) in enumerate(zip(column(b, DOC).to_pylist(), texts(b, "z"))):
                body = unpress(z)
                n, g = len(body), removed[i].values
                if g is None or not len(g):
                    out.append((doc, n, 0, 0, body))
                    continue
                begin, end = repeats.merged(g.field(0).to_numpy().astype(np.int64), g.field(1).to_numpy().astype(np.int64))
                stops = [0, *np.column_stack((begin, end)).ravel().tolist(), n]
                kept = b"".join([body[a:e] for a, e in zip(stops[::2], stops[1::2])])
                out.append((doc, n, n - len(kept), begin.size, kept))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _ARROW)], _KEPT.fieldNames())

    joined = packed(rows).join(each, ROW, "left").select(DOC, "z", "gone")
    return joined.mapInArrow(tidy(cut), _KEPT).withColumnRenamed(DOC, key)


_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
