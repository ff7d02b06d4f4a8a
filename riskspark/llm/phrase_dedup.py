"""Substring dedup with repeated-phrase automata.

Passages that recur are confirmed first (``repeat_jobs``: exact, by words). Then texts are dealt out with the confirmed
passages they are known to hold; each shard of texts compiles one Aho-Corasick automaton from its distinct passages and
streams all its texts through it to locate every occurrence. A shard is bounded by the characters of its passages, so the
automata stay small however the table grows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm import repeats
from riskspark.llm.base import DOC, ROW, carried, column, keyed, packed, texts, tidy
from riskspark.llm.repeat_jobs import Search, repeated_regions


def word_search(length: int) -> Search:
    """Passes for windows of ``length`` words: a core of four words, then single windows."""
    if not 6 <= length <= 60_000:
        raise ValueError("windows must have from 6 to 60,000 words")
    return Search("words", length, (length - repeats.Words.GRAM + 1, 1), earlier=True)


def passages(rows: DataFrame, length: int = 13) -> DataFrame:
    """(_row, begin, end, first): stretches of words whose windows all start in a document with a smaller id, ``first``."""
    return repeated_regions(rows, word_search(length))


class Shard:
    """Texts with their confirmed passages, until the passages reach the size for one automaton."""

    def __init__(self, most_chars: int):
        self._most = most_chars
        self._patterns: dict[str, tuple[int, int]] = {}
        self._chars = 0
        self.texts: list[tuple[int | None, list[bytes]]] = []

    def add(self, doc: int | None, words: list[bytes], spans) -> None:
        self.texts.append((doc, words))
        for begin, end, first in spans:
            phrase = (b" " + b" ".join(words[begin:end]) + b" ").decode()
            known = self._patterns.get(phrase)
            if known is None:
                self._chars += len(phrase)
            if known is None or first < known[1]:
                self._patterns[phrase] = (end - begin, first)

    @property
    def full(self) -> bool:
        return self._chars >= self._most or len(self.texts) >= 400

    def removed(self):
        """(doc, words, begin, end) with the merged removed stretches of each text."""
        import ahocorasick

        found = None
        if self._patterns:
            found = ahocorasick.Automaton()
            for phrase, what in self._patterns.items():
                found.add_word(phrase, what)
            found.make_automaton()
        none = np.empty(0, np.int64)
        for doc, words in self.texts:
            if found is None or doc is None:
                yield doc, words, none, none
                continue
            line = (b" " + b" ".join(words) + b" ").decode()
            hits = [(end, n) for end, (n, first) in found.iter(line) if first < doc]
            if not hits:
                yield doc, words, none, none
                continue
            spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), "<u4") == 32)
            ends, sizes = np.array(hits, np.int64).T
            stop = np.searchsorted(spaces, ends)
            yield doc, words, *repeats.merged(stop - sizes, stop)


_KEPT = [T.StructField(ROW, T.LongType()), T.StructField(DOC, T.LongType()), T.StructField("n_words", T.LongType()),
         T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]
_ARROW = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]


def _joined_spans(begin: np.ndarray, end: np.ndarray, first: np.ndarray):
    """Maximal passages; the largest first document counts, since every window of the passage starts in it or earlier."""
    b, e = repeats.merged(begin, end)
    last = np.full(b.size, np.iinfo(np.int64).min)
    np.maximum.at(last, np.searchsorted(b, begin, "right") - 1, first)
    return zip(b.tolist(), e.tolist(), last.tolist())


def kept_words(rows: DataFrame, length: int = 13, automaton_chars: int = 400_000) -> DataFrame:
    """(_row, _doc, n_words, n_removed, kept), and ``rest`` where there is one, for keyed rows; see ``remove_passages``."""
    each = passages(rows.select(ROW, DOC, "text"), length).groupBy(ROW).agg(F.collect_list(F.struct("begin", "end", "first")).alias("found"))
    also = ["rest"] if "rest" in rows.columns else []
    schema = T.StructType(_KEPT + [rows.schema[c] for c in also])

    def flush(shard: Shard, ids: list[int], rest: list):
        out = []
        for row, (doc, words, begin, end) in zip(ids, shard.removed()):
            if begin.size:
                stops = [0, *np.column_stack((begin, end)).ravel().tolist(), len(words)]
                left = [w for a, e in zip(stops[::2], stops[1::2]) for w in words[a:e]]
            else:
                left = words
            body = b" ".join(left)
            out.append((row, doc, len(words), len(words) - len(left), body.decode()))
        columns = [pa.array(c, t) for c, t in zip(zip(*out), _ARROW)]
        return pa.RecordBatch.from_arrays(columns + ([pa.concat_arrays(rest)] if also else []), schema.fieldNames())

    def cut(batches):
        import zstandard

        unpress = zstandard.ZstdDecompressor().decompress
        shard, ids, rest = Shard(automaton_chars), [], []
        for b in batches:
            found, since = column(b, "found"), 0
            for i, (row, doc, z) in enumerate(zip(column(b, ROW).to_pylist(), column(b, DOC).to_pylist(), texts(b, "z"))):
                f = found[i].values
                spans = () if f is None or not len(f) else _joined_spans(*(f.field(k).to_numpy().astype(np.int64) for k in range(3)))
                shard.add(doc, unpress(z).split(), spans)
                ids.append(row)
                if shard.full:
                    yield flush(shard, ids, rest + [column(b, c).slice(since, i + 1 - since) for c in also])
                    shard, ids, rest, since = Shard(automaton_chars), [], [], i + 1
            rest += [column(b, c).slice(since) for c in also]
        if ids:
            yield flush(shard, ids, rest)

    joined = packed(rows).join(each, ROW, "left").select(ROW, DOC, "z", *also, "found")
    return joined.mapInArrow(tidy(cut), schema)


def remove_passages(docs: DataFrame, length: int = 13, text: str = "text", key: str = "doc_id", automaton_chars: int = 400_000) -> DataFrame:
    """(key, n_words, n_removed, kept): texts without words that an earlier document already has.

    Words are what ASCII white space separates, unchanged. A word goes if it lies in a window of ``length`` words that also
    starts in a document with a smaller id; windows are judged on the input. ``kept`` joins the other words by one space.

    Null texts have no words. A row with a null id is kept whole and takes nothing from others, as it is neither smaller
    nor larger; rows with equal ids take nothing from each other. Texts shorter than ``length`` words stay whole, an empty
    table gives an empty table, and columns other than ``key`` and ``text`` are not looked at.
    """
    out = kept_words(keyed(docs, text, key), length, automaton_chars)
    return out.drop(ROW).withColumnRenamed(DOC, key)


def without_passages(docs: DataFrame, length: int = 13, text: str = "text", key: str = "doc_id", size: str | None = "n_chars") -> DataFrame:
    """``docs`` with ``text`` cut as in ``remove_passages`` and ``size`` (if there is such a column) set to its new length.

    Texts from which nothing is removed stay as they are, white space and null included.
    """
    done = kept_words(carried(docs, text, key), length)
    cut = F.col("n_removed") > 0

    def value(c: str):
        old = F.col(f"rest.`{c}`")
        if c == text:
            return F.when(cut, F.col("kept")).otherwise(old).alias(c)
        if c == size:
            return F.when(cut, F.length("kept").cast(docs.schema[c].dataType)).otherwise(old).alias(c)
        return old.alias(c)

    return done.select(*[value(c) for c in docs.columns])
