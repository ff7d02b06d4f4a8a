"""Repeated fixed-length windows of token sequences, found exactly and without a row per window.

Every window of ``length`` tokens has one anchor: the position of the smallest token-gram hash among its first ``width``
positions (leftmost on ties). Equal windows have their anchors at equal offsets, so it is enough to order the suffixes at
anchors. A node is an anchor with a range of ``size`` offsets; its *core* are the tokens that all its windows share, its
*full* reach the tokens that any of them holds. If the core is found nowhere else, no window of the node repeats; if the
full reach is found elsewhere, all do; otherwise the node is split into smaller ranges and tried again, down to single
windows. Keys of full reaches have 128 bits, keys of cores 64.

The functions here run inside tasks on one text at a time; what is grouped and joined is left to Spark.
"""

from __future__ import annotations

import numpy as np
import xxhash

_ODD = np.uint64(0x9E3779B97F4A7C15)
_LEFT, _RIGHT = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)
_LOW = np.uint64((1 << 24) - 1)
_STEP = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _ODD
    x ^= x >> np.uint64(29)
    return x


def runs(order_of, windows: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor position, first and last window start of each run of windows with the same anchor.

    ``order_of(a, b)`` gives the order hashes of positions a to b-1; it is asked for pieces, so long texts need little memory.
    """
    found, starts = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for s in range(0, windows, _STEP):
        e = min(windows, s + _STEP)
        v = order_of(s, e + width - 1)
        x = (v & ~_LOW) | np.arange(v.size, dtype=np.uint64)
        size = 1
        while size * 2 <= width:
            x = np.minimum(x[:-size], x[size:])
            size *= 2
        if size < width:
            x = np.minimum(x[: x.size - (width - size)], x[width - size :])
        at = (x & _LOW).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(at)) + 1))
        found.append(at[first] + s)
        starts.append(first + s)
    at, lo = np.concatenate(found), np.concatenate(starts)
    new = np.ones(at.size, bool)
    new[1:] = at[1:] != at[:-1]
    at, lo = at[new], lo[new]
    return at, lo, np.append(lo[1:] - 1, windows - 1)[: at.size]


class Bytes:
    """A text as bytes; regions are hashed where they lie."""

    def __init__(self, text: bytes):
        self.n = len(text)
        self._text, self._view = text, memoryview(text)

    def order(self, a: int, b: int) -> np.ndarray:
        """Hashes of the eight bytes at each position; the last positions, where fewer follow, are never asked for."""
        grams = np.ndarray((b - a,), "<u8", self._text, a, (1,))
        return mixed(grams * _LEFT)

    def keys(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """(n, 2) keys of the regions."""
        v, digest = self._view, xxhash.xxh3_128_digest
        return np.frombuffer(b"".join([digest(v[a:b]) for a, b in zip(begin.tolist(), end.tolist())]), "<u8").reshape(-1, 2)


class Words:
    """A text as words between ASCII white space; words are hashed when first needed."""

    GRAM = 4

    def __init__(self, words: list[bytes]):
        self.words = words
        self.n = len(self.words)
        self._levels: list[np.ndarray] = []

    def _level(self, j: int) -> np.ndarray:
        if not self._levels:
            self._levels.append(np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, self.words)), "<u8").reshape(-1, 2))
        while len(self._levels) <= j:
            p, half = self._levels[-1], 1 << (len(self._levels) - 1)
            self._levels.append(mixed(p[:-half] * _LEFT + p[half:] * _RIGHT) if p.shape[0] > half else p[:0])
        return self._levels[j]

    def order(self, a: int, b: int) -> np.ndarray:
        return self._level(2)[a:b, 0]

    def keys(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """(n, 2) keys of regions of one common length. Words outside of them are left alone."""
        if not begin.size:
            return np.empty((0, 2), np.uint64)
        if not self._levels:
            first, last = merged(begin, end)
            if 2 * int((last - first).sum()) < self.n:
                part = Words([w for a, b in zip(first.tolist(), last.tolist()) for w in self.words[a:b]])
                part._level(0)
                size = last - first
                at = begin + (np.cumsum(size) - size - first)[np.searchsorted(first, begin, "right") - 1]
                return part.keys(at, at + (end - begin))
        size = int(end[0] - begin[0])
        j = size.bit_length() - 1
        p = self._level(j)
        return mixed(p[begin] * _RIGHT + p[end - (1 << j)] * _LEFT + np.uint64(size))


#: A node's first offset and the offsets that occur in its anchor's run, as one number.
def packed_offsets(off: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return off | low << 16 | high << 32


def nodes(seq, length: int, width: int, size: int, pick: tuple[np.ndarray, np.ndarray, int] | None = None) -> dict[str, np.ndarray]:
    """Nodes of ``size`` offsets with their keys: at all anchors, or inside the picked (anchor, packed offsets, size) nodes.

    Returns ``at`` (anchor), ``off`` (packed offsets), ``core``, ``full1``, ``full2`` and ``whole`` (whether the full reach
    lies inside the text; its keys are 0 otherwise). Only offsets that occur in the anchor's run are given out.
    """
    if pick is None:
        at, lo, hi = runs(seq.order, max(0, seq.n - length + 1), width)
        off, low, high = np.zeros(at.size, np.int64), at - hi, at - lo
    else:
        anchors, known, parent = pick
        steps = np.arange(0, parent, size)
        at = np.repeat(anchors, steps.size)
        off = ((known & 0xFFFF)[:, None] + steps).ravel()
        low, high = np.repeat(known >> 16 & 0xFFFF, steps.size), np.repeat(known >> 32, steps.size)
        ok = (off <= high) & (off + size - 1 >= low)
        at, off, low, high = at[ok], off[ok], low[ok], high[ok]
    begin, end = at - off - size + 1, at - off + length
    whole = (begin >= 0) & (end <= seq.n)
    full = np.zeros((at.size, 2), np.uint64)
    full[whole] = seq.keys(begin[whole], end[whole])
    core = full[:, 0] if size == 1 else seq.keys(at - off, at - off - size + 1 + length)[:, 0]
    signed = lambda x: np.ascontiguousarray(x).view(np.int64)
    return {"at": at, "off": packed_offsets(off, low, high), "core": signed(core), "full1": signed(full[:, 0]), "full2": signed(full[:, 1]), "whole": whole}


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of half-open spans; touching spans make one run."""
    if not begin.size:
        return begin, end
    o = np.argsort(begin, kind="stable")
    b, e = begin[o], np.maximum.accumulate(end[o])
    new = np.concatenate(([True], b[1:] > e[:-1]))
    return b[new], e[np.concatenate((np.flatnonzero(new)[1:] - 1, [b.size - 1]))]
