"""SentencePiece encoding and decoding with byte offsets.

Normalisation takes the longest prefix that the model's compiled character map knows and records for every output byte the
source byte it came from. The segmentation library only cuts normalised stretches into pieces, and, as no piece of the
model runs from other text into a word mark, it does so once per distinct stretch; lengths of pieces then give places in the
normalised text, and the recorded alignment gives the byte span of every piece in the original. Decoding joins the surfaces
of the pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.base import column, texts, tidy

MARK = "▁"
_MARK = MARK.encode()
#: Piece types of the model format (fixed values).
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_STRETCH = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+$")


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 prefixes and its replacement strings."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little")
        self._units = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self._strings = blob[4 + size :]

    @staticmethod
    def _step(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest known prefix of ``text`` from ``at``."""
        units, found = self._units, None
        node = self._step(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            unit = units[node] if node < len(units) else 0
            if unit & 0x800000FF != text[i]:
                break
            node ^= self._step(unit)
            if unit >> 8 & 1:
                begin = units[node] & 0x7FFFFFFF
                found = i + 1 - at, self._strings[begin : self._strings.index(b"\0", begin)]
        return found


class Model:
    """What the encoder needs of a model file: normaliser settings, piece tables, and the library for segmentation."""

    CACHE = 150_000

    def __init__(self, blob: bytes):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as form

        proto = form.ModelProto()
        proto.ParseFromString(blob)
        norm = proto.normalizer_spec
        if proto.trainer_spec.treat_whitespace_as_suffix or not norm.escape_whitespaces:
            raise ValueError("models with word marks as suffix or without word marks are not supported")
        self.map = CharacterMap(norm.precompiled_charsmap) if norm.precompiled_charsmap else None
        self.prefix, self.squeeze = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        kinds = [p.type for p in proto.pieces]
        self.end = next((i for i, p in enumerate(proto.pieces) if p.piece == (proto.trainer_spec.eos_piece or "</s>")), -1)
        unk = (proto.trainer_spec.unk_surface or " ⁇ ").encode()
        surface, width = [], []
        for p in proto.pieces:
            if p.type == BYTE:
                surface.append(bytes([int(p.piece[3:-1], 16)]))
                width.append(1)
            elif p.type == CONTROL:
                surface.append(b"")
                width.append(0)
            elif p.type == UNKNOWN:
                surface.append(unk)
                width.append(-1)
            else:
                surface.append(p.piece.replace(MARK, " ").encode())
                width.append(len(p.piece.encode()))
        self.has_bytes = BYTE in kinds
        self._surface, self._width = b"".join(surface), np.array(width, np.int64)
        self._size = np.array([len(s) for s in surface], np.int64)
        self._start = np.cumsum(self._size) - self._size
        self._flat = np.frombuffer(self._surface, np.uint8)
        self.by_stretch = not any(re.search(f"[^{MARK}]{MARK}", p.piece) for p in proto.pieces if p.type in (NORMAL, USER))
        norm.precompiled_charsmap = b""
        norm.add_dummy_prefix = norm.remove_extra_whitespaces = norm.escape_whitespaces = False
        self._cut = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        self._forget()

    # normalisation

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and the source position of each of them with the end of the text as last entry."""
        if not text:
            return b"", np.zeros(1, np.int64)
        if self.map is None and not self.squeeze:
            source = np.repeat(np.arange(len(text)), np.where(np.frombuffer(text, np.uint8) == 32, len(_MARK), 1))
            body, stop = text.replace(b" ", _MARK), len(text)
        else:
            body, source, stop = self._by_prefix(text)
        if not body:
            return b"", np.array([len(text)])
        if self.prefix:
            body, source = _MARK + body, np.concatenate((np.repeat(source[:1], len(_MARK)), source))
        return body, np.append(source, stop)

    def _by_prefix(self, text: bytes) -> tuple[bytes, np.ndarray, int]:
        parts, places, at = [], [], 0
        while at < len(text):
            hit = self.map.longest(text, at) if self.map else None
            if hit is None:
                n = 1
                while at + n < len(text) and text[at + n] & 0xC0 == 0x80:
                    n += 1
                hit = n, text[at : at + n]
            parts.append(hit[1])
            places.append(at)
            at += hit[0]
        if self.squeeze:
            while parts and not parts[0].strip(b" "):
                parts.pop(0), places.pop(0)
        out, source, space = [], [], False
        for part, place in zip(parts, places):
            for i in range(len(part)):
                c = part[i : i + 1]
                if c == b" " and self.squeeze and (space or not out):
                    continue
                space = c == b" "
                out.append(_MARK if space else c)
                source += [place] * len(out[-1])
        stop = len(text)
        while self.squeeze and out and out[-1] == _MARK:
            out.pop()
            stop = source[-1]
            del source[-len(_MARK) :]
        return b"".join(out), np.array(source, np.int64), stop

    # segmentation

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._table, self._first, self._count = np.empty(1 << 16, np.int32), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        self._used = 0

    def _stretches(self, body: bytes) -> list[str]:
        text = body.decode("utf-8", "replace")
        if not self.by_stretch:
            return [text]
        if text.startswith(MARK) and MARK * 2 not in text and not text.endswith(MARK):
            return [MARK + w for w in text[1:].split(MARK)]
        return _STRETCH.findall(text)

    def _learned(self, stretches: list[str]) -> np.ndarray:
        """Number of each stretch in the table of known ones, which is filled as needed."""
        new = [s for s in dict.fromkeys(stretches) if s not in self._known]
        if new:
            cut = self._cut.encode(new)
            count = np.fromiter(map(len, cut), np.int64, len(cut))
            n, total = len(self._known), int(count.sum())
            self._count, self._first = _room(self._count, n + len(new)), _room(self._first, n + len(new))
            self._table = _room(self._table, self._used + total)
            self._count[n : n + len(new)] = count
            self._first[n : n + len(new)] = self._used + np.cumsum(count) - count
            self._table[self._used : self._used + total] = np.fromiter((i for c in cut for i in c), np.int32, total)
            self._used += total
            self._known.update(zip(new, range(n, n + len(new))))
        return np.fromiter(map(self._known.__getitem__, stretches), np.int64, len(stretches))

    def encode(self, bodies: list[bytes], end: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Flat ids, first and last source byte of each piece, and the offsets of the texts in them."""
        if len(self._known) > self.CACHE:
            self._forget()
        norm = [self.normalise(b) for b in bodies]
        cut = [self._stretches(b) if b else [] for b, _ in norm]
        which = self._learned([s for c in cut for s in c])
        count = self._count[which]
        ids = self._table[spread(self._first[which], count)]
        by_text = np.concatenate(([0], np.cumsum([len(c) for c in cut], dtype=np.int64)))
        per = np.diff(np.concatenate(([0], np.cumsum(count)))[by_text])
        if end:
            ids = np.insert(ids, np.cumsum(per), self.end).astype(np.int32)
            per = per + 1
        offsets = np.concatenate(([0], np.cumsum(per)))
        width = self._width[ids]
        if (width < 0).any():
            width = self._measured(ids, offsets, [b for b, _ in norm], width)
        stop = np.cumsum(width)
        base = np.repeat(np.concatenate(([0], stop))[offsets[:-1]], per)
        shift = np.cumsum([0, *[len(s) for _, s in norm[:-1]]])
        source = np.concatenate([s for _, s in norm]) if norm else np.empty(0, np.int64)
        at = np.repeat(shift, per)
        return ids, source[at + stop - width - base], source[at + stop - base], offsets

    def _measured(self, ids, offsets, bodies, width) -> np.ndarray:
        """Widths where unknown pieces occur: an unknown piece reaches to where the rest of its text matches again."""
        width = width.copy()
        for t, body in enumerate(bodies):
            own = slice(offsets[t], offsets[t + 1])
            if (width[own] < 0).any():
                cut = self._cut.encode(body.decode("utf-8", "replace"), return_type="pieces")
                width[own] = [len(p.encode()) for p in cut] + [0] * (offsets[t + 1] - offsets[t] - len(cut))
        return width

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """Texts of flat ids: surfaces joined, the word mark that encoding put in front taken off."""
        size = self._size[ids]
        flat = self._flat[spread(self._start[ids], size)].tobytes()
        stops = np.concatenate(([0], np.cumsum(size)))[offsets].tolist()
        front = self.prefix or self.squeeze
        out = []
        for a, b in zip(stops[:-1], stops[1:]):
            text = flat[a:b].decode("utf-8", "replace")
            out.append(text[1:] if front and text.startswith(" ") else text)
        return out


def _room(a: np.ndarray, size: int) -> np.ndarray:
    return a if a.size >= size else np.concatenate((a, np.empty(max(size, 2 * a.size) - a.size, a.dtype)))


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices start..start+size-1 of each range, one after another."""
    total = np.cumsum(size)
    return np.arange(total[-1] if total.size else 0) + np.repeat(start - (total - size), size)


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


_OUT = T.StructType(
    [T.StructField("key", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
     T.StructField("begins", T.ArrayType(T.IntegerType(), False)), T.StructField("ends", T.ArrayType(T.IntegerType(), False)),
     T.StructField("decoded", T.StringType())]
)


def encode_documents(docs: DataFrame, model: str, text: str = "text", key: str = "doc_id", end: bool = True, chunk: int = 1 << 18) -> DataFrame:
    """(key, ids, begins, ends, decoded): pieces of each whole text, the source bytes of each piece, and the decoded text.

    ``model`` is a path on the driver; tasks get its content. With ``end`` the end id closes each text; its span is empty.
    Null and empty texts have the end id alone and decode to an empty text. Repeated rows and null keys each keep their
    line; an empty table gives an empty table; other columns are not looked at. Texts are worked on about ``chunk`` bytes
    at a time, a single longer text in one go.
    """
    blob = docs.sparkSession.sparkContext.broadcast(read_model(model))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(blob.value)

        def done(keys, bodies):
            ids, begin, stop, offsets = own.encode(bodies, end)
            at = pa.array(offsets.astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, pa.array(v.astype(np.int32))) for v in (ids, begin, stop)]
            columns = [pa.array(keys, pa.int64()), *lists, pa.array(own.decode(ids, offsets), pa.string())]
            return pa.RecordBatch.from_arrays(columns, _OUT.fieldNames())

        for b in batches:
            keys, bodies, held = [], [], 0
            for k, body in zip(column(b, "key").to_pylist(), texts(b)):
                keys.append(k)
                bodies.append(body)
                held += len(body)
                if held >= chunk:
                    yield done(keys, bodies)
                    keys, bodies, held = [], [], 0
            if keys:
                yield done(keys, bodies)

    slim = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return slim.mapInArrow(tidy(scan), _OUT).withColumnRenamed("key", key)


def digests(encoded: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of encoded documents."""
    return encoded.select(
        key,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
