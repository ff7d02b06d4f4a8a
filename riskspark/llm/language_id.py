"""Language identification with a byte convolutional network.

Bytes are embedded, filters of widths 2, 3 and 4 slide over them, each filter keeps its largest response in a fixed-length
window, and a softmax over these gives the language. The network is trained in numpy with gradients through the pooled
positions only. To apply it, each filter's response is a sum of look-ups in tables over byte pairs, so a window costs two
gathers and one maximum instead of a matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.base import column, texts, tidy

WIDTHS = (2, 3, 4)
WINDOW = 192
UNKNOWN = "und"


def windows(text: bytes, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(n, size) bytes covering the whole text, zero-padded, and the text bytes each window adds.

    Neighbours overlap by three bytes, so that every position of the widest filter lies inside one window.
    """
    step = size - max(WIDTHS) + 1
    n = max(1, -(-(len(text) - max(WIDTHS) + 1) // step))
    flat = np.zeros(n * step + size - step, np.uint8)
    flat[: len(text)] = np.frombuffer(text, np.uint8)
    weight = np.full(n, float(step))
    weight[-1] = max(1.0, len(text) - step * (n - 1))
    return np.lib.stride_tricks.sliding_window_view(flat, size)[::step], weight


class Network:
    """Parameters and training; ``labels`` are the classes in order."""

    def __init__(self, labels: list[str], filters: int = 12, depth: int = 8, seed: int = 7):
        r = np.random.default_rng(seed)
        self.labels, self.filters, self.depth = labels, filters, depth
        self.bytes = r.normal(0, 0.5, (256, depth))
        self.kernels = [r.normal(0, (w * depth) ** -0.5, (w, depth, filters)) for w in WIDTHS]
        self.bias = np.zeros(filters * len(WIDTHS))
        self.out = r.normal(0, 0.1, (filters * len(WIDTHS), len(labels)))
        self.shift = np.zeros(len(labels))

    def parameters(self) -> list[np.ndarray]:
        return [self.bytes, *self.kernels, self.bias, self.out, self.shift]

    def _pooled(self, x: np.ndarray):
        e = self.bytes[x]
        m = x.shape[1] - max(WIDTHS) + 1
        best, where = [], []
        for w, k in zip(WIDTHS, self.kernels):
            response = sum(e[:, i : i + m] @ k[i] for i in range(w))
            at = response.argmax(1)
            where.append(at)
            best.append(np.take_along_axis(response, at[:, None, :], 1)[:, 0])
        return np.concatenate(best, 1) + self.bias, where

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        pooled, where = self._pooled(x)
        hidden = np.maximum(pooled, 0)
        p = softmax(hidden @ self.out + self.shift)
        rows = np.arange(len(y))
        loss = float(-np.log(p[rows, y] + 1e-12).mean())
        d = p
        d[rows, y] -= 1
        d /= len(y)
        d_out, d_shift = hidden.T @ d, d.sum(0)
        d_pool = (d @ self.out.T) * (pooled > 0)
        d_bytes, d_kernels = np.zeros_like(self.bytes), []
        for j, (w, k) in enumerate(zip(WIDTHS, self.kernels)):
            dk, dp = np.zeros_like(k), d_pool[:, j * self.filters : (j + 1) * self.filters]
            for i in range(w):
                seen = np.take_along_axis(x, where[j] + i, 1)
                dk[i] = np.einsum("bfd,bf->df", self.bytes[seen], dp)
                np.add.at(d_bytes, seen, dp[:, :, None] * k[i].T[None])
            d_kernels.append(dk)
        return loss, [d_bytes, *d_kernels, d_pool.sum(0), d_out, d_shift]

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 400, batch: int = 96, rate: float = 0.01, seed: int = 7) -> "Network":
        r = np.random.default_rng(seed)
        params = self.parameters()
        mean, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        for t in range(1, steps + 1):
            pick = r.integers(0, len(y), batch)
            _, grads = self.gradients(x[pick], y[pick])
            now = rate * (1 - (t - 1) / steps)
            for p, g, m, s in zip(params, grads, mean, square):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= now * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
        return self

    def compiled(self) -> "Tables":
        return Tables(self)


class Tables:
    """The trained network as look-up tables over byte pairs."""

    def __init__(self, net: Network):
        by = [[net.bytes @ k[i] for i in range(len(k))] for k in net.kernels]
        low, high = np.arange(65536) & 255, np.arange(65536) >> 8  # a pair is read as a little-endian number
        two, three, four = by
        self.head = np.concatenate([two[0][low] + two[1][high], three[0][low] + three[1][high], four[0][low] + four[1][high]], 1).astype("f4")
        self.tail = np.concatenate([three[2][low], four[2][low] + four[3][high]], 1).astype("f4")
        self.filters, self.bias, self.out, self.shift = net.filters, net.bias, net.out, net.shift

    def probabilities(self, x: np.ndarray, block: int = 128) -> np.ndarray:
        m = x.shape[1] - max(WIDTHS) + 1
        pooled = np.empty((len(x), self.head.shape[1]), "f4")
        for s in range(0, len(x), block):
            b = x[s : s + block].astype(np.uint16)
            pairs = b[:, :-1] | (b[:, 1:] << 8)
            response = self.head.take(pairs[:, :m].ravel(), 0)
            response[:, self.filters :] += self.tail.take(pairs[:, 2 : m + 2].ravel(), 0)
            pooled[s : s + block] = response.reshape(len(b), m, -1).max(1)
        return softmax(np.maximum(pooled + self.bias, 0) @ self.out + self.shift)

    def predict(self, bodies: list[bytes], most: int = 1024) -> tuple[np.ndarray, np.ndarray]:
        """Class index and mean probability of each text; windows count by the bytes they add."""
        best, score = np.zeros(len(bodies), np.int64), np.zeros(len(bodies))
        held, first, n = [], 0, 0
        for i, body in enumerate(bodies):
            held.append(windows(body))
            n += len(held[-1][1])
            if n >= most or i + 1 == len(bodies):
                p = self.probabilities(np.concatenate([w for w, _ in held]))
                weight = np.concatenate([w for _, w in held])
                starts = np.cumsum([0, *[len(w) for _, w in held[:-1]]])
                mean = np.add.reduceat(p * weight[:, None], starts) / np.add.reduceat(weight, starts)[:, None]
                best[first : i + 1], score[first : i + 1] = mean.argmax(1), mean.max(1)
                held, first, n = [], i + 1, 0
        return best, score


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


def held_out(key: Column, folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves remainder 0; rows without id are held out too, so they are never learned from."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(True))


_SAMPLE = T.StructType([T.StructField("lang", T.StringType()), T.StructField("order", T.LongType()), T.StructField("piece", T.BinaryType())])


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", rows: int = 6000, pieces: int = 4, folds: int = 5) -> Network | None:
    """A network fitted on a bounded sample of labelled rows outside the held-out fold; None if there are none.

    ``rows`` bounds the sampled documents over all languages together (the same share for each, one at least; the first in
    hash order of id and text, equal rows once) and ``pieces`` the windows taken from each, spread over the whole text. They
    are cut to that on Spark, so at most rows x pieces x 192 bytes reach the driver. Nothing but these windows and their
    labels enters the fit.
    """
    labelled = docs.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l")).where(
        F.col("l").isNotNull() & F.col("t").isNotNull() & ~held_out(F.col("k"), folds)
    )
    hashed = labelled.where(F.col("t").rlike(r"\p{L}")).select("l", F.xxhash64("k", "t").alias("h"), "t")
    counts = {r["l"]: r["n"] for r in hashed.select("l", "h").distinct().groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    share = max(1, rows // len(counts))
    unit = F.col("h").bitwiseAND(F.lit((1 << 30) - 1))
    cut = {k: int(min(1.0, 1.3 * share / n + 30 / n) * (1 << 30)) for k, n in counts.items()}
    limit = F.element_at(F.create_map(*[F.lit(x) for kv in cut.items() for x in kv]), F.col("l"))

    def pick(batches):
        for b in batches:
            out = []
            for lang_, order, body in zip(column(b, "l").to_pylist(), column(b, "o").to_pylist(), texts(b, "t")):
                w, _ = windows(body)
                for i in np.unique(np.linspace(0, len(w) - 1, pieces).round().astype(int)):
                    out.append((lang_, order, w[i].tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.binary()))], _SAMPLE.fieldNames())

    # distinct rows below the cut are few (about the share of each language, whatever the input), so one window may rank them
    thin = hashed.where(unit < limit).groupBy("l", "h").agg(F.first("t").alias("t"))
    place = F.row_number().over(Window.partitionBy("l").orderBy(unit, "h"))
    sample = thin.withColumn("o", place.cast("long")).where(F.col("o") <= share).select("l", "o", "t").mapInArrow(tidy(pick), _SAMPLE).collect()
    labels = sorted({r["lang"] for r in sample})
    chosen: list[tuple[bytes, int]] = []
    for i, name in enumerate(labels):
        chosen += [(p, i) for _, p in sorted((r["order"], bytes(r["piece"])) for r in sample if r["lang"] == name)]
    x = np.frombuffer(b"".join(p for p, _ in chosen), np.uint8).reshape(len(chosen), WINDOW)
    y = np.array([i for _, i in chosen])
    return Network(labels).fit(x, y)


def language(net: Network | None, text: Column) -> Column:
    """struct(lang, score) of a text: a learned label, or ``und`` with score 0 where it is null or has no letter."""
    kind = "lang string, score double"
    if net is None:
        return F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))

    @F.pandas_udf(kind)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables, names = net.compiled(), np.array(net.labels, object)

        def said(series: pd.Series) -> pd.DataFrame:
            best, score = tables.predict([t.encode() for t in series])
            return pd.DataFrame({"lang": names[best], "score": np.clip(score, 0, 1)})

        yield from tidy(lambda parts: map(said, parts))(batches)

    letters = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    said = predict(F.when(letters, text).otherwise(F.lit("")))
    return F.when(letters, said).otherwise(F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score")))


def identify(docs: DataFrame, net: Network | None, text: str = "text", key: str = "doc_id", folds: int = 5) -> DataFrame:
    """(key, held_out, lang_pred, score) of each row, from its whole text alone.

    ``und`` with score 0 where the text is null, empty or has no letter, and everywhere if nothing could be learned. Rows
    with null ids count as held out. Equal texts get equal answers; other columns are not looked at.
    """
    said = docs.select(F.col(key).alias("k"), language(net, F.col(text)).alias("s"))
    return said.select(F.col("k").alias(key), held_out(F.col("k"), folds).alias("held_out"), F.col("s.lang").alias("lang_pred"), F.col("s.score").alias("score"))


def least_score(labels: int) -> float:
    """The score that a text must reach: a fifteenth of the way from chance to certainty (0.3 for four labels), none for one label."""
    return 1 / labels + (1 - 1 / labels) / 15 if labels > 1 else 0.0


def accepted(docs: DataFrame, net: Network | None, least: float | None = None, text: str = "text") -> DataFrame:
    """``docs`` without the rows that have no language or one below the score ``least``, by default ``least_score``.

    Where nothing could be learned, no text has a score; then only texts that are null or without a letter go.
    """
    if net is None:
        return docs.where(F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
    least = least_score(len(net.labels)) if least is None else least
    said = docs.select(F.struct("*").alias("rest"), language(net, F.col(text)).alias("s"))
    return said.where((F.col("s.lang") != UNKNOWN) & (F.col("s.score") >= least)).select("rest.*")
