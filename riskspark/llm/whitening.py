"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation over distributed rows.

With X the centred rows, right vectors v and left vectors u follow from X v_j = b_{j-1} u_{j-1} + a_j u_j and
X' u_j = a_j v_j + b_j v_{j+1}. A pass over the rows multiplies Xv, then X'u, and takes the products of the new left vector with
all earlier ones; what they take off u is taken off X'u by the stored X'u of those. Both sides are orthogonalised in full against
all earlier vectors, the left ones by a second pass where the first took most of a vector away.
A left vector has one entry per row, so it is never stored: u_j = X w_j for a short vector w_j, and a task makes its entries anew from
its rows, which also survives a lost executor. The singular values of the small bidiagonal matrix are those of X; its left singular
vectors turn the v_j into components.

Rows are packed once into blocks of integers in the scratch folder. A pass sends each task's sums through a grouped sum, so what
reaches the driver has a length of at most the dimension, whatever the number of rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.base import column, forget, stored, tidy

#: Entries of one block.
BLOCK_ENTRIES = 1 << 20
#: Entries are integers of at most this size, so that they and their offsets are exact doubles.
MOST = 1 << 52

_BLOCK = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("rows", T.LongType()), T.StructField("bytes", T.IntegerType()),
                       T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("x", T.BinaryType())])
_SUMS = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("value", T.DoubleType())])
_WIDE = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("value", T.LongType())])
_OUT = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("component", T.IntegerType()), T.StructField("deviation", T.LongType()),
                     T.StructField("whitened", T.DoubleType())])


def packed_rows(vectors: DataFrame, key: str, vector: str, scale: float, offset: int) -> DataFrame:
    """Blocks (dim, rows, bytes, ids, x) of the integer rows floor(scale * c) + offset, kept without the offset in the fewest bytes."""

    def pack(batches):
        for b in batches:
            v, ids = column(b, "v"), column(b, "id")
            sizes = pc.list_value_length(v).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                step = max(1, BLOCK_ENTRIES // int(dim))
                for s in range(0, len(at), step):
                    part = pa.array(at[s : s + step])
                    flat = v.take(part).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                    with np.errstate(over="ignore"):
                        x = np.clip(np.floor(scale * flat), -MOST, MOST).astype(np.int64)
                    kind = next(k for k in (np.int16, np.int32, np.int64) if x.min() >= np.iinfo(k).min and x.max() <= np.iinfo(k).max)
                    row = pa.array([int(dim)], pa.int32()), pa.array([len(part)], pa.int64()), pa.array([np.dtype(kind).itemsize], pa.int32())
                    held = pa.array([ids.take(part).to_pylist()], pa.list_(pa.int64())), pa.array([x.astype(kind).tobytes()], pa.binary())
                    yield pa.RecordBatch.from_arrays([*row, *held], _BLOCK.fieldNames())

    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    slim = vectors.where(F.col(vector).isNotNull()).where((F.size(vector) > 0) & good)
    return slim.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).mapInArrow(tidy(pack), _BLOCK)


def _matrices(batches):
    """(ids, integer rows without the offset) of every block."""
    for b in batches:
        for i in range(b.num_rows):
            width, dim = column(b, "bytes")[i].as_py(), column(b, "dim")[i].as_py()
            x = np.frombuffer(column(b, "x")[i].as_buffer(), dtype={2: np.int16, 4: np.int32, 8: np.int64}[width])
            yield column(b, "ids")[i].values, x.reshape(-1, dim)


def _total(blocks: DataFrame, of, size: int, schema=_SUMS) -> np.ndarray:
    """Sum over all rows of the arrays that ``of(rows)`` gives for a block: one array per task, added up by a grouped sum."""

    def scan(batches):
        total = None
        for _, x in _matrices(batches):
            part = of(x)
            total = part if total is None else total + part
        if total is not None:
            kind = pa.float64() if schema is _SUMS else pa.int64()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total, kind)], schema.fieldNames())

    value = F.col("value") if schema is _SUMS else F.col("value").cast("decimal(38,0)")
    rows = blocks.select(*_BLOCK.fieldNames()).mapInArrow(tidy(scan), schema).groupBy("at").agg(F.sum(value).alias("value")).collect()
    out = np.zeros(size, dtype=np.float64 if schema is _SUMS else object)
    for r in rows:
        out[r["at"]] = r["value"] if schema is _SUMS else int(r["value"])
    return out


class Centre:
    """The exact mean as a whole number per dimension and the rest: centred rows lose no digits however far off zero they are."""

    def __init__(self, sums: np.ndarray, n: int):
        self.sums, self.n = sums, n  # Python integers
        whole = [int(s) // n for s in sums]
        self.whole = np.array(whole, dtype=np.int64)
        self.rest = np.array([(int(s) - n * w) / n for s, w in zip(sums, whole)])

    def rows(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.int64) - self.whole).astype(np.float64) - self.rest


def bidiagonalise(blocks: DataFrame, centre: Centre, top: int, tolerance: float = 1e-15, seed: int = 0):
    """(squared deviations in all, singular values, components as columns) of the centred rows; at most ``top`` of them.

    Steps go on until the residuals of the first ``top`` singular vectors are below ``tolerance`` times the largest value, or the
    space is used up. Where a vector vanishes, the space found so far is invariant, and a fresh direction orthogonal to it begins
    anew: so equal and vanishing singular values are found too. Values below 1e-11 of the largest one count as zero and are left out.
    """
    d = len(centre.whole)
    rng = np.random.default_rng(seed)
    norm = float(_total(blocks, lambda x: np.array([(centre.rows(x) ** 2).sum()]), 1)[0])
    none = np.zeros(0), np.zeros((d, 0))
    if not norm > 0:
        return norm, *none
    floor = math.sqrt(norm) * 1e-11
    vs, ws, backs = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))  # right vectors; left vectors as X w; X'u
    b = []  # columns of the bidiagonal matrix

    def fresh() -> np.ndarray:
        v = rng.normal(size=d)
        for _ in range(3):
            v -= vs @ (vs.T @ v)
        return v / np.linalg.norm(v)

    v, link = fresh(), 0.0
    while True:
        j = vs.shape[1]
        vs = np.column_stack((vs, v))
        w = v - (link * ws[:, -1] if j and link else 0)
        for _ in range(2):  # X v and X'u; the part of u along earlier left vectors is taken off, again if that takes most of it

            def both(x, w=w, ws=ws):
                c = centre.rows(x)
                u = c @ w
                return np.concatenate((u @ (c @ ws), [u @ u], c.T @ u))

            got = _total(blocks, both, j + 1 + d)
            along, whole, back = got[:j], got[j], got[j + 1 :]
            w, back = w - ws @ along, back - backs @ along
            a = math.sqrt(max(0.0, whole - float(along @ along)))
            if a <= floor or a * a > whole / 2:
                break
        found = a > floor
        column_ = np.zeros(j + 1)
        if j:
            column_[j - 1] = link
        column_[j] = a if found else 0.0
        b.append(column_)
        ws = np.column_stack((ws, w / a if found else np.zeros(d)))
        backs = np.column_stack((backs, back / a if found else np.zeros(d)))
        if j + 1 == d:
            break
        link = 0.0
        if found:
            z = backs[:, -1] - a * v
            for _ in range(2):
                z -= vs @ (vs.T @ z)
            link = float(np.linalg.norm(z))
        if link <= floor:
            v, link = fresh(), 0.0
        else:
            v = z / link
            m = np.zeros((j + 1, j + 1))
            for i, c in enumerate(b):
                m[: i + 1, i] = c
            p, s, _ = np.linalg.svd(m)
            if j + 1 > top and (np.abs(link * p[-1, :top]) <= tolerance * s[0]).all():
                break
    m = np.zeros((len(b), len(b)))
    for i, c in enumerate(b):
        m[: i + 1, i] = c
    _, s, qt = np.linalg.svd(m)
    real = np.flatnonzero(s > max(floor, 1e-11 * s[0]))[:top]
    return norm, s[real], vs @ qt[real].T


def whiten(vectors: DataFrame, top: int = 8, scale: float = 1024.0, offset: int = 100_000, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), a line for each row and component up to ``top``.

    Components become floor(scale * c) + offset (clipped at 2**52 before the offset). ``whitened`` is the centred row along the component over its
    deviation, covariances with divisor n; ``explained`` the component's share of the trace; ``identity_error`` the largest
    absolute entry of the covariance of the whitened rows minus the identity; ``deviation`` the exact sum of (n x - S)^2 over all
    dimensions, null where it passes the range of a long.

    Rows whose vector is null, empty or holds null or non-finite components take no part. Where vectors have several
    lengths only those of the most frequent length (of equally frequent ones the shortest) do. Null and repeated ids stay
    as rows of their own. Components without variance are left out, so equal rows or a single one give an empty table, as does
    an empty table; equal variances give some orthogonal basis, the same for all rows. Further columns are not looked at.
    """
    spark = vectors.sparkSession
    every = stored(packed_rows(vectors, key, vector, scale, offset), "blocks")
    sizes = every.groupBy("dim").agg(F.sum("rows").alias("n")).orderBy(F.desc("n"), "dim").first()
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if sizes is None:
        return spark.createDataFrame([], schema)
    d, n = sizes["dim"], sizes["n"]
    blocks = every.where(F.col("dim") == d)

    def halves(x):  # high and low parts of the entries, so that no sum leaves the range of a long
        x = x.astype(np.int64)
        return np.concatenate(((x >> 26).sum(axis=0), (x & ((1 << 26) - 1)).sum(axis=0)))

    parts = _total(blocks, halves, 2 * d, _WIDE)
    centre = Centre(np.array([(int(h) << 26) + int(low) for h, low in zip(parts[:d], parts[d:])], dtype=object), n)
    norm, values, components = bidiagonalise(blocks, centre, min(top, d))
    k = len(values)
    if not k:
        forget(every)
        return spark.createDataFrame([], schema)
    project = components / (values / math.sqrt(n))

    def moments(x):
        y = centre.rows(x) @ project
        return np.concatenate(((y.T @ y).ravel(), y.sum(axis=0)))

    got = _total(blocks, moments, k * k + k)
    mean = got[k * k :] / n
    error = float(np.abs(got[: k * k].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())
    shares = (values**2 / norm).tolist()

    def deviations(x: np.ndarray) -> list:
        """Sums of (n x - S)^2: in longs where a bound shows that they fit, else in whole numbers of any size."""
        far = n * float(np.abs(centre.rows(x)).max(initial=0.0)) + 1
        if far * far * d < 2**62 and n * float(np.abs(x.astype(np.float64)).max(initial=0.0) + 1) < 2**62:
            gap = n * x.astype(np.int64) - centre.sums.astype(np.int64)
            return (gap * gap).sum(axis=1).tolist()
        out = ((n * x.astype(object) - centre.sums) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in out]

    def give(batches):
        for ids, x in _matrices(batches):
            y = centre.rows(x) @ project
            spread = pa.array(deviations(x), pa.int64())
            at = np.repeat(np.arange(len(x)), k)
            order = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)))
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), order, spread.take(pa.array(at)), pa.array(y.ravel())], _OUT.fieldNames())

    out = blocks.select(*_BLOCK.fieldNames()).mapInArrow(tidy(give), _OUT)
    explained = F.element_at(F.array(*[F.lit(float(s)) for s in shares]), F.col("component"))
    return out.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), F.lit(error).alias("identity_error"))
