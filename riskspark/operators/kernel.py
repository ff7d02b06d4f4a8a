"""A kernel machine by landmarks: a whitened kernel map, linear support vectors on it, and a logistic calibration."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.stages import _Fitted

#: Rows that may become landmarks, per landmark: the sample is a bounded number of rows in hash order.
CANDIDATES = 8


def _gram(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    return np.exp(-gamma * np.maximum((a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None], 0))


class KernelMap(_Fitted):
    """``features`` becomes k(x, L) W, whose products are the kernel projected on the landmarks L. Saved as one JSON-ready state."""

    def _transform(self, df: DataFrame) -> DataFrame:
        s = self.state
        mean, scale, marks, white = (np.array(s[k]) for k in ("mean", "scale", "marks", "white"))
        gamma = s["gamma"]

        @F.arrow_udf("array<double>")
        def mapped(x: pa.Array) -> pa.Array:
            if x.null_count:
                raise ValueError("a row has no features")
            z = (x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(mean)) - mean) / scale
            image = _gram(z, marks, gamma) @ white
            return pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * image.shape[1], image.ravel())

        return df.withColumn("features", array_to_vector(mapped(vector_to_array("features"))))


def fit_map(df: DataFrame, landmarks: int = 200, gamma: float | None = None, seed: int = 42) -> KernelMap:
    """Radial kernel map of standardised features; ``gamma`` is one over the number of features if not given.

    Means and deviations are of all rows. Landmarks are chosen among ``CANDIDATES * landmarks`` distinct rows in hash order, one after the other,
    each time the row that the landmarks so far explain least (a pivoted decomposition of their kernel), until none
    is left that adds anything. The whitening is the inverse root of the landmarks' own kernel.
    """
    x = vector_to_array("features")
    first = df.select(x.alias("x")).first()
    if first is None:
        raise ValueError("no rows to fit a kernel map on")
    d = len(first["x"])
    cells = df.select(F.posexplode(x).alias("i", "v"))
    stats = {r["i"]: r for r in cells.groupBy("i").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()}  # a line per feature
    mean = np.array([stats[i]["m"] for i in range(d)])
    scale = np.array([stats[i]["s"] or 1.0 for i in range(d)])
    picked = df.select(x.alias("x")).withColumn("h", F.xxhash64("x", F.lit(seed))).dropDuplicates(["h"]).orderBy("h").limit(CANDIDATES * landmarks)
    z = (np.array([r["x"] for r in picked.collect()], dtype=float) - mean) / scale
    gamma = 1.0 / d if gamma is None else gamma
    left, rows, factors = np.ones(len(z)), [], np.zeros((len(z), 0))
    while len(rows) < min(landmarks, len(z)) and left.max() > 1e-8:
        at = int(left.argmax())
        column = (_gram(z, z[at : at + 1], gamma)[:, 0] - factors @ factors[at]) / np.sqrt(left[at])
        factors = np.column_stack((factors, column))
        left = np.maximum(left - column**2, 0)
        left[at] = 0
        rows.append(at)
    values, vectors = np.linalg.eigh(_gram(z[rows], z[rows], gamma))
    good = values > 1e-10 * values[-1]
    white = vectors[:, good] / np.sqrt(values[good])
    return KernelMap({"mean": mean.tolist(), "scale": scale.tolist(), "marks": z[rows].tolist(), "white": white.tolist(), "gamma": gamma})


def map_error(model: KernelMap, df: DataFrame) -> float:
    """Mean of k(x, x) less the squared length of its image over all rows: 0 if the landmarks span every row, at most 1."""
    mapped = model.transform(df).select(vector_to_array("features").alias("z"))
    return mapped.agg(F.avg(1 - F.aggregate("z", F.lit(0.0), lambda a, v: a + v * v))).first()[0] or 0.0
