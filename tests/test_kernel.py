"""The landmark kernel machine."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskspark.operators import evaluate as E
from riskspark.operators import kernel
from riskspark.operators import models as M


@pytest.fixture(scope="module")
def circles(spark):
    """An inner and an outer ring, and a constant column; a third of the rows are copies."""
    r = np.random.default_rng(0)
    y = r.integers(0, 2, 600)
    angle, radius = r.random(600) * 2 * np.pi, np.where(y == 1, 1.0, 2.5) + r.normal(0, 0.15, 600)
    x = np.column_stack((radius * np.cos(angle), radius * np.sin(angle), np.full(600, 4.0)))
    x[:200], y[:200] = x[0], y[0]
    rows = [(i, *(float(v) for v in a), int(b)) for i, (a, b) in enumerate(zip(x, y))]
    return x, M.assemble(spark.createDataFrame(rows, "id bigint, a double, b double, c double, isFraud int").repartition(4), ["a", "b", "c"])


def test_rings_are_separated(circles):
    _, df = circles
    model = M.kernel_svm(df.where("id % 3 > 0"), landmarks=40, max_iter=20)
    held = M.score(model, df.where("id % 3 = 0"))
    assert sorted(held.columns) == sorted([*df.columns, "p"])
    assert E.ranking_metrics(held).first()["auc_roc"] > 0.98
    line, calibration = M.linear_svm(df.where("id % 3 > 0"), max_iter=20)
    flat = M.apply_platt(calibration, M.svm_margin(line, df.where("id % 3 = 0")), "margin")
    assert abs(E.ranking_metrics(flat).first()["auc_roc"] - 0.5) < 0.3


def test_products_of_images_are_the_kernel(spark, circles):
    """With as many landmarks as the kernel has rank the map is exact; with fewer its error falls with their number."""
    x, df = circles
    errors = [kernel.map_error(kernel.fit_map(df, m), df) for m in (2, 8, 60)]
    assert errors[0] > errors[1] > errors[2] and errors[2] < 0.001
    model = kernel.fit_map(df, 400)
    rows = model.transform(df.where("id < 260")).select("id", vector_to_array("features").alias("z")).orderBy("id").collect()
    z = np.array([r["z"] for r in rows])
    s = x.std(axis=0)
    u = ((x - x.mean(axis=0)) / np.where(s > 1e-9, s, 1))[:260]
    want = np.exp(-((u[:, None] - u[None]) ** 2).sum(2) / 3)
    assert np.abs(z @ z.T - want).max() < 1e-3


def test_a_saved_map_gives_the_same_image(circles, tmp_path):
    _, df = circles
    model = kernel.fit_map(df, 10)
    model.write().overwrite().save(str(tmp_path / "map"))
    again = kernel.KernelMap.load(str(tmp_path / "map"))
    a, b = (m.transform(df).select("id", "features").orderBy("id").collect() for m in (model, again))
    assert a == b


def test_no_rows_and_equal_rows(spark, circles):
    _, df = circles
    with pytest.raises(ValueError):
        kernel.fit_map(df.limit(0))
    same = kernel.fit_map(df.where("id < 100"))
    assert len(same.state["marks"]) == 1 and kernel.map_error(same, df.where("id < 100")) == pytest.approx(0, abs=1e-9)
    assert same.transform(df.where(F.lit(False))).count() == 0
