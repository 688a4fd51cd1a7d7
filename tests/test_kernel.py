"""Kernel regression over all training rows against numpy, in several cells and on odd rows."""

import numpy as np
import pytest
from conftest import SF_SMALL

from tessera.operators.kernel import kernel_regression
from tessera.plans import QUERIES


def corr(a, b):
    a, b = a - a.mean(), b - b.mean()
    n = np.sqrt((a @ a) * (b @ b))
    return (a @ b) / n if n > 1e-12 else 0.0


@pytest.mark.parametrize(("group", "part"), [(1 << 14, 1 << 16), (7, 11)])
def test_equals_plain_sums(spark, group, part):
    rng = np.random.default_rng(4)
    x, q = rng.normal(size=(60, 8)).round(2), rng.normal(size=(23, 8)).round(2)
    x[3], q[5], q[6] = 1.5, 2.0, q[7]
    y = rng.integers(0, 9, 60).astype(float)
    floats = lambda r: [float(v) for v in r]
    training = [(floats(r), float(v)) for r, v in zip(x, y, strict=True)] + [(None, 1.0), ([1.0, None] + [0.0] * 6, 2.0), ([1.0], 3.0), (floats(x[0]), None), ([float("nan")] * 8, 1.0)]
    queries = [(i, floats(r)) for i, r in enumerate(q)] + [(100, None), (101, [1.0, 2.0]), (None, floats(q[0]))]
    got = kernel_regression(spark.createDataFrame(queries, "id long, x array<double>"), spark.createDataFrame(training, "x array<double>, y double"), (4, 8), 2.0, group, part)
    rows = {r.id: (r.pred_4, r.pred_8) for r in got.collect()}
    assert rows.keys() == set(range(23))
    for i, r in enumerate(q):
        for h, value in zip((4, 8), rows[i], strict=True):
            w = np.exp(2 * np.array([corr(r[:h], t[:h]) for t in x]))
            assert value == pytest.approx((w @ y) / w.sum(), abs=1e-9)


def test_empty_sides(spark):
    none = spark.createDataFrame([], "id long, x array<double>, y double")
    one = spark.createDataFrame([(1, [1.0, 2.0], 3.0)], "id long, x array<double>, y double")
    assert kernel_regression(none.select("id", "x"), one.select("x", "y"), (2,)).collect() == []
    assert kernel_regression(one.select("id", "x"), none.select("x", "y"), (2,)).collect() == []


def test_actual_against_predicted_is_least_squares(spark):
    k = QUERIES["kernel_regression_all_rows"](spark, SF_SMALL).toPandas()
    got = QUERIES["kernel_actual_predicted"](spark, SF_SMALL).toPandas().sort_values("vec_id")
    feats = np.column_stack([k[[c for c in k.columns if c.startswith("pred_")]], np.ones(len(k))])
    fit = (k.vec_id % 40 == 0).to_numpy()
    coef = np.linalg.lstsq(feats[fit], k.actual.to_numpy()[fit], rcond=None)[0]
    want = dict(zip(k.vec_id[~fit], feats[~fit] @ coef, strict=True))
    assert len(got) == (~fit).sum()
    if fit.sum() > 5:
        assert np.allclose(got.predicted, [want[i] for i in got.vec_id], rtol=1e-2, atol=1e-2)
