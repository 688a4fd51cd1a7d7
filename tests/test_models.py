import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import clean, recsys, regress, stats


def test_gradient_descent_matches_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.random((200, 2))
    y = 1.5 + 2.0 * x[:, 0] - 0.5 * x[:, 1] + rng.normal(0, 0.01, 200)
    rows = [(1.0, float(a), float(b), float(t)) for (a, b), t in zip(x, y)]
    df = spark.createDataFrame(rows, "intercept double, x1 double, x2 double, y double")
    hist = regress.gradient_descent(df, ["intercept", "x1", "x2"], "y", alpha=0.001, epochs=30, lr=0.1, tol=0.0)
    X = np.column_stack([np.ones(200), x])
    w = np.zeros(3)
    for epoch in range(30):
        err = X @ w - y
        w = w - 0.1 * (2 * X.T @ err / 200 + 2 * 0.001 * w)
        cost = np.mean(err ** 2) + 0.001 * (w ** 2).sum()
        assert hist[epoch][1] == pytest.approx(cost, rel=1e-9)
    assert list(hist[-1][2:]) == pytest.approx(list(w), rel=1e-9)


def test_chi2_survival_known_values():
    assert regress.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert regress.chi2_sf(18.307038053275146, 10) == pytest.approx(0.05, abs=1e-9)
    assert regress.chi2_sf(2.0, 2) == pytest.approx(math.exp(-1.0), abs=1e-12)


def _merge_twin(means, threshold):
    keys = sorted(means)
    merged = {k: k for k in keys}
    for i, ki in enumerate(keys):
        for kj in keys[i + 1:]:
            if abs(means[ki] - means[kj]) < threshold:
                merged[kj] = merged[ki]
    return merged


@pytest.mark.parametrize("threshold", [0.05, 0.2])
def test_merge_close_categories_matches_loop(spark, threshold):
    means = {"a": 0.10, "b": 0.12, "c": 0.40, "d": 0.41, "e": 0.15, "f": 0.90}
    pivot = spark.createDataFrame(list(means.items()), "cat string, m double")
    got = {r.cat: r.merged for r in regress.merge_close_categories(pivot, "cat", "m", threshold).collect()}
    assert got == _merge_twin(means, threshold)


def test_overdispersion_formula(spark):
    xs = [0, 1, 4, 2, 0, 3, 4, 1]
    df = spark.createDataFrame([(x,) for x in xs], "x int")
    r = stats.overdispersion(df, "x", 4).first()
    p = sum(xs) / (len(xs) * 4)
    var = np.var(xs, ddof=1)
    assert r.p == pytest.approx(p) and r.dispersion == pytest.approx(var / (4 * p * (1 - p)))
    assert r.statistic == pytest.approx((len(xs) - 1) * var / (4 * p * (1 - p)))


def test_overdispersion_without_a_ratio(spark):
    df = spark.createDataFrame([(0, 1), (0, 1), (2, 3)], "x int, size int")
    got = {r.size: r for r in stats.overdispersion_by_size(df, "x", "size").collect()}
    assert (got[1].n, got[1].p, got[1].dispersion) == (2, 0.0, None)
    assert (got[3].n, got[3].observed_var, got[3].dispersion) == (1, None, None)


def test_hash_split_is_disjoint_and_balanced(spark):
    df = spark.range(20000).select(F.col("id").alias("user"), (F.col("id") * 7).alias("item"))
    s = recsys.split_by_hash(df, ["user", "item"], [0.4, 0.4, 0.2], seed=13)
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(counts.values()) == 20000
    assert abs(counts[0] / 20000 - 0.4) < 0.03 and abs(counts[2] / 20000 - 0.2) < 0.03


def test_bins_and_impute(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 5, 10]], "v double")
    b = {r.bin: r["count"] for r in clean.bin_counts(df, "v", 5).collect()}
    assert b == {1: 3, 2: 2, 3: 1, 4: 0, 5: 1}  # (−0.01,2] (2,4] (4,6] (6,8] (8,10]
    t = spark.createDataFrame([("1", 1.0), ("2", None), ("3", 4.0)], "id string, v double")
    out = {r.id: r.v for r in clean.append_mean_row(clean.impute_mean(t, ["v"]), ["v"]).collect()}
    assert out == {"1": 1.0, "2": 2.5, "3": 4.0, "Mean": 2.5}


def test_top_x_hit_rate_matches_brute_force(spark):
    train = [(1, 10), (1, 11), (2, 10), (3, 12)]
    truth = [(1, 12), (1, 13), (2, 11), (3, 10), (3, 14)]
    score = {10: 5.0, 11: 4.0, 12: 3.0, 13: 3.0, 14: 1.0}
    tr = spark.createDataFrame(train, "user long, item long")
    te = spark.createDataFrame(truth, "user long, item long")
    sc = spark.createDataFrame(list(score.items()), "item long, score double")
    got = recsys.top_x_hit_rate(tr, te, sc).first().score
    ranked = sorted(score, key=lambda i: (-score[i], i))
    per = []
    for u in {u for u, _ in truth}:
        actual = {i for v, i in truth if v == u}
        seen = {i for v, i in train if v == u}
        top = [i for i in ranked if i not in seen][: len(actual)]
        per.append(len(set(top) & actual) / len(actual))
    assert got == pytest.approx(sum(per) / len(per))


@pytest.mark.parametrize("first, block, chunk", [(4096, 4096, 4096), (3, 2, 2)])
def test_model_top_x_hit_rate_matches_brute_force_without_recommending_all(spark, monkeypatch, first, block, chunk):
    from types import SimpleNamespace

    import numpy as np

    for name, value in (("FIRST_ITEMS", first), ("BLOCK_ITEMS", block), ("CHUNK_USERS", chunk)):
        monkeypatch.setattr(recsys, name, value)
    rng = np.random.default_rng(4)
    u, v = rng.integers(-3, 4, (9, 3)).astype(float), rng.integers(-3, 4, (20, 3)).astype(float)  # many equal scores
    v[7] = v[8]
    pairs = [(a, b) for a in range(10) for b in range(21) if rng.random() < 0.5]  # user 9 and item 20 are unknown to the model
    train, truth = [p for p in pairs if rng.random() < 0.5], [p for p in pairs if rng.random() < 0.6]
    factors = lambda m: spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "id int, features array<float>")
    model = SimpleNamespace(userFactors=factors(u), itemFactors=factors(v))
    schema = "user long, item long"
    got = recsys.model_top_x_hit_rate(model, spark.createDataFrame(train, schema), spark.createDataFrame(truth, schema)).first()
    per = []
    for a in {a for a, _ in truth}:
        actual, seen = {b for x, b in truth if x == a}, {b for x, b in train if x == a}
        ranked = sorted(range(20), key=lambda b: (-(u[a] @ v[b]), b)) if a < 9 else []
        per.append(len(set([b for b in ranked if b not in seen][: len(actual)]) & actual) / len(actual))
    assert got.users == len(per) and got.score == pytest.approx(sum(per) / len(per)) and got.score > 0


def test_overdispersion_p_values(spark):
    from conftest import SF_SMALL

    from tessera.operators.regress import chi2_sf
    from tessera.plans import QUERIES

    # upper tails from published tables
    for x, k, p in ((3.841, 1, 0.05), (18.307, 10, 0.05), (124.342, 100, 0.05), (6.635, 1, 0.01)):
        assert abs(chi2_sf(x, k) - p) < 2e-4
    rows = QUERIES["overdispersion_test"](spark, SF_SMALL).collect()
    assert rows
    for r in rows:
        assert r.p_value is None or (0 <= r.p_value <= 1 and abs(r.p_value - chi2_sf(r.statistic, r.df)) < 1e-12)
    assert any(r.p_value is not None for r in rows)
