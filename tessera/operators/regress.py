"""Regression models: full-batch gradient descent, binomial GLM summaries, category merging.

Gradient descent keeps only the weight vector on the driver: each epoch is one
aggregate over the (cached) training frame returning the gradient sums, so the
data never leave the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.joins import lookup_join
from tessera.session import cut_lineage


def gradient_descent(
    df: DataFrame, features: list[str], target: str, alpha: float = 0.001, epochs: int = 1000,
    lr: float = 0.025, reg: str = "l2", tol: float = 0.01,
) -> list[tuple]:
    """L2-regularised least squares by full-batch gradient descent.

    Update: w ← w − lr·(2·Xᵀ(Xw − y)/n + R(w)), R = 2αw (``"l2"``) or α·w² (``"as_written"``).
    Cost after each epoch: mean squared error of that epoch's (pre-update) errors + α·Σw²
    (post-update). Stops early after the fourth epoch once |Δcost| ≤ tol.
    Returns ``[(epoch, cost, w...)]`` — one row per epoch, weights as plain floats.
    """
    data = df.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(target).cast("double").alias("_y")).persist()
    w = [0.0] * len(features)
    history, prev = [], None
    try:
        for epoch in range(1, epochs + 1):
            pred = sum((F.col(c) * F.lit(wj) for c, wj in zip(features, w)), F.lit(0.0))
            err = pred - F.col("_y")
            sums = data.agg(
                F.count(F.lit(1)).alias("n"), F.sum(err * err).alias("sse"),
                *[F.sum(err * F.col(c)).alias(f"g{j}") for j, c in enumerate(features)],
            ).first()
            n = sums["n"]
            grads = [2.0 * sums[f"g{j}"] / n for j in range(len(features))]
            penalty = [2.0 * alpha * wj if reg == "l2" else alpha * wj * wj for wj in w]
            w = [wj - lr * (g + p) for wj, g, p in zip(w, grads, penalty)]
            cost = sums["sse"] / n + alpha * sum(wj * wj for wj in w)
            history.append((epoch, cost, *w))
            if epoch >= 4 and prev is not None and abs(cost - prev) <= tol:
                break
            prev = cost
    finally:
        data.unpersist()
    return history


def merge_close_categories(pivot: DataFrame, key: str, value: str, threshold: float = 0.05) -> DataFrame:
    """Merge categories whose group means are close.

    Categories are taken in key order; category j adopts the final label of the
    *last* earlier category i with |m_i − m_j| < threshold, else keeps its own
    key. The pivot holds one row per category, so the pair scan and the label
    chase run on a table bounded by the number of categories.
    """
    # one row per category: an unpartitioned window over it is bounded by the category count
    p = pivot.select(F.col(key).alias("k"), F.col(value).alias("m")).withColumn("r", F.row_number().over(Window.orderBy("k")))
    a, b = p.alias("a"), p.alias("b")
    close = a.join(b, (F.col("a.r") < F.col("b.r")) & (F.abs(F.col("a.m") - F.col("b.m")) < threshold))
    pred = close.groupBy(F.col("b.r").alias("r")).agg(F.max("a.r").alias("p"))
    state = cut_lineage(p.join(pred, "r", "left").select("r", "k", "m", F.coalesce("p", "r").alias("ptr")))
    # pointer chase to the root of each chain (depth ≤ number of categories)
    while True:
        nxt = state.alias("s").join(state.select(F.col("r").alias("ptr"), F.col("ptr").alias("pp")), "ptr").select(
            "r", "k", "m", "pp"
        ).withColumnRenamed("pp", "ptr")
        nxt = cut_lineage(nxt)
        if nxt.join(state.select("r", F.col("ptr").alias("old")), "r").where(F.col("ptr") != F.col("old")).isEmpty():
            state = nxt
            break
        state = nxt
    roots = state.select(F.col("r").alias("ptr"), F.col("k").alias("merged"))
    return state.join(roots, "ptr").select(F.col("k").alias(key), F.col("m").alias(value), "merged")


def apply_category_map(df: DataFrame, mapping: DataFrame, col: str) -> DataFrame:
    """Replace ``col`` by its merged label (categories absent from the map keep their value)."""
    m = mapping.select(F.col(col).alias("_from"), F.col("merged").alias("_to"))
    joined = lookup_join(df.withColumn("_from", F.col(col)), m, "_from")  # broadcast only behind a count
    return joined.withColumn(col, F.coalesce("_to", col)).drop("_from", "_to").select(*df.columns)


def chi2_sf(x: float, k: float) -> float:
    """Survival function of the χ² distribution (regularised upper incomplete gamma Q(k/2, x/2))."""
    if x <= 0:
        return 1.0
    a, z = k / 2.0, x / 2.0
    if z < a + 1:  # series for P, then Q = 1 − P
        term = total = 1.0 / a
        n = a
        for _ in range(1000):
            n += 1
            term *= z / n
            total += term
            if abs(term) < abs(total) * 1e-15:
                break
        return max(0.0, 1.0 - total * math.exp(-z + a * math.log(z) - math.lgamma(a)))
    # continued fraction for Q (Lentz)
    tiny = 1e-300
    b = z + 1 - a
    c = 1 / tiny
    d = 1 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1 / d
        delta = d * c
        h *= delta
        if abs(delta - 1) < 1e-15:
            break
    return math.exp(-z + a * math.log(z) - math.lgamma(a)) * h


def fit_binomial_glm(df: DataFrame, features: list[str], label: str):
    """Logistic GLM (binomial family, logit link) with Spark ML; returns the fitted model."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    data = VectorAssembler(inputCols=features, outputCol="features").transform(df.withColumn(label, F.col(label).cast("double")))
    glm = GeneralizedLinearRegression(family="binomial", link="logit", labelCol=label, featuresCol="features", maxIter=50)
    return glm.fit(data)


def glm_terms(spark, model, features: list[str]) -> DataFrame:
    """``(term, coefficient, std_error, p_value)`` including the intercept."""
    s = model.summary
    coefs = [float(c) for c in model.coefficients] + [float(model.intercept)]
    names = features + ["(Intercept)"]
    se = list(s.coefficientStandardErrors)
    pv = list(s.pValues)
    rows = [(n, c, float(e), float(p)) for n, c, e, p in zip(names, coefs, se, pv)]
    return spark.createDataFrame(rows, "term string, coefficient double, std_error double, p_value double")


def deviance_test(full, smaller=None) -> tuple[float, float, float, float, float]:
    """χ² test of a nested model from two fit summaries (``smaller`` None: the intercept alone):
    deviance of the full and of the smaller model, degrees of freedom, difference, p-value
    (1 where nothing was added)."""
    d_full = float(full.deviance)
    d_small = float(full.nullDeviance if smaller is None else smaller.deviance)
    left = full.residualDegreeOfFreedomNull if smaller is None else smaller.residualDegreeOfFreedom
    df, gain = float(left - full.residualDegreeOfFreedom), max(0.0, d_small - d_full)
    return d_full, d_small, df, gain, chi2_sf(gain, df) if df > 0 and gain > 0 else 1.0
