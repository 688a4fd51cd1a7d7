"""Vector expressions on ``array<double>`` columns, evaluated row-wise in the JVM.

Higher-order functions keep these inside whole-stage codegen: no UDF, no
explode/regroup shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(v: Column) -> Column:
    return F.transform(v, lambda x: x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; null when either vector has zero length."""
    den = norm(a) * norm(b)
    return F.when(den > 0, dot(a, b) / den)


def unit(a: Column) -> Column:
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x / n))


def scale(a: Column, s: Column) -> Column:
    return F.transform(a, lambda x: x * s)


def add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def nan_to_zero(a: Column) -> Column:
    return F.transform(a, lambda x: F.nanvl(x, F.lit(0.0)))


def pearson(a: Column, b: Column) -> Column:
    """Pearson correlation of two equal-length vectors (population moments); null if a variance is 0.

    One pass over the pairs accumulates n, Σa, Σb, Σab, Σa², Σb² (no per-element
    re-evaluation of the means inside the lambda).
    """
    zero = F.struct(*[F.lit(0.0).alias(k) for k in ("n", "sa", "sb", "sab", "saa", "sbb")])

    def step(acc, p):
        x, y = p["x"], p["y"]
        return F.struct(
            (acc["n"] + 1).alias("n"), (acc["sa"] + x).alias("sa"), (acc["sb"] + y).alias("sb"),
            (acc["sab"] + x * y).alias("sab"), (acc["saa"] + x * x).alias("saa"), (acc["sbb"] + y * y).alias("sbb"),
        )

    def finish(s):
        cov = s["n"] * s["sab"] - s["sa"] * s["sb"]
        va = s["n"] * s["saa"] - s["sa"] * s["sa"]
        vb = s["n"] * s["sbb"] - s["sb"] * s["sb"]
        return F.when((va > 0) & (vb > 0), cov / F.sqrt(va * vb))

    pairs = F.arrays_zip(a.alias("x"), b.alias("y"))
    return F.aggregate(pairs, zero, step, finish)
