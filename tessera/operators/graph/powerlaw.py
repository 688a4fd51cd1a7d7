"""Power-law exponent fit with an xmin scan over a degree histogram.

For each candidate xmin (every distinct degree but the largest):
α = 1 + n / Σ ln(x / xmin) over the n values ≥ xmin (continuous MLE), and the
Kolmogorov–Smirnov distance D = max |S(x) − (1 − (x/xmin)^(1−α))| over the
distinct tail values, S the empirical CDF of the tail. The fit is the xmin with
the smallest D (ties: smaller xmin).

Running sums over the histogram give n and Σ ln x for every candidate. The KS maximum
compares each candidate with its tail values: (distinct degrees)² comparisons, at most 4·|E|
and independent of the number of vertices with each degree. The tail values travel as blocks
of BLOCK values, one copy a block of candidates, so the pairs never become rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.ordering import prefix_sum_within
from tessera.session import cut_lineage

BLOCK = 1024


def fit_power_law(hist: DataFrame, value: str = "degree", weight: str = "count") -> DataFrame:
    """One row ``(xmin, alpha, ks, n_tail)`` from a ``(value, weight)`` histogram."""
    h = hist.select(F.col(value).cast("double").alias("x"), F.col(weight).cast("double").alias("w")).where("x > 0")
    h = h.select(F.lit(0).alias("all"), "x", (-F.col("x")).alias("down"), "w", (F.col("w") * F.ln("x")).alias("wl"))
    h = cut_lineage(prefix_sum_within(h, "all", ["down"], ["w", "wl"], ["above", "logs_above"]))
    n_values, total, xmax = h.agg(F.count(F.lit(1)), F.sum("w"), F.max("x")).first()
    blocks = max(1, -(-n_values // BLOCK))
    block = F.pmod(F.xxhash64("x"), F.lit(blocks)).cast("int")
    n = F.col("above") + F.col("w")
    below = F.lit(total) - n
    cand = h.where(F.col("x") < F.lit(xmax)).select(
        block.alias("block"), F.col("x").alias("xmin"), n.alias("n_tail"), below.alias("below"),
        (1 + n / (F.col("logs_above") + F.col("wl") - n * F.ln("x"))).alias("alpha"),
    )
    tail = h.groupBy(block.alias("tail_block")).agg(
        F.collect_list(F.struct("x", (below + F.col("w")).alias("cum"))).alias("tail")
    ).select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "tail")
    distance = lambda t: F.when(
        t.x >= F.col("xmin"),
        F.abs((t.cum - F.col("below")) / F.col("n_tail") - (1 - F.pow(t.x / F.col("xmin"), 1 - F.col("alpha")))),
    )
    met = cand.join(tail, "block").withColumn("ks", F.array_max(F.transform("tail", distance)))
    ks = met.groupBy("xmin", "alpha", "n_tail").agg(F.max("ks").alias("ks"))
    best = ks.orderBy("ks", "xmin").limit(1)
    return best.select("xmin", "alpha", "ks", F.col("n_tail").cast("bigint").alias("n_tail"))
