"""Random graphs G(n, p) and G(n, m), generated inside tasks.

G(n, p) uses geometric skipping (Batagelj–Brandes): for vertex v the gaps between
its neighbours w < v are geometric, so the work is proportional to the edges
produced, not to n². Each vertex draws from its own seeded generator, so the
result does not depend on how the vertex table is partitioned.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EDGE_SCHEMA = "src long, dst long"


def gnp(vertices: DataFrame, p: float, seed: int = 0) -> DataFrame:
    """Undirected G(n, p) over integer vertex ids 0..n−1 given as ``vertices(id)``;
    each edge once as ``(src, dst)`` with ``dst < src``."""
    if not 0 < p < 1:
        raise ValueError("p must lie in (0, 1)")
    log_q = float(np.log1p(-p))

    def gen(batches):
        for pdf in batches:
            src, dst = [], []
            for v in pdf["id"].to_numpy():
                rng = np.random.default_rng([seed, int(v)])
                w = -1
                while True:
                    w += 1 + int(np.floor(np.log1p(-rng.random()) / log_q))
                    if w >= v:
                        break
                    src.append(int(v))
                    dst.append(w)
            yield pd.DataFrame({"src": np.asarray(src, dtype="int64"), "dst": np.asarray(dst, dtype="int64")})

    return vertices.select(F.col("id").cast("long").alias("id")).mapInPandas(gen, EDGE_SCHEMA)


def gnm(spark: SparkSession, n: int, m: int, seed: int = 0, slices: int = 8) -> DataFrame:
    """Undirected G(n, m): exactly ``m`` distinct edges chosen uniformly among n(n−1)/2 pairs.

    Candidate pairs are drawn in parallel (``slices`` seeded generators), deduplicated,
    and the first ``m`` by a seeded random key are kept; more candidates are drawn
    until at least ``m`` distinct pairs exist.
    """
    total = n * (n - 1) // 2
    if m > total:
        raise ValueError("m exceeds the number of vertex pairs")
    want, attempt = int(m * 1.1) + 16, 0
    while True:
        per = want // slices + 1

        def gen(batches, per=per, attempt=attempt):
            for pdf in batches:
                for s in pdf["id"].to_numpy():
                    rng = np.random.default_rng([seed, attempt, int(s)])
                    a = rng.integers(0, n, size=per)
                    b = rng.integers(0, n, size=per)
                    keep = a != b
                    yield pd.DataFrame({"src": np.maximum(a, b)[keep], "dst": np.minimum(a, b)[keep]})

        cand = spark.range(slices).mapInPandas(gen, EDGE_SCHEMA).distinct()
        if cand.count() >= m:
            return cand.orderBy(F.xxhash64("src", "dst", F.lit(seed)), "src", "dst").limit(m)
        want, attempt = want * 2, attempt + 1
