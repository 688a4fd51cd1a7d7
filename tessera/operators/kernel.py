"""Kernel regression of query rows on all training rows, by blocked matrix products.

A query's value is sum(y * e^(c*corr)) / sum(e^(c*corr)) over the training rows, corr being the
correlation of the first ``h`` positions, for each horizon h. Queries lie in groups and training
rows in parts of bounded size; a cell holds one group as a matrix and streams one part through
it. A cell gives two partial sums a query and horizon, so pairs are never rows and nothing is
broadcast. Shuffled: the queries once a part, the training rows once a group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Queries of a group and training rows of a part, about; training rows multiplied at once.
GROUP_ROWS, PART_ROWS, STEP = 1 << 14, 1 << 16, 1 << 10


def _usable(longest: int):
    bad = F.exists(F.slice("x", 1, longest), lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.col("x").isNotNull() & (F.size("x") >= longest) & ~bad


def _scaled(x: np.ndarray, h: int) -> np.ndarray:
    """Rows whose products are the correlations of their first h positions; constant rows give 0."""
    x = x[:, :h] - x[:, :h].mean(1, keepdims=True)
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    flat = norm <= 1e-12 * np.sqrt(h)
    return np.where(flat, 0, x / np.where(flat, 1, norm))


def _cells(horizons: tuple[int, ...], c: float, key: pa.DataType):
    schema = pa.schema([("id", key), *[(f"{n}_{h}", pa.float64()) for h in horizons for n in ("num", "den")]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, ids, rows, scaled, sums = None, [], [], None, None

        def done() -> Iterator[pa.RecordBatch]:
            if sums is not None:
                yield pa.RecordBatch.from_arrays([pa.array(ids, key), *[pa.array(s) for s in sums]], schema=schema)

        for batch in batches:
            where = list(zip(batch.column("g").to_pylist(), batch.column("p").to_pylist(), strict=True))
            kinds = batch.column("kind").to_numpy()
            cuts = [0, *[i for i in range(1, len(where)) if where[i] != where[i - 1] or kinds[i] != kinds[i - 1]], len(where)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if where[a] != cell:
                    yield from done()
                    cell, ids, rows, scaled, sums = where[a], [], [], None, None
                x = np.array(part.column("x").to_pylist())
                if kinds[a] == 0:
                    ids += part.column("id").to_pylist()
                    rows.append(x)
                    continue
                if not rows:
                    continue
                if scaled is None:
                    scaled = [_scaled(np.concatenate(rows), h) for h in horizons]
                    sums = [np.zeros(len(ids)) for _ in range(2 * len(horizons))]
                y = part.column("y").to_numpy()
                for begin in range(0, len(x), STEP):
                    for k, h in enumerate(horizons):
                        weight = np.exp(c * (scaled[k] @ _scaled(x[begin : begin + STEP], h).T))
                        sums[2 * k] += weight @ y[begin : begin + STEP]
                        sums[2 * k + 1] += weight.sum(1)
        yield from done()

    return run


def kernel_regression(queries: DataFrame, training: DataFrame, horizons: tuple[int, ...], c: float = 2.0,
                      group_rows: int = GROUP_ROWS, part_rows: int = PART_ROWS) -> DataFrame:
    """``id, pred_<h>, ...``. ``queries``: (id, x); ``training``: (x, y). Rows whose first positions are
    missing, null or not finite take no part, nor training rows without y; ids are not null and differ."""
    longest = max(horizons)
    queries = queries.select("id", F.transform("x", lambda v: v.cast("double")).alias("x")).where(_usable(longest) & F.col("id").isNotNull())
    training = training.select(F.transform("x", lambda v: v.cast("double")).alias("x"), F.col("y").cast("double").alias("y")).where(_usable(longest) & F.col("y").isNotNull())
    groups, parts = queries.count() // group_rows + 1, training.count() // part_rows + 1
    kind = queries.schema["id"].dataType.simpleString()
    asked = queries.select(F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("g"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("p"), F.lit(0).alias("kind"), "id", "x", F.lit(None).cast("double").alias("y"))
    spread = training.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("g"), F.pmod(F.xxhash64("x", "y"), F.lit(parts)).cast("int").alias("p"), F.lit(1).alias("kind"), F.lit(None).cast(kind).alias("id"), "x", "y")
    dealt = asked.unionByName(spread).repartition(groups * parts, "g", "p").sortWithinPartitions("g", "p", "kind")
    ddl = f"id {kind}, " + ", ".join(f"num_{h} double, den_{h} double" for h in horizons)
    arrow = pa.string() if kind == "string" else pa.int64() if kind == "bigint" else pa.int32()
    sums = dealt.mapInArrow(_cells(tuple(horizons), c, arrow), ddl)
    total = sums.groupBy("id").agg(*[F.sum(f"{n}_{h}").alias(f"{n}_{h}") for h in horizons for n in ("num", "den")])
    return total.select("id", *[(F.col(f"num_{h}") / F.col(f"den_{h}")).alias(f"pred_{h}") for h in horizons])
