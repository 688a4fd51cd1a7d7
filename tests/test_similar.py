"""Nearest vertices by pivots against all pairs; distance sums by bit sets against plain BFS."""

from collections import defaultdict, deque

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators.graph import paths, similar


def brute(rows, k):
    seen = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        seen[i] = min(seen.get(i, v), v)
    size = max(sorted({len(v) for v in seen.values()}), key=lambda d: sum(len(v) == d for v in seen.values()))
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in seen.items() if len(v) == size}
    out = {}
    for q in (i for i in unit if i % 20 == 0):
        best = sorted((-round(float(unit[q] @ x), 9), i) for i, x in unit.items() if i != q)[:k]
        out |= {(q, n + 1): (i, -s) for n, (s, i) in enumerate(best)}
    return out


@pytest.mark.parametrize("small", [False, True])
def test_nearest_equals_all_pairs(spark, monkeypatch, small):
    if small:  # many parts a cell, many lanes
        monkeypatch.setattr(similar, "PART_ROWS", 16)
        monkeypatch.setattr(similar, "LANE_ROWS", 7)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 6))
    rows = [(i, [float(x) for x in centres[i % 12] + rng.normal(size=6) * 0.2]) for i in range(600)]
    rows += [(600 + i, rows[7][1]) for i in range(200)]  # a quarter are copies: one hot cell, ties by id
    rows += [(None, [1.0] * 6), (900, None), (901, [0.0] * 6), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (903, [float("nan")] * 6),
             (904, [float("inf")] + [0.0] * 5), (905, [1.0, 2.0]), (906, []), (40, [9.0] * 6)]
    frame = spark.createDataFrame(rows, "id long, attrs array<double>").withColumn("cell", F.lit("x"))
    got = {(r.query_id, r["rank"]): (r.id, r.similarity) for r in similar.nearest(frame, F.col("id") % 20 == 0).collect()}
    want = brute(rows, 5)
    assert got.keys() == want.keys()
    assert {q: i for q, (i, _) in got.items()} == {q: i for q, (i, _) in want.items()}
    assert all(abs(got[q][1] - want[q][1]) < 2e-9 for q in want)


def test_few_and_no_vertices(spark):
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.0, -2.0])]
    frame = spark.createDataFrame(rows, "id long, attrs array<double>")
    got = [tuple(r) for r in similar.nearest(frame, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 1.0), (0, 2, 3, 0.0), (20, 1, 0, 1.0), (20, 2, 3, 0.0)]
    assert similar.nearest(frame.limit(0), F.col("id") % 20 == 0).collect() == []


def test_distance_sums_equal_plain_search(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 150, (170, 2))] + [(200 + i, 201 + i) for i in range(30)] + [(500, 500)]
    near = defaultdict(set)
    for a, b in edges:
        if a != b:
            near[a].add(b), near[b].add(a)
    frame = spark.createDataFrame(edges, "src long, dst long")
    for every in (1, 3):
        marks = [v for v in near if v % every == 0]
        want = defaultdict(lambda: [0, 0])
        for m in marks:
            dist, todo = {m: 0}, deque([m])
            while todo:
                v = todo.popleft()
                for w in near[v] - dist.keys():
                    dist[w] = dist[v] + 1
                    todo.append(w)
            for v, d in dist.items():
                if d:
                    want[v][0] += d
                    want[v][1] += 1
        got = paths.distance_sums(frame, spark.createDataFrame([(m,) for m in marks], "id long"))
        assert {r.id: [r.total, r.reached] for r in got.collect()} == dict(want)
    assert paths.distance_sums(frame.limit(0), frame.select(F.col("src").alias("id")).limit(0)).collect() == []
