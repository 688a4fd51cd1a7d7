"""The k most similar vertices by attributes, beyond the edges: exact, by pivots and bounds.

Attributes are scaled to unit length, so that the order by cosine is the order by distance, for
which the triangle inequality holds. Every vertex joins the cell of its nearest pivot. A vertex
that asks meets its own cell first; with the k-th distance found there it then visits only
those cells, and in a cell only those vertices, whose distance from their pivot leaves room for
something nearer. Pairs are compared in blocks of matrix products and never become rows.

Cells are cut into parts of bounded length, so one that holds a third of all vertices is many
tasks; those that ask pass through a part's matrix batch by batch, in lanes of bounded length.
The pivots (at most ``MAX_PIVOTS``) and two figures a cell are all that reaches the driver.

Defined results: vertices whose id or vector is null, whose vector holds null or non-finite
components, has length zero or another number of components than most, take no part; rows that
share an id count once, with the smallest vector. Similarities are ordered rounded to nine digits, ties by id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.vectors import as_double, norm, unit
from tessera.session import cut_lineage, ship_package

MAX_PIVOTS, PART_ROWS, LANE_ROWS, BLOCK = 1024, 8192, 1 << 18, 256
#: Room for rounding in bounds: far above the error of a distance between unit vectors, 1e-7.
SLACK = 1e-6
DIGITS = 9


def usable(vertices: DataFrame, dim: int | None = None) -> DataFrame:
    """``(id, v)``: unit vectors of the vertices that take part."""
    v = as_double(F.col("attrs"))
    # a null component makes the length null, one that is not finite makes it NaN or infinite
    whole = F.col("id").isNotNull() & F.forall("attrs", lambda x: x.isNotNull()) & (norm(v) > 0) & (norm(v) < float("inf"))
    rows = vertices.select(F.col("id").cast("long").alias("id"), "attrs").where(whole)
    if dim is None:
        sizes = rows.groupBy(F.size("attrs").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
        most = sizes.orderBy(F.desc("n"), "dim").first()
        dim = most.dim if most else 0
    one = rows.where(F.size("attrs") == dim).groupBy("id").agg(F.min("attrs").alias("attrs"))
    return one.select("id", unit(as_double(F.col("attrs"))).alias("v"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _from_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (x @ pivots.T), 0.0))


def _to_cells(pivots: np.ndarray) -> Callable:
    """Adds each vertex's cell and its distance from the cell's pivot."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                b = batch.slice(at, 4096)
                far = _from_pivots(_matrix(b.column("v")), pivots)
                cell = far.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), b.column("v"), pa.array(cell.astype(np.int32)), pa.array(far[np.arange(len(cell)), cell])], ["id", "v", "cell", "far"])

    return run


def _visits(pivots: np.ndarray, least: np.ndarray, most: np.ndarray) -> Callable:
    """``(id, v, cell, far, reach)`` for every other cell that may hold something within ``reach``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                far, reach = _from_pivots(_matrix(b.column("v")), pivots), b.column("reach").to_numpy()
                nearest = np.maximum(np.maximum(far - most, least - far), 0.0)
                open_ = nearest <= reach[:, None] + SLACK
                open_[np.arange(len(reach)), b.column("cell").to_numpy()] = False
                rows, cells = np.nonzero(open_)
                yield pa.RecordBatch.from_arrays(
                    [b.column("id").take(pa.array(rows)), b.column("v").take(pa.array(rows)), pa.array(cells.astype(np.int32)), pa.array(far[rows, cells]), pa.array(reach[rows])],
                    ["id", "v", "cell", "far", "reach"])

    return run


def best_of(ids: np.ndarray, points: np.ndarray, far: np.ndarray, ask_ids: np.ndarray, asks: np.ndarray, ask_far: np.ndarray, reach: np.ndarray, k: int):
    """``(row of the asking, id, similarity)`` of the k best points for each that asks; points are sorted
    by ``far``, and those whose distance from the pivot differs by more than ``reach`` are left out."""
    order = np.argsort(ask_far, kind="stable")
    for at in range(0, len(order), BLOCK):
        rows = order[at : at + BLOCK]
        wide = reach[rows] + SLACK
        lo = np.searchsorted(far, (ask_far[rows] - wide).min())
        hi = np.searchsorted(far, (ask_far[rows] + wide).max(), side="right")
        if lo == hi:
            continue
        scores = np.round(asks[rows] @ points[lo:hi].T, DIGITS)
        for i, row in enumerate(rows):
            found = np.flatnonzero(ids[lo:hi] != ask_ids[row])
            mine = scores[i][found]
            if len(found) > k:
                keep = mine >= -np.partition(-mine, k - 1)[k - 1]
                found, mine = found[keep], mine[keep]
                first = np.lexsort((ids[lo:hi][found], -mine))[:k]
                found, mine = found[first], mine[first]
            for f, s in zip(found, mine, strict=True):
                yield row, ids[lo + f], s


def _search(k: int) -> Callable:
    """Rows come sorted by (cell, part, lane), a part's points before those that ask."""
    names = ["query_id", "id", "similarity"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, points, ready = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("cell", "part", "lane", "ask")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if hi == lo:
                    continue
                key, ask = tuple(keys[lo, :3]), keys[lo, 3]
                if key != here:
                    here, points, ready = key, [], None
                b = batch.slice(lo, hi - lo)
                cols = b.column("id").to_numpy(), _matrix(b.column("v")), b.column("far").to_numpy()
                if not ask:
                    points.append(cols)
                    continue
                if not points:
                    continue
                if ready is None:
                    ids, x, far = (np.concatenate([p[i] for p in points]) for i in range(3))
                    by = np.argsort(far, kind="stable")
                    ready = ids[by], x[by], far[by]
                got = list(best_of(*ready, cols[0], cols[1], cols[2], b.column("reach").to_numpy(), k))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array([cols[0][r] for r, _, _ in got], np.int64)), pa.array(np.array([i for _, i, _ in got], np.int64)),
                     pa.array(np.array([s for _, _, s in got], np.float64))], names)

    return run


def nearest(vertices: DataFrame, asks: Column, k: int = 5, dim: int | None = None) -> DataFrame:
    """``(query_id, rank, id, similarity)``: for every vertex of ``vertices`` (``id``, ``attrs``) that
    ``asks`` (a condition on ``id``), its k most similar others by cosine, without regard to edges."""
    spark = vertices.sparkSession
    ship_package(spark)
    rows = cut_lineage(usable(vertices, dim))
    total = rows.count()
    schema = "query_id long, id long, similarity double"
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, id long, similarity double")
    wanted = min(MAX_PIVOTS, int(np.ceil(np.sqrt(total))))
    pivots = np.array([r.v for r in rows.orderBy(F.xxhash64("id"), "id").limit(wanted).collect()])
    placed = cut_lineage(rows.mapInArrow(_to_cells(pivots), "id long, v array<double>, cell int, far double"))
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("far").alias("a"), F.max("far").alias("b")).collect()
    least, most, parts = np.full(len(pivots), np.inf), np.full(len(pivots), -np.inf), np.ones(len(pivots), int)
    for c in cells:  # one row a pivot
        least[c.cell], most[c.cell], parts[c.cell] = c.a, c.b, -(-c.n // PART_ROWS)
    parts_of = F.element_at(F.array(*[F.lit(int(p)) for p in parts]), F.col("cell") + 1)
    queries = placed.where(asks)
    lanes = max(1, -(-queries.count() // LANE_ROWS))
    lane = F.pmod(F.xxhash64("id", F.lit(2)), F.lit(lanes)).cast("int").alias("lane")
    named = ["id", "v", "cell", "far", "part", "lane", "ask", "reach"]
    points = placed.withColumn("part", F.pmod(F.xxhash64("id", F.lit(1)), parts_of).cast("int")).withColumn(
        "lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).withColumn("ask", F.lit(False)).withColumn("reach", F.lit(0.0)).select(*named)

    def search(asking: DataFrame) -> DataFrame:
        spread = asking.select("*", lane, F.explode(F.sequence(F.lit(0), parts_of - 1)).alias("part")).withColumn("ask", F.lit(True)).select(*named)
        dealt = points.unionByName(spread).repartition("cell", "part", "lane").sortWithinPartitions("cell", "part", "lane", "ask")
        return dealt.mapInArrow(_search(k), schema)

    home = cut_lineage(search(queries.withColumn("reach", F.lit(2.0))))
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    kth = home.withColumn("n", F.row_number().over(order)).where(F.col("n") == k).select(F.col("query_id").alias("id"), "similarity")
    # what is as similar as the k-th up to rounding still counts, for ties go by id
    reach = F.coalesce(F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * (F.col("similarity") - 10.0**-DIGITS))), F.lit(2.0))
    reaching = queries.join(kth, "id", "left").select("id", "v", "cell", reach.alias("reach"))
    visits = reaching.mapInArrow(_visits(pivots, least, most), "id long, v array<double>, cell int, far double, reach double")
    found = home.unionByName(search(visits))
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "id", "similarity")
