"""Exact top-k search by inner product over KD-trees, one tree a shard.

Rows are dealt to shards by hash; a shard's tree splits its rows at the median of the
widest coordinate and keeps tight bounding boxes. A query walks a tree best first: a box's
bound is the largest inner product that any point of the box could have, and a box whose
bound lies under the query's k-th best score so far is not opened. Every query searches its
own shard first; the k-th score found there goes with it to all other shards, so that they
prune from the start.

Queries travel in blocks of bounded size: a task holds one tree and one block.

Defined results: vectors that are null, or hold null or non-finite components, and null ids
take no part; rows that share an id count once, with the smallest vector; vectors are
compared with those of their own length only; scores saturate at the limits of 64 bits;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import groups
from tessera.session import cut_lineage

SCALE, TOP = 256, 5
#: Rows of a shard's tree, of a leaf, and of a block of queries.
SHARD_ROWS, LEAF_ROWS, BLOCK_ROWS = 16384, 128, 1024
_LEAST = -(1 << 63)


class Tree:
    """A KD-tree over integer vectors (as float64 when all products are exact in it)."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.ids, self.points, self.nodes = ids, points, []
        self._build(np.arange(len(ids)))

    def _build(self, rows: np.ndarray) -> int:
        box = self.points[rows]
        low, high = box.min(axis=0), box.max(axis=0)
        me = len(self.nodes)
        self.nodes.append(None)
        if len(rows) <= LEAF_ROWS or not len(low) or (low == high).all():
            self.nodes[me] = (low, high, rows, box, self.ids[rows])
        else:
            axis = int((high - low).argmax())
            order = rows[np.argpartition(box[:, axis], len(rows) // 2)]
            self.nodes[me] = (low, high, self._build(order[: len(rows) // 2]), self._build(order[len(rows) // 2 :]), None)
        return me

    def search(self, query_id: int, q: np.ndarray, k: int, at_least) -> list[tuple]:
        """The best ``(score, -id)`` of other ids that can still reach the score ``at_least``."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        best: list[tuple] = []  # a heap whose first entry is the worst kept
        limit = at_least
        low, high = self.nodes[0][:2]
        front = [(-(high @ up + low @ down), 0)]
        while front:
            bound, node = heapq.heappop(front)
            if -bound < limit:
                break
            _, _, a, b, ids = self.nodes[node]
            if ids is None:
                for child in (a, b):
                    low, high = self.nodes[child][:2]
                    bound = high @ up + low @ down
                    if bound >= limit:
                        heapq.heappush(front, (-bound, child))
                continue
            scores = b @ q
            hit = np.flatnonzero((scores >= limit) & (ids != query_id))
            if len(hit) > k:
                hit = hit[np.lexsort((ids[hit], -scores[hit]))[:k]]
            for i in hit:
                entry = (scores[i], -int(ids[i]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
            if len(best) == k:
                limit = max(limit, best[0][0])
        return best


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy()
    rows = flat.reshape(len(column), dim)
    peak = int(np.abs(rows).max(initial=0))
    if peak * peak * max(dim, 1) < 1 << 53:
        return rows.astype(np.float64)
    return rows if peak * peak * dim < 1 << 62 else rows.astype(object)


def _search(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, ["dim", "shard", "block"]):
            dim = g.column("dim")[0].as_py()
            asks = np.array(g.column("ask").to_pylist(), bool)
            points = _matrix(g.column("v"), dim)
            ids = g.column("vec_id").to_numpy()
            if asks.all() or not asks.any():
                continue
            tree, limits = Tree(ids[~asks], points[~asks]), g.column("limit").to_numpy()
            out: list[list] = [[], [], []]
            for i in np.flatnonzero(asks):
                for score, minus in tree.search(int(ids[i]), points[i], k, int(limits[i])):
                    for column, x in zip(out, (int(ids[i]), -minus, max(min(int(score), (1 << 63) - 1), _LEAST)), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], schema=schema)

    return run


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``(vec_id, v)``: floor(scale * x) of each usable vector, one row an id."""
    usable = F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return vectors.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, asks: Column, k: int = TOP, scale: int = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best rows for every row that ``asks``."""
    rows = cut_lineage(quantised(vectors, scale).withColumn("dim", F.size("v")))
    total = rows.count()
    shards, blocks = max(1, -(-total // SHARD_ROWS)), max(1, -(-total // (50 * BLOCK_ROWS)))
    placed = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"))
    queries = placed.where(asks).withColumn("home", F.col("shard"))

    def search(wanted: DataFrame, home: bool) -> DataFrame:
        """``wanted``: queries with ``home`` and ``limit``; against their own shard or all others."""
        spread = wanted if home else wanted.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home")
        named = ["dim", "shard", "block", "vec_id", "v"]
        met = spread.select("dim", "shard", "block").distinct()
        points = placed.drop("block").join(met, ["dim", "shard"])
        both = points.select(*named, F.lit(False).alias("ask"), F.lit(_LEAST).alias("limit")).union(
            spread.select(*named, F.lit(True).alias("ask"), "limit"))
        dealt = both.repartition("dim", "shard", "block").sortWithinPartitions("dim", "shard", "block")
        return dealt.mapInArrow(_search(k), "query_id long, vec_id long, score long")

    near = cut_lineage(search(queries.withColumn("limit", F.lit(_LEAST)), True))
    kth = near.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("limit"))
    far = search(queries.join(kth.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").withColumn(
        "limit", F.coalesce("limit", F.lit(_LEAST))), False) if shards > 1 else near.limit(0)
    return _ranked(near.union(far), k).select("query_id", "rank", "vec_id", "score")
