"""Best-fit packing of documents into few sequences by linear grouping.

Large pieces are dealt, by falling length, into groups of equal cardinality and rounded up
to the group's longest; few-size configurations of the rounded lengths are optimised by
column generation; every configuration slot is then given an actual piece of its group,
and all small pieces go by falling length to the tightest place that is left.

Only the histogram of lengths (at most ``capacity`` rows, whatever the input) reaches the
driver. The plan made from it is a table of runs: pieces ``rank .. rank + count`` of one
length go, ``per`` to a sequence, to sequences ``bin, bin + 1, ...`` from a given place on.
Executors number the pieces of a length by (hash bucket, id), so a frequent length is dealt
out over many tasks, and look their run up in the plan.

Defined results: null and empty texts are pieces of the end id alone; a null id is a piece
owner like any other; repeated rows are packed as often as they occur; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.tokens import word_bpe
from tessera.session import cut_lineage

CAPACITY = 4096
END_ID = 1
#: Pieces longer than capacity / LARGE_PART are grouped; the others fill what is left.
LARGE_PART = 10
#: Groups of equal cardinality, and so sizes that a configuration chooses from.
GROUPS = 64
#: Column generation stops when no configuration improves by more than this, or after ROUNDS.
TOLERANCE, ROUNDS = 1e-3, 400
#: Pieces of one length and bucket that a window sorts together, on average at most.
BUCKET_ROWS = 100_000
#: Texts tokenized at a time.
TEXTS = 500

PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
])
RUNS = "length long, rank long, count long, bin long, per long, place long"


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: each document's ids and the end id, cut at ``capacity``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = word_bpe(tokenizer), np.array([end_id], "<u2").tobytes()
        for whole in batches:
            for a in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(a, TEXTS)
                out: list[list] = [[], [], [], [], []]
                for doc, ids in zip(batch.column("doc_id").to_pylist(), bpe.ids(batch.column("text").to_pylist()), strict=True):
                    ids = np.frombuffer(ids + end, "<u2").astype("<u4")
                    for k, at in enumerate(range(0, len(ids), capacity)):
                        part = ids[at : at + capacity]
                        for col, x in zip(out, (doc, k, at, len(part), zlib.crc32(part)), strict=True):
                            col.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(out, PIECES, strict=True)], schema=PIECES)

    types = "doc_id long, piece int, start long, length long, ids_crc32 long"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, types)


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], int]]:
    """``(pieces of each size, how often)``: whole uses of the best few-size configurations.

    Column generation for the fractional cutting-stock problem, rounded down; what the
    rounding leaves is the caller's.
    """
    n = len(sizes)
    s, need = np.array(sizes), np.array(demand, float)
    basis = np.diag([float(capacity // x) for x in sizes])
    for _ in range(ROUNDS):
        inverse = np.linalg.inv(basis)
        worth = inverse.sum(axis=0)  # what one more piece of each size costs
        # the most worth that pieces fill into each capacity, one more piece a layer
        best, took = np.zeros(capacity + 1), []
        for _ in range(capacity // int(s.min())):
            layer, pick = best.copy(), np.full(capacity + 1, -1)
            for i, size in enumerate(sizes):
                value = best[: capacity + 1 - size] + worth[i]
                better = value > layer[size:]
                layer[size:][better], pick[size:][better] = value[better], i
            if not (pick >= 0).any():
                break
            best = layer
            took.append(pick)
        if best[capacity] < 1 + TOLERANCE:
            break
        column, c = np.zeros(n), capacity
        for pick in reversed(took):
            if pick[c] >= 0:
                column[pick[c]] += 1
                c -= sizes[pick[c]]
        uses, rate = inverse @ need, inverse @ column
        ratio = np.where(rate > 1e-12, uses / np.where(rate > 1e-12, rate, 1), np.inf)
        basis[:, int(ratio.argmin())] = column
    uses = np.floor(np.linalg.inv(basis) @ need + 1e-9).astype(int)
    return [(basis[:, k].astype(int).tolist(), int(u)) for k, u in enumerate(uses) if u > 0]


class Places:
    """Sequences by what is left in them: for each capacity left, runs of (first, how many)."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.runs, self.left = capacity, 0, {}, []

    def put(self, left: int, first: int, count: int) -> None:
        if left not in self.runs:
            self.runs[left] = []
            insort(self.left, left)
        self.runs[left].append((first, count))

    def tightest(self, length: int, wanted: int) -> tuple[int, int, int]:
        """A run of sequences with the least room for a piece of that length; new ones if there is none."""
        k = bisect_left(self.left, length)
        if k == len(self.left):
            count = -(-wanted // (self.capacity // length))
            self.bins += count
            return self.capacity, self.bins - count, count
        left = self.left[k]
        first, count = self.runs[left].pop()
        if not self.runs[left]:
            del self.runs[left], self.left[k]
        return left, first, count

    def fit(self, length: int, count: int, rank: int) -> Iterator[tuple[int, int, int, int, int, int]]:
        """Best fit of equal pieces: the runs that take them."""
        while count:
            left, first, bins = self.tightest(length, count)
            per, place = left // length, self.capacity - left
            full = min(bins, count // per)
            if full:
                yield length, rank, full * per, first, per, place
                rank, count = rank + full * per, count - full * per
                self.put(left - per * length, first, full)
                first, bins = first + full, bins - full
            if count and bins:  # fewer than ``per`` are left
                yield length, rank, count, first, count, place
                self.put(left - count * length, first, 1)
                first, bins, count = first + 1, bins - 1, 0
            if bins:
                self.put(left, first, bins)


def plan(histogram: dict[int, int], capacity: int = CAPACITY, large_part: int = LARGE_PART, groups: int = GROUPS) -> list[tuple]:
    """The runs ``(length, rank, count, bin, per, place)`` that pack a histogram of lengths.

    Their number is bounded by the capacity and the groups, not by the counts.
    """
    places, runs = Places(capacity), []
    used = dict.fromkeys(histogram, 0)  # pieces of a length that have a place
    full = histogram.get(capacity, 0)
    if full:
        runs.append((capacity, 0, full, 0, 1, 0))
        places.bins, used[capacity] = full, full
    large = sorted((x for x in histogram if capacity // large_part < x < capacity), reverse=True)
    total = sum(histogram[x] for x in large)
    if total:
        # groups of equal cardinality: runs (length, first rank, count), longest first
        edges = [total * g // groups for g in range(groups + 1)]
        grouped: list[list[list[int]]] = [[] for _ in range(groups)]
        at, g = 0, 0
        for x in large:
            done = 0
            while done < histogram[x]:
                while at >= edges[g + 1]:
                    g += 1
                take = min(histogram[x] - done, edges[g + 1] - at)
                grouped[g].append([x, done, take])
                done, at = done + take, at + take
        grouped = [members for members in grouped if members]
        rounded: dict[int, list[list[int]]] = {}
        for members in grouped:
            rounded.setdefault(members[0][0], []).extend(members)
        sizes = list(rounded)
        for pattern, times in configurations(sizes, [sum(m[2] for m in rounded[x]) for x in sizes], capacity):
            filled = [(places.bins, times, 0)]  # runs of sequences with the same content so far: (first, count, place)
            places.bins += times
            for size, slots in zip(sizes, pattern, strict=True):
                for _ in range(slots):
                    after, members = [], rounded[size]
                    for first, count, place in filled:
                        while count and members:
                            length, rank, there = members[0]
                            take = min(count, there)
                            runs.append((length, rank, take, first, 1, place))
                            used[length] += take
                            after.append((first, take, place + length))
                            first, count = first + take, count - take
                            members[0] = [length, rank + take, there - take]
                            if take == there:
                                members.pop(0)
                        if count:
                            after.append((first, count, place))
                    filled = after
            for first, count, place in filled:
                if place < capacity:
                    places.put(capacity - place, first, count)
        rest = sorted((m for members in rounded.values() for m in members), key=lambda m: -m[0])
    else:
        rest = []
    small = [[x, 0, histogram[x]] for x in sorted((x for x in histogram if x <= capacity // large_part), reverse=True)]
    for length, rank, count in [*rest, *small]:
        if count and length < capacity:
            runs += places.fit(length, count, rank)
    return runs


def place(cut: DataFrame, capacity: int = CAPACITY, large_part: int = LARGE_PART, groups: int = GROUPS) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to a written table of pieces."""
    spark = cut.sparkSession
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = spark.createDataFrame(plan(histogram, capacity, large_part, groups), RUNS)
    buckets = max(1, -(-max(histogram.values(), default=1) // BUCKET_ROWS))
    keyed = cut.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)))
    counts = keyed.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = keyed.withColumn("_i", F.row_number().over(inside) - 1).join(offsets, ["length", "_bucket"])
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_i")).drop("_before", "_i", "_bucket")
    # the runs' number is bounded by capacity and groups: safe to broadcast
    r = F.broadcast(runs.withColumnRenamed("length", "_length"))
    hit = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("rank")) & (F.col("_rank") < F.col("rank") + F.col("count"))
    step = F.col("_rank") - F.col("rank")
    return ranked.join(r, hit).select(
        *cut.columns,
        (F.col("bin") + F.floor(step / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("place") + step % F.col("per") * F.col("length")).cast("long").alias("offset"),
    )


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row a piece: ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``."""
    return place(cut_lineage(pieces(docs, tokenizer, capacity, end_id)), capacity)
