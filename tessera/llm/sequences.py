"""Packed token-id matrices by best-fit decreasing.

Documents are tokenized, cut losslessly at the capacity and dealt to shards by hash; in a
shard the pieces, longest first, go to the sequence with the least room that fits, which a
segment tree over capacities finds in log steps. A shard is bounded by its share of the
corpus; shards cost at most one part-filled sequence each.

A sequence is a row: its ids as a little-endian 16-bit matrix row padded to the capacity,
the cumulative lengths of its segments, and positions that restart at every segment.

Defined results: null and empty texts are segments of the end id alone; null ids own
segments like others; repeated rows are packed each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import groups
from tessera.llm.tokens import word_bpe

CAPACITY, END_ID, PAD_ID = 2048, 1, 0
#: Characters of text whose ids a shard holds, on average (a character makes under one id).
SHARD_CHARS = 16 << 20
TEXTS = 500

TYPES = ("shard int, sequence int, n_tokens int, ids binary, cu_seqlens array<int>, position_ids binary, "
         "doc_ids array<long>, pieces array<int>, starts array<long>")


class Rooms:
    """A segment tree over capacities: which amounts of room occur, and the smallest that fits."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.any = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, sequence: int) -> None:
        self.bins[room].append(sequence)
        i = room + self.size
        while i:
            self.any[i] += 1
            i >>= 1

    def take(self, length: int) -> tuple[int, int] | None:
        """The least room of at least ``length`` and a sequence that has it, taken out."""
        i = length + self.size
        while not self.any[i]:
            while i & 1:  # a right child: nothing further right below its parent
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.size:
            i = 2 * i if self.any[2 * i] else 2 * i + 1
        room = i - self.size
        sequence = self.bins[room].pop()
        while i:
            self.any[i] -= 1
            i >>= 1
        return room, sequence


def best_fit(lengths: list[int], capacity: int) -> list[int]:
    """The sequence of each piece; ``lengths`` fall."""
    rooms, out, made = Rooms(capacity), [], 0
    for n in lengths:
        room, sequence = rooms.take(n) or (capacity, made)
        made += sequence == made
        out.append(sequence)
        if room > n:
            rooms.add(room - n, sequence)
    return out


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """``(doc_id, piece, start, ids)``: 16-bit ids of each document and the end id, cut at the capacity."""
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("ids", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = word_bpe(tokenizer), np.array([end_id], "<u2").tobytes()
        for whole in batches:
            for a in range(0, whole.num_rows, TEXTS):
                batch, out = whole.slice(a, TEXTS), ([], [], [], [])
                for doc, ids in zip(batch.column("doc_id").to_pylist(), bpe.ids(batch.column("text").to_pylist()), strict=True):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 2 * capacity)):
                        for column, x in zip(out, (doc, k, at // 2, ids[at : at + 2 * capacity]), strict=True):
                            column.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, piece int, start long, ids binary")


def _pack(capacity: int, pad_id: int):
    types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
    names = [t.split()[0] for t in TYPES.split(", ")]
    schema = pa.schema(list(zip(names, types, strict=True)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pad = np.array([pad_id], "<u2").tobytes()
        for g in groups(batches, ["shard"]):
            shard, ids = g.column("shard")[0].as_py(), g.column("ids").to_pylist()
            docs, part, start = (g.column(c).to_pylist() for c in ("doc_id", "piece", "start"))
            order = sorted(range(len(ids)), key=lambda i: (-len(ids[i]), docs[i] is not None, docs[i] or 0, part[i]))
            rows: list[list[int]] = []
            for i, s in zip(order, best_fit([len(ids[i]) // 2 for i in order], capacity), strict=True):
                if s == len(rows):
                    rows.append([])
                rows[s].append(i)
            for a in range(0, len(rows), 1000):
                out: list[list] = [[] for _ in names]
                for s, row in enumerate(rows[a : a + 1000], a):
                    lengths = [len(ids[i]) // 2 for i in row]
                    total = sum(lengths)
                    positions = np.concatenate([np.arange(n, dtype="<u2") for n in [*lengths, capacity - total]])
                    made = (shard, s, total, b"".join(ids[i] for i in row) + pad * (capacity - total),
                            np.cumsum([0, *lengths]).tolist(), positions.tobytes(), [docs[i] for i in row], [part[i] for i in row], [start[i] for i in row])
                    for column, x in zip(out, made, strict=True):
                        column.append(x)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], schema=schema)

    return run


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, pad_id: int = PAD_ID,
         shard_chars: int = SHARD_CHARS) -> DataFrame:
    """One row a sequence: ``ids`` and ``position_ids`` (capacity 16-bit numbers each), ``cu_seqlens``,
    and the documents, pieces and starts of its segments."""
    if not 0 < capacity < 1 << 16:
        raise ValueError("positions are 16-bit")
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = max(1, -(-chars // shard_chars))
    dealt = pieces(docs, tokenizer, capacity, end_id).withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)).cast("int"))
    return dealt.repartition(shards, "shard").sortWithinPartitions("shard").mapInArrow(_pack(capacity, pad_id), TYPES)


def write_matrices(packed: DataFrame, path: str) -> None:
    """Writes the packed rows as Parquet: fixed-width id and position rows, a folder a shard."""
    packed.write.mode("overwrite").partitionBy("shard").parquet(path)
