"""Shared helpers of the corpus operators: reading tables, folds, vectorised word hashing,
and streaming groups of a sorted partition."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir

#: A word is a maximal run of bytes outside the six ASCII white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Texts are hashed in pieces of about this many bytes, to bound a task's memory.
CHUNK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_RADIX = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def ship(spark: SparkSession) -> None:
    """Give executors this package, by Spark's own file distribution, once a session."""
    sc = spark.sparkContext
    if not any(os.path.basename(f) == "tessera_package.zip" for f in sc._python_includes):
        root = Path(__file__).resolve().parents[1]
        target = os.path.join(tempfile.mkdtemp(prefix="tessera-"), "tessera_package.zip")
        with zipfile.ZipFile(target, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        sc.addPyFile(target)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table of the data folder, read by Spark (a file or a folder of part files)."""
    ensure_checkpoint_dir(spark)
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, training: Column, rows: int) -> DataFrame:
    """``(doc_id, text, label)`` of at most ``rows`` labelled documents.

    The sample is the labelled rows of the training folds with the smallest md5 of their
    id: the same on every run and at every partitioning. Only its ids (at most ``rows``)
    are broadcast, so the texts of the other documents are neither moved nor decoded further.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & training)
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.md5(F.col("doc_id").cast("string").cast("binary")), "doc_id")
        .limit(rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + (1 << 16))
        for slot, base in ((0, _RADIX), (1, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[slot] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


class Words:
    """The words of several texts as flat arrays.

    ``buf``: the bytes of the texts, joined by line ends; ``start``/``end``: a word's
    place in ``buf``; ``hash``: its 64-bit hash; ``doc``: the text's index in the list;
    ``first``: for each text the index of its first word (one entry more than texts);
    ``at``: where each text begins in ``buf``.
    """

    def __init__(self, texts: list[bytes | None], lower: bool = True):
        texts = [t or b"" for t in texts]
        joined = b"\n".join(texts) + b"\n"
        if lower:
            joined = joined.lower()  # of bytes: A-Z alone
        self.buf = buf = np.frombuffer(joined, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.at = np.concatenate(([0], np.cumsum(sizes)))
        inside = ~_SPACE[buf]
        edge = np.diff(inside.view(np.int8), prepend=0, append=0)
        self.start = np.flatnonzero(edge == 1)
        self.end = np.flatnonzero(edge == -1)
        power, inverse = _power_tables(len(buf))
        total = np.empty(len(buf) + 1, np.uint64)
        total[0] = 0
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * power, out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * inverse[self.start])
        self.first = np.searchsorted(self.start, self.at)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))


def chunks(texts: list[bytes | None]) -> Iterator[tuple[int, int]]:
    """Ranges of the list that hold about CHUNK_BYTES each (a longer text stands alone)."""
    return spans([len(t or b"") for t in texts])


def spans(lengths: list[int], most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """``chunks`` of about ``most`` bytes by the texts' lengths, before any is taken out of its batch."""
    begin, size = 0, 0
    for i, n in enumerate(lengths):
        if size and size + n > most:
            yield begin, i
            begin, size = i, 0
        size += n + 1
    if begin < len(lengths):
        yield begin, len(lengths)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def per_text(fn: Callable, columns: list[str], schema: pa.Schema, most: int = CHUNK_BYTES) -> Callable:
    """A mapInArrow function: ``fn(texts, batch slice)`` gives arrays for the schema's other
    fields; ``columns`` are carried from the input. Works in chunks of about ``most`` bytes, and
    takes no more texts than a chunk's out of a batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in spans(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist(), most):
                part = batch.slice(a, b - a)
                made = fn(text_bytes(part), part)
                arrays = [part.column(c) if c in columns else made[c] for c in schema.names]
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x, type=schema.field(i).type) for i, x in enumerate(arrays)],
                    schema=schema,
                )

    return run


def groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal ``keys`` from a partition sorted by them; holds one group and one batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[a] for c in cols)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)

