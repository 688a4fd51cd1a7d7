"""Near-duplicate classes from bottom-k sketches of one hash function.

1. A document's set: the 64-bit hashes of its distinct five-word shingles. Documents with
   equal sets form a class at once, represented by the smallest id.
2. A representative keeps the k smallest hashes of its set, its bottom-k sketch. Inverted
   lists generate the overlaps. A list is keyed by three retained values that follow each
   other, not by one, because a passage that many documents share would give its every
   value a list of all of them. Two sets of likeness 0.85 share such a run unless their
   sketches agree in no three neighbours: about one pair in 10^10 for k = 48, and never for
   sets no larger than k.
3. Every member of a list is filed under the list's smallest id, its centre. Two documents
   that share any run share a centre, so a centre's members are compared with each other
   and nothing else is. They are compared in blocks of bounded size: a hot centre becomes
   many tasks, and pairs never become rows.
4. In a block, the union sketch (all values below the smaller of two sketches' largest)
   estimates each pair's likeness. Members with no partner near the threshold leave.
5. The others' full sets, from their whole texts, confirm the links exactly; a block emits
   a spanning forest of its confirmed links. Components of those links are the classes.

Defined results: a null or empty text has an empty set and links with nothing; a null id
takes part in nothing and its row is kept; repeated rows give repeated, equal rows; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tessera.llm.common import Words, chunks, groups, mix, text_bytes
from tessera.operators.graph.components import connected_components
from tessera.session import cut_lineage

WORDS = 5
#: Link when 100 * intersection >= PERCENT * union.
PERCENT = 85
SKETCH = 48
RUN = 3
#: The estimate may fall short of the threshold by this many standard deviations.
SLACK = 4.8
#: Members of a block of sketches; hashes in a block of full sets.
BLOCK_MEMBERS, BLOCK_HASHES = 512, 1 << 17
#: Cells of the overlap matrix filled at a time.
CELLS = 1 << 22


def shingle_sets(texts: list[bytes | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles."""
    for a, b in chunks(texts):
        w = Words(texts[a:b])
        h, first = w.hash, w.first
        rolled = np.zeros(max(len(h) - words + 1, 0), np.uint64)
        for i in range(words):
            rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + h[i : len(h) - words + 1 + i]
        rolled = mix(rolled)
        for k in range(b - a):
            begin, n = first[k], first[k + 1] - first[k]
            if n >= words:
                yield np.unique(rolled[begin : begin + n - words + 1])
            elif n:
                short = np.uint64(n)
                for x in h[begin : begin + n]:
                    short = (short ^ x) * np.uint64(0xD6E8FEB86659FD93)  # scalars wrap
                yield mix(np.array([short], np.uint64))
            else:
                yield np.empty(0, np.uint64)


def _sketches(k: int, words: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_key", pa.binary()), ("sketch", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                n, key, sketch = [], [], []
                for s in shingle_sets(text_bytes(batch), words):
                    n.append(len(s))
                    key.append(xxh3_128_digest(s.tobytes()) if len(s) else None)
                    sketch.append(s[:k].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sketch, pa.binary())], schema=schema)

    return run


def _runs(length: int):
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = [], []
            for i, s in zip(batch.column("id").to_pylist(), batch.column("sketch").to_pylist(), strict=True):
                s = np.frombuffer(s, np.uint64)
                if len(s) >= length:
                    m = len(s) - length + 1
                    rolled = np.zeros(m, np.uint64)
                    for j in range(length):
                        rolled = rolled * np.uint64(0xA0761D6478BD642F) + s[j : j + m]
                    keys.append(mix(rolled).view(np.int64))
                    ids.append(np.full(m, i, np.int64))
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids))], schema=schema)

    return run


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections of some sets, without forming pairs of hashes."""
    m = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    column = np.cumsum(np.diff(values, prepend=values[:1]) != 0) if len(values) else values
    shared = np.bincount(column.astype(np.int64)) > 1 if len(values) else np.zeros(0, bool)
    keep = shared[column.astype(np.int64)] if len(values) else np.zeros(0, bool)
    owner, column = owner[keep], (np.cumsum(shared) - 1)[column[keep].astype(np.int64)] if keep.any() else owner[keep]
    total = np.zeros((m, m))
    step = max(1, CELLS // m)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        lo, hi = np.searchsorted(column, [a, a + step])
        seen = np.zeros((m, min(step, int(column[-1]) + 1 - a)), np.float32)
        seen[owner[lo:hi], column[lo:hi] - a] = 1
        total += seen @ seen.T
    return total


def estimates(sketches: list[np.ndarray], sizes: np.ndarray, k: int) -> np.ndarray:
    """Likeness of all pairs from their union sketches; exact when both sets fit their sketch."""
    common = overlaps(sketches)
    top = np.array([np.iinfo(np.uint64).max if n <= k else s[-1] for s, n in zip(sketches, sizes, strict=True)], np.uint64)
    below = np.stack([np.searchsorted(s, top, "right") for s in sketches])  # [i, j]: values of i up to j's largest
    own = np.array([len(s) for s in sketches])
    mine = np.where(top[:, None] <= top[None, :], own[:, None], below)
    return common / np.maximum(mine + mine.T - common, 1)


def _crossing(side: np.ndarray, i: int, j: int) -> np.ndarray:
    """Pairs that this block pair owns: all inside one block, or those between two."""
    m = len(side)
    own = ~np.eye(m, dtype=bool)
    return own if i == j else own & (side[:, None] != side[None, :])


def _near(least: float, k: int):
    schema = pa.schema([("center", pa.int64()), ("id", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, ["center", "_i", "_j"]):
            if g.num_rows < 2:
                continue
            sketches = [np.frombuffer(s, np.uint64) for s in g.column("sketch").to_pylist()]
            likeness = estimates(sketches, g.column("n").to_numpy(), k)
            own = _crossing(g.column("_b").to_numpy(), g.column("_i")[0].as_py(), g.column("_j")[0].as_py())
            stay = ((likeness >= least) & own).any(axis=1)
            if stay.any():
                t = g.select(["center", "id"]).filter(pa.array(stay)).combine_chunks()
                yield from t.cast(schema).to_batches()

    return run


def block_links(percent: int):
    """A mapInArrow function: the links inside each block pair of ``blocked`` sets (``id``, ``n``, ``hashes``)."""
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, ["center", "_i", "_j"]):
            if g.num_rows < 2:
                continue
            sets = [np.frombuffer(s, np.uint64) for s in g.column("hashes").to_pylist()]
            n = g.column("n").to_numpy()
            common = overlaps(sets)
            linked = 100 * common >= percent * (n[:, None] + n[None, :] - common)
            linked &= _crossing(g.column("_b").to_numpy(), g.column("_i")[0].as_py(), g.column("_j")[0].as_py())
            ids, src, dst = g.column("id").to_numpy(), [], []
            left = np.ones(len(ids), bool)
            while left.any():  # a spanning forest, breadth first
                root = int(left.argmax())
                left[root] = False
                wave = [root]
                while wave:
                    x = wave.pop()
                    new = np.flatnonzero(linked[x] & left)
                    left[new] = False
                    src += [ids[x]] * len(new)
                    dst += ids[new].tolist()
                    wave += new.tolist()
            if src:
                yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], schema=schema)

    return run


def blocked(members: DataFrame, weight: str | None, limit: int) -> DataFrame:
    """Deals each centre's members to blocks of about ``limit`` (rows, or sum of ``weight``) and
    gives every pair of its blocks ``(_i <= _j)`` a copy, sorted for a pass over the groups."""
    load = F.count(F.lit(1)) if weight is None else F.sum(weight)
    sizes = members.groupBy("center").agg(F.ceil(load / limit).cast("int").alias("_blocks"), F.count(F.lit(1)).alias("_m"))
    dealt = members.join(sizes.where("_m > 1").drop("_m"), "center").withColumn(
        "_b", F.pmod(F.xxhash64("id", F.lit(7)), F.col("_blocks")).cast("int"))
    dealt = dealt.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    dealt = dealt.withColumns({"_i": F.least("_b", "_o").cast("int"), "_j": F.greatest("_b", "_o").cast("int")}).drop("_o", "_blocks")
    return dealt.repartition("center", "_i", "_j").sortWithinPartitions("center", "_i", "_j")


def links(docs: DataFrame, reps: DataFrame, percent: int = PERCENT, k: int = SKETCH, words: int = WORDS) -> DataFrame:
    """``(src, dst)``: confirmed links that connect what is linked, between representatives.

    ``reps``: written ``(id, n, sketch)``; ``docs``: ``(doc_id, text)`` with their texts.
    """
    lists = reps.where(f"n >= {RUN}").select("id", "sketch").mapInArrow(_runs(RUN), "key long, id long")
    heads = lists.groupBy("key").agg(F.min("id").alias("center"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    filed = lists.join(heads.select("key", "center"), "key").select("center", "id").distinct()
    t = percent / 100
    least = t - SLACK * (t * (1 - t) / k) ** 0.5
    near = cut_lineage(
        blocked(filed.join(reps, "id"), None, BLOCK_MEMBERS).select("center", "_i", "_j", "_b", "id", "n", "sketch")
        .mapInArrow(_near(least, k), "center long, id long").distinct()
    )
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("hashes", pa.binary())])

    def full(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                sets = list(shingle_sets(text_bytes(batch), words))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], schema=schema)

    wanted = near.select(F.col("id").alias("doc_id")).distinct()
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(wanted, "doc_id")
    sets = texts.select(F.col("doc_id").alias("id"), "text").mapInArrow(full, "id long, n long, hashes binary")
    return cut_lineage(
        blocked(near.join(sets, "id"), "n", BLOCK_HASHES).select("center", "_i", "_j", "_b", "id", "n", "hashes")
        .mapInArrow(block_links(percent), "src long, dst long").distinct()
    )


def classes(docs: DataFrame, percent: int = PERCENT, k: int = SKETCH, words: int = WORDS) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, a row for each row of ``docs``."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = cut_lineage(plain.mapInArrow(_sketches(k, words), "doc_id long, n long, set_key binary, sketch binary"))
    reps = cut_lineage(
        made.where("set_key is not null and doc_id is not null").groupBy("set_key")
        .agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    )
    # a repeated id may own several texts: they are told apart by their sets, and linked under one id
    found = links(plain, reps.select("id", "n", "sketch"), percent, k, words)
    same = made.where("set_key is not null and doc_id is not null").groupBy("set_key", "doc_id").agg(F.lit(1)).join(
        reps.select("set_key", F.col("id").alias("rep")), "set_key").where("rep <> doc_id").select(
        F.col("rep").alias("src"), F.col("doc_id").alias("dst"))
    twice = made.groupBy("doc_id").agg(F.countDistinct("set_key").alias("_sets")).where("_sets > 1").select("doc_id")
    bridges = same.join(twice.withColumnRenamed("doc_id", "dst"), "dst", "left_semi").select("src", "dst")
    component = connected_components(found.union(bridges))
    named = reps.select("set_key", "id").join(component, "id", "left").select(
        "set_key", F.coalesce("component", "id").alias("_component"))
    return made.join(named, "set_key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
