"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax.

A word is a path of four choices among eight: two name its class, which follows from its last
bytes (the ENDINGS heaviest three-byte endings have classes of their own, the others share by
last byte), two name its cell, one of 64 in the class, by its hash. Each choice is a softmax
over the sum of weights of four features of the history: the previous word and the previous
two classes (n-grams), the word before the last and the class three back (skips). Weights lie
in a table addressed by a hash of feature and path so far, so P(class | history) and
P(cell | class, history) are both learned. Inside a cell words have their smoothed corpus
frequency. With all weights zero a score is the unigram model's.

Counts cover every training token: tasks count hashed words, a shuffle adds them up.
Training is distributed and synchronised: the documents are dealt to ROUNDS shares by a hash
of their text; in a round every task sums the gradients (seen less expected counts) of the
share's tokens under the same weights, the sums are added up over tasks by blocks of the
table, and one step is taken, each weight's as long as its own counts allow. So every training
token is used once and the scores do not depend on the file layout, but for rounding. Scoring
runs in numpy batches. Frequent words (at most HEAD, of fixed size when broadcast) are looked
up in the task; all others meet their counts in a join, so no vocabulary has to fit a task.

Defined results: null and empty texts are an end token alone; null ids count as empty text
for the folds; repeated rows are rows; without training tokens all counts are 0; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Words, chunks, mix, text_bytes
from tessera.session import cut_lineage

CLASSES, ENDINGS = 64, 41
#: A path: LEVELS choices among WAYS; CELLS leaves in all, and the first node of each level.
LEVELS, WAYS, CELLS, BITS = 4, 8, 4096, 3
FIRST_NODE = (0, 1, 9, 73)
NODES = 585
#: Rows of the weight table (WAYS weights each), rows of a block when tasks' sums are added.
ROW_BITS, BLOCK = 17, 1024
ROWS = 1 << ROW_BITS
FEATURES = 4
#: Words looked up inside the tasks, and slots of their table (16 bytes each).
HEAD, SLOTS = 1 << 18, 1 << 20
#: Tokens handled at once; shares of the training documents; step length; counts that a weight
#: must outweigh before its step is a full one.
BATCH, ROUNDS, RATE, PRIOR = 1 << 15, 4, 0.4, 8.0
#: The end token's hash; its class is 0 and no word has it.
END = 1
_NODE, _ROW = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _endings(w: Words) -> np.ndarray:
    """Each word's last three bytes as a number; shorter words have zeros in front."""
    n = w.end - w.start
    code = w.buf[w.end - 1].astype(np.int32)
    for i in (2, 3):
        code |= np.where(n >= i, w.buf[np.maximum(w.end - i, 0)], 0).astype(np.int32) << (8 * (i - 1))
    return code


def class_of(codes: np.ndarray, endings: np.ndarray) -> np.ndarray:
    """Classes of endings; ``endings``: the sorted heavy ones."""
    rest = 1 + ENDINGS + (codes & 255) % (CLASSES - 1 - ENDINGS)
    if not len(endings):
        return rest
    at = np.minimum(np.searchsorted(endings, codes), len(endings) - 1)
    return np.where(endings[at] == codes, 1 + at, rest)


def counts(docs: DataFrame) -> DataFrame:
    """``(h, ending, c)``: how often each hashed token occurs in the texts, end tokens included."""
    schema = pa.schema([("h", pa.int64()), ("ending", pa.int32()), ("c", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch)
            parts = []
            for a, b in chunks(texts):
                w = Words(texts[a:b])
                h, at, n = np.unique(w.hash.view(np.int64), return_index=True, return_counts=True)
                parts.append((h, _endings(w)[at], n))
            h = np.concatenate([p[0] for p in parts] + [np.array([END])])
            ending = np.concatenate([p[1] for p in parts] + [np.array([-1], np.int32)])
            n = np.concatenate([p[2] for p in parts] + [np.array([len(texts)])])
            h, at, back = np.unique(h, return_index=True, return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(ending[at].astype(np.int32)), pa.array(np.bincount(back, n).astype(np.int64))], schema=schema)

    return docs.select("text").mapInArrow(run, "h long, ending int, c long").groupBy("h").agg(
        F.min("ending").alias("ending"), F.sum("c").alias("c"))


class Tokens:
    """Token arrays of several texts, each followed by its end token."""

    def __init__(self, texts: list[bytes | None], endings: np.ndarray):
        w = Words(texts)
        at = w.first[1:]
        self.hash = np.insert(w.hash.view(np.int64), at, END)
        self.cls = np.insert(class_of(_endings(w), endings), at, 0)
        self.first = w.first + np.arange(len(texts) + 1)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))

        self.leaf = leaf_of(self.cls, self.hash)

    def histories(self) -> np.ndarray:
        """A mixed key a feature of every token's history; history ends at the text's start."""
        def back(x, n, empty):
            out = np.full(len(x), empty, x.dtype)
            out[n:] = x[:-n]
            since = np.arange(len(x)) - self.first[:-1][self.doc]
            out[since < n] = empty
            return out

        c1, c2, c3 = (back(self.cls, n, 0) for n in (1, 2, 3))
        parts = back(self.hash, 1, END), c1 * CLASSES + c2, back(self.hash, 2, END), c3
        return np.stack([mix(x.astype(np.int64).view(np.uint64) * np.uint64(FEATURES) + np.uint64(i)) for i, x in enumerate(parts)])


def leaf_of(cls: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Leaves of words: the class, then six bits of the hash."""
    return cls.astype(np.int64) * (CELLS // CLASSES) + ((hashes >> 20) & (CELLS // CLASSES - 1))


def biases(mass: np.ndarray) -> np.ndarray:
    """Every node's log shares (NODES x WAYS) of its choices, from the leaves' masses."""
    levels = [mass.reshape(-1, CELLS >> BITS * (level + 1)).sum(axis=1).reshape(-1, WAYS) for level in range(LEVELS)]
    return np.concatenate([np.log(m / m.sum(axis=1, keepdims=True)) for m in levels]).astype(np.float32)


def choices(leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes on the way to the leaves and what is chosen there (LEVELS x tokens each)."""
    node = np.stack([FIRST_NODE[i] + (leaf >> BITS * (LEVELS - i)) for i in range(LEVELS)])
    return node, np.stack([(leaf >> BITS * (LEVELS - 1 - i)) & (WAYS - 1) for i in range(LEVELS)])


def _rows(history: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Rows of the table (FEATURES x LEVELS*tokens): one a feature and a choice."""
    key = history[:, None, :] + (node.astype(np.uint64) * _NODE)[None]
    return ((key * _ROW) >> np.uint64(64 - ROW_BITS)).astype(np.int32).reshape(FEATURES, -1)


def _sums(weights: np.ndarray, bias: np.ndarray, rows: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Sums of weights of each choice. A weight is at most 2 * RATE * ROUNDS, so their
    exponentials do not overflow."""
    z = bias.take(node.ravel(), axis=0)
    for r in rows:
        z += weights.take(r, axis=0)
    return z


def _across(x: np.ndarray) -> np.ndarray:
    """Row sums of WAYS columns, by halves: a matrix product would start threads in every task."""
    while x.shape[1] > 1:
        x = x[:, 0::2] + x[:, 1::2]
    return x[:, 0]


def gradients(weights: np.ndarray, bias: np.ndarray, history: np.ndarray, leaf: np.ndarray, total: np.ndarray) -> None:
    """Adds the tokens' seen counts (``total[0]``) and expected counts (``total[1]``), WAYS x ROWS each."""
    node, chosen = choices(leaf)
    rows = _rows(history, node)
    p = np.exp(_sums(weights, bias, rows, node))
    share = np.ascontiguousarray((p / _across(p)[:, None]).T, np.float64)
    flat = rows.ravel().astype(np.int64)
    total[0] += np.bincount(np.tile(chosen.ravel() * ROWS, FEATURES) + flat, minlength=WAYS * ROWS).reshape(WAYS, ROWS)
    for way in range(WAYS):
        total[1, way] += np.bincount(flat, np.tile(share[way], FEATURES), ROWS)


def step(weights: np.ndarray, seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """The weights after one step along the gradient, scaled by each weight's own counts."""
    return (weights + RATE * (seen - expected) / ((seen + expected) / 2 + PRIOR)).astype(np.float32)


def log_paths(weights: np.ndarray, bias: np.ndarray, history: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """log10 P(leaf | history) of every token."""
    node, chosen = choices(leaf)
    z = _sums(weights, bias, _rows(history, node), node)
    picked = z[np.arange(len(z)), chosen.ravel()] - np.log(_across(np.exp(z)))
    return picked.reshape(LEVELS, -1).astype(np.float64).sum(axis=0) / np.log(10)


def train(docs: DataFrame, endings: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """The weights (ROWS x WAYS) after ROUNDS synchronised steps over the documents' shares."""
    sc = docs.sparkSession.sparkContext
    weights = np.zeros((ROWS, WAYS), np.float32)
    schema = pa.schema([("block", pa.int32()), ("sums", pa.binary())])
    # A round reads a share of the documents: as many fewer tasks keep the sums to one table a full task.
    tasks = max(sc.defaultParallelism, docs.rdd.getNumPartitions() // ROUNDS)

    def blocks(total: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, ROWS, BLOCK):
            part = total[:, :, i : i + BLOCK]
            if part[0].any():
                yield pa.RecordBatch.from_arrays([pa.array([i // BLOCK], pa.int32()), pa.array([part.astype(np.float32).tobytes()], pa.binary())], schema=schema)

    def add_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}  # at most ROWS / BLOCK entries
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                sums[block] = sums.get(block, 0.0) + np.frombuffer(raw, np.float32).astype(np.float64)
        for block, x in sorted(sums.items()):
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([x.astype(np.float32).tobytes()], pa.binary())], schema=schema)

    def sums_under(model) -> Callable:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, bias, endings = model.value
            total = np.zeros((2, WAYS, ROWS))
            for batch in batches:
                texts = text_bytes(batch)
                for a, b in chunks(texts):
                    t = Tokens(texts[a:b], endings)
                    history = t.histories()
                    for s in range(0, len(t.leaf), BATCH):
                        gradients(weights, bias, history[:, s : s + BATCH], t.leaf[s : s + BATCH], total)
            yield from blocks(total)

        return run

    share = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(ROUNDS))
    for i in range(ROUNDS):
        model = sc.broadcast((weights, bias, endings))  # 4 MB, whatever the corpus
        summed = (
            docs.where(share == i).select("text").coalesce(tasks).mapInArrow(sums_under(model), "block int, sums binary")
            .repartition("block").mapInArrow(add_up, "block int, sums binary"))
        seen, expected = np.zeros((ROWS, WAYS)), np.zeros((ROWS, WAYS))
        for r in summed.collect():  # at most ROWS / BLOCK blocks of 64 KB
            part = np.frombuffer(r["sums"], np.float32).reshape(2, WAYS, BLOCK)
            at = slice(r["block"] * BLOCK, (r["block"] + 1) * BLOCK)
            seen[at], expected[at] = part[0].T, part[1].T
        weights = step(weights, seen, expected)
        model.unpersist()
    return weights


def _head(words: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A direct-addressed table of frequent words; of two words with one slot the more frequent stays."""
    keys, c = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
    h, n = (words.column(x).to_numpy()[::-1] for x in ("h", "c"))
    keys[h & (SLOTS - 1)], c[h & (SLOTS - 1)] = h, n
    return keys, c


def score(docs: DataFrame, training: Column) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` of every document;
    ``training`` names the documents that the model learns from."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sc = docs.sparkSession.sparkContext
    known = cut_lineage(counts(texts.where(training)))
    total, distinct = known.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    heavy = known.where("ending >= 0").groupBy("ending").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "ending").limit(ENDINGS)
    endings = np.array(sorted(r["ending"] for r in heavy.collect()), np.int32)

    def masses(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros(CELLS)
        for batch in batches:
            code = batch.column("ending").to_numpy()
            leaf = leaf_of(np.where(code < 0, 0, class_of(code, endings)), batch.column("h").to_numpy())
            mass += np.bincount(leaf, batch.column("c").to_numpy() + 1.0, CELLS)
        own = np.flatnonzero(mass)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(mass[own])], names=["leaf", "mass"])

    mass = np.full(CELLS, 1 / CELLS)  # one in all, for a word that training does not know
    for r in known.mapInArrow(masses, "leaf int, mass double").groupBy("leaf").agg(F.sum("mass").alias("mass")).collect():
        mass[r["leaf"]] += r["mass"]
    bias = biases(mass)
    model = sc.broadcast((train(texts.where(training), endings, bias), bias, endings, np.log10(mass)))
    head = sc.broadcast(_head(known.select("h", "c").orderBy(F.desc("c"), "h").limit(HEAD).toArrow()))
    schema = pa.schema([
        ("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("logs", pa.float64()), ("model", pa.float64()), ("tail", pa.binary()), ("times", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, endings, log_mass = model.value
        keys, c = head.value
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts, ids = text_bytes(batch), batch.column("doc_id")
            for a, b in chunks(texts):
                t, n = Tokens(texts[a:b], endings), b - a
                history, value = t.histories(), np.empty(len(t.leaf))
                for s in range(0, len(t.leaf), BATCH):
                    leaf = t.leaf[s : s + BATCH]
                    value[s : s + BATCH] = log_paths(weights, bias, history[:, s : s + BATCH], leaf) - log_mass[leaf]
                slot = t.hash & (SLOTS - 1)
                hit = (keys[slot] == t.hash) & (c[slot] > 0)
                tails = []
                for k in range(n):
                    own = t.hash[t.first[k] : t.first[k + 1]]
                    tails.append(np.unique(own[~hit[t.first[k] : t.first[k + 1]]], return_counts=True))
                yield pa.RecordBatch.from_arrays([
                    pa.array(row + np.arange(n)), ids.slice(a, n), pa.array(np.diff(t.first), pa.int64()),
                    pa.array(np.bincount(t.doc, hit, n).astype(np.int64)),
                    pa.array(np.bincount(t.doc, np.where(hit, np.log10(c[slot] + 1.0), 0), n)), pa.array(np.bincount(t.doc, value, n)),
                    pa.array([h.tobytes() for h, _ in tails], pa.binary()), pa.array([m.tobytes() for _, m in tails], pa.binary())], schema=schema)
                row += n

    made = cut_lineage(texts.mapInArrow(
        run, "row long, doc_id long, n_tokens long, n_known long, logs double, model double, tail binary, times binary"))
    flat = pa.schema([("row", pa.int64()), ("h", pa.int64()), ("times", pa.int64())])

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = [np.frombuffer(x, np.int64) for x in batch.column("tail").to_pylist()]
            n = [np.frombuffer(x, np.int64) for x in batch.column("times").to_pylist()]
            row = np.repeat(batch.column("row").to_numpy(), [len(x) for x in h])
            if len(row):
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(np.concatenate(h)), pa.array(np.concatenate(n))], schema=flat)

    rare = made.select("row", "tail", "times").mapInArrow(unpack, "row long, h long, times long")
    found = rare.join(known.select("h", "c"), "h").groupBy("row").agg(
        F.sum("times").alias("_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("_logs"))
    out = made.drop("tail", "times").join(found, "row", "left")
    logs = F.col("logs") + F.coalesce("_logs", F.lit(0.0))
    return out.select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.log10(F.lit(float(total + distinct + 1)))).alias("base_score"), (logs + F.col("model")).alias("score"))
