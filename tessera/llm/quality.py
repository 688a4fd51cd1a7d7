"""Quality classifier: supervised subword embeddings.

Every word, adjacent word pair and character 3- and 4-gram (white space included, case
kept) of a text is hashed to a row of an embedding table. A document is the average of its
rows; a linear layer and softmax give the label. Embeddings and layer are learned together
by numpy stochastic gradient descent on a bounded, documented sample of labelled rows. All
tasks that read the documents write their part of the sample; one task then reads what was
written, and that alone. A word pair that repeats its word falls on one
fixed row, so runs of a repeated word are visible whatever the word.

Because the layer is linear, a row's whole effect on the score is one number: the model
that scoring tasks get is a vector of BUCKETS floats, of fixed size.

Defined results: null and empty texts have no features and get the prior alone; rows
without a label, with null labels or ids do not train; with no training rows, or one class
only, every document scores the share of positive labels (0.5 without any); repeated rows
are rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Words, labelled_sample, mix, per_text, spans, text_bytes
from tessera.session import cut_lineage

#: Rows of the embedding table; row 0 is the repeated word.
BUCKETS = 1 << 16
DIMENSIONS, EPOCHS, RATE = 8, 8, 0.5
#: Labelled documents that train, at most.
SAMPLE_ROWS = 8000
#: Documents scoring this or more are predicted good.
THRESHOLD = 0.3

#: Bytes of text whose features are held at once: each makes some 60 bytes of them.
HELD_BYTES = 1 << 18

_MULTIPLIER = np.uint32(0x9E3779B1)


def features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """``(text index, table row)`` of every feature of the texts."""
    w = Words(texts, lower=False)
    mask = np.uint64(BUCKETS - 1)
    rows = [(w.hash & mask).astype(np.uint32)]
    owners = [w.doc]
    pair = (w.doc[1:] == w.doc[:-1]) if len(w.doc) else np.zeros(0, bool)
    first, second = w.hash[:-1][pair], w.hash[1:][pair]
    joined = (mix(first * np.uint64(3) + second) & mask).astype(np.uint32)
    rows.append(np.where(first == second, np.uint32(0), joined))
    owners.append(w.doc[1:][pair])
    owner = np.repeat(np.arange(len(texts)), np.diff(w.at))
    codes = w.buf.astype(np.uint32)
    for n in (3, 4):
        if len(codes) >= n:
            gram = codes[: len(codes) - n + 1].copy()
            for i in range(1, n):
                gram |= codes[i : len(codes) - n + 1 + i] << np.uint32(8 * i)
            inside = owner[: len(gram)] == owner[n - 1 :]  # the line end between texts belongs to the one before
            rows.append((((gram + np.uint32(n)) * _MULTIPLIER) >> np.uint32(16))[inside])
            owners.append(owner[: len(gram)][inside])
    rows[2:] = [r & np.uint32(BUCKETS - 1) for r in rows[2:]]
    return np.concatenate(owners), np.concatenate(rows)


def bags(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct table rows and their shares of all its features."""
    for a, b in spans([len(t or b"") for t in texts], HELD_BYTES):
        owner, row = features(texts[a:b])
        order = np.argsort(owner, kind="stable")
        owner, row = owner[order], row[order]
        cuts = np.searchsorted(owner, np.arange(b - a + 1))
        for k in range(b - a):
            r, n = np.unique(row[cuts[k] : cuts[k + 1]], return_counts=True)
            yield r, (n / max(n.sum(), 1)).astype(np.float32)


def fit(examples: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 11) -> tuple[np.ndarray, float]:
    """Each row's effect on the log-odds of label 1, and the constant."""
    share = float(labels.mean()) if len(labels) else 0.5
    if not 0 < share < 1:
        share = min(max(share, 1e-3), 1 - 1e-3)
        return np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer = np.zeros((2, DIMENSIONS), np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    steps, done = EPOCHS * len(examples), 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(examples)):
            rows, weight = examples[k]
            rate = RATE * (1 - done / steps)
            done += 1
            if not len(rows):
                continue
            x = weight @ table[rows]
            z = layer @ x + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[k]] -= 1
            back = p @ layer
            layer -= rate * np.outer(p, x)
            bias -= 0.1 * rate * p
            # the step is spread by the features' shares, scaled to the size of a bag
            table[rows] -= (rate * len(rows) ** 0.5) * weight[:, None] * back
    return (table @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0])


def train(sample: DataFrame, seed: int = 11) -> tuple[np.ndarray, float]:
    """The model from ``(doc_id, text, label)`` of bounded size, learned in one task: the sample is
    to be a written table, or that task computes all that the sample comes from."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, examples, labels = [], [], []
        for batch in batches:
            examples += bags(text_bytes(batch))
            ids += batch.column("doc_id").to_pylist()
            labels += batch.column("label").to_pylist()
        order = sorted(range(len(ids)), key=lambda k: (ids[k], len(examples[k][0])))  # as read, order is chance
        effect, constant = fit([examples[k] for k in order], np.array([labels[k] for k in order], int), seed)
        yield pa.RecordBatch.from_pydict({"effect": [effect.tobytes()], "constant": [constant]})

    row = sample.coalesce(1).mapInArrow(run, "effect binary, constant double").first()
    if row is None:  # no labelled row, so no task
        return fit([], np.zeros(0, int), seed)
    return np.frombuffer(row["effect"], np.float32), row["constant"]


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """``docs`` with ``score``: the probability of label 1."""
    effect, constant = docs.sparkSession.sparkContext.broadcast(model[0]), model[1]
    kept = [c for c in docs.columns if c != "score"]
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def value(texts, _):
        owner, row = features(texts)
        total = np.bincount(owner, effect.value[row], len(texts))
        z = total / np.maximum(np.bincount(owner, minlength=len(texts)), 1) + constant
        return {"score": 1 / (1 + np.exp(-np.clip(z, -500, 500)))}

    if kept == ["doc_id", "text"]:
        return docs.mapInArrow(per_text(value, ["doc_id"], schema, HELD_BYTES), "doc_id long, score double")
    raise ValueError("score takes doc_id and text")


def classify(docs: DataFrame, labels: DataFrame, training: Column, label: str = "quality",
             sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, score, predicted)`` for every document; ``training`` names the rows whose labels are read."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = train(cut_lineage(labelled_sample(texts, labels, label, training, sample_rows)))
    return score(texts, model).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
