"""Toxicity: a subsequence string-kernel support vector machine with Nystroem landmarks.

The kernel compares two words by the gapped chains of ORDER letters that they share, with marks for a word's start and end: a chain
that spans s letters weighs DECAY ** s, spans beyond SPAN count nothing, and the kernel is
normalised. Inserted letters stretch a chain without losing it, and marks between letters
("s.t.u.p") and single letters standing apart ("s t u p") are closed up first.

Sentences carry their document's label, so an insult's own words are not known: this is a
multiple-instance problem. Words that toxic texts of the sample use markedly more often
than clean ones start as the positive instances; common and random words of clean texts
are the negatives. Insults of several ordinary words are learned from the sentences' windows of two and
three words, read as one: a window is an instance when toxic texts use it as markedly, in
different surroundings (so copies of one passage count once), and none of its words is an instance
by itself. The machine (squared hinge loss, Newton steps in numpy, on the
Nystroem features K_mm^-1/2 k_m of the landmarks) is fitted, positives that it places
among the clean are given up, the clean words that it finds most toxic join the negatives, and
it is fitted again. A sentence's value is that of its
most toxic word, a document's that of its most toxic sentence; a logistic curve fitted on
the sample turns it into a probability.

The features are linear in the kernel, so landmarks, whitening and weights fold into one
table: a number for each chain. Scoring a word sums its chains' numbers; windows are scored
where they are, but for up to two inserted letters a word, a learned window.

Defined results: null, empty and wordless texts get the value of a word without chains;
rows without a label, with null labels or ids do not train; with no training rows or one
class only, every document scores the share of positive labels (0 without any); repeated rows
are rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import combinations, pairwise, product, zip_longest

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import labelled_sample, spans
from tessera.session import cut_lineage

DECAY, SPAN, ORDER = 0.6, 6, 4
#: Longer words are seen through windows of this many letters, half overlapping.
WINDOW = 18
#: Shorter words are no instances.
LEAST_LETTERS = 3
#: Chains are hashed to this many numbers.
CHAINS = 1 << 20
LANDMARKS, STEPS, RIDGE = 320, 60, 1e-5
#: Rounds of adding the hardest clean words; words of a smaller lift count as clean.
ROUNDS, CLEAN_LIFT = 4, 3.0
#: Labelled documents that train, at most; words of either side that become instances, at most.
SAMPLE_ROWS, INSTANCES = 16000, 3000
#: A positive instance is so much more frequent in toxic texts, with this log-likelihood ratio.
LEAST_LIFT, LEAST_RATIO = 20.0, 20.0
#: Words of the longest window that is read as one; windows of fewer letters are no instances.
PHRASE_WORDS, PHRASE_LETTERS = 3, 6
#: Windows of clean texts are counted where toxic ones have one of the same hash, of so many.
HASHES = 1 << 22
#: Documents scoring this or more are predicted toxic.
THRESHOLD = 0.3
#: Words whose values a worker keeps, and words as written; a store is emptied beyond that.
KEPT_WORDS = 200_000
#: Texts are taken out of a batch and into words in slices of about this many bytes.
SLICE_BYTES = 1 << 18

_APART = re.compile(r"(?<!\w)\w(?:[\W_]{1,2}\w(?!\w)){2,}")
_MARKS = re.compile(r"[\W\d_]+")
_SENTENCE = re.compile(r"[.!?]+\s|\n")


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts whose texts hold about SLICE_BYTES each (a longer text stands alone)."""
    for a, b in spans(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist(), SLICE_BYTES):
        yield batch.slice(a, b - a)


def words_of(text: str | None) -> set[str]:
    """The parts of a text between white space, with letters standing apart closed up."""
    if not text:
        return set()
    text = text.lower()
    found = set(text.split())
    # three or more single letters in a row read as a word
    found.update(_MARKS.sub("", m) for m in _APART.findall(text))
    return found


def _letters(word: str) -> str:
    return _MARKS.sub("", word)


def sentences(text: str | None) -> Iterator[list[str]]:
    """The words of each sentence, letters only; words without letters are passed over."""
    for sentence in _SENTENCE.split((text or "").lower()):
        words = [x for x in map(_letters, sentence.split()) if x]
        if len(words) > 1:
            yield words


def phrases(text: str | None) -> set[str]:
    """A text's windows, their words joined by spaces."""
    found: set[str] = set()
    for words in sentences(text):
        for n in range(2, PHRASE_WORDS + 1):
            found.update(map(" ".join, zip(*[words[i:] for i in range(n)], strict=False)))
    return found


def surroundings(text: str | None) -> Iterator[tuple[str, int]]:
    """``(window, hash of the words before and after it)``."""
    for words in sentences(text):
        around = ["", *words, ""]
        for n in range(2, PHRASE_WORDS + 1):
            for i in range(len(words) - n + 1):
                yield " ".join(words[i : i + n]), zlib.crc32(f"{around[i]} {around[i + n + 1]}".encode())


def _near(word: str, parts: frozenset[str]) -> list[str]:
    """Those of ``parts`` that the word is, or becomes without one or two of its letters."""
    if not 3 < len(word) <= WINDOW:
        return [word] if word in parts else []
    fewer = {word[:i] + word[i + 1 :] for i in range(len(word))}
    return sorted(parts & ({word} | fewer | {w[:i] + w[i + 1 :] for w in fewer for i in range(len(w))}))


def joined(text: str | None, learned: frozenset[str], known: dict[str, tuple[str, list[str]]]) -> set[str]:
    """The text's windows that are near one of ``learned`` word by word, each read as one word.

    ``known`` keeps, for a word as written, its letters and the parts it is near.
    """
    found: set[str] = set()
    if not text or not learned:
        return found
    parts = frozenset(w for x in learned for w in x.split(" ")) if "" not in known else known[""][1]
    known.setdefault("", ("", parts))
    for sentence in _SENTENCE.split(text.lower()):
        words = []
        for raw in sentence.split():
            if raw not in known:
                letters = _letters(raw)
                known[raw] = letters, _near(letters, parts)
            if known[raw][0]:
                words.append(known[raw])
        for i in range(len(words) - 1):
            for n in range(2, PHRASE_WORDS + 1):
                if i + n > len(words) or not words[i + n - 1][1] or not words[i][1]:
                    break
                if any(" ".join(x) in learned for x in product(*[near for _, near in words[i : i + n]])):
                    found.add("".join(letters for letters, _ in words[i : i + n]))
    return found


def _windows(word: str) -> list[str]:
    """A word's letters between a mark for its start and one for its end, cut into windows."""
    letters = f"^{_MARKS.sub('', word)}$"
    if len(letters) <= WINDOW:
        return [letters]
    return [letters[a : a + WINDOW] for a in range(0, len(letters) - WINDOW // 2, WINDOW // 2)]


_shapes: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _chains(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights of the gapped chains of a word of n letters."""
    if n not in _shapes:
        at = [(i, *rest) for i in range(n) for rest in combinations(range(i + 1, min(n, i + SPAN)), ORDER - 1)]
        places = np.array(at, np.int64).reshape(-1, ORDER)
        _shapes[n] = places, DECAY ** (places[:, -1] - places[:, 0] + 1.0)
    return _shapes[n]


def vectors(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(word indices, chain hashes, normalised weights)`` by length; words of under three letters are left out."""
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        if len(w) >= ORDER:
            by_length.setdefault(len(w), []).append(i)
    for n, index in by_length.items():
        places, weight = _chains(n)
        codes = np.frombuffer("".join(words[i] for i in index).encode("utf-32-le"), np.uint32).reshape(-1, n).astype(np.uint64)
        key = np.zeros((len(index), len(places)), np.uint64)
        for i in range(ORDER):
            key = key * np.uint64(0x1000193) + codes[:, places[:, i]]
        key *= np.uint64(0x9E3779B97F4A7C15)
        order = np.argsort(key, axis=1, kind="stable")
        ordered, w = np.take_along_axis(key, order, 1), weight[order]
        # a repeated chain's weights add up, on its first place
        new = np.ones(ordered.shape, bool)
        new[:, 1:] = ordered[:, 1:] != ordered[:, :-1]
        starts = np.flatnonzero(new.ravel())
        summed = np.add.reduceat(w.ravel(), starts)
        row = starts // ordered.shape[1]
        norm = np.sqrt(np.bincount(row, summed**2, len(index)))
        yield np.array(index)[row], (ordered.ravel()[starts] >> np.uint64(44)).astype(np.int64), summed / norm[row]


class Machine:
    """Scores words by a table of chains; ``spread`` and ``middle`` make documents' probabilities,
    ``learned`` are the windows that were positive instances."""

    learned: frozenset[str] = frozenset()

    def __init__(self, table: np.ndarray, bias: float, spread: float = 1.0, middle: float = 0.0):
        self.table, self.bias, self.spread, self.middle = table, bias, spread, middle

    def values(self, words: list[str]) -> np.ndarray:
        """The values of words as written: the largest over a long word's windows."""
        letters = [_windows(w) for w in words]
        owner = np.repeat(np.arange(len(words)), [len(x) for x in letters])
        flat = [x for parts in letters for x in parts]
        out = np.full(len(flat), self.bias)
        for index, chain, weight in vectors(flat):
            out += np.bincount(index, self.table[chain] * weight, len(flat))
        best = np.full(len(words), -np.inf)
        np.maximum.at(best, owner, out)
        return best

    def probability(self, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.spread * (value - self.middle), -500, 500)))


def _kernel(words: list[str], others: list[str]) -> np.ndarray:
    dense = np.zeros((len(others), 0))
    parts = [(i, t, w) for i, t, w in vectors(others)]
    used = np.unique(np.concatenate([t for _, t, _ in parts])) if parts else np.zeros(0, np.int64)
    dense = np.zeros((len(others), len(used)))
    for i, t, w in parts:
        np.add.at(dense, (i, np.searchsorted(used, t)), w)
    out = np.zeros((len(words), len(others)))
    for i, t, w in vectors(words):
        at = np.minimum(np.searchsorted(used, t), max(len(used) - 1, 0))
        hit = used[at] == t if len(used) else np.zeros(len(t), bool)
        if hit.any():
            first = np.unique(i[hit])
            rows = np.searchsorted(first, i[hit])
            sparse = np.zeros((len(first), len(used)))
            np.add.at(sparse, (rows, at[hit]), w[hit])
            out[first] += sparse @ dense.T
    return out


def _separate(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear machine: the squared hinge loss, by Newton steps on the instances within the margin."""
    f = np.concatenate([x, np.ones((len(x), 1))], 1)
    ridge = RIDGE * np.eye(f.shape[1])
    ridge[-1, -1] = 1e-9
    p, inside = np.zeros(f.shape[1]), np.ones(len(y), bool)
    for _ in range(STEPS):
        fw = f[inside] * weight[inside][:, None]
        p = 0.5 * p + 0.5 * np.linalg.solve(fw.T @ f[inside] + ridge, fw.T @ y[inside])
        now = y * (f @ p) < 1
        if (now == inside).all():
            break
        inside = now
    return p[:-1], float(p[-1])


def fit(positive: list[str], negative: list[str]) -> tuple[Machine, list[str]]:
    """The machine from words of either side (letters only), and the positives that it kept.

    Landmarks are the first words of either list: the most telling, and the hardest or most common.
    """
    nothing = Machine(np.zeros(CHAINS, np.float32), -1.0), []
    while positive and negative:
        marks = [_windows(w)[0] for w in dict.fromkeys(positive[: LANDMARKS // 2] + negative[: LANDMARKS // 2])]
        value, vector = np.linalg.eigh(_kernel(marks, marks))
        ok = value > 1e-6
        whiten = vector[:, ok] / np.sqrt(value[ok])
        x = _kernel([_windows(w)[0] for w in positive + negative], marks) @ whiten
        y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
        weight = np.where(y > 0, 0.25 / len(positive), 0.75 / len(negative))
        u, b = _separate(x, y, weight)
        kept = [w for w, v in zip(positive, x[: len(positive)] @ u + b, strict=True) if v > 0]
        if len(kept) == len(positive):
            table = np.zeros(CHAINS)
            beta = whiten @ u
            for i, t, w in vectors(marks):
                np.add.at(table, t, beta[i] * w)
            return Machine(table.astype(np.float32), b), positive
        positive = kept
    return nothing


def learn(counts: DataFrame, positive: list[str], negative: list[str], instances: int) -> Machine:
    """Fits, adds the clean words that the machine finds most toxic to the negatives, and fits again.

    ``counts``: written ``(word, toxic, clean, lift)`` of the whole sample.
    """
    machine, kept = fit(positive, negative)
    sc = counts.sparkSession.sparkContext
    for _ in range(ROUNDS):
        if not kept:
            break
        sent = sc.broadcast(machine)

        def run(batches: Iterable[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column("word"), pa.array(sent.value.values(batch.column("word").to_pylist()), pa.float64())], names=["word", "value"])

        clean = counts.where((F.col("clean") > 0) & (F.col("lift") < CLEAN_LIFT)).select("word")
        worst = clean.mapInArrow(run, "word string, value double").where(F.col("value") > -1).orderBy(F.desc("value"), "word").limit(instances // 3)
        hard = [r["word"] for r in worst.collect()]
        new = set(hard).difference(negative)
        negative = list(dict.fromkeys(hard + negative))
        if not new:
            break
        machine, kept = fit(kept, negative)
    return machine


def _telling(counts: DataFrame, usual: float) -> DataFrame:
    """The rows of ``(word, toxic, clean, lift)`` that toxic texts use markedly more often, by lift."""
    share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
    ratio = 2 * (F.col("toxic") * F.log(share / usual) + F.when(share < 1, F.col("clean") * F.log((1 - share) / (1 - usual))).otherwise(0.0))
    return counts.where((F.col("toxic") > 0) & (F.col("lift") >= LEAST_LIFT)).where(ratio >= LEAST_RATIO).orderBy(F.desc("lift"), "word")


def _phrase_instances(texts: DataFrame, lift: Column, usual: float, words: list[str], instances: int) -> tuple[DataFrame, list[str]]:
    """Counts of windows, and those that are positive instances, at most ``instances``.

    A window counts once for each surrounding that it has in toxic texts, but for each clean text.
    """
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(of_batch) -> Callable:
        def run_all(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for part in slices(whole):
                    got = of_batch(part.column("text").to_pylist())
                    yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in got], pa.string()), pa.array([n for _, n in got], pa.int64())], schema=schema)

        return run_all

    met = texts.where("label > 0").select("text").mapInArrow(run(lambda some: {x for t in some for x in surroundings(t)}), "word string, n long").distinct()
    # the ratio of one that no clean text has is 2 toxic log(1 / usual)
    least = LEAST_RATIO / (2 * -math.log(usual))
    toxic = cut_lineage(met.groupBy("word").agg(F.count(F.lit(1)).alias("toxic")).where(F.col("toxic") >= least))
    bits = np.zeros(HASHES, bool)
    bits[[r["h"] for r in toxic.select(F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(HASHES)).alias("h")).distinct().collect()]] = True
    sent = texts.sparkSession.sparkContext.broadcast(np.packbits(bits, bitorder="little").tobytes())

    def of_clean(some: list) -> list[tuple[str, int]]:
        there, counted = sent.value, Counter()
        for text in some:
            for x in phrases(text):
                h = zlib.crc32(x.encode()) % HASHES
                if there[h >> 3] >> (h & 7) & 1:
                    counted[x] += 1
        return list(counted.items())

    clean = texts.where("label = 0").select("text").mapInArrow(run(of_clean), "word string, n long").groupBy("word").agg(F.sum("n").alias("clean"))
    counts = cut_lineage(toxic.join(clean, "word", "left").select("word", "toxic", F.coalesce("clean", F.lit(0).cast("long")).alias("clean")).withColumn("lift", lift))
    own = set(words)
    marked = _telling(counts.where(F.length(F.replace("word", F.lit(" "))) >= PHRASE_LETTERS), usual)
    apart = marked.where(~F.arrays_overlap(F.split("word", " "), F.array(*[F.lit(w) for w in sorted(own)]).cast("array<string>"))) if own else marked
    found = [r["word"] for r in apart.select("word").limit(instances).collect()]
    pairs = {w for w in found if w.count(" ") == 1}
    # a longer window around one that tells by itself adds nothing
    return counts, [w for w in found if w in pairs or pairs.isdisjoint(" ".join(x) for x in pairwise(w.split(" ")))]


def _instances(sample: DataFrame, instances: int) -> tuple[DataFrame, list[str], list[str], frozenset[str]]:
    """Counts of distinct texts by word, and from them positive and negative words, at most ``instances``
    of each; windows learned are among the positives, and come last by themselves."""
    schema = pa.schema([("word", pa.string()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                sides = Counter(), Counter()
                for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
                    sides[label > 0].update({_letters(w) for w in words_of(text)})
                words = [w for w in sides[0] | sides[1] if len(w) >= LEAST_LETTERS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.string()), pa.array([sides[1][w] for w in words], pa.int64()), pa.array([sides[0][w] for w in words], pa.int64())],
                    schema=schema)

    # exact copies of a text are one text: their words are no more telling for it
    texts = cut_lineage(sample.where("text is not null").groupBy(F.xxhash64("text").alias("_h")).agg(F.first("text").alias("text"), F.max("label").alias("label")))
    totals = {r["label"]: r["count"] for r in texts.groupBy("label").count().collect()}
    lift = (F.col("toxic") / max(totals.get(1, 0), 1)) / ((F.col("clean") + 0.5) / max(totals.get(0, 0), 1))
    counts = cut_lineage(texts.select("text", "label").mapInArrow(run, "word string, toxic long, clean long")
                         .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).withColumn("lift", lift))
    usual = min(max(totals.get(1, 0) / max(sum(totals.values()), 1), 1e-6), 1 - 1e-6)
    # longer strings are mostly no words: they are negatives only where the machine takes them for toxic
    short = counts.where(F.length("word") <= WINDOW - 2)
    common = short.where("clean > toxic").orderBy(F.desc("clean"), "word").limit(instances // 2)
    chance = short.where("toxic = 0").orderBy(F.md5("word"), "word").limit(instances // 2)
    read = lambda df: [r["word"] for r in df.select("word").collect()]
    plain = list(dict.fromkeys(x for pair in zip_longest(read(common), read(chance)) for x in pair if x is not None))
    positive = read(_telling(counts, usual).limit(instances))
    windows, telling = _phrase_instances(texts, lift, usual, positive, instances)
    parts = frozenset(w for x in telling for w in x.split(" "))
    if telling:
        # clean windows of the same words are what the machine has to tell them from
        alike = windows.where(F.forall(F.split("word", " "), lambda w: w.isin(sorted(parts))))
        counts = cut_lineage(counts.unionByName(alike.withColumn("word", F.replace("word", F.lit(" ")))))
    return counts, positive + list(dict.fromkeys(x.replace(" ", "") for x in telling)), plain, frozenset(telling)


def values(docs: DataFrame, machine: Machine, columns: str) -> DataFrame:
    """``docs`` (doc_id, text and ``columns``) with the value of each text's most toxic word in place of the text."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        nothing = float(m.bias)
        kept: dict[str, float] = {}
        known: dict = {}
        for whole in batches:
            for batch in slices(whole):
                found = [words_of(t) | joined(t, m.learned, known) for t in batch.column("text").to_pylist()]
                if len(kept) > KEPT_WORDS:
                    kept = {}
                if len(known) > KEPT_WORDS:
                    known = {}
                new = list(set().union(*found).difference(kept))
                for at in range(0, len(new), 20_000):
                    some = new[at : at + 20_000]
                    kept.update(zip(some, m.values(some).tolist(), strict=True))
                best = [max(map(kept.__getitem__, f), default=nothing) for f in found]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(best, pa.float64())], names=[*names, "value"])

    return docs.mapInArrow(run, f"{columns}, value double")


def train(sample: DataFrame, instances: int = INSTANCES) -> Machine:
    """The machine from ``(doc_id, text, label)`` of bounded size."""
    counts, positive, negative, learned = _instances(sample, instances)
    machine = learn(counts, positive, negative, instances)
    machine.learned = learned
    judged = values(sample.select("doc_id", "text", F.col("label").cast("int")), machine, "doc_id long, label int").select("value", "label").collect()
    x, y = np.array([r["value"] for r in judged]), np.array([r["label"] for r in judged], float)
    share = float(y.mean()) if len(y) else 0.0
    if not 0 < share < 1:
        machine.spread, machine.middle = 0.0, 0.0
        machine.prior = share
        return machine
    # logistic curve by Newton steps with a little ridge
    p = np.array([1.0, 0.0])
    f = np.stack([x, np.ones_like(x)], 1)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(f @ p, -30, 30)))
        step = np.linalg.solve((f * (q * (1 - q))[:, None]).T @ f + 1e-2 * np.eye(2), f.T @ (y - q) - 1e-2 * p)
        p += step
        if np.abs(step).max() < 1e-9:
            break
    machine.spread, machine.middle = float(p[0]), float(-p[1] / p[0]) if p[0] else 0.0
    return machine


def classify(docs: DataFrame, labels: DataFrame, training: Column, label: str = "toxic",
             sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, score, predicted)`` for every document; ``training`` names the rows whose labels are read."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    machine = train(cut_lineage(labelled_sample(texts, labels, label, training, sample_rows)))
    found = values(texts, machine, "doc_id long")
    z = F.lit(machine.spread) * (F.col("value") - F.lit(machine.middle))
    score = F.lit(machine.prior) if hasattr(machine, "prior") else 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0))))
    return found.select("doc_id", score.cast("double").alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
