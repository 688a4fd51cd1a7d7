"""Corpus operators against brute force, and on odd inputs: nulls, empty and very long texts,
ties and repeated rows, empty tables, extra columns."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import common, kdtree, maxent, mixing, neardup, packing, quality, rollup, sequences, spotsigs, toxicity
from tessera.llm.tokens import WordBpe

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, rank int, size long, center long, row long, shard int"


def words(text):
    return (text or "").encode().lower().split()


def prose(rng, n):
    return " ".join(rng.choice(["the", "of", "and", "Wort", "die", "año", "chien", "tree", "river.", "stone,"]) + str(rng.randrange(60)) * rng.randrange(2) for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(3)
    base = prose(rng, 120)
    near = base.split(" ")
    near[60] = "changed"
    texts = [base, base, " ".join(near), "", None, " \n\t ", "one", "two words", "a b c d e", "A B\tC d  E", prose(rng, 9000), "x" * 60000,
             "日本 語 　 text Σ ΑΣ", "same same same same same same", base.upper(), *(prose(rng, rng.randrange(3, 300)) for _ in range(40))]
    rows = [(i, t, None if i % 7 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}", None) for i, t in enumerate(texts)]
    return [*rows, rows[3], rows[0], (None, base, "en", "s1", 4), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    common.ship(spark)
    return spark.createDataFrame([(*r, 0.5, 1, 2, 3, 4, 5) for r in odd_rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    common.ship(spark)
    return spark.createDataFrame([], SCHEMA)


def test_words_match_split():
    rng = random.Random(1)
    texts = [prose(rng, rng.randrange(0, 30)).encode() for _ in range(50)] + [None, b"", b" \x0b\x0c", "é ß A".encode()]
    w = common.Words(texts)
    split = [(t or b"").lower().split() for t in texts]
    assert [w.buf[a:b].tobytes() for a, b in zip(w.start, w.end, strict=True)] == [x for s in split for x in s]
    assert np.diff(w.first).tolist() == [len(s) for s in split]
    flat = [x for s in split for x in s]
    assert len(set(flat)) == len(set(w.hash.tolist())) == len(set(zip(flat, w.hash.tolist(), strict=True)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab cdE é'll 09ß!?.\n\t日ΣςİJ́\x85\xa0\x1c🎉<|endoftext|>\0　"), max_size=50), max_size=8))
def test_token_ids_equal_library(texts):
    bpe = test_token_ids_equal_library.__dict__.setdefault("bpe", WordBpe(TOKENIZER))
    assert bpe.ids(texts) == [bpe.one(t) for t in texts]


# ---- 1: top-k

def test_top_k_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.normal(size=6).round(1)], "extra") for i in range(700)]
    rows += [(i, rows[5][1], "tie") for i in range(700, 760)] + [(800, None, ""), (801, [float("nan")] * 6, ""), (802, [None] + [1.0] * 5, ""), (None, [1.0] * 6, ""),
             (850, [1.0, 2.0], ""), (851, [2.0, 1.0], ""), (5, rows[5][1], "again"), (900, [], "")]
    common.ship(spark)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    old = kdtree.SHARD_ROWS, kdtree.LEAF_ROWS
    kdtree.SHARD_ROWS, kdtree.LEAF_ROWS = 200, 16
    try:
        got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in kdtree.top_k(df, F.col("vec_id") % 50 == 0).collect()}
    finally:
        kdtree.SHARD_ROWS, kdtree.LEAF_ROWS = old
    v = {i: [math.floor(256 * x) for x in e] for i, e, _ in rows if i is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)}
    want = {}
    for q in v:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(v[q], v[i], strict=True)), i) for i in v if i != q and len(v[i]) == len(v[q]))[:5]
            want |= {(q, k): (i, -s) for k, (s, i) in enumerate(best, 1)}
    assert got == want
    assert kdtree.top_k(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []


# ---- 2: SpotSigs

def test_fingerprints(odd, odd_rows, empty, monkeypatch):
    monkeypatch.setattr(spotsigs, "RANGE_ROWS", 7)
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_chars, r.edited_sha256, r.fingerprint, r.near_edited, r.near_next) for r in spotsigs.fingerprints(odd).collect())
    rows = sorted(((i is not None, i or 0, t or "") for i, t, *_ in odd_rows))
    want = []
    for k, (some, i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][2]
        want.append((some, i, len(t), hashlib.sha256(spotsigs.edited(t, after).encode()).hexdigest()))
    assert [g[:4] for g in got] == sorted(want)
    by_text = {}
    for (_, _, t), (_, _, _, _, fp, near, nxt) in zip(rows, sorted(got), strict=False):
        assert 0 <= near <= 1 and 0 <= nxt <= 1
    for i, t, *_ in odd_rows:
        fp = spotsigs.fingerprint(next(spotsigs.signatures([(t or "").encode()])))
        assert by_text.setdefault(t or "", fp) == fp
        assert any(g[4] == fp and g[2] == len(t or "") for g in got)
    assert spotsigs.fingerprints(empty).collect() == []
    rng = random.Random(5)
    a, b = prose(rng, 400), prose(rng, 400)
    x, y, z = spotsigs.signatures([s.encode() for s in (a, spotsigs.edited(a, b), b)])
    assert spotsigs.likeness(x, y) > 0.4 > spotsigs.likeness(x, z)


# ---- 3: near duplicates

def brute_classes(rows):
    sets = {}
    for i, t, *_ in rows:
        w = words(t)
        sets.setdefault(i, []).append(frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else []))
    root = {i: i for i in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in root:
        for j in root:
            if i < j and any(s and t and 100 * len(s & t) >= 85 * len(s | t) for s in sets[i] for t in sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in root}, sets


def test_near_fingerprints(odd, odd_rows, empty, monkeypatch):
    """Classes over length partitions equal those of all pairs."""
    monkeypatch.setattr(spotsigs, "BLOCK_HASHES", 60)
    for percent in (80, 30):
        rows = [(i, set(next(spotsigs.signatures([(t or "").encode()])).tolist())) for i, t, *_ in odd_rows]
        parent = {i: i for i, _ in rows if i is not None}

        def find(x, parent=parent):
            while parent[x] != x:
                x = parent[x]
            return x

        for i, a in rows:
            for j, b in rows:
                if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                    low, high = sorted((find(i), find(j)))
                    parent[high] = low
        want = Counter((i, len(x), None if i is None else find(i)) for i, x in rows)
        assert Counter(tuple(r) for r in spotsigs.near(odd, percent).collect()) == want
    assert spotsigs.near(empty).collect() == []


def test_near_duplicates(odd, odd_rows, empty):
    want, sets = brute_classes(odd_rows)
    got = neardup.classes(odd).collect()
    assert len(got) == len(odd_rows)
    for r in got:
        assert r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id is None or r.doc_id == want[r.doc_id])
        assert r.n_shingles in [len(s) for s in sets[r.doc_id]]
    assert neardup.classes(empty).collect() == []


def test_near_duplicate_chains_and_blocks(spark, monkeypatch):
    """A family of drifting copies: links between neighbours only, over many small blocks."""
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 6)
    monkeypatch.setattr(neardup, "BLOCK_HASHES", 900)
    rng = random.Random(8)
    text, rows = prose(rng, 200).split(" "), []
    for i in range(60):
        rows.append((i, " ".join(text)))
        for _ in range(rng.randrange(1, 5)):
            text[rng.randrange(len(text))] = f"new{rng.randrange(10**6)}"
    passage = prose(rng, 60)
    rows += [(100 + i, f"{prose(rng, 100)} {passage} {prose(rng, 40)}") for i in range(40)]
    got = {r.doc_id: r.component_id for r in neardup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_classes(rows)[0]


# ---- 4: language model

def test_language_model(odd, odd_rows, empty):
    got = maxent.score(odd, common.fold(F.col("doc_id"), 7) != 2).collect()
    fold = lambda i: zlib.crc32(b"" if i is None else str(i).encode()) % 7
    tokens = [(i, [*words(t), b" "]) for i, t, *_ in odd_rows]
    c = Counter(x for i, w in tokens if fold(i) != 2 for x in w)
    n, v = sum(c.values()), len(c)
    want = sorted((i is not None, i or 0, len(w), sum(c[x] > 0 for x in w), round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6)) for i, w in tokens)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert all(r.train_tokens == n and r.score < 0 for r in got)
    assert maxent.score(empty, F.lit(True)).collect() == []


def brute_language_scores(rows, held):
    """Scores token by token and choice by choice, with lists and dicts alone."""
    mask = (1 << 64) - 1

    def mixed(h):
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            h = ((h ^ (h >> shift)) * factor) & mask
        return h ^ (h >> 33)

    def ending(w):
        return int.from_bytes(w[-3:], "big")

    tokens = {i: [*(w.encode() if isinstance(w, str) else w for w in words(t)), None] for i, t in rows}
    c = Counter(w for i, _ in rows if i not in held for w in tokens[i])
    heavy = Counter()
    for w, n in c.items():
        if w is not None:
            heavy[ending(w)] += n
    endings = sorted(sorted(heavy, key=lambda e: (-heavy[e], e))[:41])

    def number(w):
        return 1 if w is None else int(common.Words([w]).hash[0])

    def kind(w):
        if w is None:
            return 0
        return 1 + endings.index(ending(w)) if ending(w) in endings else 42 + w[-1] % 22

    def path(w):
        leaf = kind(w) * 64 + ((number(w) >> 20) & 63)
        digits = [(leaf >> 9) & 7, (leaf >> 6) & 7, (leaf >> 3) & 7, leaf & 7]
        nodes = [0, 1 + digits[0], 9 + digits[0] * 8 + digits[1], 73 + digits[0] * 64 + digits[1] * 8 + digits[2]]
        return leaf, list(zip(nodes, digits, strict=True))

    mass = {leaf: 1 / 4096 for leaf in range(4096)}
    for w, n in c.items():
        mass[path(w)[0]] += n + 1
    share = {}
    for first, depth in ((0, 0), (1, 1), (9, 2), (73, 3)):
        for node in range(8**depth):
            size = 8 ** (3 - depth)
            below = [sum(mass[(node * 8 + d) * size + j] for j in range(size)) for d in range(8)]
            share[first + node] = [math.log(x / sum(below)) for x in below]
    weights = {}

    def look(seq, at):
        """(rows of the weight table, node, digit) of every choice of the token."""
        before = [seq[at - k] if at >= k else None for k in (1, 2, 3)]
        parts = [number(before[0]), kind(before[0]) * 64 + kind(before[1]), number(before[1]), kind(before[2])]
        keys = [mixed((x * 4 + f) & mask) for f, x in enumerate(parts)]
        for node, digit in path(seq[at])[1]:
            found = [(((k + node * 0x9E3779B97F4A7C15) & mask) * 0xD6E8FEB86659FD93 & mask) >> 47 for k in keys]
            z = [share[node][d] + sum(weights.get((r, d), 0.0) for r in found) for d in range(8)]
            total = math.log(sum(map(math.exp, z)))
            yield found, digit, [x - total for x in z]

    for turn in range(4):
        seen, expected = Counter(), Counter()
        for i, t in rows:
            signed = xxhash.xxh64_intdigest((t or "").encode(), seed=42)
            if i in held or (signed - (signed >> 63 << 64)) % 4 != turn:
                continue
            for at in range(len(tokens[i])):
                for found, digit, logs in look(tokens[i], at):
                    for r in found:
                        seen[r, digit] += 1
                        for d in range(8):
                            expected[r, d] += math.exp(logs[d])
        for k in expected:
            weights[k] = weights.get(k, 0.0) + 0.4 * (seen[k] - expected[k]) / ((seen[k] + expected[k]) / 2 + 8)
    return {i: sum(logs[digit] / math.log(10) for at in range(len(seq)) for _, digit, logs in look(seq, at))
            + sum(math.log10((c[w] + 1) / mass[path(w)[0]]) for w in seq) for i, seq in tokens.items()}


def test_language_model_scores_against_a_plain_twin_at_any_layout(spark):
    rng = random.Random(4)
    vocabulary = ["the", "cat", "sat", "on", "a", "mat", "running", "walking", "É", "x"]
    rows = [(i, " ".join(rng.choices(vocabulary, range(10, 0, -1), k=rng.randrange(1, 25)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "unseen words only"), (63, rows[0][1])]
    held = {62, *range(0, 60, 7)}
    want = brute_language_scores(rows, held)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 16):
        got = {r.doc_id: r.score for r in maxent.score(docs.repartition(parts), ~F.col("doc_id").isin(*held)).collect()}
        assert got == pytest.approx(want, abs=1e-3)


def test_language_model_without_training_tokens_is_the_base(odd):
    for r in maxent.score(odd, F.lit(False)).collect():
        assert r.train_tokens == 0 and r.score == pytest.approx(r.base_score, abs=1e-4 * r.n_tokens)


def test_language_model_rare_words_meet_their_counts(odd, monkeypatch):
    """The join of rare words gives what the table of frequent words gives."""
    key = lambda df: sorted((r.doc_id or -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in df.collect())
    all_head = key(maxent.score(odd, F.lit(True)))
    monkeypatch.setattr(maxent, "HEAD", 5)
    assert key(maxent.score(odd, F.lit(True))) == all_head


# ---- 5: rollups

def test_rollup_batches(spark, odd, odd_rows, empty):
    def totals(rolled):
        return sorted(tuple(str(x) for x in r) for r in rolled.totals().select("source", "lang", "tokenizer", "docs", "tokens").collect())

    rolled = rollup.Rollup(spark)
    assert totals(rolled) == []
    counted = rollup.count_tokens(odd, "words-1")
    rolled.commit("1", counted)
    once = totals(rolled)
    rolled.commit("1", counted)
    assert totals(rolled) == once
    want = Counter()
    for i, t, lang, source, _ in {(r[0], r[1], r[2], r[3], None) for r in odd_rows if r[0] is not None}:
        want[(str(source), str(lang), "words-1")] += len(words(t))
    assert {x[:3]: int(x[4]) for x in once} == dict(want)
    gone = odd.where("doc_id % 3 = 0").select("doc_id")
    rolled.commit("2", deletes=gone)
    rolled.commit("2", deletes=gone)
    rolled.commit("3", rollup.count_tokens(odd.where("doc_id % 3 = 1"), "words-2"))
    direct = rollup.Rollup(spark)
    direct.commit("a", rollup.count_tokens(odd.where("doc_id % 3 = 1"), "words-2"))
    direct.commit("b", rollup.count_tokens(odd.where("doc_id % 3 = 2"), "words-1"))
    assert totals(rolled) == totals(direct)
    rolled.commit("4", rollup.count_tokens(empty, "words-1"))
    assert totals(rolled) == totals(direct)


def test_rollup_earlier_batch_again_and_reopened(spark, odd, tmp_path):
    """Any batch may be committed again, also changed, in this process or a later one."""
    def totals(rolled):
        return sorted(tuple(str(x) for x in r) for r in rolled.totals().collect())

    def commits(rolled, first=odd, ids=("1", "2", "3")):
        if "1" in ids:
            rolled.commit("1", rollup.count_tokens(first, "words-1"))
        if "2" in ids:
            rolled.commit("2", deletes=odd.where("doc_id % 3 = 0").select("doc_id"))
        if "3" in ids:
            rolled.commit("3", rollup.count_tokens(odd.where("doc_id % 3 = 1"), "words-2"))
        return rolled

    want = totals(commits(rollup.Rollup(spark, f"{tmp_path}/a")))
    rolled = rollup.Rollup(spark, f"{tmp_path}/a")
    assert totals(rolled) == want
    assert totals(commits(rolled, ids="1")) == want
    assert totals(commits(rolled, ids="2")) == want
    last = rollup.count_tokens(odd.where("doc_id < 20"), "words-2")
    rolled.commit("4", last, odd.where("doc_id >= 30").select("doc_id"))
    fresh = commits(rollup.Rollup(spark))
    fresh.commit("4", last, odd.where("doc_id >= 30").select("doc_id"))
    assert totals(rolled) == totals(fresh)
    # a first batch that lacked documents which later batches delete and revise, then has them
    part = commits(rollup.Rollup(spark, f"{tmp_path}/b"), odd.where("doc_id > 12"))
    assert totals(commits(part, ids="1")) == want
    assert totals(rollup.Rollup(spark, f"{tmp_path}/b")) == want
    part.commit("3", rollup.count_tokens(odd.limit(0), "words-2"))
    assert totals(part) == totals(commits(rollup.Rollup(spark), ids=("1", "2")))


# ---- 6, 7: packing

def check_plan(lengths, capacity):
    histogram = Counter(lengths)
    seen, fill = {x: set() for x in histogram}, {}
    for length, rank, count, first, per, place in packing.plan(dict(histogram), capacity):
        for i in range(count):
            assert rank + i not in seen[length]
            seen[length].add(rank + i)
            fill.setdefault(first + i // per, []).append((place + i % per * length, length))
    assert all(seen[x] == set(range(n)) for x, n in histogram.items())
    for row in fill.values():
        at = 0
        for place, length in sorted(row):
            assert place == at
            at += length
        assert at <= capacity
    return len(fill)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=300))
def test_plan_is_a_packing(lengths):
    bins = check_plan(lengths, 100)
    assert -(-sum(lengths) // 100) <= bins <= max(1, 2 * -(-sum(lengths) // 100)) or not lengths


def test_plan_is_tight():
    rng = random.Random(2)
    lengths = [min(4096, max(1, int(rng.lognormvariate(6.3, 1.1)))) for _ in range(20000)]
    assert check_plan(lengths, 4096) <= 1.01 * sum(lengths) / 4096 + 1


def test_packing(odd, odd_rows, empty):
    library = Tokenizer.from_file(TOKENIZER)
    got = packing.pack(odd, TOKENIZER, capacity=64).collect()
    want = Counter()
    for i, t, *_ in odd_rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), 64)):
            want[(i, k, a, len(ids[a:a + 64]), zlib.crc32(np.array(ids[a:a + 64], "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    rows = {}
    for r in got:
        rows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for row in rows.values():
        at = 0
        for place, n in sorted(row):
            assert place == at
            at += n
        assert at <= 64
    assert packing.pack(empty, TOKENIZER).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_best_fit_equals_plain_scan(lengths):
    lengths = sorted(lengths, reverse=True)
    rooms, want = [], []
    for n in lengths:
        fit = [r for r in rooms if r >= n]
        want.append(min(fit) if fit else 50)
        if fit:
            rooms.remove(min(fit))
        rooms.append(want[-1] - n)
    fill = Counter()
    for n, s, room in zip(lengths, sequences.best_fit(lengths, 50), want, strict=True):
        assert 50 - fill[s] == room
        fill[s] += n


def test_matrices_round_trip(odd, odd_rows, empty):
    library = Tokenizer.from_file(TOKENIZER)
    parts = {}
    for r in sequences.pack(odd, TOKENIZER, capacity=128, shard_chars=20000).collect():
        ids, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(positions) == 128 and r.cu_seqlens[-1] == r.n_tokens and not ids[r.n_tokens:].any()
        for doc, k, at, a, b in zip(r.doc_ids, r.pieces, r.starts, r.cu_seqlens[:-1], r.cu_seqlens[1:], strict=True):
            assert positions[a:b].tolist() == list(range(b - a)) and at == k * 128
            parts.setdefault(doc, []).append((k, ids[a:b].tolist()))
    for i in {r[0] for r in odd_rows if r[0] is not None}:
        texts = [r[1] for r in odd_rows if r[0] == i]
        joined = [x for _, ids in sorted(parts[i], key=lambda p: p[0]) for x in ids]
        if len(texts) == 1:
            assert joined == [*library.encode(texts[0] or "", add_special_tokens=False).ids, 1]
        assert len(joined) == sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for t in texts)
    assert sequences.pack(empty, TOKENIZER).collect() == []


# ---- 8, 10: classifiers

def labelled(spark, rng, marks, rows=600):
    texts = []
    for i in range(rows):
        bad = i % 5 == 0
        text = prose(rng, rng.randrange(5, 80)).split(" ")
        if bad:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(marks))
        texts.append((i, " ".join(text), int(bad)))
    common.ship(spark)
    df = spark.createDataFrame(texts, "doc_id long, text string, y int")
    return df, df.select("doc_id", F.col("y").alias("toxic"), (1 - F.col("y")).alias("quality")), {i: y for i, _, y in texts}


def held_accuracy(got, truth, fold, of):
    held = [(r.predicted, of(truth[r.doc_id])) for r in got if zlib.crc32(str(r.doc_id).encode()) % fold[0] == fold[1]]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    return sum(a == b for a, b in held) / len(held)


def test_quality(spark, odd, empty):
    docs, labels, truth = labelled(spark, random.Random(1), ["BUY!!", "now###", "win win win win win"])
    training = common.fold(F.col("doc_id"), 5) != 0
    got = quality.classify(docs, labels, training).collect()
    assert held_accuracy(got, truth, (5, 0), lambda y: 1 - y) > 0.95
    assert [tuple(r) for r in sorted(quality.classify(docs, labels, training).collect())] == [tuple(r) for r in sorted(got)]
    assert quality.classify(odd, labels, training).count() == odd.count()
    assert {r.score for r in quality.classify(odd, labels.limit(0), training).collect()} == {0.5}
    assert quality.classify(empty, labels, training).collect() == []


def test_quality_learns_from_a_written_sample(spark, monkeypatch):
    """The task that learns reads the sample, not the documents through it."""
    docs, labels, _ = labelled(spark, random.Random(4), ["BUY!!"], rows=60)
    seen, train = [], quality.train
    monkeypatch.setattr(quality, "train", lambda sample, *a: seen.append(sample) or train(sample, *a))
    assert quality.classify(docs, labels, F.lit(True), sample_rows=20).count() == 60
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Scan parquet" in plan and seen[0].count() == 20


def test_toxicity(spark, odd, empty):
    insults = ["grobnak", "plinfex", "grobnaken", "zwordel"]
    docs, labels, truth = labelled(spark, random.Random(2), insults)
    training = common.fold(F.col("doc_id"), 4) != 2
    got = toxicity.classify(docs, labels, training).collect()
    assert held_accuracy(got, truth, (4, 2), lambda y: y) > 0.95
    machine = toxicity.train(common.labelled_sample(docs, labels, "toxic", training, 10000))
    value = dict(zip(seen := ["grobnak", "g.r.o.b.n.a.k", "grobxnak", "plin-fex", "river", "wort", "stone"], machine.values(seen), strict=True))
    assert min(value[w] for w in seen[:4]) > max(value[w] for w in seen[4:])
    assert "grobnak" in toxicity.words_of("you g r o b n a k you")
    assert toxicity.classify(odd, labels, training).count() == odd.count()
    assert {r.score for r in toxicity.classify(odd, labels.limit(0), training).collect()} == {0.0}
    assert toxicity.classify(empty, labels, training).collect() == []


def test_letters_apart_read_as_a_word():
    """Also with a letter twice, and with marks beside the letters."""
    assert "odo" in toxicity.words_of("you o d o you")
    assert "grob" in toxicity.words_of("you G. r, o. b! you")
    assert toxicity.words_of("a b") == {"a", "b"}


def test_long_insults_and_insults_of_ordinary_words(spark):
    """A word of 26 letters, and two words that are harmless alone, also with letters put in."""
    long = "grobnakplinfexzwordelhumkr"
    rng, texts = random.Random(3), []
    for i in range(900):
        words = prose(rng, rng.randrange(5, 80)).split(" ")
        # both words also stand in clean texts, apart
        for x in [rng.choice([long, "mudd kettle"]) for _ in range(3)] if i % 5 == 0 else rng.sample(["mudd", "kettle", "lamp", "mudd"], 2):
            words.insert(rng.randrange(len(words)), x)
        texts.append((i, " ".join(words), int(i % 5 == 0)))
    docs = spark.createDataFrame(texts, "doc_id long, text string, y int")
    labels, truth = docs.select("doc_id", F.col("y").alias("toxic")), {i: y for i, _, y in texts}
    training = common.fold(F.col("doc_id"), 4) != 2
    got = toxicity.classify(docs, labels, training).collect()
    assert held_accuracy(got, truth, (4, 2), lambda y: y) > 0.95
    machine = toxicity.train(common.labelled_sample(docs, labels, "toxic", training, 10000))
    assert machine.learned == {"mudd kettle"}

    def score(text):
        found = sorted(toxicity.words_of(text) | toxicity.joined(text, machine.learned, {}))
        return machine.probability(machine.values(found)).max()

    for bad in (f"a {long} b", "such a mudd kettle you are", "MUDD, k.e.t.t.l.e", "muxdd kettle", "mudd. x kettle mudd ketxtle"):
        assert score(bad) >= 0.3, bad
    for good in ("a mudd lamp", "the kettle mudd", "mudd here. kettle there", "stone kettle"):
        assert score(good) < 0.3, good


def test_windows_of_one_passage_count_once():
    """By their surroundings: copies of a sentence have the same ones."""
    one, two = set(toxicity.surroundings("a mudd kettle b")), set(toxicity.surroundings("a mudd kettle c. a mudd kettle b\nd"))
    assert len([x for x, _ in one | two if x == "mudd kettle"]) == 2
    assert {x for x, _ in two} == toxicity.phrases("a mudd kettle c. a mudd kettle b\nd")
    assert toxicity.phrases("a b. c") == {"a b"} and toxicity.phrases(None) == set() and list(toxicity.surroundings(None)) == []


# ---- 9: mixing

def brute_targets(sizes):
    """Excess reshared by weight until no source is above its stop."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        stopped = {s for s in open_ if weight[s] * level >= 2 * sizes[s]}
        if not stopped:
            return target | {s: weight[s] * level for s in open_}
        for s in stopped:
            target[s] = 2 * sizes[s]
            left -= target[s]
        open_ -= stopped
    return target


def test_mixing(odd, odd_rows, empty):
    got = mixing.mix(odd).collect()
    assert len(got) == len(odd_rows)
    sizes = Counter()
    for _, t, _, source, _ in odd_rows:
        sizes[source] += len(words(t))
    target = brute_targets(sizes)
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source]) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        assert (r.position is None) == (r.taken == 0) and (r.position is None or 0 <= r.position <= 1)
    assert all(taken[s] == math.floor(target[s] + 1e-9) for s in sizes)
    assert sorted(map(str, mixing.mix(odd.repartition(3)).collect())) == sorted(map(str, got))
    arranged = mixing.arrange(odd)
    assert arranged.columns == odd.columns
    assert mixing.mix(empty).collect() == [] and mixing.arrange(empty).collect() == []


def test_positions_follow_the_schedule(spark):
    """A rising schedule reads less than half of its source in the first half of training."""
    common.ship(spark)
    docs = spark.createDataFrame([(i, "w " * 10, "a") for i in range(2000)], "doc_id long, text string, source string")
    got = mixing.mix(docs, schedules=(((0.0, 0.0), (1.0, 2.0)),), share_percent=100).collect()
    early = sum(r.taken for r in got if r.position <= 0.5) / sum(r.taken for r in got)
    assert early == pytest.approx(0.25, abs=0.01)


def test_taken_words_follow_the_reading_times(spark, monkeypatch):
    """Words are those that the schedule's demand takes between a reading's two times, whatever their number."""
    rows = [(i, "abc"[i % 3], 10**11 + i * 7919, f"{i * 2654435761 % 4096:03x}") for i in range(300)]
    sized = spark.createDataFrame(rows, "doc_id long, source string, size long, _key string")
    got = mixing.place_rows(sized, sized).collect()
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
        assert 0 <= r._first <= r.size and 0 <= r._second <= r.size
    assert all(taken[r.source] == math.floor(r.target) for r in got)
    monkeypatch.setattr(mixing, "_position", lambda place, share, schedules: F.lit(0.5))
    assert sum(r.taken for r in mixing.place_rows(sized, sized).collect()) == 0


def test_texts_leave_their_batch_a_chunk_at_a_time():
    """A batch's texts are not all taken out before the first chunk is worked on."""
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(9)), "text": ["x" * 100, None, "", "é" * 60, *["y" * 300] * 5]})
    seen = []

    def value(texts, part):
        assert [len(t or b"") for t in texts] == [len((t or "").encode()) for t in part.column("text").to_pylist()]
        seen.append(len(texts))
        return {"size": np.array([len(t or b"") for t in texts])}

    schema = pa.schema([("doc_id", pa.int64()), ("size", pa.int64())])
    made = pa.Table.from_batches(common.per_text(value, ["doc_id"], schema, 400)([batch]))
    assert made.column("size").to_pylist() == [100, 0, 0, 120, *[300] * 5] and seen == [4, 1, 1, 1, 1, 1]


def test_toxicity_takes_texts_in_slices(monkeypatch):
    """A batch is taken in parts of bounded bytes, whole and in order; nulls and long texts included."""
    batch = pa.record_batch({"text": pa.array(["a" * 40, None, "b" * 500, "é" * 30, "", "c" * 50])})
    monkeypatch.setattr(toxicity, "SLICE_BYTES", 100)
    parts = [p.column("text").to_pylist() for p in toxicity.slices(batch)]
    assert [t for p in parts for t in p] == batch.column("text").to_pylist()
    assert all(len(p) == 1 or sum(len((t or "").encode()) for t in p) <= 100 for p in parts) and len(parts) > 2
