"""Phrase mining against a brute-force count, on odd rows, ties, long texts and an empty table."""

import random
import re
from collections import Counter

import pytest

from tessera.llm import common, setm

SCHEMA = "text string, lang string, id long, phrase string, a long, n long, rank int, block long"


def brute(rows, least, longest, share, top):
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i : i + k])] += 1
    f = {p: a for p, a in f.items() if a >= least}
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2:
            continue
        if any(l2 == lang and len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (l2, q), b in f.items()):
            continue
        score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    rank, ranked = Counter(), []
    for r in out:
        rank[r[0]] += 1
        if rank[r[0]] <= top:
            ranked.append((r[0], rank[r[0]], *r[1:]))
    return ranked


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = ["der", "Hund", "la", "niño", "the", "cat", "x", "日本", "\x85q", "a\xa0b", "\x1c"]
    prose = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "! "]) for _ in range(n))
    texts = [prose(rng.randrange(0, 60)) for _ in range(120)] + [prose(9000), "in spite of all this " * 50, "IN SPITE OF all this."]
    made = [(t, rng.choice(["en", "de", None, "und"])) for t in texts]
    return [*made, made[0], made[0], (None, "en"), ("", None), (" \t ", "fr"), ("alone", "fr")]


@pytest.mark.parametrize(("least", "longest", "share", "top", "block"), [(5, 5, 100, 2000, 1 << 21), (3, 4, 60, 7, 300), (2, 2, 100, 2000, 50)])
def test_equals_brute_force(spark, rows, least, longest, share, top, block):
    common.ship(spark)
    docs = spark.createDataFrame([(t, lang, 7, "x", 1, 2, 3, 4) for t, lang in rows], SCHEMA).repartition(4)
    got = setm.collocations(docs, least, longest, share, top, block)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute(rows, least, longest, share, top))


def test_slices_keep_words_and_pieces(monkeypatch):
    text = "A b.c  D\te,f g h\n\ni j".encode() * 9
    whole = [w for part in setm.words_of(text) for w in part]
    for size in (1, 3, 8):
        monkeypatch.setattr(setm, "SLICE", size)
        assert [w for part in setm.words_of(text) for w in part] == whole


def test_empty_table(spark):
    common.ship(spark)
    assert setm.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
