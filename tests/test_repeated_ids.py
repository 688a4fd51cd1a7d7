"""Pairs and chunks made in a document's own row, and rows that share an id."""

import contextlib
import io
from collections import Counter

import pytest

from tessera.operators import text as ops

ROWS = [(1, ["a", "b", "c", "a"]), (2, ["b"]), (3, ["c", "a", "a"]), (4, []), (5, None), (6, ["x", "y", "x"]), (6, ["z", "x"]), (None, ["a", "b"]), (None, ["c"]),
        (7, ["line\nend", "", "a", "", "line\nend", None, "a", None])]


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, tokens array<string>").repartition(3)


def pairs_of(rows, window):
    placed = [(d, p, t) for d, tokens in rows if d is not None for p, t in enumerate(tokens or [])]
    return Counter((d, p, a, b) for d, p, a in placed for e, q, b in placed if d == e and 0 < abs(p - q) <= window)


@pytest.mark.parametrize("window", [1, 2, 3])
def test_context_pairs_of_rows_with_shared_and_null_ids(docs, window):
    want = pairs_of(ROWS, window)
    got = Counter(tuple(r) for r in ops.context_pairs(docs, window).collect())
    assert got == want
    counted = Counter()
    for (_, _, a, b), n in want.items():
        counted[a, b] += n
    for most in (5, 1 << 21):
        assert Counter({(r[0], r[1]): r[2] for r in ops.context_pair_counts(docs.coalesce(1), window, most).collect()}) == counted


def test_chunks_of_rows_with_shared_and_null_ids(docs):
    streams = {}
    for d, tokens in ROWS:
        for p, t in enumerate(tokens or []):
            streams.setdefault((d, p // 2), []).append((p, t))
    want = {k: [t for _, t in sorted(v, key=lambda x: (x[0], x[1] or ""))] for k, v in streams.items()}
    assert {(r[0], r[1]): r[2] for r in ops.rechunk(docs, 2).collect()} == want


def test_documents_with_ids_of_their_own_are_not_shuffled(spark):
    own = spark.createDataFrame([(i, ["a", "b", "c"]) for i in range(8)], "doc_id long, tokens array<string>")
    for made in (ops.context_pairs(own, 2), ops.rechunk(own, 2)):
        assert "Join" not in plan(made) and "Exchange" not in plan(made)
