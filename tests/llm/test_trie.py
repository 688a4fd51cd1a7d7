"""The conversation trie against brute force, with nodes that go over the edges of ranges."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tessera.llm import common, trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, part int, own long, depth long"


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def brute(rows):
    members = defaultdict(list)
    sequences = rebuilt(rows)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def under(p):
        leaves, saved = (0 if children[p] else 1), (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        for q in children[p]:
            more = under(q)
            leaves, saved = leaves + more[0], saved + more[1]
        return leaves, saved

    out = []
    for p, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(sequences[c]) == len(p))
        out.append((min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), len(children[p]), *under(p), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed, n):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        c = rng.randrange(-150, 420) if n > 20 else rng.randrange(0, 120)
        for turn in range(rng.choice([0, 1, 1, 2, 3, 4, 7])):
            rows.append((c, rng.choice([turn, None, 1]), rng.choice(["user", "user", None, "bot"]), rng.choice(["yes", "no", "", None, "naïve 日本", "ok"])))
    hot = [(c, t, "user", f"same {t}") for c in range(500, 560) for t in range(6)]
    return [*rows, rows[0], (None, 1, "user", "lost"), *hot, *((900, t, "user", "yes") for t in range(150))]


@pytest.mark.parametrize(("seed", "n", "parts", "fan"), [(1, 200, 40, 2), (2, 200, 7, 256), (3, 8, 5, 3), (4, 300, 1, 2)])
def test_equals_brute_force(spark, seed, n, parts, fan):
    common.ship(spark)
    rows = conversations(seed, n)
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": str(parts)}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = trie.conversation_trie(spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA), fan)
        got = sorted((tuple(r) for r in out.collect()), key=str)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == brute(rows)


def test_empty_table(spark):
    common.ship(spark)
    assert trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert trie.conversation_trie(spark.createDataFrame([(None, 1, "a", "b", "", 1, 1, 1)], SCHEMA)).collect() == []


def test_deepest_common_turn():
    a = ["0" * 32, "1" * 32, "2" * 32]
    for n in range(4):
        assert trie._lcp("".join(a[:n]), "".join(a)) == n
    assert trie._lcp("".join([a[0], a[2]]), "".join(a)) == 1
    assert trie._lcp("".join([a[2], a[1], a[2]]), "".join(a)) == 0
