import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from graph_brute import adjacency, bfs_dist, components, cut_vertices
from tessera.operators.graph import biconn, community, components as cc, core, paths, walks
from tessera.operators.graph.generate import gnm, gnp
from tessera.sources import tables

# The 10-vertex example graph and its closeness (1 / sum of hop distances).
INLINE_EDGES = [
    ("A", "B"), ("A", "C"), ("A", "D"), ("B", "C"), ("B", "D"), ("B", "E"), ("C", "D"), ("C", "F"), ("C", "H"),
    ("D", "E"), ("D", "F"), ("D", "G"), ("E", "F"), ("E", "G"), ("F", "G"), ("F", "H"), ("H", "I"), ("I", "J"),
]
INLINE_CLOSENESS = {"C": 1 / 14, "F": 1 / 14, "D": 1 / 15, "H": 1 / 15, "B": 1 / 17, "E": 1 / 17,
                    "A": 1 / 18, "G": 1 / 18, "I": 1 / 21, "J": 1 / 29}


def edges_df(spark, pairs, typ="string"):
    return spark.createDataFrame(pairs, f"src {typ}, dst {typ}")


def random_pairs(n, m, seed):
    rng = random.Random(seed)
    return [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]


def test_inline_closeness(spark):
    got = {r.id: r.closeness for r in paths.closeness(edges_df(spark, INLINE_EDGES)).collect()}
    assert got.keys() == INLINE_CLOSENESS.keys()
    for k, v in INLINE_CLOSENESS.items():
        assert got[k] == pytest.approx(v)


def test_landmark_distances_match_bfs(spark):
    pairs = random_pairs(40, 70, 3)
    adj = adjacency(pairs)
    lm = sorted(adj)[:3]
    got = {(r.landmark, r.id): r.dist for r in paths.landmark_distances(
        edges_df(spark, pairs, "long"), spark.createDataFrame([(x,) for x in lm], "id long")).collect()}
    want = {(s, t): d for s in lm for t, d in bfs_dist(adj, s).items()}
    assert got == want


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_match_brute_force(spark, seed):
    pairs = [p for p in random_pairs(60, 45, seed) if p[0] != p[1]]
    labels = {r.id: r.component for r in cc.connected_components(edges_df(spark, pairs, "long")).collect()}
    adj = adjacency(pairs)
    assert len(set(labels.values())) == components(adj)
    for a, b in pairs:
        assert labels[a] == labels[b]
    for v, c in labels.items():
        assert c == min(u for u in labels if labels[u] == c)


@pytest.mark.parametrize("seed,n,m", [(1, 30, 32), (2, 25, 30), (5, 40, 48), (9, 12, 14)])
def test_cut_vertices_match_brute_force(spark, seed, n, m):
    pairs = [p for p in random_pairs(n, m, seed) if p[0] != p[1]]
    got = {r.id for r in biconn.articulation_points(edges_df(spark, pairs, "long")).collect()}
    assert got == cut_vertices(pairs)


def dense_and_sparse(seed):
    """Two dense blocks, a bridge between them, trees hanging off, and repeated and looped rows."""
    rng = random.Random(seed)
    pairs = [(a, b) for o in (0, 20) for a in range(o, o + 20) for b in range(o, a) if rng.random() < 0.6]
    pairs += [(5, 25), (25, 50), (50, 51), (51, 52), (52, 50), (3, 60), (60, 61), (7, 7), (70, 71)]
    return pairs + [(b, a) for a, b in pairs[::3]]


def test_components_work_on_two_links_a_vertex(spark, monkeypatch):
    """All edges are read for numbers that differ (here the first numbering has collisions), and what
    is contracted round by round is at most two links a vertex and one edge a pair of labels."""
    pairs = dense_and_sparse(1)
    plain = cc._number
    monkeypatch.setattr(cc, "_number", lambda c, salt: F.pmod(plain(c, salt), F.lit(7)) if salt == 0 else plain(c, salt))
    found = cc.spanned(edges_df(spark, [p for p in pairs if p[0] != p[1]], "long"))
    adj = adjacency([p for p in pairs if p[0] != p[1]])
    assert found.names.select("n").distinct().count() == found.names.count() == len(adj)
    assert found.links.count() <= 2 * len(adj) + 3 and found.pairs.count() > 4 * len(adj)
    got = {r.id: r.component for r in cc.connected_components(edges_df(spark, pairs, "long")).collect()}
    assert got == {v: min(bfs_dist(adj, v)) for v in adj}


def test_cut_vertices_work_on_a_link_a_vertex(spark):
    """Edges outside the search tree become at most one link a vertex, and the cut vertices are those of all edges."""
    pairs = dense_and_sparse(2)
    e = edges_df(spark, pairs, "long")
    found = cc.spanned(cc.plain_edges(e))
    order, roots = biconn.search_order(found)
    at = {r.n: r.o for r in order.collect()}
    numbered = [tuple(sorted((at[r.s], at[r.d]))) for r in found.pairs.collect()]
    tree, links = biconn.tree_and_rest(edges_df(spark, numbered, "long").toDF("lo", "hi"), roots)
    parent = {r.id: r.parent for r in tree.collect()}
    assert all(parent[v] == min((a for a, b in numbered if b == v), default=None) for v in parent)
    assert links.count() < len(at) < len(set(numbered)) / 2
    assert {r.id for r in biconn.articulation_points(e).collect()} == cut_vertices([p for p in pairs if p[0] != p[1]])


def test_cut_vertices_on_sparse_purchase_graph(spark):
    pl = tables.purchase_lines(spark, SF_SMALL).where(F.col("qty") >= 45)
    e = pl.select(F.concat(F.lit("c"), F.col("user").cast("string")).alias("src"),
                  F.concat(F.lit("p"), F.col("item").cast("string")).alias("dst")).distinct()
    pairs = [(r.src, r.dst) for r in e.collect()]
    got = {r.id for r in biconn.articulation_points(e).collect()}
    assert got == cut_vertices(pairs)


def test_degree_distribution_properties(spark):
    e = core.simple(tables.bipartite_edges(spark, SF_SMALL))
    hist = core.degree_distribution(e).collect()
    n_v = core.vertices_from_edges(e).count()
    assert sum(r["count"] for r in hist) == n_v
    assert sum(r["degree"] * r["count"] for r in hist) == e.count()


def test_power_law_in_blocks(spark, monkeypatch):
    """Several blocks of tail values give the fit of a plain scan."""
    from tessera.operators.graph import powerlaw

    monkeypatch.setattr(powerlaw, "BLOCK", 4)
    hist = [(d, max(1, 400 // d**2) + d % 3) for d in range(1, 30)]
    got = powerlaw.fit_power_law(spark.createDataFrame(hist, "degree long, count long")).first()
    fits = []
    for xmin, _ in hist[:-1]:
        tail = [(x, w) for x, w in hist if x >= xmin]
        n = sum(w for _, w in tail)
        alpha = 1 + n / sum(w * math.log(x / xmin) for x, w in tail)
        seen, worst = 0, 0.0
        for x, w in tail:
            seen += w
            worst = max(worst, abs(seen / n - (1 - (x / xmin) ** (1 - alpha))))
        fits.append((worst, xmin, alpha, n))
    ks, xmin, alpha, n = min(fits)
    assert (got.xmin, got.n_tail) == (xmin, n)
    assert (got.alpha, got.ks) == (pytest.approx(alpha), pytest.approx(ks))


def test_random_walk_steps_are_edges(spark):
    pairs = [p for p in random_pairs(30, 60, 4) if p[0] != p[1]]
    adj = adjacency(pairs)
    w = walks.random_walks(edges_df(spark, pairs, "long"), walks_per_node=2, length=6, seed=1).collect()
    seq = {}
    for r in w:
        seq.setdefault(r.walk_id, {})[r.step] = r.node
    for steps in seq.values():
        for s in range(1, len(steps)):
            assert steps[s] in adj[steps[s - 1]]


def test_modularity_gain_equals_difference(spark):
    pairs = [p for p in random_pairs(20, 40, 6) if p[0] != p[1]]
    und = sorted({(min(a, b), max(a, b)) for a, b in pairs})
    e = spark.createDataFrame([(a, b, 1.0) for a, b in und], "src long, dst long, weight double")
    lab = {v: v % 3 for v in {x for p in und for x in p}}
    labels = spark.createDataFrame(list(lab.items()), "id long, comm long")
    attrs = spark.createDataFrame([(v, [1.0, float(v % 5), 2.0]) for v in lab], "id long, attrs array<double>")
    q0 = community.modularity(e, labels).first()[0]
    gains = community.candidate_gains(e, labels, attrs, alpha=1.0).collect()
    assert gains
    for g in gains[:5]:
        moved = dict(lab)
        moved[g.id] = g.comm
        q1 = community.modularity(e, spark.createDataFrame(list(moved.items()), "id long, comm long")).first()[0]
        assert g.dq_newman == pytest.approx(q1 - q0, abs=1e-12)


def test_gnp_and_gnm(spark):
    v = spark.range(200).select(F.col("id"))
    e = gnp(v, 0.05, seed=3).collect()
    assert all(r.dst < r.src for r in e)
    assert 0.6 * 0.05 * 200 * 199 / 2 < len(e) < 1.4 * 0.05 * 200 * 199 / 2
    m = gnm(spark, 100, 300, seed=2).collect()
    assert len(m) == 300 and len({(r.src, r.dst) for r in m}) == 300
    assert all(r.src != r.dst for r in m)


def test_closeness_from_distance_maps(spark):
    e = edges_df(spark, INLINE_EDGES)
    lm = core.vertices_from_edges(core.simple(e))
    got = {r.id: r.closeness for r in paths.closeness_from_maps(paths.distance_maps(paths.landmark_distances(e, lm))).collect()}
    for k, v in INLINE_CLOSENESS.items():
        assert got[k] == pytest.approx(v)


def test_sample_landmarks_any_id_type(spark):
    ints = spark.range(2000).select(F.col("id"))
    strs = ints.select(F.concat(F.lit("v"), F.col("id").cast("string")).alias("id"))
    a = paths.sample_landmarks(ints, 100, seed=1).count()
    b = paths.sample_landmarks(strs, 100, seed=1).count()
    assert 100 < a < 320 and 100 < b < 320
    assert paths.sample_landmarks(ints, 100, seed=1).count() == a  # reproducible


def test_walk_steps_are_not_linear(spark):
    """On complete graphs of degree 2, 3, 5 and 15 each neighbour is taken about equally often,
    and a walk's choice does not repeat from step to step."""
    from collections import Counter

    from tessera.functions.ordering import hash_mixed

    for degree in (2, 3, 5, 15):
        rows = spark.range(2000).selectExpr("id as walk_id", "explode(sequence(1, 10)) as step").select(
            "walk_id", "step", F.pmod(hash_mixed("walk_id", "step", 0), F.lit(degree)).alias("k")).collect()
        taken = Counter(r.k for r in rows)
        assert all(abs(taken[k] - 20000 / degree) < 6 * (20000 / degree) ** 0.5 for k in range(degree))
        choice = {(r.walk_id, r.step): r.k for r in rows}
        same = sum(choice[w, s] == choice[w, s + 1] for w in range(2000) for s in range(1, 10)) / 18000
        assert abs(same - 1 / degree) < 0.02
