"""Articulation points (cut vertices) with the Tarjan–Vishkin construction on DataFrames.

Instead of one connectivity job per removed vertex, the whole graph is solved in O(depth) rounds
of joins, and all but four shuffles of edges work on at most 2 V of them:

1. links that connect what the edges connect (``components.spanned``); a BFS of these gives an
   order in which every vertex but a root has an earlier neighbour; vertices are renumbered by it;
2. search tree: parent(v) = the smallest of all neighbours. No other edge joins a vertex with one
   of its descendants (scanned in this order, a vertex takes all neighbours not yet taken);
3. so two edges outside the tree that meet in v both close a cycle over v – parent(v): all edges
   of a component of graph minus tree lie in one block. Each such component is replaced by links
   of its vertices with the deepest of them, c. None of them lies below c, so all cycles so closed
   share c – parent(c) and cover the tree paths of the component's edges: the blocks of the tree's
   edges stay the same;
4. on tree and links: bottom-up subtree sizes nd(v), top-down preorder numbers pre(v)
   (pre(child) = pre(parent) + 1 + Σ nd of earlier siblings);
5. bottom-up low/high(v) = min/max pre over the subtree and its non-tree neighbours;
6. auxiliary graph on tree edges (named by their child vertex):
   - non-tree edge u–w with u, w unrelated (pre(u) + nd(u) <= pre(w)) links u and w;
   - tree edge v→w with v not a root links v and w when
     low(w) < pre(v) or high(w) >= pre(v) + nd(v);
7. components of the auxiliary graph are the biconnected components; a vertex is
   a cut vertex when its incident tree edges (to its parent, to its children)
   fall in two or more of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.ordering import prefix_sum_within, with_global_position
from tessera.operators.graph.components import Spanned, connected_components, contracted, joined_labels, plain_edges, spanned
from tessera.operators.graph.core import simple
from tessera.session import cut_lineage


def bfs_forest(e: DataFrame, roots: DataFrame) -> DataFrame:
    """``(id, level, parent)`` of a BFS forest grown from ``roots(id)`` over simple edges ``e``."""
    frontier = cut_lineage(roots.select("id", F.lit(0).alias("level"), F.lit(None).cast(e.schema["src"].dataType).alias("parent")))
    layers = [frontier]
    level = 0
    while True:
        level += 1
        # the graph is undirected: neighbours of one level lie on it or on the levels beside it
        seen = reduce(DataFrame.unionByName, layers[-2:]).select("id")
        nxt = (
            frontier.select(F.col("id").alias("src"))
            .join(e, "src")
            .select(F.col("dst").alias("id"), F.col("src").alias("parent"))
            .join(seen, "id", "left_anti")
            .groupBy("id")
            .agg(F.min("parent").alias("parent"))
            .select("id", F.lit(level).alias("level"), "parent")
        )
        frontier = cut_lineage(nxt)
        if frontier.isEmpty():
            break
        layers.append(frontier)
    return cut_lineage(reduce(lambda a, b: a.unionByName(b), layers))


CUT_EVERY = 1  # levels between lineage cuts in the level-by-level passes


def _bottom_up(rows: DataFrame, max_level: int, combine) -> DataFrame:
    """Fold child values into parents level by level, deepest first.

    ``rows(id, parent, level, val...)`` holds each vertex's own value; ``combine(own_df, child_agg_df)``
    returns the vertex's final value given the aggregated values of its children.
    """
    done = []
    below = None
    for level in range(max_level, -1, -1):
        own = combine(rows.where(F.col("level") == level).drop("level"), below)
        cur = cut_lineage(own) if level % CUT_EVERY == 0 else own
        done.append(cur)
        below = cur
    merged = reduce(lambda a, b: a.unionByName(b), done)
    # every level is already a written table when CUT_EVERY is 1: the union is cheap to re-read
    return merged if CUT_EVERY == 1 else cut_lineage(merged)


def search_order(found: Spanned) -> tuple[DataFrame, DataFrame]:
    """``(n, o)``: positions by which every vertex but a root has an earlier neighbour, and the roots ``(id)`` by position."""
    roots = found.labels.groupBy("label").agg(F.min("n").alias("id"))
    layers = bfs_forest(cut_lineage(simple(found.links.select(F.col("s").alias("src"), F.col("d").alias("dst")))), roots)
    order = cut_lineage(with_global_position(layers.select(F.col("id").alias("n"), "level"), ["level", "n"], "o"))
    return order.select("n", "o"), order.where("level = 0").select(F.col("o").alias("id"))


def tree_and_rest(pairs: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The search tree ``(id, level, parent)`` of the edges ``pairs(lo, hi)``, numbered by a search order,
    and links ``(src, dst)``, one way, that close the same cycles as all edges outside the tree."""
    down, up = (F.struct(v.alias("id"), lo.alias("lo"), hi.alias("hi")) for v, lo, hi in (
        (F.col("hi"), F.col("lo"), F.lit(None).cast("long")), (F.col("lo"), F.lit(None).cast("long"), F.col("hi"))))
    near = cut_lineage(pairs.select(F.inline(F.array(down, up))).groupBy("id").agg(
        F.min("lo").alias("parent"), F.max("lo").alias("far"), F.max("hi").alias("up")))
    tree = bfs_forest(near.where("parent is not null").select(F.col("parent").alias("src"), F.col("id").alias("dst")), roots)
    # components of graph minus tree: first by at most two of its edges a vertex, then by all that these leave open
    above = near.select(F.col("id").alias("up"), F.col("parent").alias("over"))
    early = near.where("far <> parent").select(F.col("far").alias("s"), F.col("id").alias("d"))
    late = near.join(above, "up").where("over <> id").select(F.col("id").alias("s"), F.col("up").alias("d"))
    labels = contracted(early.unionByName(late))
    ends = labels.withColumnRenamed("n", "hi").join(near.select(F.col("id").alias("hi"), "parent"), "hi")
    open_ = pairs.join(ends, "hi").where("lo <> parent").select("label", "lo").distinct()
    open_ = open_.join(labels.select(F.col("n").alias("lo"), F.col("label").alias("k")), "lo", "left").select(
        F.col("label").alias("s"), F.coalesce("k", "lo").alias("d")).where("s <> d").distinct()
    open_ = cut_lineage(open_)
    if not open_.isEmpty():
        labels = joined_labels(labels, open_)
    placed = labels.join(tree.select(F.col("id").alias("n"), "level"), "n")
    deepest = placed.groupBy("label").agg(F.max_by("n", F.struct("level", "n")).alias("dst"))
    links = labels.join(deepest, "label").where("n <> dst").select(F.col("n").alias("src"), "dst")
    # a link may lie on a tree edge: it closes no cycle
    return tree, links.join(tree.select(F.col("id").alias("dst"), F.col("parent").alias("src")), ["src", "dst"], "left_anti")


def articulation_points(edges: DataFrame) -> DataFrame:
    """``(id, articulation)`` for every cut vertex (articulation = 1); undirected view of ``edges``."""
    found = spanned(cut_lineage(plain_edges(edges)))
    order, roots = search_order(found)
    numbered = found.pairs.join(order.select(F.col("n").alias("s"), F.col("o").alias("a")), "s").join(
        order.select(F.col("n").alias("d"), F.col("o").alias("b")), "d")
    pairs = cut_lineage(numbered.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")))
    tree, links = tree_and_rest(pairs, roots)
    cut = cut_positions(tree, cut_lineage(links))
    return cut.join(order.select(F.col("o").alias("id"), "n"), "id").drop("id").join(found.names, "n").select("id", "articulation")


def cut_positions(tree: DataFrame, links: DataFrame) -> DataFrame:
    """``(id, articulation)`` for every cut vertex of the forest ``tree(id, level, parent)`` with the
    edges ``links(src, dst)`` outside it, one way."""
    max_level = tree.agg(F.max("level")).first()[0] or 0

    # subtree sizes, bottom-up
    def nd_combine(own, below):
        if below is None:
            return own.select("id", "parent", F.lit(1).cast("bigint").alias("nd"))
        kids = below.groupBy(F.col("parent").alias("id")).agg(F.sum("nd").alias("knd"))
        return own.join(kids, "id", "left").select("id", "parent", (1 + F.coalesce("knd", F.lit(0))).cast("bigint").alias("nd"))

    nd = _bottom_up(tree, max_level, nd_combine).select("id", "nd")

    # preorder numbers, top-down; siblings ordered by id. The sibling offsets are a running
    # sum per parent, computed block-wise so a parent with a huge fan-out spans many tasks.
    sized = tree.join(nd, "id").select("id", "parent", "level", "nd")
    step = cut_lineage(
        prefix_sum_within(sized, "parent", ["id"], "nd", "before").select(
            "id", "parent", "level", (F.col("before") + 1).alias("step")
        )
    )
    pre_layers = [cut_lineage(step.where(F.col("level") == 0).select("id", F.lit(0).cast("bigint").alias("pre")))]
    for level in range(1, max_level + 1):
        up = pre_layers[-1].select(F.col("id").alias("parent"), F.col("pre").alias("ppre"))
        cur = step.where(F.col("level") == level).join(up, "parent").select(
            "id", (F.col("ppre") + F.col("step")).cast("bigint").alias("pre")
        )
        pre_layers.append(cut_lineage(cur) if level % CUT_EVERY == 0 else cur)
    pre = reduce(lambda a, b: a.unionByName(b), pre_layers)
    pre = pre if CUT_EVERY == 1 else cut_lineage(pre)
    info = cut_lineage(tree.join(pre, "id").join(nd, "id"))  # id, level, parent, pre, nd

    nontree = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    pre_of = info.select(F.col("id").alias("dst"), F.col("pre").alias("dpre"))
    local = nontree.join(pre_of, "dst").groupBy(F.col("src").alias("id")).agg(
        F.min("dpre").alias("nlo"), F.max("dpre").alias("nhi")
    )
    local_info = info.join(local, "id", "left").select(
        "id", "parent", "level",
        F.least("pre", F.coalesce("nlo", "pre")).alias("lo0"),
        F.greatest("pre", F.coalesce("nhi", "pre")).alias("hi0"),
    )

    def lh_combine(own, below):
        if below is None:
            return own.select("id", "parent", F.col("lo0").alias("low"), F.col("hi0").alias("high"))
        kids = below.groupBy(F.col("parent").alias("id")).agg(F.min("low").alias("klo"), F.max("high").alias("khi"))
        return own.join(kids, "id", "left").select(
            "id", "parent",
            F.least("lo0", F.coalesce("klo", "lo0")).alias("low"),
            F.greatest("hi0", F.coalesce("khi", "hi0")).alias("high"),
        )

    lowhigh = _bottom_up(cut_lineage(local_info), max_level, lh_combine).select("id", "low", "high")
    full = cut_lineage(info.join(lowhigh, "id"))

    # auxiliary graph on non-root vertices (each stands for the tree edge to its parent)
    u = full.select(F.col("id").alias("src"), F.col("pre").alias("upre"), F.col("nd").alias("und"))
    w = full.select(F.col("id").alias("dst"), F.col("pre").alias("wpre"))
    rule1 = nontree.join(u, "src").join(w, "dst").where(F.col("upre") + F.col("und") <= F.col("wpre")).select("src", "dst")
    parent_side = full.where(F.col("parent").isNotNull()).select(
        F.col("id").alias("v"), F.col("pre").alias("vpre"), F.col("nd").alias("vnd")
    )
    rule2 = (
        full.select(F.col("id").alias("dst"), F.col("parent").alias("v"), "low", "high")
        .join(parent_side, "v")
        .where((F.col("low") < F.col("vpre")) | (F.col("high") >= F.col("vpre") + F.col("vnd")))
        .select(F.col("v").alias("src"), "dst")
    )
    aux_vertices = full.where(F.col("parent").isNotNull()).select("id")
    aux = connected_components(rule1.unionByName(rule2), aux_vertices)

    # a vertex's incident tree edges: its own (if not a root) and its children's
    own = aux.select("id", F.col("component").alias("bc"))
    kids = full.where(F.col("parent").isNotNull()).select(F.col("parent").alias("id"), F.col("id").alias("child")).join(
        aux.select(F.col("id").alias("child"), F.col("component").alias("bc")), "child"
    ).select("id", "bc")
    blocks = own.unionByName(kids).groupBy("id").agg(F.count_distinct("bc").alias("blocks"))
    return blocks.where(F.col("blocks") >= 2).select("id", F.lit(1).alias("articulation"))
