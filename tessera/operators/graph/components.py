"""Connected components: a small subgraph first, then the edges it leaves open.

Vertices are numbered by a hash that is checked to differ for every vertex, so edges become
pairs of longs without a join. Each vertex is linked to two of its neighbours (the smallest and
the largest number); these at most 2 V links are contracted to single vertices round by round.
One pass over all edges then finds those between different labels, one for each pair of labels,
and these are contracted in turn. So all edges are read twice and shuffled once, whatever the
rounds; the rounds (about the logarithm of V) work on links. Every table a round needs is written
to the shared checkpoint folder: the lineage stays one round deep.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def _number(column: Column, salt: int) -> Column:
    return F.xxhash64(column, F.lit(salt))


def _both(a: str, b: str) -> Column:
    """Rows ``(n, nb)`` of a link in both directions."""
    return F.inline(F.array(F.struct(F.col(a).alias("n"), F.col(b).alias("nb")), F.struct(F.col(b).alias("n"), F.col(a).alias("nb"))))


def contracted(links: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``(n, label)`` for the ends of the numbered ``links(s, d)``: equal labels where they connect.

    In a round every vertex takes its smallest neighbour, or itself if that is smaller, and then
    that vertex' choice until nothing changes. A vertex left without followers has a smaller
    neighbour in the next round, so two rounds leave at most half of the vertices.
    """
    steps = []
    for _ in range(max_rounds):
        step = cut_lineage(links.select(_both("s", "d")).groupBy("n").agg(F.least("n", F.min("nb")).alias("p")))
        while True:
            for _ in range(2):
                above = step.select(F.col("n").alias("p"), F.col("p").alias("q"))
                jump = step.join(above, "p").select("n", F.col("q").alias("p"), (F.col("p") != F.col("q")).alias("moved"))
                step = jump.select("n", "p")
            jump = cut_lineage(jump)
            step = jump.select("n", "p")
            if jump.where("moved").isEmpty():
                break
        steps.append(step)
        named = links.join(step.select(F.col("n").alias("s"), F.col("p").alias("a")), "s").join(
            step.select(F.col("n").alias("d"), F.col("p").alias("b")), "d")
        links = cut_lineage(named.where("a <> b").select(F.least("a", "b").alias("s"), F.greatest("a", "b").alias("d")).distinct())
        if links.isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    labels = steps.pop().withColumnRenamed("p", "label")
    for step in reversed(steps):
        labels = step.join(labels.withColumnRenamed("n", "p"), "p", "left").select("n", F.coalesce("label", "p").alias("label"))
    return cut_lineage(labels)


def joined_labels(labels: DataFrame, rest: DataFrame) -> DataFrame:
    """``labels(n, label)`` after links ``rest(s, d)`` between labels; new vertices of ``rest`` are added."""
    more = contracted(rest)
    renamed = labels.join(more.select(F.col("n").alias("label"), F.col("label").alias("new")), "label", "left").select(
        "n", F.coalesce("new", "label").alias("label"))
    return cut_lineage(renamed.unionByName(more.join(labels.select("n"), "n", "left_anti")))


@dataclass
class Spanned:
    """``names`` (id, n); all edges as numbers ``pairs`` (s, d), repeats included; ``links`` (s, d),
    edges of these that connect all that they connect; ``labels`` (n, label) of vertices with edges."""

    names: DataFrame
    pairs: DataFrame
    links: DataFrame
    labels: DataFrame


def spanned(e: DataFrame) -> Spanned:
    """Links and labels of the written edges ``e(src, dst)``, whose ends differ and are not null."""
    for salt in count():
        s, d = (_number(F.col(c), salt) for c in ("src", "dst"))
        ends = F.array(F.struct(F.col("src").alias("id"), d.alias("nb")), F.struct(F.col("dst").alias("id"), s.alias("nb")))
        near = e.select(F.inline(ends)).groupBy("id").agg(F.min("nb").alias("lo"), F.max("nb").alias("hi"))
        near = cut_lineage(near.select("id", _number(F.col("id"), salt).alias("n"), "lo", "hi"))
        if near.groupBy("n").count().where("count > 1").isEmpty():  # no two vertices share a number
            break
    pairs = e.select(s.alias("s"), d.alias("d"))
    two = F.array(F.struct(F.col("n").alias("s"), F.col("lo").alias("d")), F.struct(F.col("n").alias("s"), F.col("hi").alias("d")))
    links = near.select(F.inline(two)).distinct()
    labels = contracted(links)
    half = pairs.join(labels.select(F.col("n").alias("s"), F.col("label").alias("l")), "s").groupBy("l", "d").agg(F.min("s").alias("s"))
    across = half.join(labels.select(F.col("n").alias("d"), F.col("label").alias("k")), "d").where("l <> k")
    rest = cut_lineage(across.groupBy(F.least("l", "k").alias("l"), F.greatest("l", "k").alias("k")).agg(F.min(F.struct("s", "d")).alias("edge")))
    if not rest.isEmpty():
        labels = joined_labels(labels, rest.select(F.col("l").alias("s"), F.col("k").alias("d")))
        links = links.unionByName(rest.select("edge.*"))
    return Spanned(near.select("id", "n"), pairs, links, labels)


def plain_edges(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """``(src, dst)`` of one type, without loops and nulls."""
    ids = edges.select("src").union(edges.select("dst"))
    kind = (ids if vertices is None else ids.union(vertices.select("id"))).schema["src"].dataType
    return edges.where(F.col("src") != F.col("dst")).select(F.col("src").cast(kind), F.col("dst").cast(kind))


def connected_components(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """``(id, component)`` where component = smallest vertex id of the component.

    ``edges`` may be directed; connectivity is taken as undirected. Isolated
    vertices in ``vertices(id)`` form their own components.
    """
    found = spanned(cut_lineage(plain_edges(edges, vertices)))
    ids = found.names.join(found.labels, "n").select("id", "label")
    least = ids.groupBy("label").agg(F.min("id").alias("component"))
    labels = ids.join(least, "label").select("id", "component")
    if vertices is not None:
        alone = vertices.select("id").distinct().join(labels.select("id"), "id", "left_anti")
        labels = labels.unionByName(alone.select("id", F.col("id").alias("component")))
    return cut_lineage(labels)


def component_sizes(labels: DataFrame) -> DataFrame:
    return labels.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
