"""Graph basics over edge tables ``(src, dst[, weight])``.

A graph is just two DataFrames; vertices default to the edge endpoints.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vertices_from_edges(edges: DataFrame) -> DataFrame:
    """Distinct endpoints as ``(id)``."""
    return edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id"))).distinct()


def simple(edges: DataFrame) -> DataFrame:
    """Undirected closure without multi-edges or loops: both directions, distinct, src != dst.

    Both directions come from one pass over the input (explode of the pair and its
    flip), so an edge table defined by a join is computed once, not once per direction.
    """
    both = F.explode(F.array(F.struct(F.col("src"), F.col("dst")), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))))
    e = edges.where(F.col("src") != F.col("dst")).select(both.alias("e"))
    return e.select("e.src", "e.dst").distinct()


def degrees(edges: DataFrame, direction: str = "in") -> DataFrame:
    """Per-vertex degree ``(id, degree)`` counted on ``dst`` (in) or ``src`` (out)."""
    key = "dst" if direction == "in" else "src"
    return edges.groupBy(F.col(key).alias("id")).agg(F.count(F.lit(1)).alias("degree"))


def degree_distribution(simple_edges: DataFrame) -> DataFrame:
    """``(degree, count)`` histogram. Both aggregations combine map-side, so a
    hot vertex costs one partial row per task, not a skewed shuffle."""
    return (
        degrees(simple_edges)
        .groupBy("degree")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def graph_size(edges: DataFrame) -> DataFrame:
    """One row: directed edges, vertices, undirected edges (= directed / 2 on a simple graph).

    A single aggregate over the endpoints tagged with whether the row is an edge.
    """
    tagged = edges.select(F.col("src").alias("id"), F.lit(1).alias("is_edge")).unionByName(
        edges.select(F.col("dst").alias("id"), F.lit(0).alias("is_edge"))
    )
    return tagged.agg(
        F.sum("is_edge").cast("bigint").alias("directed_edges"),
        F.count_distinct("id").alias("vertices"),
    ).withColumn("undirected_edges", F.floor(F.col("directed_edges") / 2).cast("bigint"))


def remove_vertex(edges: DataFrame, vertex) -> DataFrame:
    """Edges not touching ``vertex``."""
    return edges.where((F.col("src") != F.lit(vertex)) & (F.col("dst") != F.lit(vertex)))


def induced_subgraph(edges: DataFrame, vertex_set: DataFrame) -> DataFrame:
    """Edges with both ends in ``vertex_set(id)`` — two semi-joins."""
    ids = vertex_set.select("id").distinct()
    return edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(
        ids.withColumnRenamed("id", "dst"), "dst", "left_semi"
    )


def adjacency(simple_edges: DataFrame) -> DataFrame:
    """``(id, neighbors sorted array, n)`` — the adjacency-list form written by sinks.

    The list of a vertex is materialised in one row by definition of the
    format; operators that walk the graph use the edge table instead.
    """
    return simple_edges.groupBy(F.col("src").alias("id")).agg(
        F.sort_array(F.collect_set("dst")).alias("neighbors")
    ).withColumn("n", F.size("neighbors").cast("bigint"))


def has_self_loops(edges: DataFrame) -> DataFrame:
    """One row ``(has_loops boolean)``."""
    return edges.agg(F.coalesce(F.max((F.col("src") == F.col("dst")).cast("int")), F.lit(0)).cast("boolean").alias("has_loops"))


def has_edge(edges: DataFrame, a, b) -> DataFrame:
    """One row ``(has_edge boolean)``: is there an edge a-b in either direction."""
    hit = ((F.col("src") == F.lit(a)) & (F.col("dst") == F.lit(b))) | (
        (F.col("src") == F.lit(b)) & (F.col("dst") == F.lit(a))
    )
    return edges.agg(F.coalesce(F.max(hit.cast("int")), F.lit(0)).cast("boolean").alias("has_edge"))
