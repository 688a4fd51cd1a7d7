"""Queries of the small helpers: column handling, null checks, formatting, single vectors,
single edges and the map form of distances."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.vectors import nan_to_zero
from tessera.operators import clean, stats
from tessera.operators import vectors as V
from tessera.operators.graph import core, paths
from tessera.plans.graphs import SAMPLED_LM_SQL, SIMPLE_U_SQL, bfs_oracle
from tessera.plans.registry import register
from tessera.plans.vectors import word_vectors
from tessera.sources import tables


@register("selected_columns", "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def selected_columns(spark, sf_dir):
    """A column that is dropped, one that is absent, and the rest picked by name."""
    c = tables.table(spark, sf_dir, "customer")
    left = clean.drop_if_present(clean.drop_if_present(c, "c_acctbal"), "no_such_column")
    return clean.select_columns(left, clean.columns(left))


@register("stripped_column_names", "SELECT s_suppkey AS suppkey, s_name AS suppliername FROM supplier")
def stripped_column_names(spark, sf_dir):
    """Column names without any white space."""
    s = tables.table(spark, sf_dir, "supplier")
    return clean.strip_column_names(s.select(F.col("s_suppkey").alias(" suppkey "), F.col("s_name").alias("supplier name\t")))


@register(
    "null_checks",
    """
    WITH q AS (SELECT l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
    SELECT COUNT(*) > COUNT(quality) AS before, FALSE AS after, CAST(SUM(COALESCE(quality, -1)) AS BIGINT) AS total FROM q
    """,
)
def null_checks(spark, sf_dir):
    """Whether any document lacks a quality label, before and after such gaps are filled with -1."""
    d = tables.table(spark, sf_dir, "documents").select("doc_id")
    q = d.join(tables.table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    filled = clean.fill_null(q, ["quality"], -1)
    return filled.agg(F.sum("quality").alias("total")).select(
        clean.has_nulls(q, "quality").scalar().alias("before"), clean.has_nulls(filled, "quality").scalar().alias("after"), "total"
    )


@register(
    "duplicate_lines",
    """
    SELECT COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_partkey, l_suppkey, l_quantity FROM lineitem) q) AS duplicates,
           COUNT(*) AS rows FROM lineitem
    """,
)
def duplicate_lines(spark, sf_dir):
    """Rows that repeat an earlier one, over part, supplier and quantity of the line items."""
    li = tables.table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity")
    return li.agg(F.count(F.lit(1)).alias("rows")).select(stats.duplicate_row_count(li).alias("duplicates"), "rows")


@register(
    "nan_vectors",
    "SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CASE WHEN x < 0 THEN 0.0 ELSE round(x, 6) END) AS vector FROM embeddings",
)
def nan_vectors(spark, sf_dir):
    """Vectors whose undefined components (square roots of negative numbers) become zero."""
    v = word_vectors(spark, sf_dir)
    rooted = F.transform("vector", lambda x: F.pow(F.sqrt(x), 2))
    return v.select(F.col("key").alias("vec_id"), F.transform(nan_to_zero(rooted), lambda x: F.round(x, 6)).alias("vector"))


@register(
    "formatted_rows",
    "SELECT p_partkey, printf('%d: %s [%s] size %d', p_partkey, p_name, p_brand, p_size) AS line FROM part",
)
def formatted_rows(spark, sf_dir):
    """Report lines by a format string."""
    p = tables.table(spark, sf_dir, "part")
    return p.select("p_partkey", F.format_string("%d: %s [%s] size %d", "p_partkey", "p_name", "p_brand", "p_size").alias("line"))


@register(
    "vector_similarity",
    """
    SELECT ROUND(list_dot_product(x, y) / sqrt(list_dot_product(x, x) * list_dot_product(y, y)), 6) AS similarity
    FROM (SELECT (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings ORDER BY vec_id LIMIT 1) AS x,
                 (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings ORDER BY vec_id DESC LIMIT 1) AS y) v
    """,
)
def vector_similarity(spark, sf_dir):
    """Cosine of the vectors of the smallest and the largest key."""
    v = word_vectors(spark, sf_dir)
    low, high = v.agg(F.min("key"), F.max("key")).first()
    return V.similarity(v, low, high).select(F.round("similarity", 6).alias("similarity"))


@register(
    "vector_lookup",
    """
    SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: round(x, 6)) AS vector FROM embeddings
    WHERE vec_id IN (SELECT doc_id FROM labels)
    """,
)
def vector_lookup(spark, sf_dir):
    """Vectors of requested keys, here the labelled ids; unknown keys give no row."""
    keys = tables.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("key"))
    found = V.lookup(word_vectors(spark, sf_dir), keys)
    return found.select(F.col("key").alias("vec_id"), F.transform("vector", lambda x: F.round(x, 6)).alias("vector"))


HUB_SQL = "SELECT arg_min(l_suppkey, (-n, l_suppkey)) FROM (SELECT l_suppkey, COUNT(*) AS n FROM lineitem GROUP BY l_suppkey) q"


def _supply(spark, sf_dir):
    """Edges ``p:<part> - s:<supplier>`` of the line items and the name of the busiest supplier."""
    li = tables.table(spark, sf_dir, "lineitem")
    hub = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n")).agg(F.min_by("l_suppkey", F.struct(-F.col("n"), F.col("l_suppkey")))).first()[0]
    name = lambda kind, col: F.concat(F.lit(kind), F.col(col).cast("string"))
    return li.select(name("p:", "l_partkey").alias("src"), name("s:", "l_suppkey").alias("dst")).distinct(), f"s:{hub}"


@register(
    "vertex_removed",
    f"SELECT DISTINCT 'p:' || l_partkey AS src, 's:' || l_suppkey AS dst FROM lineitem WHERE l_suppkey <> ({HUB_SQL})",
)
def vertex_removed(spark, sf_dir):
    """The supply graph without its busiest supplier."""
    edges, hub = _supply(spark, sf_dir)
    return core.remove_vertex(edges, hub)


@register(
    "edge_lookup",
    f"""
    SELECT COALESCE(BOOL_OR(l_suppkey = ({HUB_SQL})), FALSE) AS has_edge FROM lineitem
    WHERE l_partkey = (SELECT MIN(l_partkey) FROM lineitem)
    """,
)
def edge_lookup(spark, sf_dir):
    """Whether the busiest supplier delivers the part of the smallest key, asked from either end."""
    edges, hub = _supply(spark, sf_dir)
    part = tables.table(spark, sf_dir, "lineitem").agg(F.min("l_partkey")).first()[0]
    return core.has_edge(edges, hub, f"p:{part}")


@register(
    "closeness_maps",
    f"""
    WITH d AS ({bfs_oracle(SIMPLE_U_SQL, SAMPLED_LM_SQL)}), t AS (SELECT id, SUM(dist) AS total FROM d GROUP BY id)
    SELECT id, ROUND(CASE WHEN total > 0 THEN 1.0 / total END, 8) AS closeness FROM t
    """,
)
def closeness_maps(spark, sf_dir):
    """Closeness from each vertex's map of landmark distances."""
    e = tables.user_edges(spark, sf_dir)
    marks = paths.sample_landmarks(core.vertices_from_edges(core.simple(e)), 60, seed=1)
    maps = paths.distance_maps(paths.landmark_distances(e, marks))
    return paths.closeness_from_maps(maps).select("id", F.round("closeness", 8).alias("closeness"))
