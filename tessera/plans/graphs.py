"""Graph queries over graphs derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators.graph import core
from tessera.plans.registry import register
from tessera.sources import tables

# SQL for the customer–part purchase graph, shared by the oracles below.
B_SQL = """
    SELECT 'c:' || CAST(o.o_custkey AS VARCHAR) AS src, 'p:' || CAST(l.l_partkey AS VARCHAR) AS dst
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""
SIMPLE_B_SQL = f"""
    SELECT DISTINCT src, dst FROM (
        SELECT src, dst FROM ({B_SQL}) b UNION ALL SELECT dst AS src, src AS dst FROM ({B_SQL}) b2
    ) u WHERE src <> dst
"""


def purchase_graph(spark, sf_dir):
    return core.simple(tables.bipartite_edges(spark, sf_dir))


@register(
    "degree_distribution",
    f"""
    SELECT CAST(degree AS BIGINT) AS degree, CAST(COUNT(*) AS BIGINT) AS count
    FROM (SELECT dst AS id, COUNT(*) AS degree FROM ({SIMPLE_B_SQL}) s GROUP BY dst) d
    GROUP BY degree
    """,
)
def degree_distribution(spark, sf_dir):
    return core.degree_distribution(purchase_graph(spark, sf_dir))


@register(
    "graph_size",
    f"""
    SELECT CAST(COUNT(*) AS BIGINT) AS directed_edges,
           CAST((SELECT COUNT(*) FROM (SELECT src AS id FROM ({SIMPLE_B_SQL}) a UNION SELECT dst FROM ({SIMPLE_B_SQL}) b) v) AS BIGINT) AS vertices,
           CAST(FLOOR(COUNT(*) / 2) AS BIGINT) AS undirected_edges
    FROM ({SIMPLE_B_SQL}) s
    """,
)
def graph_size(spark, sf_dir):
    return core.graph_size(purchase_graph(spark, sf_dir))


USER_E_SQL = """
    SELECT a.user_id AS src, b.user_id AS dst FROM
      (SELECT user_id, ROW_NUMBER() OVER (ORDER BY ts, event_id) AS pos FROM events) a
    JOIN (SELECT user_id, ROW_NUMBER() OVER (ORDER BY ts, event_id) AS pos FROM events) b
      ON b.pos = a.pos + 1
    WHERE a.user_id <> b.user_id
"""
SIMPLE_U_SQL = f"""
    SELECT DISTINCT src, dst FROM (
        SELECT src, dst FROM ({USER_E_SQL}) u UNION ALL SELECT dst, src FROM ({USER_E_SQL}) u2) s
"""


def cc_oracle(simple_sql: str) -> str:
    return f"""
    WITH RECURSIVE e AS ({simple_sql}),
    v AS (SELECT DISTINCT src AS id FROM e),
    cc(id, component) USING KEY (id) AS (
        SELECT id, id FROM v
        UNION
        SELECT e.dst AS id, MIN(c.component) AS component
        FROM cc c JOIN e ON e.src = c.id JOIN recurring.cc r ON r.id = e.dst
        GROUP BY e.dst HAVING MIN(c.component) < MIN(r.component)
    )
    SELECT id, component FROM cc
    """


def bfs_oracle(simple_sql: str, landmark_sql: str) -> str:
    return f"""
    WITH RECURSIVE e AS ({simple_sql}),
    d(landmark, id, dist) USING KEY (landmark, id) AS (
        SELECT id, id, 0 FROM ({landmark_sql}) l
        UNION
        SELECT c.landmark, e.dst, MIN(c.dist) + 1
        FROM d c JOIN e ON e.src = c.id
        LEFT JOIN recurring.d r ON r.landmark = c.landmark AND r.id = e.dst
        WHERE r.id IS NULL
        GROUP BY c.landmark, e.dst
    )
    SELECT landmark, id, dist FROM d
    """


SAMPLED_LM_SQL = f"SELECT DISTINCT src AS id FROM ({SIMPLE_U_SQL}) s WHERE ((src % 2147483647) * 1103515245 + 1 * 12345) % 2147483647 % 1000 < 60"


@register("connected_components", cc_oracle(SIMPLE_B_SQL))
def connected_components(spark, sf_dir):
    from tessera.operators.graph.components import connected_components as cc

    return cc(tables.bipartite_edges(spark, sf_dir))


@register("user_graph_components", cc_oracle(SIMPLE_U_SQL))
def user_graph_components(spark, sf_dir):
    from tessera.operators.graph.components import connected_components as cc

    return cc(tables.user_edges(spark, sf_dir))


@register("landmark_paths", bfs_oracle(SIMPLE_U_SQL, SAMPLED_LM_SQL))
def landmark_paths(spark, sf_dir):
    from tessera.operators.graph import paths

    e = tables.user_edges(spark, sf_dir)
    lm = paths.sample_landmarks(core.vertices_from_edges(core.simple(e)), 60, seed=1)
    return paths.landmark_distances(e, lm)


@register(
    "closeness_users",
    f"""
    WITH d AS ({bfs_oracle(SIMPLE_U_SQL, f"SELECT DISTINCT src AS id FROM ({SIMPLE_U_SQL}) s")}),
    t AS (SELECT id, SUM(dist) AS total FROM d GROUP BY id)
    SELECT id, ROUND(CASE WHEN total > 0 THEN 1.0 / total END, 8) AS closeness FROM t
    """,
)
def closeness_users(spark, sf_dir):
    from tessera.operators.graph import paths

    c = paths.closeness(tables.user_edges(spark, sf_dir))
    return c.select("id", F.round("closeness", 8).alias("closeness"))


@register(
    "closeness_sampled",
    f"""
    WITH d AS ({bfs_oracle(SIMPLE_U_SQL, SAMPLED_LM_SQL)}),
    v AS (SELECT DISTINCT src AS id FROM ({SIMPLE_U_SQL}) s),
    t AS (SELECT id, SUM(dist) AS total FROM d GROUP BY id)
    SELECT v.id, ROUND(CASE WHEN total > 0 THEN 1.0 / total END, 8) AS closeness FROM v LEFT JOIN t ON t.id = v.id
    """,
)
def closeness_sampled(spark, sf_dir):
    from tessera.operators.graph import paths

    e = tables.user_edges(spark, sf_dir)
    lm = paths.sample_landmarks(core.vertices_from_edges(core.simple(e)), 60, seed=1)
    c = paths.closeness(e, lm)
    return c.select("id", F.round("closeness", 8).alias("closeness"))


DEG_HIST_SQL = f"SELECT degree, COUNT(*) AS cnt FROM (SELECT dst, COUNT(*) AS degree FROM ({SIMPLE_B_SQL}) s GROUP BY dst) d GROUP BY degree"


@register(
    "power_law_fit",
    f"""
    WITH h AS (SELECT CAST(degree AS DOUBLE) AS x, CAST(cnt AS DOUBLE) AS w FROM ({DEG_HIST_SQL}) q),
    s AS (SELECT x, w,
                 SUM(w) OVER (ORDER BY x DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n,
                 SUM(w * LN(x)) OVER (ORDER BY x DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sl,
                 SUM(w) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
          FROM h),
    c AS (SELECT x AS xmin, n AS n_tail, cum - w AS below, 1 + n / (sl - n * LN(x)) AS alpha
          FROM s WHERE x < (SELECT MAX(x) FROM h)),
    k AS (SELECT xmin, alpha, n_tail,
                 MAX(ABS((s.cum - below) / n_tail - (1 - POW(s.x / xmin, 1 - alpha)))) AS ks
          FROM c JOIN s ON s.x >= c.xmin GROUP BY xmin, alpha, n_tail)
    SELECT ROUND(xmin, 6) AS xmin, ROUND(alpha, 6) AS alpha, ROUND(ks, 6) AS ks, CAST(n_tail AS BIGINT) AS n_tail
    FROM k ORDER BY ks, xmin LIMIT 1
    """,
)
def power_law_fit(spark, sf_dir):
    from tessera.operators.graph.powerlaw import fit_power_law

    hist = core.degree_distribution(purchase_graph(spark, sf_dir))
    f = fit_power_law(hist, "degree", "count")
    return f.select(*[F.round(c, 6).alias(c) for c in ("xmin", "alpha", "ks")], "n_tail")


@register(
    "random_walks",
    f"""
    WITH RECURSIVE e AS ({SIMPLE_U_SQL}),
    adj AS (SELECT src, dst, ROW_NUMBER() OVER (PARTITION BY src ORDER BY dst) - 1 AS rk,
                   COUNT(*) OVER (PARTITION BY src) AS deg FROM e),
    v AS (SELECT DISTINCT src AS id FROM e),
    w(walk_id, step, cur) AS (
        SELECT id * 2 + r.range, 0, id FROM v, range(2) r
        UNION ALL
        SELECT w.walk_id, w.step + 1, a.dst FROM w JOIN adj a ON a.src = w.cur
          AND a.rk = CAST('0x' || substr(md5(concat_ws('|', w.walk_id, w.step + 1, 0)), 1, 8) AS BIGINT) % a.deg
        WHERE w.step + 1 < 10
    )
    SELECT walk_id, step, cur AS node FROM w
    """,
)
def random_walks(spark, sf_dir):
    from tessera.operators.graph.walks import random_walks as rw

    return rw(tables.user_edges(spark, sf_dir), walks_per_node=2, length=10, seed=0)


@register(
    "undirected_adjacency",
    f"SELECT src AS id, list_sort(list(dst)) AS neighbors, CAST(COUNT(*) AS BIGINT) AS n FROM ({SIMPLE_U_SQL}) s GROUP BY src",
)
def undirected_adjacency(spark, sf_dir):
    return core.adjacency(core.simple(tables.user_edges(spark, sf_dir)))


@register(
    "induced_subgraph",
    f"""
    SELECT s.src, s.dst FROM ({SIMPLE_B_SQL}) s
    WHERE s.src IN (SELECT 'c:' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')
       OR s.dst IN (SELECT 'c:' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')
    """,
)
def induced_subgraph(spark, sf_dir):
    """Edges of the purchase graph induced by BUILDING customers and every part."""
    g = purchase_graph(spark, sf_dir)
    cust = tables.table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == "BUILDING").select(
        F.concat(F.lit("c:"), F.col("c_custkey").cast("string")).alias("id")
    )
    parts = core.vertices_from_edges(g).where(F.col("id").startswith("p:"))
    return core.induced_subgraph(g, cust.unionByName(parts))


@register(
    "degree_sample_checks",
    f"""
    SELECT CAST(MAX(CASE WHEN src = dst THEN 1 ELSE 0 END) AS BOOLEAN) AS has_loops,
           CAST(COUNT(*) AS BIGINT) AS directed_edges
    FROM ({B_SQL}) b
    """,
)
def degree_sample_checks(spark, sf_dir):
    e = tables.bipartite_edges(spark, sf_dir)
    return core.has_self_loops(e).select("has_loops", e.agg(F.count(F.lit(1))).scalar().alias("directed_edges"))


URGENT_B_SQL = """
    SELECT DISTINCT 'c:' || CAST(o.o_custkey AS VARCHAR) AS src, 'p:' || CAST(l.l_partkey AS VARCHAR) AS dst
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    WHERE l.l_quantity = 50 AND o.o_orderpriority = '1-URGENT'
"""
SIMPLE_URGENT_SQL = f"""
    SELECT DISTINCT src, dst FROM (
        SELECT src, dst FROM ({URGENT_B_SQL}) u UNION ALL SELECT dst, src FROM ({URGENT_B_SQL}) u2) s
"""


def urgent_bulk_edges(spark, sf_dir):
    """Purchase graph of urgent orders for the full quantity of 50 (sparse: many components)."""
    pl = tables.purchase_lines(spark, sf_dir).where((F.col("qty") == 50) & (F.col("o_orderpriority") == "1-URGENT"))
    return pl.select(
        F.concat(F.lit("c:"), F.col("user").cast("string")).alias("src"),
        F.concat(F.lit("p:"), F.col("item").cast("string")).alias("dst"),
    ).distinct()


@register("urgent_bulk_components", cc_oracle(SIMPLE_URGENT_SQL))
def urgent_bulk_components(spark, sf_dir):
    from tessera.operators.graph.components import connected_components as cc

    return cc(urgent_bulk_edges(spark, sf_dir))


def cut_vertex_oracle(simple_sql: str) -> str:
    """Brute force: components of G - v for every v (keyed recursive CTE over (removed, vertex))."""
    return f"""
    WITH RECURSIVE e AS ({simple_sql}),
    v AS (SELECT DISTINCT src AS id FROM e),
    cc(rm, id, comp) USING KEY (rm, id) AS (
        SELECT r.id, v.id, v.id FROM v r JOIN v ON v.id <> r.id
        UNION
        SELECT c.rm, e.dst, MIN(c.comp) FROM cc c JOIN e ON e.src = c.id AND e.dst <> c.rm
        JOIN recurring.cc x ON x.rm = c.rm AND x.id = e.dst
        GROUP BY c.rm, e.dst HAVING MIN(c.comp) < MIN(x.comp)
    ),
    base AS (SELECT COUNT(DISTINCT comp) AS n FROM ({cc_oracle(simple_sql)}) b(id, comp)),
    per AS (SELECT rm, COUNT(DISTINCT comp) AS n FROM cc GROUP BY rm)
    SELECT rm AS id, 1 AS articulation FROM per WHERE n > (SELECT n FROM base)
    """


@register("urgent_bulk_cut_vertices", cut_vertex_oracle(SIMPLE_URGENT_SQL))
def urgent_bulk_cut_vertices(spark, sf_dir):
    from tessera.operators.graph.biconn import articulation_points

    return articulation_points(urgent_bulk_edges(spark, sf_dir))


@register("articulation_points")
def articulation_points(spark, sf_dir):
    """Cut vertices of the whole purchase graph (no SQL oracle: brute force is |V| connectivity
    problems; checked against a brute-force twin in tests)."""
    from tessera.operators.graph.biconn import articulation_points as ap

    return ap(tables.bipartite_edges(spark, sf_dir))


@register(
    "power_law_fit_counts",
    f"""
    WITH h AS (SELECT CAST(cnt AS DOUBLE) AS x, CAST(COUNT(*) AS DOUBLE) AS w FROM ({DEG_HIST_SQL}) q GROUP BY cnt),
    s AS (SELECT x, w,
                 SUM(w) OVER (ORDER BY x DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS n,
                 SUM(w * LN(x)) OVER (ORDER BY x DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sl,
                 SUM(w) OVER (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum
          FROM h),
    c AS (SELECT x AS xmin, n AS n_tail, cum - w AS below, 1 + n / (sl - n * LN(x)) AS alpha
          FROM s WHERE x < (SELECT MAX(x) FROM h)),
    k AS (SELECT xmin, alpha, n_tail,
                 MAX(ABS((s.cum - below) / n_tail - (1 - POW(s.x / xmin, 1 - alpha)))) AS ks
          FROM c JOIN s ON s.x >= c.xmin GROUP BY xmin, alpha, n_tail)
    SELECT ROUND(xmin, 6) AS xmin, ROUND(alpha, 6) AS alpha, ROUND(ks, 6) AS ks, CAST(n_tail AS BIGINT) AS n_tail
    FROM k ORDER BY ks, xmin LIMIT 1
    """,
)
def power_law_fit_counts(spark, sf_dir):
    """The fit as the reference script feeds it: the sample is the histogram's count column
    (one value per distinct degree), not the degrees themselves."""
    from tessera.operators.graph.powerlaw import fit_power_law

    hist = core.degree_distribution(purchase_graph(spark, sf_dir))
    counts = hist.groupBy("count").agg(F.count(F.lit(1)).alias("w"))
    f = fit_power_law(counts, "count", "w")
    return f.select(*[F.round(c, 6).alias(c) for c in ("xmin", "alpha", "ks")], "n_tail")
