"""Word-vector and kernel-regression queries over ``embeddings`` (vec_id = word key,
embedding = vector, label = target)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.ordering import hash_uniform
from tessera.functions.vectors import pearson
from tessera.operators import vectors as V
from tessera.operators.kernel import kernel_regression as kernel_regression_rows
from tessera.plans.registry import register
from tessera.session import cut_lineage
from tessera.sources import tables

M = 2147483647
POSITIVE, NEGATIVE = [1, 2], [3]
ODD_ONE_OUT = [1, 2, 3, 4, 5]

U_SQL = """
    WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
    n AS (SELECT vec_id, x, sqrt(list_sum(list_transform(x, lambda b: b * b))) AS nrm FROM v),
    u AS (SELECT vec_id, list_transform(x, lambda a: a / nrm) AS u FROM n)
"""


def word_vectors(spark, sf_dir):
    e = tables.table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("key"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"))


def _round_vec(c, d=6):
    return F.transform(c, lambda x: F.round(x, d))


@register("unit_vectors", U_SQL + " SELECT vec_id, list_transform(u, lambda a: round(a, 6)) AS vector FROM u")
def unit_vectors(spark, sf_dir):
    u = V.unit_vectors(word_vectors(spark, sf_dir))
    return u.select(F.col("key").alias("vec_id"), _round_vec(F.col("vector")).alias("vector"))


def _weighted_query_sql(weights: dict) -> str:
    w_values = ", ".join(f"({k}, {float(w)})" for k, w in weights.items())
    return f"""
    , w(vec_id, wt) AS (VALUES {w_values}),
    qs AS (SELECT pos, SUM(wt * val) AS s FROM (
            SELECT w.wt, generate_subscripts(u.u, 1) AS pos, unnest(u.u) AS val FROM u JOIN w ON w.vec_id = u.vec_id) t GROUP BY pos),
    q0 AS (SELECT list(s ORDER BY pos) AS q FROM qs),
    q AS (SELECT list_transform(q, lambda a: a / sqrt(list_sum(list_transform(q, lambda b: b * b)))) AS q FROM q0)
    """


@register(
    "most_similar",
    U_SQL
    + _weighted_query_sql({1: 1.0, 2: 1.0, 3: -1.0})
    + """
    SELECT vec_id, ROUND(list_dot_product(u.u, q.q), 6) AS similarity FROM u, q
    WHERE vec_id NOT IN (1, 2, 3) ORDER BY similarity DESC, vec_id LIMIT 10
    """,
)
def most_similar(spark, sf_dir):
    r = V.most_similar(word_vectors(spark, sf_dir), POSITIVE, NEGATIVE, topn=10)
    return r.select(F.col("key").alias("vec_id"), F.round("similarity", 6).alias("similarity"))


@register(
    "most_similar_cosmul",
    U_SQL
    + """
    , inp AS (SELECT vec_id AS k, u AS iu FROM u WHERE vec_id IN (1, 2, 3)),
    f AS (SELECT u.vec_id, inp.k, (list_dot_product(u.u, inp.iu) + 1) / 2 AS f FROM u, inp WHERE u.vec_id NOT IN (1, 2, 3))
    SELECT vec_id, ROUND(EXP(SUM(CASE WHEN k IN (1, 2) THEN LN(f) ELSE 0 END))
                         / (EXP(SUM(CASE WHEN k = 3 THEN LN(f) ELSE 0 END)) + 1e-6), 6) AS similarity
    FROM f GROUP BY vec_id ORDER BY similarity DESC, vec_id LIMIT 10
    """,
)
def most_similar_cosmul(spark, sf_dir):
    r = V.most_similar_cosmul(word_vectors(spark, sf_dir), POSITIVE, NEGATIVE, topn=10)
    return r.select(F.col("key").alias("vec_id"), F.round("similarity", 6).alias("similarity"))


@register(
    "doesnt_match",
    U_SQL
    + """
    , p AS (SELECT * FROM u WHERE vec_id IN (1, 2, 3, 4, 5)),
    ms AS (SELECT pos, AVG(val) AS m FROM (SELECT generate_subscripts(u, 1) AS pos, unnest(u) AS val FROM p) t GROUP BY pos),
    m0 AS (SELECT list(m ORDER BY pos) AS m FROM ms),
    m AS (SELECT list_transform(m, lambda a: a / sqrt(list_sum(list_transform(m, lambda b: b * b)))) AS m FROM m0)
    SELECT vec_id, ROUND(list_dot_product(p.u, m.m), 6) AS similarity FROM p, m ORDER BY similarity, vec_id LIMIT 1
    """,
)
def doesnt_match(spark, sf_dir):
    r = V.doesnt_match(word_vectors(spark, sf_dir), ODD_ONE_OUT)
    return r.select(F.col("key").alias("vec_id"), F.round("similarity", 6).alias("similarity"))


def _mean_sql(ids: str, name: str) -> str:
    return f"""
    {name} AS (SELECT list(m ORDER BY pos) AS m FROM (
        SELECT pos, AVG(val) AS m FROM (
            SELECT generate_subscripts(x, 1) AS pos, unnest(x) AS val FROM v WHERE vec_id IN ({ids})) t GROUP BY pos) s)
    """


@register(
    "n_similarity",
    "WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings), "
    + _mean_sql("1, 2, 3", "a") + ", " + _mean_sql("4, 5", "b")
    + """
    SELECT ROUND(list_dot_product(a.m, b.m) / (sqrt(list_dot_product(a.m, a.m)) * sqrt(list_dot_product(b.m, b.m))), 6) AS similarity
    FROM a, b
    """,
)
def n_similarity(spark, sf_dir):
    r = V.n_similarity(word_vectors(spark, sf_dir), [1, 2, 3], [4, 5])
    return r.select(F.round("similarity", 6).alias("similarity"))


@register(
    "label_centroid_similarity",
    """
    WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
    c AS (SELECT label, list(m ORDER BY pos) AS c FROM (
            SELECT label, pos, AVG(val) AS m FROM (SELECT label, generate_subscripts(x, 1) AS pos, unnest(x) AS val FROM v) t
            GROUP BY label, pos) s GROUP BY label)
    SELECT v.vec_id, ROUND(list_dot_product(v.x, c.c) / (sqrt(list_dot_product(v.x, v.x)) * sqrt(list_dot_product(c.c, c.c))), 6) AS similarity
    FROM v JOIN c ON c.label = v.label
    """,
)
def label_centroid_similarity(spark, sf_dir):
    """``similarity`` of every vector to the centroid of its label (one join on the label)."""
    from tessera.functions.vectors import cosine

    e = tables.table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("x")
    )
    c = V.centroids(e, "label", "x")
    return e.join(c, "label").select("vec_id", F.round(cosine(F.col("x"), F.col("centroid")), 6).alias("similarity"))


# ---- centroid-kernel regression: the patterns are label centroids, not training rows -----

BUCKET_SQL = f"((((vec_id % {M}) * 1103515245 + 17 * 12345) % {M}) % 10)"
HORIZONS = (16, 32, 64)


def _patterns_and_queries(spark, sf_dir):
    e = tables.table(spark, sf_dir, "embeddings").select(
        "vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("x"),
        F.pmod(hash_uniform("vec_id", 17), F.lit(10)).alias("bucket"),
    )
    patterns = V.centroids(e.where(F.col("bucket") < 7), "label", "x")
    return e, patterns


def kernel_features(queries, patterns, c: float = 2.0):
    """Adds ``pred_<h>`` = Σ y_p·e^{c·corr(x[:h], p[:h])} / Σ e^{c·corr} over the patterns.

    The pattern table is bounded by the number of labels; it is attached to every
    query row as one scalar array, so scoring is a map-only pass.
    """
    pats = patterns.agg(F.collect_list(F.struct(F.col("label").cast("double").alias("y"), "centroid")).alias("p")).select("p").scalar()
    out = queries.withColumn("_pats", pats)
    for h in HORIZONS:
        agg = F.aggregate(F.col("_pats"), F.struct(F.lit(0.0).alias("num"), F.lit(0.0).alias("den")), _kernel_step(h, c))
        out = out.withColumn(f"pred_{h}", agg["num"] / agg["den"])
    return out.drop("_pats")


def _kernel_step(h: int, c: float):
    xs = F.slice(F.col("x"), 1, h)

    def step(acc, p):
        w = F.exp(F.lit(c) * F.coalesce(pearson(xs, F.slice(p["centroid"], 1, h)), F.lit(0.0)))
        return F.struct((acc["num"] + p["y"] * w).alias("num"), (acc["den"] + w).alias("den"))

    return step


def _kernel_sql():
    parts = []
    for h in HORIZONS:
        parts.append(f"""
        k{h} AS (SELECT q.vec_id, SUM(c.label * EXP(2 * COALESCE(corr_v, 0))) / SUM(EXP(2 * COALESCE(corr_v, 0))) AS pred_{h} FROM (
            SELECT q.vec_id, c.label, (SELECT CASE WHEN var_pop(a) > 0 AND var_pop(b) > 0 THEN covar_pop(a, b) / sqrt(var_pop(a) * var_pop(b)) END
                                        FROM (SELECT unnest(q.x[1:{h}]) AS a, unnest(c.c[1:{h}]) AS b) z) AS corr_v
            FROM q, c) s JOIN c ON c.label = s.label JOIN q ON q.vec_id = s.vec_id GROUP BY q.vec_id)""")
    return parts


KERNEL_SQL = f"""
    WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x, {BUCKET_SQL} AS bucket FROM embeddings),
    c AS (SELECT label, list(m ORDER BY pos) AS c FROM (
            SELECT label, pos, AVG(val) AS m FROM (
                SELECT label, generate_subscripts(x, 1) AS pos, unnest(x) AS val FROM v WHERE bucket < 7) t
            GROUP BY label, pos) s GROUP BY label),
    q AS (SELECT vec_id, label, x FROM v WHERE bucket >= 7),
    {",".join(_kernel_sql())}
    SELECT q.vec_id, q.label, ROUND(k16.pred_16, 6) AS pred_16, ROUND(k32.pred_32, 6) AS pred_32, ROUND(k64.pred_64, 6) AS pred_64
    FROM q JOIN k16 ON k16.vec_id = q.vec_id JOIN k32 ON k32.vec_id = q.vec_id JOIN k64 ON k64.vec_id = q.vec_id
"""


def kernel_table(spark, sf_dir):
    e, patterns = _patterns_and_queries(spark, sf_dir)
    return kernel_features(e.where(F.col("bucket") >= 7), patterns)


@register("kernel_regression", KERNEL_SQL)
def kernel_regression(spark, sf_dir):
    """Centroid-kernel regression: label weighted by e^(c·correlation) over the label centroids."""
    k = kernel_table(spark, sf_dir)
    return k.select("vec_id", "label", *[F.round(f"pred_{h}", 6).alias(f"pred_{h}") for h in HORIZONS])


@register(
    "kernel_ols_single",
    f"""
    WITH k AS ({KERNEL_SQL})
    SELECT ROUND(regr_slope(label, pred_64), 4) AS slope, ROUND(regr_intercept(label, pred_64), 4) AS intercept,
           COUNT(*) AS n FROM k
    """,
)
def kernel_ols_single(spark, sf_dir):
    """One-predictor least squares of the label on the 64-step kernel prediction."""
    k = kernel_table(spark, sf_dir).select(F.col("label").cast("double").alias("y"), F.round("pred_64", 6).alias("p"))
    return k.agg(
        F.round(F.regr_slope("y", "p"), 4).alias("slope"), F.round(F.regr_intercept("y", "p"), 4).alias("intercept"),
        F.count(F.lit(1)).alias("n"),
    )


@register("kernel_ols")
def kernel_ols(spark, sf_dir):
    """OLS on the three horizon predictions (fit on buckets 7-8, evaluated on 9): coefficients and
    test MSE (model-valued: rows only)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    k = kernel_table(spark, sf_dir).withColumn("y", F.col("label").cast("double"))
    k = cut_lineage(k.withColumn("bucket", F.pmod(hash_uniform("vec_id", 17), F.lit(10))))  # reused by every solver pass
    feats = VectorAssembler(inputCols=[f"pred_{h}" for h in HORIZONS], outputCol="features").transform(k)
    model = LinearRegression(solver="normal", regParam=0.0, labelCol="y").fit(feats.where(F.col("bucket") < 9))
    test = model.transform(feats.where(F.col("bucket") == 9))
    mse = test.agg(F.avg(F.pow(F.col("y") - F.col("prediction"), 2))).scalar()
    coefs = [float(c) for c in model.coefficients] + [float(model.intercept)]
    names = [f"pred_{h}" for h in HORIZONS] + ["intercept"]
    rows = spark.createDataFrame(list(zip(names, coefs)), "term string, coefficient double")
    return rows.select("term", F.round("coefficient", 6).alias("coefficient"), F.round(mse, 6).alias("test_mse"))


# ---- kernel regression over the training rows themselves ----------------------------------


def _row_kernel_sql() -> str:
    z = ", ".join(
        f"list_transform(x[1:{h}], lambda a: CASE WHEN list_aggregate(x[1:{h}], 'var_pop') > 1e-24 THEN (a - list_aggregate(x[1:{h}], 'avg')) / sqrt({h} * list_aggregate(x[1:{h}], 'var_pop')) ELSE 0 END) AS z{h}"
        for h in HORIZONS)
    preds = ", ".join(f"ROUND(SUM(t.y * EXP(2 * list_inner_product(q.z{h}, t.z{h}))) / SUM(EXP(2 * list_inner_product(q.z{h}, t.z{h}))), 6) AS pred_{h}" for h in HORIZONS)
    return f"""
    WITH v AS (SELECT vec_id, CAST(label AS DOUBLE) AS y, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
    z AS (SELECT vec_id, y, {z} FROM v)
    SELECT q.vec_id, ANY_VALUE(q.y) AS actual, {preds}
    FROM z q, z t WHERE q.vec_id % 20 = 0 AND t.vec_id % 20 <> 0 GROUP BY q.vec_id
    """


def row_kernel_table(spark, sf_dir):
    """``vec_id, actual, pred_<h>``: vectors with ids divisible by 20, each against all the others."""
    e = tables.table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("x"), F.col("label").cast("double").alias("y"))
    queries, training = e.where(F.col("vec_id") % 20 == 0), e.where(F.col("vec_id") % 20 != 0)
    found = kernel_regression_rows(queries.select(F.col("vec_id").alias("id"), "x"), training.select("x", "y"), HORIZONS)
    return queries.select("vec_id", F.col("y").alias("actual")).join(found.withColumnRenamed("id", "vec_id"), "vec_id")


@register("kernel_regression_all_rows", _row_kernel_sql())
def kernel_regression_all_rows(spark, sf_dir):
    """Kernel regression over all training rows, three horizons, for each twentieth vector."""
    k = row_kernel_table(spark, sf_dir)
    return k.select("vec_id", "actual", *[F.round(f"pred_{h}", 6).alias(f"pred_{h}") for h in HORIZONS])


@register("kernel_actual_predicted")
def kernel_actual_predicted(spark, sf_dir):
    """Actual against predicted values of the least squares on the three kernel predictions, fitted on
    ids divisible by 40 and applied to the other queries (rows; a test compares with numpy)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    k = cut_lineage(row_kernel_table(spark, sf_dir))
    feats = VectorAssembler(inputCols=[f"pred_{h}" for h in HORIZONS], outputCol="features").transform(k)
    model = LinearRegression(solver="normal", regParam=0.0, labelCol="actual").fit(feats.where(F.col("vec_id") % 40 == 0))
    return model.transform(feats.where(F.col("vec_id") % 40 != 0)).select("vec_id", "actual", F.col("prediction").alias("predicted"))


# ---- analogy questions derived from the label groups -------------------------------------

ANALOGY_SQL = """
    WITH nx AS (SELECT label, COALESCE(LEAD(label) OVER (ORDER BY label), MIN(label) OVER ()) AS nxt
                FROM (SELECT DISTINCT label FROM embeddings) l),
    r AS (SELECT vec_id, embeddings.label, nxt, ROW_NUMBER() OVER (PARTITION BY embeddings.label ORDER BY vec_id) - 1 AS rk
          FROM embeddings JOIN nx ON nx.label = embeddings.label),
    q AS (SELECT a.vec_id * 1 AS qid, 'label_' || CAST(a.label AS VARCHAR) AS section, a.vec_id AS a, b.vec_id AS b,
                 c.vec_id AS c, d.vec_id AS expected
          FROM r a JOIN r b ON b.label = a.label AND b.rk = a.rk + 1
          JOIN r c ON c.label = a.nxt AND c.rk = a.rk
          JOIN r d ON d.label = c.label AND d.rk = c.rk + 1),
    v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
    u AS (SELECT vec_id, list_transform(x, lambda t: t / sqrt(list_sum(list_transform(x, lambda y: y * y)))) AS u FROM v),
    qv AS (SELECT q.*, list_transform(range(1, len(ub.u) + 1), lambda i: ub.u[i] - ua.u[i] + uc.u[i]) AS qv
           FROM q JOIN u ua ON ua.vec_id = q.a JOIN u ub ON ub.vec_id = q.b JOIN u uc ON uc.vec_id = q.c),
    s AS (SELECT qv.qid, qv.section, qv.expected, u.vec_id, list_dot_product(u.u, qv.qv) AS sc
          FROM qv, u WHERE u.vec_id NOT IN (qv.a, qv.b, qv.c)),
    p AS (SELECT qid, section, expected, arg_min(vec_id, (-sc, vec_id)) AS predicted FROM s GROUP BY qid, section, expected)
"""


def analogy_questions(spark, sf_dir):
    """a, b consecutive vectors of one label; c, expected the same ranks in the next label
    (the smallest label follows the largest)."""
    from tessera.functions.ordering import rank_within, with_global_position

    e = tables.table(spark, sf_dir, "embeddings").select("vec_id", "label")
    r = rank_within(e, "label", ["vec_id"], "rk")
    a = r.select(F.col("vec_id").alias("a"), F.col("label").alias("la"), F.col("rk").alias("ra"))
    b = r.select(F.col("vec_id").alias("b"), F.col("label").alias("la"), (F.col("rk") - 1).alias("ra"))
    labels = with_global_position(e.where(F.col("label").isNotNull()).select("label").distinct(), ["label"], "at")
    count = labels.agg(F.count(F.lit(1))).scalar()
    before = labels.select(F.col("label").alias("la"), F.pmod(F.col("at") + 1, count).alias("at")).join(
        labels.select(F.col("label").alias("lc"), "at"), "at").select("la", "lc")
    c = r.select(F.col("vec_id").alias("c"), F.col("label").alias("lc"), F.col("rk").alias("ra")).join(before, "lc")
    d = r.select(F.col("vec_id").alias("expected"), F.col("label").alias("lc"), (F.col("rk") - 1).alias("ra"))
    q = a.join(b, ["la", "ra"]).join(c, ["la", "ra"]).join(d, ["lc", "ra"])
    return q.select(F.col("a").alias("qid"), F.concat(F.lit("label_"), F.col("la").cast("string")).alias("section"), "a", "b", "c", "expected")


@register(
    "analogy_accuracy",
    ANALOGY_SQL + """
    SELECT section, CAST(SUM(CASE WHEN predicted = expected THEN 1 ELSE 0 END) AS BIGINT) AS correct, COUNT(*) AS total,
           ROUND(AVG(CASE WHEN predicted = expected THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM p GROUP BY section
    UNION ALL
    SELECT 'total', CAST(SUM(CASE WHEN predicted = expected THEN 1 ELSE 0 END) AS BIGINT), COUNT(*),
           ROUND(AVG(CASE WHEN predicted = expected THEN 1.0 ELSE 0.0 END), 6) FROM p
    """,
)
def analogy_accuracy(spark, sf_dir):
    """Analogy accuracy by section and in total, over the whole vocabulary."""
    pred = V.analogy_predictions(word_vectors(spark, sf_dir), analogy_questions(spark, sf_dir))
    acc = V.analogy_accuracy(pred)
    return acc.select("section", F.col("correct").cast("bigint").alias("correct"), "total", F.round("accuracy", 6).alias("accuracy"))
