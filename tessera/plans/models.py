"""Statistical-model queries: gradient descent, logistic GLM on an auction-like stand-in,
category merging, over-dispersion, class-capped sampling, dice overlap, mini-batches."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import functions as F

from tessera.functions.ordering import hash_uniform, rank_within, with_global_position
from tessera.operators import clean, regress, stats
from tessera.plans.registry import register
from tessera.session import cut_lineage
from tessera.sources import tables

M = 2147483647

# ---- auction stand-in: one row per line item ---------------------------------------------

AUCTION_SQL = f"""
    SELECT l.l_orderkey, l.l_linenumber, p.p_type AS category, o.o_orderpriority AS currency,
           CAST(dayofweek(o.o_orderdate) AS VARCHAR) AS endday, CAST(CAST(FLOOR(p.p_size / 10) AS BIGINT) AS VARCHAR) AS duration,
           l.l_discount, l.l_tax, l.l_quantity,
           CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS competitive,
           CASE WHEN ((((l.l_orderkey % {M}) * 1103515245 + (l.l_linenumber % {M}) * 12345 + 23 * 12347) % {M}) % 10) < 6
                THEN 'train' ELSE 'test' END AS part
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey
"""
CATEGORICAL = ["category", "currency", "endday", "duration"]
MERGE_THRESHOLD = 0.003  # the stand-in's group means all lie within 0.01 of each other


def auctions(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem")
    o = tables.table(spark, sf_dir, "orders")
    p = tables.table(spark, sf_dir, "part")
    bucket = F.pmod(hash_uniform("l_orderkey", "l_linenumber", 23), F.lit(10))
    return li.join(o, li.l_orderkey == o.o_orderkey).join(p, p.p_partkey == li.l_partkey).select(
        "l_orderkey", "l_linenumber",
        F.col("p_type").alias("category"), F.col("o_orderpriority").alias("currency"),
        (F.dayofweek("o_orderdate") - 1).cast("string").alias("endday"),
        F.floor(F.col("p_size") / 10).cast("bigint").cast("string").alias("duration"),
        "l_discount", "l_tax", "l_quantity",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("competitive"),
        F.when(bucket < 6, "train").otherwise("test").alias("part"),
    )


def _level_means(train):
    """``(column_name, level, mean)`` of every categorical column by one aggregation."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("level")) for c in CATEGORICAL])
    return train.select("competitive", F.inline(pairs)).groupBy("column_name", "level").agg(F.avg("competitive").alias("mean"))


PIVOT_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS level, AVG(competitive) AS mean FROM ({AUCTION_SQL}) a WHERE part = 'train' GROUP BY {c}"
    for c in CATEGORICAL
)


@register("group_means", f"SELECT column_name, level, ROUND(mean, 6) AS mean FROM ({PIVOT_SQL}) p")
def group_means(spark, sf_dir):
    means = _level_means(auctions(spark, sf_dir).where(F.col("part") == "train"))
    return means.select("column_name", "level", F.round("mean", 6).alias("mean"))


def _merged_sql(c: str) -> str:
    return f"""
    SELECT * FROM (
    WITH RECURSIVE p AS (SELECT level AS k, mean AS m, ROW_NUMBER() OVER (ORDER BY level) AS r
                         FROM ({PIVOT_SQL}) q WHERE column_name = '{c}'),
    pr AS (SELECT b.r, MAX(a.r) AS p FROM p a JOIN p b ON a.r < b.r AND ABS(a.m - b.m) < {MERGE_THRESHOLD} GROUP BY b.r),
    st AS (SELECT p.r, p.k, p.m, COALESCE(pr.p, p.r) AS ptr FROM p LEFT JOIN pr ON pr.r = p.r),
    ch(r, cur) AS (SELECT r, ptr FROM st UNION ALL SELECT ch.r, st.ptr FROM ch JOIN st ON st.r = ch.cur WHERE st.ptr <> st.r)
    SELECT '{c}' AS column_name, st.k AS level, ROUND(st.m, 6) AS mean, root.k AS merged
    FROM st JOIN ch ON ch.r = st.r JOIN st root ON root.r = ch.cur AND root.ptr = root.r) x
    """


MERGED_SQL = " UNION ALL ".join(_merged_sql(c) for c in CATEGORICAL)


def _merged_maps(train):
    means = cut_lineage(_level_means(train))  # one row a level; read once a column
    return {
        c: regress.merge_close_categories(
            means.where(F.col("column_name") == c).select(F.col("level").alias(c), "mean"), c, "mean", MERGE_THRESHOLD
        )
        for c in CATEGORICAL
    }


@register("merged_categories", MERGED_SQL)
def merged_categories(spark, sf_dir):
    train = auctions(spark, sf_dir).where(F.col("part") == "train")
    parts = [
        m.select(F.lit(c).alias("column_name"), F.col(c).alias("level"), F.round("mean", 6).alias("mean"), "merged")
        for c, m in _merged_maps(train).items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def merged_auctions(spark, sf_dir):
    a = cut_lineage(auctions(spark, sf_dir))
    maps = _merged_maps(a.where(F.col("part") == "train"))
    for c, m in maps.items():
        a = regress.apply_category_map(a, m.select(c, "merged"), c)
    return a


@register(
    "category_counts",
    f"""
    WITH mg AS ({MERGED_SQL}), a AS ({AUCTION_SQL})
    SELECT a.part, 'category' AS column_name, COALESCE(mg.merged, a.category) AS merged, COUNT(*) AS n
    FROM a LEFT JOIN (SELECT * FROM mg WHERE column_name = 'category') mg ON mg.level = a.category
    GROUP BY a.part, COALESCE(mg.merged, a.category)
    """,
)
def category_counts(spark, sf_dir):
    """Rows per merged category in train and test after applying the train-fitted map."""
    a = merged_auctions(spark, sf_dir)
    return a.groupBy("part", F.lit("category").alias("column_name"), F.col("category").alias("merged")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _glm_frame(spark, sf_dir):
    a = cut_lineage(merged_auctions(spark, sf_dir).where(F.col("part") == "train"))
    feats = ["l_discount", "l_tax", "l_quantity"]
    for c in CATEGORICAL:
        levels = clean.distinct_levels(a, c)
        a = clean.one_hot(a, c, levels, keep_original=False, drop_first=True)
        feats += [f"{c}_{v}" for v in sorted(levels)[1:]]
    return a, feats


@register("glm_binomial")
def glm_binomial(spark, sf_dir):
    """Logistic GLM on all predictors (merged categories one-hot, reference level dropped):
    coefficients, standard errors, p-values (model-valued: rows only)."""
    a, feats = _glm_frame(spark, sf_dir)
    model = regress.fit_binomial_glm(a, feats, "competitive")
    t = regress.glm_terms(spark, model, feats)
    return t.select("term", *[F.round(c, 6).alias(c) for c in ("coefficient", "std_error", "p_value")])


@register("glm_significant")
def glm_significant(spark, sf_dir):
    """Predictors with p < 0.05 and the one with the largest coefficient (rows only)."""
    a, feats = _glm_frame(spark, sf_dir)
    t = regress.glm_terms(spark, regress.fit_binomial_glm(a, feats, "competitive"), feats).where(
        F.col("term") != "(Intercept)"
    )
    top = t.orderBy(F.col("coefficient").desc(), "term").limit(1).select(F.col("term").alias("_top"))
    return t.join(top, t.term == top._top, "left").where((F.col("p_value") < 0.05) | F.col("_top").isNotNull()).select(
        "term", F.round("coefficient", 6).alias("coefficient"), F.round("p_value", 6).alias("p_value"),
        F.col("_top").isNotNull().alias("largest"),
    )


@register("glm_nested_test")
def glm_nested_test(spark, sf_dir):
    """χ² deviance tests of two smaller models against the full one (rows only): ``single`` has
    the predictor of the largest coefficient, ``reduced`` those with p < 0.05."""
    a, feats = _glm_frame(spark, sf_dir)
    full = regress.fit_binomial_glm(a, feats, "competitive")
    coefs = dict(zip(feats, [float(c) for c in full.coefficients]))
    best = max(sorted(feats), key=lambda f: coefs[f])
    significant = [f for f, p in zip(feats, full.summary.pValues) if p < 0.05]
    rows = []
    for name, terms in (("single", [best]), ("reduced", significant)):
        smaller = regress.fit_binomial_glm(a, terms, "competitive").summary if terms else None
        rows.append((name, terms, *regress.deviance_test(full.summary, smaller)))
    return spark.createDataFrame(
        rows, "model string, terms array<string>, deviance_full double, deviance_model double, df double, chi2 double, p_value double"
    )


# ---- gradient descent ------------------------------------------------------------------

GD_FEATURES = ["intercept", "l_quantity", "l_discount", "l_tax"]
GD_EPOCHS, GD_LR, GD_ALPHA, GD_TOL = 1000, 0.025, 0.001, 0.01
SPLIT_SQL = f"((((l_orderkey % {M}) * 1103515245 + (l_linenumber % {M}) * 12345 + 29 * 12347) % {M}) % 10)"


def gd_train_frame(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem")
    bucket = F.pmod(hash_uniform("l_orderkey", "l_linenumber", 29), F.lit(10))
    train = li.where(bucket < 7).select("l_quantity", "l_discount", "l_tax", (F.col("l_extendedprice") / 10000).alias("y"))
    scaled = clean.min_max_scale(train, train, ["l_quantity", "l_discount", "l_tax"])
    return clean.with_intercept(scaled)


def _gd_sql(reg: str) -> str:
    pen = (lambda w: f"2 * {GD_ALPHA} * {w}") if reg == "l2" else (lambda w: f"{GD_ALPHA} * {w} * {w}")
    return f"""
    WITH RECURSIVE t0 AS (SELECT l_quantity, l_discount, l_tax, l_extendedprice / 10000 AS y FROM lineitem WHERE {SPLIT_SQL} < 7),
    mm AS (SELECT MIN(l_quantity) q0, MAX(l_quantity) q1, MIN(l_discount) d0, MAX(l_discount) d1, MIN(l_tax) t0, MAX(l_tax) t1 FROM t0),
    d AS (SELECT (l_quantity - q0) / (q1 - q0) AS x1, (l_discount - d0) / (d1 - d0) AS x2, (l_tax - t0) / (t1 - t0) AS x3, y FROM t0, mm),
    s(epoch, w0, w1, w2, w3, cost, prev) AS (
        SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, NULL::DOUBLE, NULL::DOUBLE
        UNION ALL
        SELECT epoch + 1,
               w0 - {GD_LR} * (2 * AVG(w0 + w1 * x1 + w2 * x2 + w3 * x3 - y) + {pen('w0')}),
               w1 - {GD_LR} * (2 * AVG((w0 + w1 * x1 + w2 * x2 + w3 * x3 - y) * x1) + {pen('w1')}),
               w2 - {GD_LR} * (2 * AVG((w0 + w1 * x1 + w2 * x2 + w3 * x3 - y) * x2) + {pen('w2')}),
               w3 - {GD_LR} * (2 * AVG((w0 + w1 * x1 + w2 * x2 + w3 * x3 - y) * x3) + {pen('w3')}),
               AVG(POW(w0 + w1 * x1 + w2 * x2 + w3 * x3 - y, 2)),
               cost + {GD_ALPHA} * (w0 * w0 + w1 * w1 + w2 * w2 + w3 * w3)
        -- state: cost = error term of the epoch, prev = full cost of the epoch before
        FROM s, d WHERE epoch < {GD_EPOCHS}
          AND NOT (epoch >= 4 AND ABS(cost + {GD_ALPHA} * (w0 * w0 + w1 * w1 + w2 * w2 + w3 * w3) - prev) <= {GD_TOL})
        GROUP BY epoch, w0, w1, w2, w3, cost
    )
    SELECT epoch, ROUND(cost + {GD_ALPHA} * (w0 * w0 + w1 * w1 + w2 * w2 + w3 * w3), 6) AS cost,
           ROUND(w0, 6) AS w0, ROUND(w1, 6) AS w1, ROUND(w2, 6) AS w2, ROUND(w3, 6) AS w3
    FROM s WHERE epoch > 0
"""


GD_SQL = _gd_sql("l2")


@register("gd_linear_as_written", _gd_sql("as_written"))
def gd_linear_as_written(spark, sf_dir):
    """Same descent with the penalty term as written in the reference update (α·w², element-wise)."""
    hist = regress.gradient_descent(
        gd_train_frame(spark, sf_dir), GD_FEATURES, "y", alpha=GD_ALPHA, epochs=GD_EPOCHS, lr=GD_LR, tol=GD_TOL,
        reg="as_written",
    )
    df = spark.createDataFrame(hist, "epoch int, cost double, w0 double, w1 double, w2 double, w3 double")
    return df.select("epoch", *[F.round(c, 6).alias(c) for c in ("cost", "w0", "w1", "w2", "w3")])


@register("gd_linear_l2", GD_SQL)
def gd_linear_l2(spark, sf_dir):
    """Cost curve and weights per epoch of L2 linear regression by full-batch gradient descent."""
    hist = regress.gradient_descent(
        gd_train_frame(spark, sf_dir), GD_FEATURES, "y", alpha=GD_ALPHA, epochs=GD_EPOCHS, lr=GD_LR, tol=GD_TOL
    )
    df = spark.createDataFrame(hist, "epoch int, cost double, w0 double, w1 double, w2 double, w3 double")
    return df.select("epoch", *[F.round(c, 6).alias(c) for c in ("cost", "w0", "w1", "w2", "w3")])


# ---- over-dispersion, sampling, dice, batches ---------------------------------------------

@register(
    "overdispersion",
    """
    WITH o AS (SELECT l_orderkey, SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS x, COUNT(*) AS size
               FROM lineitem GROUP BY l_orderkey),
    s AS (SELECT size, COUNT(*) AS n, SUM(x) / (COUNT(*) * size::DOUBLE) AS p, VAR_SAMP(x) AS v FROM o GROUP BY size)
    SELECT size, n, ROUND(p, 6) AS p, ROUND(v, 6) AS observed_var,
           ROUND(v / NULLIF(size * p * (1 - p), 0), 6) AS dispersion,
           ROUND((n - 1) * v / NULLIF(size * p * (1 - p), 0), 4) AS statistic, n - 1 AS df FROM s
    """,
)
def overdispersion(spark, sf_dir):
    """Binomial over-dispersion of returned lines per order, one row for every number of lines."""
    li = tables.table(spark, sf_dir, "lineitem")
    per = li.groupBy("l_orderkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("x"), F.count(F.lit(1)).alias("size")
    )
    o = stats.overdispersion_by_size(per, "x", "size")
    return o.select(
        "size", "n", F.round("p", 6).alias("p"), F.round("observed_var", 6).alias("observed_var"),
        F.round("dispersion", 6).alias("dispersion"), F.round("statistic", 4).alias("statistic"), "df",
    )


@register("overdispersion_test")
def overdispersion_test(spark, sf_dir):
    """The over-dispersion statistic of every trial size with its p-value: the upper tail of chi-squared
    with n - 1 degrees of freedom (rows; a test holds the tail against known values)."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("double")
    def tail(statistic: pd.Series, df: pd.Series) -> pd.Series:
        return pd.Series([None if pd.isna(x) or k < 1 else regress.chi2_sf(float(x), float(k)) for x, k in zip(statistic, df, strict=True)], dtype="float64")

    o = overdispersion(spark, sf_dir)
    return o.select("size", "n", "dispersion", "statistic", "df", tail("statistic", "df").alias("p_value"))


NEG_CAP = 100


@register(
    "class_capped_sample",
    f"""
    SELECT doc_id, toxic FROM labels WHERE toxic = 1
    UNION ALL
    SELECT doc_id, toxic FROM (
        SELECT doc_id, toxic, ROW_NUMBER() OVER (ORDER BY ((doc_id % {M}) * 1103515245 + 31 * 12345) % {M}, doc_id) AS rn
        FROM labels WHERE toxic = 0) n WHERE rn <= {NEG_CAP}
    """,
)
def class_capped_sample(spark, sf_dir):
    """All positive rows plus at most NEG_CAP negatives in a reproducible shuffled order."""
    lab = tables.table(spark, sf_dir, "labels").select("doc_id", "toxic")
    neg = lab.where(F.col("toxic") == 0).withColumn("h", hash_uniform("doc_id", 31))
    picked = rank_within(neg, "toxic", ["h", "doc_id"], "rk").where(F.col("rk") < NEG_CAP).select("doc_id", "toxic")
    return lab.where(F.col("toxic") == 1).unionByName(picked)


MASK_SQL = """
    SELECT vec_id, CASE WHEN x > 0 THEN 1.0 ELSE 0.0 END AS t,
           CASE WHEN nx * 2 + 0.5 >= 0.5 THEN 1.0 ELSE 0.0 END AS p
    FROM (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x,
                 CAST(unnest(list_concat(embedding[2:], embedding[1:1])) AS DOUBLE) AS nx FROM embeddings) e
"""


def masks(spark, sf_dir):
    """Mask stand-in: truth = pixel > 0, score = 2·(next pixel) + 0.5 thresholded at 0.5."""
    e = tables.table(spark, sf_dir, "embeddings")
    x = F.transform("embedding", lambda v: v.cast("double"))
    shifted = F.concat(F.slice(x, 2, 1 << 30), F.slice(x, 1, 1))
    px = e.select("vec_id", F.explode(F.arrays_zip(x.alias("x"), shifted.alias("nx"))).alias("z"))
    return px.select(
        "vec_id",
        F.when(F.col("z.x") > 0, 1.0).otherwise(0.0).alias("t"),
        F.when(F.col("z.nx") * 2 + 0.5 >= 0.5, 1.0).otherwise(0.0).alias("p"),
    )


@register(
    "dice_by_image",
    f"SELECT vec_id, ROUND((2 * SUM(t * p) + 1) / (SUM(t) + SUM(p) + 1), 6) AS dice FROM ({MASK_SQL}) m GROUP BY vec_id",
)
def dice_by_image(spark, sf_dir):
    m = masks(spark, sf_dir)
    return m.groupBy("vec_id").agg(F.round(stats.dice(F.col("t"), F.col("p")), 6).alias("dice"))


@register(
    "dice_global",
    f"SELECT ROUND((2 * SUM(t * p) + 1) / (SUM(t) + SUM(p) + 1), 6) AS dice, ROUND(1 - (2 * SUM(t * p) + 1) / (SUM(t) + SUM(p) + 1), 6) AS loss FROM ({MASK_SQL}) m",
)
def dice_global(spark, sf_dir):
    d = stats.dice(F.col("t"), F.col("p"))
    return masks(spark, sf_dir).agg(F.round(d, 6).alias("dice"), F.round(1 - d, 6).alias("loss"))


BATCH = 32


@register(
    "mini_batches",
    f"""
    SELECT vec_id, CAST(FLOOR((rn - 1) / {BATCH}) AS BIGINT) AS batch FROM (
        SELECT vec_id, ROW_NUMBER() OVER (ORDER BY ((vec_id % {M}) * 1103515245 + 37 * 12345) % {M}, vec_id) AS rn,
               COUNT(*) OVER () AS n FROM embeddings) s
    WHERE FLOOR((rn - 1) / {BATCH}) < FLOOR(n / {BATCH})
    """,
)
def mini_batches(spark, sf_dir):
    """Rows shuffled by a reproducible hash, cut into full batches of BATCH (last partial batch dropped)."""
    e = tables.table(spark, sf_dir, "embeddings").select("vec_id").withColumn("h", hash_uniform("vec_id", 37))
    pos = with_global_position(e, ["h", "vec_id"], "pos")
    full = pos.agg(F.count(F.lit(1))).scalar() / F.lit(BATCH)
    return pos.select("vec_id", F.floor(F.col("pos") / BATCH).cast("bigint").alias("batch")).where(
        F.col("batch") < F.floor(full)
    )
