"""Table wrangling queries on quiz-like stand-ins built from ``orders``/``customer``.

Stand-in: every order is a quiz attempt by its customer. ``o_orderstatus``
names the quiz, the grade is the order total / 10,000 truncated to cents, the duration text and
the missing-answer marker ``-`` are built from the order key.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import clean, stats
from tessera.plans.registry import register
from tessera.sources import tables

M = 2147483647

QUIZ_SQL = """
    SELECT o_orderkey, o_custkey AS id, o_orderstatus AS quiz,
           FLOOR(o_totalprice / 100) / 100 AS grade,
           CASE WHEN o_orderkey % 13 = 0 THEN CAST(o_orderkey % 59 AS VARCHAR) || ' secs'
                WHEN o_orderkey % 17 = 0 THEN CAST(o_orderkey % 37 AS VARCHAR) || ' mins'
                ELSE CAST(o_orderkey % 37 AS VARCHAR) || ' mins ' || CAST(o_orderkey % 59 AS VARCHAR) || ' secs' END AS time_taken,
           CASE WHEN o_orderkey % 11 = 0 THEN '-' ELSE CAST(o_custkey % 13 AS VARCHAR) END AS q5
    FROM orders
"""


def quiz_attempts(spark, sf_dir):
    k = F.col("o_orderkey")
    m, s = (k % 37).cast("string"), (k % 59).cast("string")
    return tables.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").alias("id"),
        F.col("o_orderstatus").alias("quiz"),
        (F.floor(F.col("o_totalprice") / 100) / 100).alias("grade"),
        F.when(k % 13 == 0, F.concat(s, F.lit(" secs")))
        .when(k % 17 == 0, F.concat(m, F.lit(" mins")))
        .otherwise(F.concat(m, F.lit(" mins "), s, F.lit(" secs")))
        .alias("time_taken"),
        F.when(k % 11 == 0, F.lit("-")).otherwise((F.col("o_custkey") % 13).cast("string")).alias("q5"),
    )


DURATION_SQL = """
    (COALESCE(TRY_CAST(NULLIF(regexp_extract(time_taken, '(\\d+)\\smins', 1), '') AS INTEGER), 0) * 60
     + COALESCE(TRY_CAST(NULLIF(regexp_extract(time_taken, '(\\d+)\\ssecs', 1), '') AS INTEGER), 0))
"""


@register("duration_seconds", f"SELECT o_orderkey, CAST({DURATION_SQL} AS INTEGER) AS seconds FROM ({QUIZ_SQL}) q")
def duration_seconds(spark, sf_dir):
    q = quiz_attempts(spark, sf_dir)
    return q.select("o_orderkey", clean.duration_seconds(F.col("time_taken")).cast("int").alias("seconds"))


@register(
    "coerce_and_impute",
    f"""
    WITH c AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, grade, TRY_CAST(q5 AS DOUBLE) AS q5 FROM ({QUIZ_SQL}) q),
         m AS (SELECT AVG(q5) AS mq FROM c),
         f AS (SELECT id, grade, COALESCE(q5, (SELECT mq FROM m)) AS q5 FROM c)
    SELECT id, ROUND(grade, 4) AS grade, ROUND(q5, 4) AS q5 FROM f
    UNION ALL
    SELECT 'Mean', ROUND(AVG(grade), 4), ROUND(AVG(q5), 4) FROM f
    """,
)
def coerce_and_impute(spark, sf_dir):
    q = quiz_attempts(spark, sf_dir).select(F.col("o_orderkey").cast("string").alias("id"), "grade", "q5")
    typed = clean.coerce_numeric(q, ["q5"])
    filled = clean.impute_mean(typed, ["q5"])
    out = clean.append_mean_row(filled, ["grade", "q5"], "id")
    return out.select("id", F.round("grade", 4).alias("grade"), F.round("q5", 4).alias("q5"))


@register(
    "dedupe_rows",
    "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem",
)
def dedupe_rows(spark, sf_dir):
    li = tables.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return clean.drop_duplicate_rows(li)


@register(
    "column_summary",
    """
    SELECT ROUND(AVG(value), 2) AS mean, ROUND(STDDEV_SAMP(value), 2) AS std,
           ROUND(QUANTILE_CONT(value, 0.25), 2) AS q25, ROUND(QUANTILE_CONT(value, 0.5), 2) AS q50,
           ROUND(QUANTILE_CONT(value, 0.75), 2) AS q75, ROUND(MAX(value), 2) AS max, ROUND(MIN(value), 2) AS min
    FROM events
    """,
)
def column_summary(spark, sf_dir):
    return stats.column_summary(tables.table(spark, sf_dir, "events"), "value")


@register(
    "box_stats",
    """
    WITH q AS (SELECT QUANTILE_CONT(c_acctbal, 0.25) AS q1, QUANTILE_CONT(c_acctbal, 0.5) AS med,
                      QUANTILE_CONT(c_acctbal, 0.75) AS q3 FROM customer)
    SELECT ROUND(q1, 4) AS q1, ROUND(med, 4) AS median, ROUND(q3, 4) AS q3, ROUND(q3 - q1, 4) AS iqr,
           ROUND(MIN(CASE WHEN c_acctbal >= q1 - 1.5 * (q3 - q1) THEN c_acctbal END), 4) AS whisker_low,
           ROUND(MAX(CASE WHEN c_acctbal <= q3 + 1.5 * (q3 - q1) THEN c_acctbal END), 4) AS whisker_high,
           CAST(COUNT(CASE WHEN c_acctbal < q1 - 1.5 * (q3 - q1) OR c_acctbal > q3 + 1.5 * (q3 - q1) THEN 1 END) AS BIGINT) AS outliers
    FROM customer, q GROUP BY q1, med, q3
    """,
)
def box_stats(spark, sf_dir):
    b = stats.box_stats(tables.table(spark, sf_dir, "customer"), "c_acctbal")
    return b.select(*[F.round(c, 4).alias(c) for c in ("q1", "median", "q3", "iqr", "whisker_low", "whisker_high")], "outliers")


@register(
    "column_profile",
    """
    SELECT 'o_orderkey' AS column_name, 'bigint' AS data_type, COUNT(o_orderkey) AS non_null, COUNT(*) - COUNT(o_orderkey) AS nulls, COUNT(DISTINCT o_orderkey) AS distinct_values FROM orders
    UNION ALL SELECT 'o_custkey', 'bigint', COUNT(o_custkey), COUNT(*) - COUNT(o_custkey), COUNT(DISTINCT o_custkey) FROM orders
    UNION ALL SELECT 'o_orderstatus', 'string', COUNT(o_orderstatus), COUNT(*) - COUNT(o_orderstatus), COUNT(DISTINCT o_orderstatus) FROM orders
    UNION ALL SELECT 'o_totalprice', 'double', COUNT(o_totalprice), COUNT(*) - COUNT(o_totalprice), COUNT(DISTINCT o_totalprice) FROM orders
    UNION ALL SELECT 'o_orderdate', 'timestamp_ntz', COUNT(o_orderdate), COUNT(*) - COUNT(o_orderdate), COUNT(DISTINCT o_orderdate) FROM orders
    UNION ALL SELECT 'o_orderpriority', 'string', COUNT(o_orderpriority), COUNT(*) - COUNT(o_orderpriority), COUNT(DISTINCT o_orderpriority) FROM orders
    """,
)
def column_profile(spark, sf_dir):
    return stats.profile(tables.table(spark, sf_dir, "orders"))


@register(
    "table_shape",
    "SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, 6 AS n_columns FROM orders",
)
def table_shape(spark, sf_dir):
    o = tables.table(spark, sf_dir, "orders")
    return o.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(o.columns)))


@register(
    "zero_scorers",
    f"SELECT o_orderkey FROM ({QUIZ_SQL}) q WHERE TRY_CAST(q5 AS DOUBLE) = 0 OR TRY_CAST(q5 AS DOUBLE) IS NULL",
)
def zero_scorers(spark, sf_dir):
    q = clean.coerce_numeric(quiz_attempts(spark, sf_dir), ["q5"])
    return stats.group_members(q, "q5", 0.0).select("o_orderkey")


@register(
    "max_q5_count",
    f"""
    WITH c AS (SELECT TRY_CAST(q5 AS DOUBLE) AS q5 FROM ({QUIZ_SQL}) q)
    SELECT CAST(COUNT(*) AS BIGINT) AS n_at_max FROM c WHERE q5 = (SELECT MAX(q5) FROM c)
    """,
)
def max_q5_count(spark, sf_dir):
    q = clean.coerce_numeric(quiz_attempts(spark, sf_dir), ["q5"])
    return stats.rows_at_max(q, "q5").agg(F.count(F.lit(1)).alias("n_at_max"))


MERGED_SQL = f"""
    WITH a AS (SELECT id, quiz, grade, CAST({DURATION_SQL} AS INTEGER) AS secs FROM ({QUIZ_SQL}) q),
         x AS (SELECT id, MAX(grade) AS grade, MIN(secs) AS time FROM a WHERE quiz = 'F' GROUP BY id),
         y AS (SELECT id, MAX(grade) AS grade, MIN(secs) AS time FROM a WHERE quiz = 'O' GROUP BY id)
    SELECT x.id, x.grade AS grade_x, y.grade AS grade_y, x.time AS time_x, y.time AS time_y,
           ROUND(x.grade + y.grade, 2) AS Total_score
    FROM x JOIN y ON x.id = y.id
"""


def merged_quizzes(spark, sf_dir):
    """Inner join of two per-customer quiz summaries; colliding names get _x/_y."""
    a = quiz_attempts(spark, sf_dir).select(
        "id", "quiz", "grade", clean.duration_seconds(F.col("time_taken")).cast("int").alias("secs")
    )

    def best(status, suffix):
        return a.where(F.col("quiz") == status).groupBy("id").agg(
            F.max("grade").alias(f"grade_{suffix}"), F.min("secs").alias(f"time_{suffix}")
        )

    m = best("F", "x").join(best("O", "y"), "id")
    return m.withColumn("Total_score", F.round(F.col("grade_x") + F.col("grade_y"), 2))


@register("merge_total_score", MERGED_SQL)
def merge_total_score(spark, sf_dir):
    return merged_quizzes(spark, sf_dir)


@register("max_scorers", f"WITH m AS ({MERGED_SQL}) SELECT id, Total_score FROM m WHERE Total_score = (SELECT MAX(Total_score) FROM m)")
def max_scorers(spark, sf_dir):
    return stats.rows_at_max(merged_quizzes(spark, sf_dir), "Total_score").select("id", "Total_score")


@register("fast_finishers", f"SELECT id FROM ({MERGED_SQL}) m WHERE time_x + time_y <= 1200 ORDER BY id")
def fast_finishers(spark, sf_dir):
    m = merged_quizzes(spark, sf_dir)
    return m.where(F.col("time_x") + F.col("time_y") <= 1200).select("id").orderBy("id")


@register(
    "equal_width_bins",
    """
    WITH s AS (SELECT MIN(c_acctbal) AS lo, MAX(c_acctbal) AS hi FROM customer),
         b AS (SELECT CASE WHEN c_acctbal <= lo + (hi - lo) / 5 * 1 THEN 1
                           WHEN c_acctbal <= lo + (hi - lo) / 5 * 2 THEN 2
                           WHEN c_acctbal <= lo + (hi - lo) / 5 * 3 THEN 3
                           WHEN c_acctbal <= lo + (hi - lo) / 5 * 4 THEN 4 ELSE 5 END AS bin
               FROM customer, s WHERE c_acctbal IS NOT NULL),
         g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 6))
    SELECT g.bin,
           ROUND(CASE WHEN g.bin = 1 THEN lo - (hi - lo) * 0.001 ELSE lo + (hi - lo) / 5 * (g.bin - 1) END, 4) AS lower,
           ROUND(CASE WHEN g.bin = 5 THEN hi ELSE lo + (hi - lo) / 5 * g.bin END, 4) AS upper,
           CAST((SELECT COUNT(*) FROM b WHERE b.bin = g.bin) AS BIGINT) AS count
    FROM g, s
    """,
)
def equal_width_bins(spark, sf_dir):
    c = tables.table(spark, sf_dir, "customer")
    b = clean.bin_counts(c, "c_acctbal", 5)
    return b.select("bin", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"), "count")


SPLIT_LI_SQL = f"(((l_orderkey % {M}) * 1103515245 + (l_linenumber % {M}) * 12345 + 7 * 12347) % {M}) % 10"


@register(
    "min_max_scaled",
    f"""
    WITH t AS (SELECT * FROM lineitem WHERE {SPLIT_LI_SQL} < 7),
         s AS (SELECT MIN(l_quantity) AS q0, MAX(l_quantity) AS q1, MIN(l_extendedprice) AS p0,
                      MAX(l_extendedprice) AS p1, MIN(l_discount) AS d0, MAX(l_discount) AS d1 FROM t)
    SELECT l_orderkey, l_linenumber,
           ROUND((l_quantity - q0) / (q1 - q0), 6) AS l_quantity,
           ROUND((l_extendedprice - p0) / (p1 - p0), 6) AS l_extendedprice,
           ROUND((l_discount - d0) / (d1 - d0), 6) AS l_discount,
           CAST(1.0 AS DOUBLE) AS intercept
    FROM lineitem, s WHERE {SPLIT_LI_SQL} >= 7
    """,
)
def min_max_scaled(spark, sf_dir):
    from tessera.functions.ordering import hash_uniform

    li = tables.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"
    )
    bucket = F.pmod(hash_uniform("l_orderkey", "l_linenumber", 7), F.lit(10))
    train, test = li.where(bucket < 7), li.where(bucket >= 7)
    cols = ["l_quantity", "l_extendedprice", "l_discount"]
    scaled = clean.with_intercept(clean.min_max_scale(train, test, cols))
    return scaled.select("l_orderkey", "l_linenumber", *[F.round(c, 6).alias(c) for c in cols], "intercept")


P_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@register(
    "dummy_columns",
    "SELECT p_partkey, p_type, "
    + ", ".join(f"CASE WHEN p_type = '{v}' THEN 1 ELSE 0 END AS p_type_{v}" for v in P_TYPES)
    + " FROM part",
)
def dummy_columns(spark, sf_dir):
    p = tables.table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return clean.one_hot(p, "p_type", clean.distinct_levels(p, "p_type"))


@register(
    "head_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def head_rows(spark, sf_dir):
    o = tables.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return clean.head(o, 10, [F.col("o_totalprice").desc(), "o_orderkey"])
