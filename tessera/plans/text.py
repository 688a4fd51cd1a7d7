"""Text and sentiment queries: labelled documents stand in for reviews (class = quality)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions.ordering import hash_uniform, rank_within
from tessera.operators import classify, docvec
from tessera.operators import text as ops
from tessera.plans.registry import register
from tessera.session import cut_lineage
from tessera.sources import tables

M = 2147483647
WS = T.WS
STOP_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in T.ENGLISH_STOP_WORDS) + "]"

REVIEWS_SQL = f"""
    SELECT * FROM (
        SELECT d.doc_id, l.quality AS label,
               CASE WHEN (((d.doc_id % {M}) * 1103515245 + 11 * 12345) % {M}) % 10 < 8 THEN 'train' ELSE 'test' END AS part,
               list_transform(list_filter(regexp_split_to_array(d.text, '{WS}'), lambda t: length(t) >= 3), lambda t: lower(t)) AS tokens
        FROM documents d JOIN labels l ON l.doc_id = d.doc_id) r
    WHERE len(tokens) > 0
"""
TRAIN_SQL = f"SELECT * FROM ({REVIEWS_SQL}) r WHERE part = 'train'"
DF_SQL = f"""
    SELECT word, CAST(COUNT(*) FILTER (WHERE label = 1) AS BIGINT) AS pos_df,
           CAST(COUNT(*) FILTER (WHERE label = 0) AS BIGINT) AS neg_df
    FROM (SELECT DISTINCT doc_id, label, unnest(tokens) AS word FROM ({TRAIN_SQL}) t) w GROUP BY word
"""
FEATURES_SQL = f"""
    WITH df AS ({DF_SQL}),
    n AS (SELECT COUNT(*) FILTER (WHERE label = 1) AS n_pos, COUNT(*) FILTER (WHERE label = 0) AS n_neg FROM ({TRAIN_SQL}) t)
    SELECT word, pos_df, neg_df FROM df, n
    WHERE NOT list_contains({STOP_SQL}, word)
      AND (pos_df >= n_pos * 0.01 OR neg_df >= n_neg * 0.01)
      AND (pos_df >= 2 * neg_df OR neg_df >= 2 * pos_df)
"""


def reviews(spark, sf_dir):
    """``(doc_id, label, part, tokens)``; documents without a token of length ≥ 3 dropped."""
    d = tables.table(spark, sf_dir, "documents")
    lab = tables.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    part = F.when(F.pmod(hash_uniform("doc_id", 11), F.lit(10)) < 8, "train").otherwise("test")
    r = d.join(lab, "doc_id").select("doc_id", "label", part.alias("part"), T.review_tokens(F.col("text")).alias("tokens"))
    return r.where(F.size("tokens") > 0)


def _split(spark, sf_dir):
    r = reviews(spark, sf_dir)
    return _parts(r)


def _parts(r):
    return r.where(F.col("part") == "train"), r.where(F.col("part") == "test")


def _features(spark, sf_dir):
    return _feature_words(_split(spark, sf_dir)[0])


def _feature_words(train):
    from pyspark.ml.feature import StopWordsRemover

    return ops.feature_words(train, StopWordsRemover.loadDefaultStopWords("english"))


def _written_split(spark, sf_dir):
    """Train, test and feature words from tokens written once."""
    train, test = _parts(cut_lineage(reviews(spark, sf_dir)))
    return train, test, cut_lineage(_feature_words(train))


@register(
    "tokens_clean",
    f"SELECT doc_id, label, part, CAST(len(tokens) AS INTEGER) AS n_tokens, CAST(len(list_distinct(tokens)) AS INTEGER) AS n_distinct FROM ({REVIEWS_SQL}) r",
)
def tokens_clean(spark, sf_dir):
    r = reviews(spark, sf_dir)
    return r.select("doc_id", "label", "part", F.size("tokens").alias("n_tokens"), F.size(F.array_distinct("tokens")).alias("n_distinct"))


@register("doc_frequency", DF_SQL)
def doc_frequency(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    return ops.doc_frequency_by_class(train)


@register("feature_words", FEATURES_SQL)
def feature_words(spark, sf_dir):
    return _features(spark, sf_dir).select("word", "pos_df", "neg_df")


@register(
    "binary_bow",
    f"""
    WITH f AS ({FEATURES_SQL}), r AS ({REVIEWS_SQL})
    SELECT r.doc_id, COALESCE((SELECT list_sort(list(DISTINCT w.word)) FROM (SELECT unnest(r.tokens) AS word) w
                              WHERE w.word IN (SELECT word FROM f)), []) AS features
    FROM r
    """,
)
def binary_bow(spark, sf_dir):
    return ops.binary_features(reviews(spark, sf_dir), _features(spark, sf_dir))


NB_SQL = f"""
    WITH f AS ({FEATURES_SQL}), t AS ({TRAIN_SQL}),
    nc AS (SELECT label, COUNT(*) AS n_c FROM t GROUP BY label),
    pri AS (SELECT label, LN(n_c + 1) - LN((SELECT SUM(n_c) FROM nc) + (SELECT COUNT(*) FROM nc)) AS log_prior FROM nc),
    dfc AS (SELECT label, word, COUNT(*) AS df FROM (SELECT DISTINCT doc_id, label, unnest(tokens) AS word FROM t) x
            WHERE word IN (SELECT word FROM f) GROUP BY label, word),
    theta AS (SELECT nc.label, f.word, LN(COALESCE(dfc.df, 0) + 1) - LN(nc.n_c + 2) AS log_p
              FROM f CROSS JOIN nc LEFT JOIN dfc ON dfc.label = nc.label AND dfc.word = f.word)
"""


@register("bernoulli_nb_params", NB_SQL + " SELECT label, word, ROUND(log_p, 6) AS log_p FROM theta")
def bernoulli_nb_params(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    _, theta = classify.bernoulli_nb_fit(train, _features(spark, sf_dir))
    return theta.select("label", "word", F.round("log_p", 6).alias("log_p"))


@register("nb_priors", NB_SQL + " SELECT label, ROUND(log_prior, 6) AS log_prior FROM pri")
def nb_priors(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    priors, _ = classify.bernoulli_nb_fit(train, _features(spark, sf_dir))
    return priors.select("label", F.round("log_prior", 6).alias("log_prior"))


NB_PRED_SQL = (
    NB_SQL
    + f""",
    th AS (SELECT label, word, log_p, LN(1 - EXP(log_p)) AS log_q FROM theta),
    base AS (SELECT th.label, pri.log_prior + SUM(th.log_q) AS base FROM th JOIN pri ON pri.label = th.label GROUP BY th.label, pri.log_prior),
    te AS (SELECT * FROM ({REVIEWS_SQL}) r WHERE part = 'test'),
    gain AS (SELECT x.doc_id, th.label, SUM(th.log_p - th.log_q) AS g
             FROM (SELECT DISTINCT doc_id, unnest(tokens) AS word FROM te) x JOIN th ON th.word = x.word GROUP BY x.doc_id, th.label),
    score AS (SELECT te.doc_id, te.label AS truth, base.label, base.base + COALESCE(gain.g, 0) AS s
              FROM te CROSS JOIN base LEFT JOIN gain ON gain.doc_id = te.doc_id AND gain.label = base.label),
    pred AS (SELECT doc_id, truth, arg_min(label, (-s, label)) AS pred FROM score GROUP BY doc_id, truth)
"""
)


def _nb_test_predictions(spark, sf_dir):
    train, test, features = _written_split(spark, sf_dir)
    priors, theta = classify.bernoulli_nb_fit(train, features)
    theta = cut_lineage(theta)
    pred = classify.bernoulli_nb_predict(test, priors, theta)
    return test.select("doc_id", F.col("label").alias("truth")).join(pred, "doc_id")


@register("nb_predictions", NB_PRED_SQL + " SELECT doc_id, truth, pred FROM pred")
def nb_predictions(spark, sf_dir):
    return _nb_test_predictions(spark, sf_dir)


NB_EVAL_SQL = (
    NB_PRED_SQL
    + """
    SELECT COUNT(*) FILTER (WHERE truth = 1 AND pred = 1) AS tp, COUNT(*) FILTER (WHERE truth = 1 AND pred = 0) AS fn,
           COUNT(*) FILTER (WHERE truth = 0 AND pred = 1) AS fp, COUNT(*) FILTER (WHERE truth = 0 AND pred = 0) AS tn,
           ROUND(AVG(CASE WHEN truth = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pred
    """
)


@register("nb_eval", NB_EVAL_SQL)
def nb_eval(spark, sf_dir):
    e = classify.binary_eval(_nb_test_predictions(spark, sf_dir), "truth", "pred")
    return e.select("tp", "fn", "fp", "tn", F.round("accuracy", 6).alias("accuracy"))


def _vectors(spark, sf_dir):
    """Binary vectors of the training and the test part. The vocabulary on the driver does not
    grow with the corpus: a feature word is in a hundredth of a class's documents, so there are
    at most 100 words for each distinct word that the class's documents hold on average."""
    train, test, features = _written_split(spark, sf_dir)
    words = sorted(r.word for r in features.select("word").collect())
    return classify.to_vectors(train, words), classify.to_vectors(test, words), len(words)


@register("spark_nb_eval", NB_EVAL_SQL)
def spark_nb_eval(spark, sf_dir):
    """Spark ML Bernoulli naive Bayes on the binary vectors."""
    tr, te, _ = _vectors(spark, sf_dir)
    model = classify.spark_naive_bayes("bernoulli").fit(tr.withColumn("label", F.col("label").cast("double")))
    pred = model.transform(te).select(F.col("label").alias("truth"), F.col("prediction").cast("int").alias("pred"))
    e = classify.binary_eval(pred, "truth", "pred")
    return e.select("tp", "fn", "fp", "tn", F.round("accuracy", 6).alias("accuracy"))


@register("lr_eval")
def lr_eval(spark, sf_dir):
    """Logistic regression (L2, C = 1) on the binary vectors (model-valued: rows only)."""
    tr, te, _ = _vectors(spark, sf_dir)
    n = tr.count()
    model = classify.spark_logistic_regression(n).fit(tr.withColumn("label", F.col("label").cast("double")))
    pred = model.transform(te).select(F.col("label").alias("truth"), F.col("prediction").cast("int").alias("pred"))
    return classify.binary_eval(pred, "truth", "pred")


@register(
    "gaussian_nb_params",
    """
    SELECT label, CAST(pos - 1 AS INTEGER) AS pos, ROUND(AVG(v), 6) AS mean, ROUND(VAR_POP(v), 6) AS var FROM (
        SELECT label, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) e
    GROUP BY label, pos
    """,
)
def gaussian_nb_params(spark, sf_dir):
    e = tables.table(spark, sf_dir, "embeddings").select("label", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    g = classify.gaussian_nb_params(e, "label", "x")
    return g.select("label", "pos", F.round("mean", 6).alias("mean"), F.round("var", 6).alias("var"))


GNB_SQL = f"""
    WITH r AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x,
                      (((vec_id % {M}) * 1103515245 + 23 * 12345) % {M}) % 10 < 8 AS train FROM embeddings WHERE label IS NOT NULL),
    f AS (SELECT vec_id, label, train, generate_subscripts(x, 1) AS pos, unnest(x) AS v FROM r),
    eps AS (SELECT 1e-9 * MAX(s) AS e FROM (SELECT VAR_POP(v) AS s FROM f WHERE train GROUP BY pos) q),
    pr AS (SELECT label, pos, AVG(v) AS m, VAR_POP(v) + (SELECT e FROM eps) AS s FROM f WHERE train GROUP BY label, pos),
    pri AS (SELECT label, LN(COUNT(*)) - LN((SELECT COUNT(*) FROM r WHERE train)) AS p FROM r WHERE train GROUP BY label),
    sc AS (SELECT f.vec_id, f.label AS truth, pr.label,
                  ANY_VALUE(pri.p) - 0.5 * SUM(LN(2 * PI() * pr.s) + (f.v - pr.m) * (f.v - pr.m) / pr.s) AS score
           FROM f JOIN pr ON pr.pos = f.pos JOIN pri ON pri.label = pr.label WHERE NOT f.train GROUP BY f.vec_id, f.label, pr.label),
    pred AS (SELECT vec_id, truth, arg_min(label, (-score, label)) AS pred FROM sc GROUP BY vec_id, truth)
"""


def _gaussian_nb(spark, sf_dir):
    """``(vec_id, truth, pred)`` of the held-out fifth, by parameters of the rest."""
    e = tables.table(spark, sf_dir, "embeddings").where(F.col("label").isNotNull())
    r = e.select("vec_id", "label", F.transform("embedding", lambda x: x.cast("double")).alias("x"))
    train = F.pmod(hash_uniform("vec_id", 23), F.lit(10)) < 8
    model = classify.gaussian_nb_fit(r.where(train), "label", "x")
    test = r.where(~train).select("vec_id", F.col("label").alias("truth"), "x")
    pred = classify.gaussian_nb_predict(test.select("vec_id", "x"), model, "vec_id", "label", "x")
    return test.select("vec_id", "truth").join(pred, "vec_id")


@register("gaussian_nb_predictions", GNB_SQL + " SELECT vec_id, truth, pred FROM pred")
def gaussian_nb_predictions(spark, sf_dir):
    return _gaussian_nb(spark, sf_dir)


@register(
    "gaussian_nb_eval",
    GNB_SQL + """
    SELECT truth, pred, COUNT(*) AS count, ROUND(COUNT(*) / SUM(COUNT(*)) OVER (PARTITION BY truth), 6) AS share
    FROM pred GROUP BY truth, pred
    """,
)
def gaussian_nb_eval(spark, sf_dir):
    """Confusion counts and each one's share of its true class."""
    cells = _gaussian_nb(spark, sf_dir).groupBy("truth", "pred").agg(F.count(F.lit(1)).alias("count"))
    per = cells.groupBy("truth").agg(F.sum("count").alias("n"))
    return cells.join(per, "truth").select("truth", "pred", "count", F.round(F.col("count") / F.col("n"), 6).alias("share"))


RAW_TOK_SQL = f"SELECT doc_id, list_filter(regexp_split_to_array(text, '{WS}'), lambda t: t <> '') AS tokens FROM documents"


def raw_tokens(spark, sf_dir):
    d = tables.table(spark, sf_dir, "documents")
    return d.select("doc_id", T.split_ws(F.col("text")).alias("tokens"))


WC_SQL = f"""
    SELECT word, count, ROW_NUMBER() OVER (ORDER BY count DESC, word) - 1 AS idx FROM (
        SELECT word, COUNT(*) AS count FROM (SELECT unnest(tokens) AS word FROM ({RAW_TOK_SQL}) t) w GROUP BY word) c
    WHERE count >= 5
"""


@register("word_counts_min", WC_SQL)
def word_counts_min(spark, sf_dir):
    return ops.word_counts(raw_tokens(spark, sf_dir), min_count=5)


@register(
    "subsample_prob",
    f"""
    WITH c AS ({WC_SQL}), t AS (SELECT SUM(count) * 0.001 AS t FROM c)
    SELECT word, count, ROUND(LEAST(1.0, (SQRT(count / t) + 1) * t / count), 8) AS keep_prob FROM c, t
    """,
)
def subsample_prob(spark, sf_dir):
    k = ops.keep_probability(ops.word_counts(raw_tokens(spark, sf_dir), min_count=5), sample=1e-3)
    return k.select("word", "count", F.round("keep_prob", 8).alias("keep_prob"))


@register(
    "subsampled_tokens",
    f"""
    WITH c AS ({WC_SQL}), t AS (SELECT SUM(count) * 0.001 AS t FROM c),
    k AS (SELECT word, LEAST(1.0, (SQRT(count / t) + 1) * t / count) AS keep_prob FROM c, t),
    p AS (SELECT doc_id, CAST(generate_subscripts(tokens, 1) - 1 AS INTEGER) AS pos, unnest(tokens) AS word FROM ({RAW_TOK_SQL}) r)
    SELECT doc_id, pos, p.word FROM p JOIN k ON k.word = p.word
    WHERE CAST('0x' || substr(md5(concat_ws('|', doc_id, pos, 5)), 1, 8) AS BIGINT) < keep_prob * 4294967296.0
    """,
)
def subsampled_tokens(spark, sf_dir):
    docs = raw_tokens(spark, sf_dir)
    return ops.subsample(docs, ops.word_counts(docs, min_count=5), sample=1e-3)


@register(
    "context_pairs",
    f"""
    WITH p AS (SELECT doc_id, generate_subscripts(tokens, 1) AS pos, unnest(tokens) AS word FROM ({RAW_TOK_SQL}) t)
    SELECT a.word, COUNT(*) AS contexts FROM p a JOIN p b ON a.doc_id = b.doc_id
      AND b.pos BETWEEN a.pos - 2 AND a.pos + 2 AND b.pos <> a.pos
    GROUP BY a.word
    """,
)
def context_pairs(spark, sf_dir):
    return ops.context_counts(raw_tokens(spark, sf_dir), window=2)


@register(
    "context_pair_counts",
    f"""
    WITH p AS (SELECT doc_id, generate_subscripts(tokens, 1) AS pos, unnest(tokens) AS word FROM ({RAW_TOK_SQL}) t)
    SELECT a.word, b.word AS context, COUNT(*) AS count FROM p a JOIN p b ON a.doc_id = b.doc_id
      AND b.pos BETWEEN a.pos - 2 AND a.pos + 2 AND b.pos <> a.pos
    GROUP BY a.word, b.word
    """,
)
def context_pair_counts(spark, sf_dir):
    """The (word, context) pairs within two tokens of each other and how often each occurs."""
    return ops.context_pair_counts(raw_tokens(spark, sf_dir), window=2)


@register(
    "rechunk_tokens",
    f"""
    WITH p AS (SELECT doc_id, generate_subscripts(tokens, 1) - 1 AS pos, unnest(tokens) AS tok FROM ({RAW_TOK_SQL}) t)
    SELECT doc_id, CAST(FLOOR(pos / 1000) AS BIGINT) AS chunk, list(tok ORDER BY pos) AS tokens
    FROM p GROUP BY doc_id, FLOOR(pos / 1000)
    """,
)
def rechunk_tokens(spark, sf_dir):
    return ops.rechunk(raw_tokens(spark, sf_dir), 1000)


@register(
    "tagged_tokens",
    f"""
    WITH tg AS (SELECT doc_id, array_to_string(list_transform(list_filter(regexp_split_to_array(text, '{WS}'), lambda t: t <> ''),
                   lambda t: t || '/' || CASE WHEN length(t) % 2 = 0 THEN upper(lang) ELSE upper(source) END), ' ') AS tagged
                FROM documents)
    SELECT doc_id, list_transform(list_filter(list_filter(regexp_split_to_array(tagged, '{WS}'), lambda t: t <> ''),
                                              lambda t: regexp_matches(t, '^[^/]+/[A-Za-z]+$')),
                                  lambda t: lower(split_part(t, '/', 1)) || '/' || substr(split_part(t, '/', -1), 1, 2)) AS tokens
    FROM tg
    """,
)
def tagged_tokens(spark, sf_dir):
    """Tagged corpus stand-in: each token tagged with its language (even length) or source
    (odd length, not alphabetic, so dropped by the parser)."""
    d = tables.table(spark, sf_dir, "documents")
    tag = lambda t: F.concat(t, F.lit("/"), F.when(F.length(t) % 2 == 0, F.upper("lang")).otherwise(F.upper("source")))
    tagged = d.select("doc_id", F.array_join(F.transform(T.split_ws(F.col("text")), tag), " ").alias("tagged"))
    return tagged.select("doc_id", T.tagged_tokens(F.col("tagged")).alias("tokens"))


TRACK = ["license", "secret"]


@register(
    "tracked_messages",
    f"SELECT doc_id FROM documents WHERE lang = 'en' AND regexp_matches(lower(text), '{T.keyword_pattern(TRACK)}')",
)
def tracked_messages(spark, sf_dir):
    d = tables.table(spark, sf_dir, "documents")
    return d.where((F.col("lang") == "en") & T.matches_any(F.col("text"), TRACK)).select("doc_id")


@register(
    "tagged_rows",
    f"""
    SELECT doc_id, tag || '_' || CAST(ROW_NUMBER() OVER (PARTITION BY tag ORDER BY doc_id) - 1 AS VARCHAR) AS row_key FROM (
        SELECT doc_id, upper(part) || '_' || CASE WHEN label = 1 THEN 'POS' ELSE 'NEG' END AS tag FROM ({REVIEWS_SQL}) r) x
    """,
)
def tagged_rows(spark, sf_dir):
    r = reviews(spark, sf_dir).select(
        "doc_id", F.concat(F.upper("part"), F.lit("_"), F.when(F.col("label") == 1, "POS").otherwise("NEG")).alias("tag")
    )
    ranked = rank_within(r, "tag", ["doc_id"], "n")
    return ranked.select("doc_id", F.concat("tag", F.lit("_"), F.col("n").cast("string")).alias("row_key"))


@register("doc_vector_eval")
def doc_vector_eval(spark, sf_dir):
    """Document vectors as the mean of skip-gram word vectors learned from the training part, then
    logistic regression on them (model-valued: rows only)."""
    from pyspark.ml.functions import array_to_vector

    # a row is an example of its own, also where rows share their id
    rows = cut_lineage(reviews(spark, sf_dir).withColumn("doc_id", F.monotonically_increasing_id()))
    words = cut_lineage(docvec.train_words(_parts(rows)[0], size=50, window=5, seed=42))
    vectors = rows.select("doc_id", F.col("label").cast("double").alias("label"), "part").join(docvec.means(rows, words, 50), "doc_id", "left")
    vector = F.coalesce("vector", F.array_repeat(F.lit(0.0).cast("float"), 50))  # no word known
    train, test = _parts(cut_lineage(vectors.select("label", "part", array_to_vector(vector).alias("features"))))
    lr = classify.spark_logistic_regression(train.count()).fit(train)
    pred = lr.transform(test).select(F.col("label").cast("int").alias("truth"), F.col("prediction").cast("int").alias("pred"))
    return classify.binary_eval(pred, "truth", "pred")


def _all_tokens(spark, sf_dir):
    """``(doc_id, tokens)`` of every document with a token of length >= 3, labelled or not."""
    d = tables.table(spark, sf_dir, "documents").select("doc_id", T.review_tokens(F.col("text")).alias("tokens"))
    return cut_lineage(d.where("doc_id is not null and size(tokens) > 0"))


def _held_out_quality(spark, sf_dir, method, vectors):
    """Held-out evaluation of a logistic regression of the label on document vectors."""
    from pyspark.ml.functions import array_to_vector

    labelled = reviews(spark, sf_dir).select("doc_id", F.col("label").cast("double").alias("label"), "part")
    rows = cut_lineage(vectors.join(labelled, "doc_id").select("label", "part", array_to_vector("vector").alias("features")))
    train, test = _parts(rows)
    model = classify.spark_logistic_regression(train.count()).setStandardization(True).fit(train)
    pred = model.transform(test).select(F.col("label").cast("int").alias("truth"), F.col("prediction").cast("int").alias("pred"))
    return classify.binary_eval(pred, "truth", "pred").select(F.lit(method).alias("method"), "*")


@register("paragraph_vector_eval")
def paragraph_vector_eval(spark, sf_dir):
    """Paragraph vectors of all documents (100 dimensions, window 10, 5 noise words, 5 passes), vectors
    inferred against their frozen word vectors, and the mean of these: held-out label prediction
    of each (model-valued: rows only)."""
    docs = _all_tokens(spark, sf_dir)
    vectors, words = (cut_lineage(x) for x in docvec.train(docs))
    inferred = cut_lineage(docvec.infer(docs, words, 100))
    out = _held_out_quality(spark, sf_dir, "trained", vectors)
    out = out.unionByName(_held_out_quality(spark, sf_dir, "inferred", inferred))
    return out.unionByName(_held_out_quality(spark, sf_dir, "mean of words", docvec.means(docs, words, 100)))
