"""Word-vector queries over a ``(key, vector array<double>)`` table.

A query vector is built by one small aggregate and attached to every row as a
scalar subquery, so scoring the whole table is a single map-only pass followed
by a top-k (TakeOrderedAndProject). No join against the query side is needed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.vectors import cosine, dot, scale, unit
from tessera.session import cut_lineage


def mean_vector(vectors: DataFrame, vec: str = "vector") -> DataFrame:
    """One row ``(mean)``: element-wise mean of the vectors (posexplode + avg + ordered collect)."""
    per = vectors.select(F.posexplode(vec).alias("pos", "v")).groupBy("pos").agg(F.avg("v").alias("m"))
    return per.agg(F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("s")).select(F.col("s.m").alias("mean"))


def weighted_unit_mean(vectors: DataFrame, weights: dict, key: str = "key", vec: str = "vector") -> DataFrame:
    """One row ``(mean)`` = unit(Σ w_k · unit(v_k)) / over the keys in ``weights``."""
    w = F.create_map(*[x for k, wt in weights.items() for x in (F.lit(k), F.lit(float(wt)))])
    picked = vectors.where(F.col(key).isin(list(weights))).select(scale(unit(F.col(vec)), w[F.col(key)]).alias("u"))
    summed = mean_vector(picked.select(F.col("u").alias(vec)), vec)
    return summed.select(unit(F.col("mean")).alias("mean"))


def most_similar(vectors: DataFrame, positive: list, negative: list | None = None, topn: int = 10, key: str = "key", vec: str = "vector") -> DataFrame:
    """Keys most similar to unit(mean of +unit(positive), −unit(negative)); inputs excluded."""
    negative = negative or []
    weights = {k: 1.0 for k in positive} | {k: -1.0 for k in negative}
    q = weighted_unit_mean(vectors, weights, key, vec).select("mean").scalar()
    # the scalar subquery becomes a column first: subqueries may not sit inside lambdas
    scored = (
        vectors.where(~F.col(key).isin(list(weights)))
        .withColumn("_q", q)
        .select(key, dot(unit(F.col(vec)), F.col("_q")).alias("similarity"))
    )
    return scored.orderBy(F.col("similarity").desc(), F.col(key)).limit(topn)


def most_similar_cosmul(vectors: DataFrame, positive: list, negative: list | None = None, topn: int = 10, key: str = "key", vec: str = "vector") -> DataFrame:
    """Multiplicative combination: Π (1 + cos(x, p))/2 / (Π (1 + cos(x, n))/2 + 1e-6)."""
    negative = negative or []
    inputs = vectors.where(F.col(key).isin(positive + negative)).select(key, unit(F.col(vec)).alias("u"))
    pos_u = inputs.where(F.col(key).isin(positive)).agg(F.collect_list("u").alias("p")).select("p").scalar()
    neg_u = inputs.where(F.col(key).isin(negative)).agg(F.collect_list("u").alias("n")).select("n").scalar()
    x = unit(F.col(vec))
    prod = lambda arr: F.aggregate(arr, F.lit(1.0), lambda acc, u: acc * ((dot(x, u) + 1) / 2))
    scored = (
        vectors.where(~F.col(key).isin(positive + negative))
        .withColumn("_p", pos_u)
        .withColumn("_n", neg_u)
        .select(key, (prod(F.col("_p")) / (prod(F.col("_n")) + 1e-6)).alias("similarity"))
    )
    return scored.orderBy(F.col("similarity").desc(), F.col(key)).limit(topn)


def doesnt_match(vectors: DataFrame, keys: list, key: str = "key", vec: str = "vector") -> DataFrame:
    """The key among ``keys`` least similar to the unit mean of their unit vectors (unknown keys dropped)."""
    picked = vectors.where(F.col(key).isin(keys)).select(key, unit(F.col(vec)).alias("u"))
    mean = mean_vector(picked.select(F.col("u").alias("v")), "v").select(unit(F.col("mean"))).scalar()
    scored = picked.withColumn("_m", mean).select(key, dot(F.col("u"), F.col("_m")).alias("similarity"))
    return scored.orderBy("similarity", key).limit(1)


def n_similarity(vectors: DataFrame, keys1: list, keys2: list, key: str = "key", vec: str = "vector") -> DataFrame:
    """Cosine of the mean raw vectors of two key sets."""
    m1 = mean_vector(vectors.where(F.col(key).isin(keys1)).select(vec), vec).withColumnRenamed("mean", "a")
    m2 = mean_vector(vectors.where(F.col(key).isin(keys2)).select(vec), vec).select("mean").scalar()
    return m1.withColumn("b", m2).select(cosine(F.col("a"), F.col("b")).alias("similarity"))


def similarity(vectors: DataFrame, k1, k2, key: str = "key", vec: str = "vector") -> DataFrame:
    a = vectors.where(F.col(key) == F.lit(k1)).select(F.col(vec).alias("a"))
    b = vectors.where(F.col(key) == F.lit(k2)).select(vec).scalar()
    return a.withColumn("b", b).select(cosine(F.col("a"), F.col("b")).alias("similarity"))


def unit_vectors(vectors: DataFrame, key: str = "key", vec: str = "vector") -> DataFrame:
    return vectors.select(key, unit(F.col(vec)).alias(vec))


def lookup(vectors: DataFrame, keys: DataFrame, key: str = "key") -> DataFrame:
    """Vectors of the requested keys (semi-join); keys absent from the table are simply not returned."""
    return vectors.join(keys.select(key), key, "left_semi")


def centroids(rows: DataFrame, group: str, vec: str = "x") -> DataFrame:
    """``(group, centroid)`` element-wise mean per group (posexplode + grouped avg)."""
    per = rows.select(group, F.posexplode(vec).alias("pos", "v")).groupBy(group, "pos").agg(F.avg("v").alias("m"))
    return per.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("pos", "m"))).alias("s")).select(
        group, F.col("s.m").alias("centroid")
    )


__all__ = [
    "analogy_accuracy", "analogy_predictions", "centroids", "doesnt_match", "lookup", "mean_vector", "most_similar", "most_similar_cosmul",
    "n_similarity", "similarity", "unit_vectors", "weighted_unit_mean",
]


def analogy_predictions(vectors: DataFrame, questions: DataFrame, key: str = "key", vec: str = "vector", block: int = 8192) -> DataFrame:
    """Answer ``a : b :: c : ?`` questions: the vocabulary key maximising
    unit(x) · (unit(b) − unit(a) + unit(c)), a, b and c excluded, ties → smallest key.

    Every key of ``vectors`` is a candidate. The questions' target vectors come from joins;
    they are numbered and taken ``block`` at a time. Such a block (``block`` × dimension
    doubles, whatever the vocabulary) is shipped to the tasks, each of which scores its part of
    the vocabulary batch by batch and keeps one best key a question; the parts' best are merged
    by an aggregation. Questions with a key that has no vector, or a zero one, are skipped.
    ``questions(qid, section, a, b, c, expected)``; ``qid`` is unique.
    """
    from pyspark.sql import types as T

    from tessera.functions.ordering import with_global_position

    units = cut_lineage(vectors.select(key, unit(F.col(vec)).alias("u")).where(F.col("u").isNotNull()))
    target = questions.select("qid", "section", "a", "b", "c", "expected")
    for word in ("a", "b", "c"):
        target = target.join(units.select(F.col(key).alias(word), F.col("u").alias(f"u{word}")), word)
    shift = F.zip_with(F.zip_with("ub", "ua", lambda x, y: x - y), "uc", lambda x, y: x + y)
    asked = cut_lineage(with_global_position(target.withColumn("q", shift).drop("ua", "ub", "uc"), ["qid"], "n"))
    schema = T.StructType([
        T.StructField("qid", questions.schema["qid"].dataType), T.StructField("score", T.DoubleType()),
        T.StructField("predicted", vectors.schema[key].dataType),
    ])
    total = asked.agg(F.max("n")).first()[0]
    best = [
        units.mapInPandas(_best_keys(asked.where((F.col("n") >= at) & (F.col("n") < at + block)).toPandas(), key), schema)
        for at in range(0, 0 if total is None else total + 1, block)
    ]
    if not best:
        return asked.select("qid", "section", F.lit(None).cast(vectors.schema[key].dataType).alias("predicted"), "expected")
    found = reduce(DataFrame.union, best).groupBy("qid").agg(
        F.min_by("predicted", F.struct(-F.col("score"), F.col("predicted"))).alias("predicted")
    )
    return asked.join(found, "qid").select("qid", "section", "predicted", "expected")


def _best_keys(asked, key: str):
    """A task's function: the best key of its rows for each question of the block ``asked``."""
    import numpy as np
    import pandas as pd

    targets = np.vstack(asked["q"].to_numpy()).T
    words = asked[["a", "b", "c"]].to_numpy()
    qids = asked["qid"].to_numpy()
    asking = pd.DataFrame({"word": words.ravel(), "column": np.repeat(np.arange(len(qids)), 3)})

    def score(batches):
        top, who = np.full(len(qids), -np.inf), np.empty(len(qids), dtype=object)
        for rows in batches:
            rows = rows.sort_values(key, ignore_index=True)
            for at in range(0, len(rows), 1024):
                part = rows.iloc[at : at + 1024]
                keys = part[key].to_numpy()
                scores = np.vstack(part["u"].to_numpy()) @ targets
                own = pd.DataFrame({"word": keys, "row": np.arange(len(keys))}).merge(asking, on="word")
                scores[own["row"], own["column"]] = -np.inf
                row = scores.argmax(axis=0)  # ties: the smallest key, as rows are sorted
                value = scores[row, np.arange(len(qids))]
                better = value > top
                for q in np.flatnonzero((value == top) & np.isfinite(value)):
                    better[q] = keys[row[q]] < who[q]
                top[better], who[better] = value[better], keys[row[better]]
        seen = np.isfinite(top)
        if seen.any():
            yield pd.DataFrame({"qid": qids[seen], "score": top[seen], "predicted": who[seen].tolist()})

    return score


def analogy_accuracy(predictions: DataFrame) -> DataFrame:
    """``(section, correct, total, accuracy)`` per section plus a ``total`` row."""
    hit = (F.col("predicted") == F.col("expected")).cast("int")
    per = predictions.groupBy("section").agg(F.sum(hit).alias("correct"), F.count(F.lit(1)).alias("total"))
    all_ = predictions.agg(F.lit("total").alias("section"), F.sum(hit).alias("correct"), F.count(F.lit(1)).alias("total"))
    return per.unionByName(all_).withColumn("accuracy", F.col("correct") / F.col("total"))
