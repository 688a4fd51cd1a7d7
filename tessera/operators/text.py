"""Corpus operators over ``(doc_id, tokens array<string>[, label])`` tables.

All counting is explode + aggregate (map-side combined), so a very frequent
word or a very long document never sits in one task as a whole.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.joins import lookup_join
from tessera.functions.ordering import hash_mixed, with_global_position
from tessera.session import cut_lineage, ship_package

#: Pairs that a task holds before it sends them, about; buckets that pairs are sent in; buckets of one word.
PAIRS_HELD, BUCKETS, CONTEXT_PARTS = 1 << 21, 1 << 12, 8


def doc_frequency_by_class(docs: DataFrame, label: str = "label") -> DataFrame:
    """``(word, pos_df, neg_df)``: number of label-1 / label-0 documents containing the word."""
    words = docs.select(label, F.explode(F.array_distinct("tokens")).alias("word"))
    return words.groupBy("word").agg(
        F.count_if(F.col(label) == 1).alias("pos_df"), F.count_if(F.col(label) == 0).alias("neg_df")
    )


def class_sizes(docs: DataFrame, label: str = "label") -> DataFrame:
    return docs.agg(F.count_if(F.col(label) == 1).alias("n_pos"), F.count_if(F.col(label) == 0).alias("n_neg"))


def feature_words(docs: DataFrame, stop_words: list[str], label: str = "label", min_share: float = 0.01, ratio: float = 2.0) -> DataFrame:
    """Words that are not stop words, occur in ≥ min_share of one class's documents
    and in ≥ ratio× as many documents of one class as of the other.

    Class sizes ride along in the same aggregation as an extra empty-string token
    (tokens are never empty), so the corpus is tokenised and shuffled once; the
    sizes are read back from that aggregate (its exchange is reused).
    """
    marked = docs.select(label, F.explode(F.array_union(F.array_distinct("tokens"), F.array(F.lit("")))).alias("word"))
    df = marked.groupBy("word").agg(
        F.count_if(F.col(label) == 1).alias("pos_df"), F.count_if(F.col(label) == 0).alias("neg_df")
    )
    sizes = df.where(F.col("word") == "").select(F.struct(F.col("pos_df").alias("n_pos"), F.col("neg_df").alias("n_neg"))).scalar()
    n_pos, n_neg = sizes["n_pos"], sizes["n_neg"]
    skewed = (F.col("pos_df") >= ratio * F.col("neg_df")) | (F.col("neg_df") >= ratio * F.col("pos_df"))
    keep = ((F.col("pos_df") >= n_pos * min_share) | (F.col("neg_df") >= n_neg * min_share)) & skewed
    return df.where(F.col("word") != "").where(~F.col("word").isin(stop_words)).where(keep)


def binary_features(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(doc_id, features)``: sorted distinct vocabulary words present in each document
    (the non-zero positions of its binary bag-of-words vector)."""
    present = docs.select("doc_id", F.explode(F.array_distinct("tokens")).alias("word")).join(
        vocab.select("word"), "word", "left_semi"
    )
    feats = present.groupBy("doc_id").agg(F.sort_array(F.collect_list("word")).alias("features"))
    return docs.select("doc_id").join(feats, "doc_id", "left").select(
        "doc_id", F.coalesce("features", F.array().cast("array<string>")).alias("features")
    )


def word_counts(docs: DataFrame, min_count: int = 1) -> DataFrame:
    """``(word, count, idx)``: corpus frequency, min-count filter, index by (count desc, word)."""
    c = docs.select(F.explode("tokens").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    c = c.where(F.col("count") >= min_count)
    return with_global_position(c, [F.col("count").desc(), "word"], "idx")


def keep_probability(counts: DataFrame, sample: float = 1e-3) -> DataFrame:
    """Frequent-word down-sampling: p = min(1, (sqrt(c/t) + 1)·t/c), t = sample · total count."""
    total = counts.agg(F.sum("count")).scalar()
    t = total * F.lit(sample)
    c = F.col("count").cast("double")
    return counts.select("word", "count", F.least(F.lit(1.0), (F.sqrt(c / t) + 1) * t / c).alias("keep_prob"))


def subsample(docs: DataFrame, counts: DataFrame, sample: float = 1e-3, seed: int = 5) -> DataFrame:
    """``(doc_id, pos, word)``: the tokens that frequent-word down-sampling keeps, with their places.

    Each occurrence is kept by its own reproducible draw; words outside ``counts`` are left out.
    """
    tokens = docs.select("doc_id", F.posexplode("tokens").alias("pos", "word"))
    kept = lookup_join(tokens, keep_probability(counts, sample).select("word", "keep_prob"), "word", "inner")
    draw = hash_mixed("doc_id", "pos", seed)
    return kept.where(draw < F.col("keep_prob") * float(1 << 32)).select("doc_id", "pos", "word")


def _by_repeated_id(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``docs`` whose id is on one row only, and those that share theirs (null: one id too) or None.

    Only ids are counted and shuffled; the ids on several rows are written, then looked up.
    """
    shared = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("doc_id").alias("_id"))
    shared = cut_lineage(shared)
    if shared.isEmpty():
        return docs, None
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    return lookup_join(docs, shared, same, "left_anti"), lookup_join(docs, shared, same, "left_semi")


def context_pairs(docs: DataFrame, window: int = 2, after: bool = False) -> DataFrame:
    """``(doc_id, pos, word, context)``: every token with each token within ±window of it, or
    only with those ``after`` it (each unordered pair once).

    The pairs of a document are made from its own row, an offset at a time, by laying its token
    list beside itself: nothing is shuffled. Rows that share their id are one document whose
    places hold several tokens: these alone are joined, on (doc_id, position). Rows without an
    id have no pairs.
    """
    offsets = [o for o in range(1 if after else -window, window + 1) if o != 0]
    single, shared = _by_repeated_id(docs.where(F.col("doc_id").isNotNull()))

    def beside(o: int):
        n, first = F.greatest(F.size("tokens") - abs(o), F.lit(0)), max(-o, 0)
        both = F.arrays_zip(F.slice("tokens", 1 + first, n).alias("w"), F.slice("tokens", 1 + max(o, 0), n).alias("c"))
        return F.transform(both, lambda z, i: F.struct((i + first).alias("pos"), z["w"].alias("word"), z["c"].alias("context")))

    pairs = single.select("doc_id", F.explode(F.concat(*map(beside, offsets))).alias("p")).select("doc_id", "p.pos", "p.word", "p.context")
    if shared is None:
        return pairs
    pos = shared.select("doc_id", F.posexplode("tokens").alias("pos", "word"))
    shifted = pos.select("doc_id", "pos", "word", F.explode(F.array(*[F.lit(o) for o in offsets])).alias("off"))
    ctx = pos.select("doc_id", F.col("pos").alias("cpos"), F.col("word").alias("context"))
    joined = shifted.join(ctx, (shifted.doc_id == ctx.doc_id) & (ctx.cpos == shifted.pos + shifted.off))
    return pairs.unionByName(joined.select(shifted.doc_id, "pos", "word", "context"))


def _combine_pairs(most: int):
    """(word, context) rows, in chunks of about ``most``, as rows (bucket, lines, word, context, n).

    Of two words the smaller one in byte order stands as ``word``. A line is a word, a number n and
    the contexts that the word meets n times in the chunk, a tab between them; a row holds the lines
    of a bucket. A word's contexts are dealt over several buckets by their own hash, so that a
    frequent word is not one bucket. A pair with a null, a tab or a line end has a row of its own.
    """
    schema = pa.schema([("bucket", pa.int32()), ("lines", pa.string()), ("word", pa.string()), ("context", pa.string()), ("n", pa.int64())])

    def joined(values: pa.Array, new: np.ndarray, by: str) -> tuple[pa.Array, np.ndarray]:
        """The values from each place of ``new`` to the next, and the places."""
        starts = np.flatnonzero(new)
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(starts, len(new)), pa.int32()), values), by), starts

    def lined(words: pa.Array, bucket, a, b, n) -> pa.RecordBatch:
        """Pairs sorted by (bucket, word, n) as a row a bucket."""
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (bucket[1:] != bucket[:-1]) | (n[1:] != n[:-1])
        contexts, at = joined(words.take(pa.array(b)), new, "\t")
        lines = pc.binary_join_element_wise(words.take(pa.array(a[at])), pa.array(n[at]).cast(pa.string()), contexts, "\t")
        new = np.ones(len(at), bool)
        new[1:] = bucket[at][1:] != bucket[at][:-1]
        rows, first = joined(lines, new, "\n")
        nulls = [pa.nulls(len(rows), f.type) for f in list(schema)[2:]]
        return pa.RecordBatch.from_arrays([pa.array(bucket[at][first], pa.int32()), rows, *nulls], schema=schema)

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        both = pa.chunked_array(table.column(0).chunks + table.column(1).chunks).dictionary_encode(null_encoding="encode").combine_chunks()
        codes, words = both.indices.to_numpy().astype(np.int64), both.dictionary
        order = pc.sort_indices(words).to_numpy()
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        words, codes = words.take(pa.array(order)), rank[codes]
        first, second = codes[: len(table)], codes[len(table) :]
        a, b = np.minimum(first, second), np.maximum(first, second)
        crc = np.array([crc32(w or b"") for w in words.cast(pa.binary()).to_pylist()], np.int64)
        bucket = (crc[a] + (crc[b] % CONTEXT_PARTS) * (BUCKETS // CONTEXT_PARTS)) % BUCKETS
        bits = max(len(words) - 1, 1).bit_length()
        keys, n = np.unique((bucket << bits | a) << bits | b, return_counts=True)
        a, b, bucket = keys >> bits & (1 << bits) - 1, keys & (1 << bits) - 1, keys >> 2 * bits
        strange = pc.or_(pc.is_null(words), pc.fill_null(pc.match_substring_regex(words, "[\t\n]"), False)).to_numpy(zero_copy_only=False)
        odd = strange[a] | strange[b]
        once, more, odd = np.flatnonzero(~odd & (n == 1)), np.flatnonzero(~odd & (n > 1)), np.flatnonzero(odd)
        more = more[np.lexsort((n[more], a[more], bucket[more]))]
        for some in (once, more):
            yield lined(words, bucket[some], a[some], b[some], n[some])
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[odd], pa.int32()), pa.nulls(len(odd), pa.string()), words.take(pa.array(a[odd])), words.take(pa.array(b[odd])), pa.array(n[odd], pa.int64())],
            schema=schema,
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= most:
                yield from flush(held)
                held, rows = [], 0
        if rows:
            yield from flush(held)

    return run


def context_pair_counts(docs: DataFrame, window: int = 2, most: int = PAIRS_HELD) -> DataFrame:
    """``(word, context, count)``: how often each pair of tokens lies within ±window.

    If b follows a, then a precedes b: only the tokens after each token are paired, both orders
    of two words are counted under one key, and the counts are mirrored at the end. Most pairs
    are rare, so counting them before the shuffle saves little; what repeats is the word. Tasks
    therefore send, for each ``most`` pairs, a word once with the contexts that it met.
    """
    spark = docs.sparkSession
    ship_package(spark)
    combined = context_pairs(docs, window, after=True).select("word", "context").mapInArrow(
        _combine_pairs(most), "bucket int, lines string, word string, context string, n long"
    )
    # more partitions than bytes ask for: they are counted as pairs, many for each byte shuffled
    sent = combined.repartition(max(200, int(spark.conf.get("spark.sql.shuffle.partitions"))), "bucket")
    # (one path for both kinds of rows: a filter would go below the shuffle and pair everything twice)
    odd = F.col("line").isNull()
    line = sent.select("bucket", "word", "context", "n", F.explode(F.coalesce(F.split("lines", "\n", -1), F.array(F.lit(None)))).alias("line"))
    fields = line.select("bucket", "word", "context", "n", "line", F.split("line", "\t", -1).alias("f"))
    pairs = fields.select(
        "bucket", F.when(odd, F.col("word")).otherwise(F.col("f")[0]).alias("word"), F.when(odd, F.col("n")).otherwise(F.col("f")[1].cast("long")).alias("n"),
        F.explode(F.when(odd, F.array("context")).otherwise(F.slice("f", 3, F.size("f")))).alias("b"),
    )
    counted = pairs.groupBy("bucket", "word", "b").agg(F.sum("n").alias("n"))
    a, b, n = F.col("word"), F.col("b"), F.col("n")
    row = lambda w, c, times: F.struct(w.alias("word"), c.alias("context"), times.alias("count"))
    both = F.when(a.eqNullSafe(b), F.array(row(a, b, n * 2))).otherwise(F.array(row(a, b, n), row(b, a, n)))
    return counted.select(F.explode(both).alias("r")).select("r.word", "r.context", "r.count")


def context_counts(docs: DataFrame, window: int = 2) -> DataFrame:
    """``(word, contexts)``: number of context tokens within ±window over all occurrences.

    A token at position p of an n-token text has min(p, w) + min(n − 1 − p, w)
    context tokens, so the count needs no pairing at all: one explode and a
    map-side-combined aggregate.
    """
    n = F.size("tokens")
    tok = docs.select(n.alias("n"), F.posexplode("tokens").alias("pos", "word"))
    c = F.least(F.col("pos"), F.lit(window)) + F.least(F.col("n") - 1 - F.col("pos"), F.lit(window))
    return tok.groupBy("word").agg(F.sum(c).cast("bigint").alias("contexts"))


def rechunk(docs: DataFrame, size: int = 1000) -> DataFrame:
    """Split each token stream into consecutive chunks of ``size`` tokens: ``(doc_id, chunk, tokens)``.

    A document is cut in its own row, without a shuffle. Rows that share their id (or have none)
    are one stream, ordered by (place, token): their chunks alone are brought together.
    """
    chunk = lambda i: F.struct(i.cast("bigint").alias("chunk"), F.slice("tokens", (i * size + 1).cast("int"), size).alias("tokens"))
    last = F.floor((F.size("tokens") - 1) / size)
    chunks = F.when(F.size("tokens") > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), last), chunk))
    cut = lambda d: d.select("doc_id", F.explode(chunks).alias("c")).select("doc_id", "c.chunk", "c.tokens")
    single, shared = _by_repeated_id(docs)
    if shared is None:
        return cut(single)
    placed = cut(shared).select("doc_id", "chunk", F.transform("tokens", lambda t, i: F.struct(i.alias("pos"), t.alias("tok"))).alias("s"))
    merged = placed.groupBy("doc_id", "chunk").agg(F.sort_array(F.flatten(F.collect_list("s"))).alias("s"))
    return cut(single).unionByName(merged.select("doc_id", "chunk", F.col("s.tok").alias("tokens")))
