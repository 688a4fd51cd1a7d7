"""Registered queries of the corpus operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tessera.llm import kdtree, maxent, mixing, neardup, packing, quality, repeats, rollup, sequences, setm, spotsigs, toxicity, trie
from tessera.llm.common import fold, table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn

    return add


TOP_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), rows AS (SELECT vec_id, min(v) AS v FROM usable GROUP BY vec_id),
pairs AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.v::DOUBLE[], r.v::DOUBLE[])::BIGINT AS score
  FROM rows q JOIN rows r ON q.vec_id <> r.vec_id AND len(q.v) = len(r.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs) WHERE rank <= 5
"""


@query("op1_exact_top_k", TOP_SQL)
def op1(spark, sf_dir):
    """The five rows of highest inner product for every fiftieth vector."""
    return kdtree.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 50 == 0)


@query("op2_spotsigs_fingerprints")
def op2(spark, sf_dir):
    """Fingerprints of all documents and of their edited texts."""
    return spotsigs.fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op3_minhash_neardup")
def op3(spark, sf_dir):
    """Near-duplicate classes of all documents."""
    return neardup.classes(table(spark, sf_dir, "documents", "doc_id", "text"))


@query("op4_maxent_lm")
def op4(spark, sf_dir):
    """Scores of all documents under a model learned from folds 0, 1 and 3 to 6 of 7."""
    held = fold(F.col("doc_id"), 7) == 2
    out = maxent.score(table(spark, sf_dir, "documents", "doc_id", "text"), ~held)
    return out.select("doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


ROLLUP_SQL = r"""
WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS copy FROM documents WHERE doc_id IS NOT NULL)
SELECT source, lang, 'words-2' AS tokenizer, count(*) AS docs,
  sum(len(regexp_extract_all(text, '[0-9A-Za-z\x{80}-\x{10FFFF}]+|[!-/:-@\[-`{-~]')))::BIGINT AS tokens
FROM ranked WHERE copy = 1 OR text IS NULL GROUP BY source, lang
"""


@query("op5_token_rollups", ROLLUP_SQL)
def op5(spark, sf_dir):
    """Totals after three batches: all documents, deletion of all but the first of each set of
    equal texts, recount of what is left by a new tokenizer version."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    rolled = rollup.Rollup(spark)
    rolled.commit("1-insert", rollup.count_tokens(docs, "words-1"))
    hashed = docs.where("doc_id is not null and text is not null").select("doc_id", F.sha2("text", 256).alias("h"))
    first = hashed.groupBy("h").agg(F.min("doc_id").alias("first"))
    copies = hashed.join(first, "h").where("doc_id <> first").select("doc_id")
    rolled.commit("2-delete", deletes=copies)
    left = docs.join(copies, "doc_id", "left_anti")
    rolled.commit("3-revise", rollup.count_tokens(left, "words-2"))
    return rolled.totals()


@query("op6_best_fit_packing")
def op6(spark, sf_dir):
    """All documents' token pieces, packed into sequences of at most 4096."""
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER)


@query("op7_packed_matrices")
def op7(spark, sf_dir):
    """All documents as packed sequences of 2048 ids: a row a sequence, with digests of its matrices."""
    packed = sequences.pack(table(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER)
    return packed.select(
        "shard", "sequence", "n_tokens", F.crc32("ids").alias("ids_crc32"), F.crc32("position_ids").alias("positions_crc32"),
        "cu_seqlens", "doc_ids", "pieces", "starts")


@query("op8_quality_classifier")
def op8(spark, sf_dir):
    """Quality of every document, learned from the labels of folds 1 to 4 of 5."""
    held = fold(F.col("doc_id"), 5) == 0
    out = quality.classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "quality"), ~held)
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM sources
), capped AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, source_size * 2 AS cap FROM ranked
), placed AS (
  SELECT *,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS cap_before,
    coalesce(sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS weight_before,
    sum(weight) OVER ()::BIGINT AS weight_all, sum(source_size) OVER ()::BIGINT AS size_all
  FROM capped
), levels AS (
  SELECT *, ((size_all * 150)::DOUBLE / 100 - cap_before) / (weight_all - weight_before) AS level_here FROM placed
), leveled AS (
  SELECT *, cap <= level_here * weight AS stops,
    (arg_min(level_here, cap_before) FILTER (WHERE NOT (cap <= level_here * weight)) OVER ()) AS level
  FROM levels
), goals AS (
  SELECT source, source_size,
    CASE WHEN stops OR level IS NULL THEN cap::DOUBLE ELSE level * weight END AS target
  FROM leveled
), streams AS (
  SELECT doc_id, source, size,
    coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized
)
SELECT s.doc_id, s.size, g.source_size, g.target,
  (least(s.size, greatest(floor(g.target)::BIGINT - s.start, 0))
   + least(s.size, greatest(floor(g.target)::BIGINT - s.start - g.source_size, 0)))::BIGINT AS taken
FROM streams s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
"""


@query("op9_source_mixing", MIX_SQL)
def op9(spark, sf_dir):
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents", "doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query("op10_toxicity")
def op10(spark, sf_dir):
    """Toxicity of every document, learned from the labels of folds 0, 1 and 3 of 4."""
    held = fold(F.col("doc_id"), 4) == 2
    out = toxicity.classify(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"), ~held)
    return out.select("doc_id", held.alias("held_out"), "score", "predicted")


PHRASE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
), worded AS (
  SELECT lang, w, len(w) AS m FROM (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces) WHERE len(w) > 0
), totals AS (SELECT lang, sum(m)::HUGEINT AS n FROM worded GROUP BY lang
), f AS (
  SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
      SELECT lang, w, k, unnest(range(1, m - k + 2)) AS i FROM worded, range(1, 6) AS ks(k) WHERE m >= k))
  GROUP BY lang, k, phrase HAVING count(*) >= 100
), cuts AS (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM f WHERE k >= 2
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.cut, l.a AS l, r.a AS r, t.n, (1000 * c.a * t.n) // (l.a * r.a) AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang
  JOIN f l ON l.lang = c.lang AND l.k = c.cut AND l.phrase = array_to_string(c.w[1:c.cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.k = c.k - c.cut AND r.phrase = array_to_string(c.w[c.cut + 1:], ' ')
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), inner_runs AS (
  SELECT lang, array_to_string(w[i:i + len - 1], ' ') AS phrase, max(a) AS longer FROM (
    SELECT lang, a, w, len, unnest(range(1, k - len + 2)) AS i FROM (
      SELECT lang, a, k, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS len FROM f WHERE k >= 3))
  GROUP BY ALL
), kept AS (
  SELECT s.* FROM lowest s LEFT JOIN inner_runs i ON i.lang = s.lang AND i.phrase = s.phrase
  WHERE i.longer IS NULL OR NOT (100 * i.longer >= 100 * s.a)
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) WHERE rank <= 2000
"""


@query("op11_setm_collocations", PHRASE_SQL)
def op11(spark, sf_dir):
    """The first 2000 phrases of each language that occur 100 times or more, by score."""
    return setm.collocations(table(spark, sf_dir, "documents", "lang", "text"))


TRIE_SQL = r"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(list_concat([i::BIGINT], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, b: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS t
  FROM range(0, 256) AS r(i)
), ordered AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS at
  FROM conversations WHERE conv_id IS NOT NULL
), heads AS (
  SELECT c, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(c::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda s, d: xor(s >> 8, t[(xor(s, d) & 255) + 1])), 4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT c FROM ordered), crc_table
), rebuilt AS (
  SELECT h.c, o.at, o.role, o.text FROM heads h JOIN ordered o ON o.c = h.c - h.c % 100 AND o.at <= h.h
  UNION ALL
  SELECT h.c, o.at, o.role, o.text FROM heads h JOIN ordered o ON o.c = h.c AND o.at > h.h
), sequences AS (
  SELECT h.c, coalesce(list(md5(length(r.role)::VARCHAR || ':' || r.role || r.text) ORDER BY r.at) FILTER (WHERE r.c IS NOT NULL), []) AS s,
    coalesce(list(length(r.text) ORDER BY r.at) FILTER (WHERE r.c IS NOT NULL), []) AS cps
  FROM heads h LEFT JOIN rebuilt r ON r.c = h.c GROUP BY h.c
), prefixes AS (
  SELECT c, d, array_to_string(s[1:d], '') AS p, CASE WHEN d > 0 THEN array_to_string(s[1:d - 1], '') END AS up,
    CASE WHEN d > 0 THEN cps[d] ELSE 0 END AS cp, len(s) = d AS ends
  FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM sequences)
), nodes AS (
  SELECT p, any_value(up) AS up, d, min(c) AS conv_id, count(*) AS n, any_value(cp) AS cp,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends), '')) AS sha
  FROM prefixes GROUP BY p, d
), kids AS (SELECT up AS p, count(*) AS kids FROM nodes WHERE up IS NOT NULL GROUP BY up
), weighed AS (
  SELECT n.p, n.d, n.conv_id, coalesce(k.kids, 0) AS kids, (n.n - 1) * n.cp AS saved FROM nodes n LEFT JOIN kids k ON k.p = n.p
), under AS (
  SELECT left(p, 32 * a) AS p, sum((kids = 0)::BIGINT) AS leaves, sum(saved) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM weighed) GROUP BY 1
)
SELECT n.conv_id, n.d::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(k.kids, 0)::BIGINT AS n_children,
  t.leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens, n.sha AS ends_sha256
FROM nodes n LEFT JOIN nodes u ON u.p = n.up LEFT JOIN kids k ON k.p = n.p JOIN under t ON t.p = n.p
"""


@query("op12_conversation_trie", TRIE_SQL)
def op12(spark, sf_dir):
    """A row for each distinct sequence of first turns of the conversations."""
    return trie.conversation_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


@query("op13_suffix_dedup")
def op13(spark, sf_dir):
    """All documents' bytes without those that a 100-byte string covers which also starts earlier."""
    out = repeats.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
