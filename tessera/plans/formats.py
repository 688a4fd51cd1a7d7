"""Round trips of the file formats: a given table is written under the shared checkpoint
folder in one format, read back by the format's reader, and returned."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from tessera.functions.text import WS
from tessera.operators.graph import core
from tessera.plans.registry import register
from tessera.session import ensure_checkpoint_dir
from tessera.sources import files, tables

BREAKS = r"\r\n|\n|\r"


def _folder(spark, name):
    """A new folder for one written copy in the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "formats", name, uuid.uuid4().hex)


def _one_line(col):
    return F.regexp_replace(col, BREAKS, " ")


@register(
    "io_text_lines",
    f"""
    SELECT md5(line) AS line_md5, COUNT(*) AS count FROM (
        SELECT unnest(regexp_split_to_array(text, '{BREAKS}')) AS line FROM documents) l GROUP BY line
    """,
)
def io_text_lines(spark, sf_dir):
    """Document texts as plain text lines (a text's own line breaks make lines)."""
    path = _folder(spark, "lines")
    files.write_lines(tables.table(spark, sf_dir, "documents").where(F.col("text").isNotNull()), "text", path)
    return files.text_lines(spark, path).groupBy(F.md5(F.col("value").cast("binary")).alias("line_md5")).agg(
        F.count(F.lit(1)).alias("count")
    )


@register("io_delimited", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def io_delimited(spark, sf_dir):
    """Typed tab-separated text without a header."""
    path = _folder(spark, "tab")
    s = tables.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    s.write.csv(path, sep="\t")
    return files.delimited(spark, path, "\t", s.schema)


@register("io_csv_header", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def io_csv_header(spark, sf_dir):
    """CSV sink with a header line in every file; the reader skips it."""
    path = _folder(spark, "csv")
    c = tables.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    files.write_csv(c, path)
    return files.delimited(spark, path, ",", c.schema, header=True)


@register("io_sheet", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def io_sheet(spark, sf_dir):
    """A sheet exported as CSV: quoted strings, numbers and a header."""
    path = _folder(spark, "sheet")
    p = tables.table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    p.write.csv(path, header=True, quoteAll=True)
    return files.delimited(spark, path, ",", p.schema, header=True)


def _supply_edges(spark, sf_dir):
    return tables.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))


EDGE_SQL = "SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS src, CAST(l_suppkey AS VARCHAR) AS dst FROM lineitem"


@register("io_edge_list", EDGE_SQL)
def io_edge_list(spark, sf_dir):
    """Comma-separated edge list without a header; repeated edges collapse."""
    path = _folder(spark, "edges")
    _supply_edges(spark, sf_dir).write.csv(path)
    return files.read_edges(spark, path)


@register("io_edge_list_large", EDGE_SQL)
def io_edge_list_large(spark, sf_dir):
    """Space-separated edge list whose files open with a header line."""
    path = _folder(spark, "large-edges")
    _supply_edges(spark, sf_dir).write.csv(path, sep=" ", header=True)
    return files.read_edges(spark, path, large=True)


SIMPLE_SQL = """
    SELECT DISTINCT src, dst FROM (
        SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem
        UNION ALL SELECT l_suppkey, l_partkey FROM lineitem) e WHERE src <> dst
"""


@register("io_int_edges", SIMPLE_SQL)
def io_int_edges(spark, sf_dir):
    """Whitespace-separated integer edges: both directions, distinct, no loops."""
    path = _folder(spark, "int-edges")
    _supply_edges(spark, sf_dir).write.csv(path, sep=" ")
    return files.read_int_edges(spark, path)


@register(
    "io_vertex_attributes",
    """
    SELECT c_custkey AS id, CAST(c_nationkey AS DOUBLE) AS nation, c_acctbal AS balance FROM customer
    """,
)
def io_vertex_attributes(spark, sf_dir):
    """Attribute CSV of the vertices, one numeric column an attribute."""
    path = _folder(spark, "attributes")
    c = tables.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"))
    files.write_csv(c, path)
    return files.delimited(spark, path, ",", "id bigint, nation double, balance double", header=True)


@register(
    "io_csv_vectors",
    "SELECT CAST(p_partkey AS VARCHAR) AS id, [CAST(p_partkey AS DOUBLE), CAST(p_size AS DOUBLE)] AS x, p_retailprice AS y FROM part",
)
def io_csv_vectors(spark, sf_dir):
    """Numeric CSV as vectors: the last column is the target, the others the vector."""
    path = _folder(spark, "vectors")
    p = tables.table(spark, sf_dir, "part")
    files.write_csv(p.select(F.col("p_partkey").alias("id"), F.col("p_partkey").alias("key"), "p_size", "p_retailprice"), path)
    return files.csv_vectors(spark, path, id_col="id")


@register("io_ratings", "SELECT l_suppkey AS user, l_partkey AS item, l_quantity AS rating FROM lineitem")
def io_ratings(spark, sf_dir):
    """Tab-separated ratings with a header; columns after the third are ignored."""
    path = _folder(spark, "ratings")
    li = tables.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_quantity", "l_linenumber")
    li.write.csv(path, sep="\t", header=True)
    return files.read_ratings(spark, path)


@register("io_dimension", "SELECT CAST(p_partkey AS VARCHAR) AS key, p_brand AS value FROM part")
def io_dimension(spark, sf_dir):
    """Whitespace-separated dimension file with a header; the first two tokens count."""
    path = _folder(spark, "dimension")
    p = tables.table(spark, sf_dir, "part").select(F.concat_ws("  ", F.col("p_partkey").cast("string"), "p_brand", "p_type").alias("value"))
    p.write.csv(path, header=True, sep="\x01")
    return files.read_dimension(spark, path)


def _by_lang(spark, sf_dir):
    path = _folder(spark, "listing")
    tables.table(spark, sf_dir, "documents").select("doc_id", "lang").write.partitionBy("lang").parquet(path)
    return files.list_files(spark, path, "*.parquet")


def _lang(path):
    return F.regexp_extract(path, r"lang=([^/]+)/", 1)


@register("io_file_listing", "SELECT DISTINCT COALESCE(lang, '__HIVE_DEFAULT_PARTITION__') AS lang FROM documents")
def io_file_listing(spark, sf_dir):
    """Files below a folder that match a glob, by the subfolder they lie in."""
    return _by_lang(spark, sf_dir).select(_lang(F.col("path")).alias("lang")).distinct()


@register(
    "io_first_match",
    "SELECT COALESCE(MIN(lang) FILTER (WHERE lang LIKE 'e%'), '') AS lang, 'No match found' AS absent FROM documents",
)
def io_first_match(spark, sf_dir):
    """First listed path that matches a pattern, and what a pattern without a match gives."""
    paths = _by_lang(spark, sf_dir)
    hit, miss = files.first_match(paths, "lang=e"), files.first_match(paths, "lang=/")
    return hit.select(_lang(F.col("path")).alias("lang"), miss.scalar().alias("absent"))


@register(
    "io_fixed_width",
    "SELECT CAST(c_custkey AS VARCHAR) AS key, c_mktsegment AS segment, c_name AS name FROM customer",
)
def io_fixed_width(spark, sf_dir):
    """Columns aligned by spaces, picked by position."""
    path = _folder(spark, "fixed")
    c = tables.table(spark, sf_dir, "customer").select(
        F.format_string("%12d %-12s %-24s", "c_custkey", "c_mktsegment", "c_name").alias("value")
    )
    files.write_lines(c, "value", path)
    return files.read_fixed_width(spark, path, {"key": 0, "segment": 1, "name": 2})


@register(
    "io_fixed_width_blanks",
    "SELECT CAST(p_partkey AS VARCHAR) AS key, CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS brand, p_name AS name, p_type AS type FROM part",
)
def io_fixed_width_blanks(spark, sf_dir):
    """Columns at stated places; some fields are empty, others hold blanks."""
    path = _folder(spark, "fixed")
    brand = F.when(F.col("p_partkey") % 7 != 0, F.col("p_brand")).otherwise("")
    p = tables.table(spark, sf_dir, "part").select(F.format_string("%12d%-20s%-60s%s", "p_partkey", brand, "p_name", "p_type").alias("value"))
    files.write_lines(p, "value", path)
    spans = [(0, 12), (12, 32), (32, 92), (92, 200)]
    return files.read_fixed_width(spark, path, {"key": 0, "brand": 1, "name": 2, "type": 3}, spans)


@register(
    "io_labelled_texts",
    f"""
    SELECT CASE WHEN l.quality = 1 THEN 'good' ELSE 'bad' END AS source, l.quality AS label,
           md5(regexp_replace(d.text, '{BREAKS}', ' ', 'g')) AS text_md5, COUNT(*) AS count
    FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.quality IN (0, 1) AND d.text IS NOT NULL GROUP BY ALL
    """,
)
def io_labelled_texts(spark, sf_dir):
    """One text a line in one file folder a class, read as one labelled table."""
    d = tables.table(spark, sf_dir, "documents").join(tables.table(spark, sf_dir, "labels"), "doc_id").where(F.col("text").isNotNull())
    sources = {}
    for name, label in (("good", 1), ("bad", 0)):
        path = _folder(spark, "reviews")
        files.write_lines(d.where(F.col("quality") == label).select(_one_line("text").alias("text")), "text", path)
        sources[name] = (path, label)
    t = files.read_labelled_texts(spark, sources)
    return t.groupBy("source", "label", F.md5(F.col("text").cast("binary")).alias("text_md5")).agg(F.count(F.lit(1)).alias("count"))


@register("io_word_list", "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part")
def io_word_list(spark, sf_dir):
    """One word a line with trailing blanks; repeats collapse."""
    path = _folder(spark, "words")
    w = tables.table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("word"))
    files.write_lines(w.select(F.concat("word", F.lit("  ")).alias("word")), "word", path)
    return files.read_word_list(spark, path)


@register(
    "io_line_corpus",
    f"""
    SELECT n, list_filter(regexp_split_to_array(regexp_replace(text, '{BREAKS}', ' ', 'g'), '{WS}'), lambda t: t <> '') AS tokens,
           'SENT_' || CAST(n AS VARCHAR) AS tag
    FROM (SELECT text, ROW_NUMBER() OVER (ORDER BY doc_id) - 1 AS n FROM documents WHERE text IS NOT NULL) d
    """,
)
def io_line_corpus(spark, sf_dir):
    """One token sequence a line, numbered in file order."""
    path = _folder(spark, "corpus")
    d = tables.table(spark, sf_dir, "documents").where(F.col("text").isNotNull())
    files.write_lines(d.select("doc_id", _one_line("text").alias("text")).orderBy("doc_id"), "text", path)
    return files.read_line_corpus(spark, path, tag_prefix="SENT_")


@register("io_node_list", "SELECT p_partkey AS idx, p_name AS name, p_brand AS node_type FROM part")
def io_node_list(spark, sf_dir):
    """Node table sink: index, name and type separated by tabs."""
    path = _folder(spark, "nodes")
    p = tables.table(spark, sf_dir, "part")
    files.write_node_list(p.select(F.col("p_partkey").alias("idx"), F.col("p_name").alias("name"), F.col("p_brand").alias("node_type")), path)
    return files.delimited(spark, path, "\t", "idx bigint, name string, node_type string")


@register("io_adjacency", f"SELECT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst FROM ({SIMPLE_SQL}) e")
def io_adjacency(spark, sf_dir):
    """Adjacency lines, one vertex each, written and read as edges again."""
    path = _folder(spark, "adjacency")
    files.write_adjacency(core.adjacency(core.simple(_supply_edges(spark, sf_dir))), path)
    return files.read_adjacency(spark, path)


@register("io_word_vectors", "SELECT CAST(vec_id AS VARCHAR) AS word, list_transform(CAST(embedding AS DOUBLE[]), lambda x: round(x, 6)) AS vector FROM embeddings")
def io_word_vectors(spark, sf_dir):
    """Text word vectors with their header, written and read."""
    path = _folder(spark, "word-vectors")
    e = tables.table(spark, sf_dir, "embeddings")
    files.write_word_vectors(e.select(F.col("vec_id").cast("string").alias("word"), F.transform("embedding", lambda x: x.cast("double")).alias("vector")), path)
    return files.read_word_vectors(spark, path).select("word", F.transform("vector", lambda x: F.round(x, 6)).alias("vector"))


@register(
    "io_walks",
    """
    SELECT walk, COUNT(*) AS count FROM (
        SELECT string_agg(CAST(l_partkey AS VARCHAR), ' ' ORDER BY l_linenumber, l_partkey) AS walk FROM lineitem GROUP BY l_orderkey) w
    GROUP BY walk
    """,
)
def io_walks(spark, sf_dir):
    """Walk corpus sink: the parts of each order in line order, a walk a line."""
    path = _folder(spark, "walks")
    li = tables.table(spark, sf_dir, "lineitem")
    steps = li.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("s"))
    files.write_walks(steps.select(F.col("s.l_partkey").cast("array<string>").alias("tokens")), path)
    return files.text_lines(spark, path).groupBy(F.col("value").alias("walk")).agg(F.count(F.lit(1)).alias("count"))
