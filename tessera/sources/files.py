"""File sources and sinks: text lines, delimited tables, edge and adjacency lists,
word lists, labelled text corpora, word-vector text files, file listings.

Readers return DataFrames with a declared schema (those whose columns the file's header names
read strings and cast); parsing is done with built-in string functions so it stays in the JVM
and splits across files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import WS

EDGE_SCHEMA = "src string, dst string"


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value)`` — one row per line."""
    return spark.read.text(path)


def delimited(spark: SparkSession, path: str, sep: str, schema: str | T.StructType, header: bool = False) -> DataFrame:
    """Typed delimited text (tab, space, comma…); ``header`` skips the first line of each file."""
    return spark.read.csv(path, sep=sep, schema=schema, header=header, mode="PERMISSIVE")


def read_edges(spark: SparkSession, path: str, large: bool = False) -> DataFrame:
    """Edge list → ``(src, dst)`` distinct pairs. ``large``: a ``nodes edges`` header line and
    space-separated ids; otherwise comma-separated without header."""
    if large:
        e = spark.read.csv(path, sep=" ", header=True, schema=EDGE_SCHEMA)
    else:
        e = spark.read.csv(path, sep=",", header=False, schema=EDGE_SCHEMA)
    return e.select(F.trim("src").alias("src"), F.trim("dst").alias("dst")).where(
        F.col("src").isNotNull() & F.col("dst").isNotNull()
    ).distinct()


def read_int_edges(spark: SparkSession, path: str, undirected: bool = True) -> DataFrame:
    """Whitespace-separated integer edge list: both directions (if undirected), deduplicated, no loops."""
    parts = spark.read.text(path).select(F.split(F.trim("value"), WS).alias("p")).where(F.size("p") >= 2)
    e = parts.select(F.col("p")[0].cast("bigint").alias("src"), F.col("p")[1].cast("bigint").alias("dst"))
    if undirected:
        e = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return e.where(F.col("src") != F.col("dst")).distinct()


def read_adjacency(spark: SparkSession, path: str, checked: bool = True) -> DataFrame:
    """Adjacency list ``id n1 n2 …`` (``#`` lines are comments) → ``(src, dst)``.
    ``checked`` removes repeated neighbours."""
    rows = spark.read.text(path).where(~F.col("value").startswith("#")).select(F.split(F.trim("value"), WS).alias("p"))
    rows = rows.where(F.size("p") >= 1).select(F.col("p")[0].alias("src"), F.slice("p", 2, 1 << 30).alias("nb"))
    if checked:
        rows = rows.withColumn("nb", F.array_distinct("nb"))
    return rows.select("src", F.explode("nb").alias("dst"))


def write_adjacency(adj: DataFrame, path: str) -> None:
    """``(id, neighbors array)`` → one text line ``id n1 n2 …`` per vertex."""
    adj.select(F.concat_ws(" ", F.col("id").cast("string"), F.col("neighbors").cast("array<string>")).alias("value")).write.mode(
        "overwrite"
    ).text(path)


def write_node_list(nodes: DataFrame, path: str) -> None:
    """Node table as tab-separated ``idx, name, node_type``."""
    nodes.select("idx", "name", "node_type").write.mode("overwrite").csv(path, sep="\t")


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, right-stripped, repeats collapsed → ``(word)``."""
    return spark.read.text(path).select(F.rtrim("value").alias("word")).where(F.col("word") != "").distinct()


def read_labelled_texts(spark: SparkSession, files: dict[str, tuple[str, int]]) -> DataFrame:
    """``{name: (path, label)}`` → ``(source, label, text)``: several one-text-per-line files as one table."""
    parts = [
        spark.read.text(path).select(F.lit(name).alias("source"), F.lit(label).alias("label"), F.col("value").alias("text"))
        for name, (path, label) in files.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_line_corpus(spark: SparkSession, path: str, tag_prefix: str | None = None) -> DataFrame:
    """One line = one whitespace-token sequence; optional ``SENT_<n>`` tags in file order
    (``n`` from the line's position, computed without a single-task window)."""
    from tessera.functions.ordering import with_global_position

    lines = spark.read.text(path).select(F.input_file_name().alias("_f"), F.monotonically_increasing_id().alias("_o"), "value")
    pos = with_global_position(lines, ["_f", "_o"], "n")
    out = pos.select("n", F.filter(F.split("value", WS), lambda t: t != "").alias("tokens"))
    if tag_prefix:
        out = out.withColumn("tag", F.concat(F.lit(tag_prefix), F.col("n").cast("string")))
    return out


def fixed_width_spans(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """Begin and end of each column: runs of positions that hold a character in any line.

    All lines count; what comes to the driver is at most one number a position of a line.
    """
    lines = spark.read.text(path).where(F.length("value") > 0)
    filled = F.expr("filter(sequence(1, length(value)), i -> substring(value, i, 1) not in (' ', '\t'))")
    places = sorted(r.at for r in lines.select(F.explode(filled).alias("at")).distinct().collect())
    spans: list[tuple[int, int]] = []
    for at in places:
        if spans and spans[-1][1] == at - 1:
            spans[-1] = (spans[-1][0], at)
        else:
            spans.append((at - 1, at))
    return spans


def read_fixed_width(spark: SparkSession, path: str, fields: dict[str, int], spans: list[tuple[int, int]] | None = None) -> DataFrame:
    """Columns by their places in the line: ``{name: column index}``. ``spans`` gives each column's begin
    and end (from 0, end exclusive), else they are found from the lines. A blank inside a field stays,
    an empty field is null and shifts nothing; empty lines are left out."""
    spans = spans if spans is not None else fixed_width_spans(spark, path)
    lines = spark.read.text(path).where(F.trim("value") != "")

    def field(i: int) -> Column:
        if i >= len(spans):
            return F.lit(None).cast("string")
        begin, end = spans[i]
        text = F.trim(F.substring("value", begin + 1, end - begin))
        return F.when(text != "", text)

    return lines.select(*[field(i).alias(name) for name, i in fields.items()])


def list_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``(path)`` of the files under ``folder`` matching ``glob`` (contents are not read)."""
    return (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
        .load(folder).select("path")
    )


def first_match(paths: DataFrame, pattern: str) -> DataFrame:
    """First path (in path order) matching the regex, else ``'No match found'``: one row ``(path)``."""
    hit = paths.where(F.col("path").rlike(pattern)).agg(F.min("path").alias("path"))
    return hit.select(F.coalesce("path", F.lit("No match found")).alias("path"))


def write_word_vectors(vectors: DataFrame, path: str, counts: DataFrame | None = None) -> None:
    """Text word vectors: a ``header`` file ``<vocab> <dim>`` and ``word v1 … vd`` lines,
    most frequent first when ``counts(word, count)`` is given."""
    spark = vectors.sparkSession
    v = vectors.select("word", "vector")
    if counts is not None:
        v = v.join(counts.select("word", "count"), "word", "left").orderBy(F.col("count").desc_nulls_last(), "word")
    stats = v.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("d")).first()
    spark.createDataFrame([(f"{stats['n']} {stats['d']}",)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}/header"
    )
    v.select(F.concat_ws(" ", "word", F.col("vector").cast("array<string>")).alias("value")).write.mode("overwrite").text(
        f"{path}/vectors"
    )


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Inverse of :func:`write_word_vectors`; rows whose length disagrees with the header dimension raise."""
    dim = int(spark.read.text(f"{path}/header").first()["value"].split()[1])
    p = spark.read.text(f"{path}/vectors").select(F.split("value", " ").alias("p"))
    out = p.select(F.col("p")[0].alias("word"), F.transform(F.slice("p", 2, 1 << 30), lambda x: x.cast("double")).alias("vector"))
    return out.withColumn(
        "vector", F.when(F.size("vector") == dim, F.col("vector")).otherwise(F.raise_error(F.lit("vector dimension mismatch")))
    )


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_lines(df: DataFrame, col: str, path: str) -> None:
    df.select(F.col(col).cast("string").alias("value")).write.mode("overwrite").text(path)


def write_walks(walk_sentences: DataFrame, path: str, expected_lines: int | None = None) -> bool:
    """Walk corpus: one space-joined walk per line, one file per partition.

    A corpus at ``path`` that already has ``expected_lines`` lines is kept. True when written.
    """
    if expected_lines is not None:
        try:
            if walk_sentences.sparkSession.read.text(path).count() == expected_lines:
                return False
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    walk_sentences.select(F.array_join("tokens", " ").alias("value")).write.mode("overwrite").text(path)
    return True


def image_manifest(spark: SparkSession, labels_path: str, image_dir: str, mask_dir: str) -> DataFrame:
    """Defect manifest: fixed-width label file (flag col 1, image col 2, mask col 4) joined with
    the image and mask files that exist → ``(image, mask, flag, image_path, mask_path)``."""
    lab = read_fixed_width(spark, labels_path, {"flag": 1, "image": 2, "mask": 4})
    stem = lambda c: F.regexp_extract(c, r"([^/]+)$", 1)
    imgs = list_files(spark, image_dir).select(stem("path").alias("image"), F.col("path").alias("image_path"))
    masks = list_files(spark, mask_dir).select(stem("path").alias("mask"), F.col("path").alias("mask_path"))
    return lab.join(imgs, "image").join(masks, "mask", "left").select(
        "image", "mask", F.col("flag").cast("int").alias("flag"), "image_path", "mask_path"
    )


def csv_vectors(spark: SparkSession, path: str, id_col: str | None = None) -> DataFrame:
    """Header CSV of numeric columns → ``(x array<double>, y double)``: all columns but the last
    form the vector, the last one is the target (optionally keeping an id column)."""
    raw = spark.read.csv(path, header=True)
    cols = [c for c in raw.columns if c != id_col]
    x = F.array(*[F.col(f"`{c}`").cast("double") for c in cols[:-1]]).alias("x")
    y = F.col(f"`{cols[-1]}`").cast("double").alias("y")
    return raw.select(*([id_col] if id_col else []), x, y)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated ratings with a header; the first three columns (user, item, rating) are kept."""
    raw = spark.read.csv(path, sep="\t", header=True)
    u, i, r = raw.columns[:3]
    return raw.select(F.col(u).cast("bigint").alias("user"), F.col(i).cast("bigint").alias("item"), F.col(r).cast("double").alias("rating"))


def read_dimension(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Whitespace-separated dimension file → ``(key, value)`` from the first two tokens of each
    line (header line skipped; undecodable bytes are replaced, not fatal)."""
    lines = spark.read.option("encoding", encoding).option("header", True).csv(path, sep="\x01", schema="value string")
    p = lines.select(F.split(F.trim("value"), WS).alias("p")).where(F.size("p") >= 2)
    return p.select(F.col("p")[0].alias("key"), F.col("p")[1].alias("value"))
