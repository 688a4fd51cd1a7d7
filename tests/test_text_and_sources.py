import os
import tempfile

import pytest

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.functions import text as T
from tessera.operators import clean, stats
from tessera.sources import files, tables


def test_stop_words_equal_spark_list(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert T.ENGLISH_STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_review_tokens_and_tagged(spark):
    df = spark.createDataFrame([("  The cat\tSAT on a mat  ",), ("a/DT big/JJ dog/N1 x/y/NN",)], "t string")
    toks = [r[0] for r in df.select(T.review_tokens(F.col("t"))).collect()]
    assert toks[0] == ["the", "cat", "sat", "mat"]
    tagged = [r[0] for r in df.select(T.tagged_tokens(F.col("t"))).collect()]
    assert tagged[1] == ["a/DT", "big/JJ"]


def test_duration_seconds(spark):
    df = spark.createDataFrame([("14 mins 16 secs",), ("3 secs",), ("7 mins",), ("1 min 1 sec",), (None,)], "t string")
    assert [r[0] for r in df.select(clean.duration_seconds(F.col("t"))).collect()] == [856, 3, 420, 0, 0]


def test_exact_quantiles_linear(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 3, 4, 10]], "v double")
    q = stats.exact_quantiles(df, "v", [0.25, 0.5, 0.9]).first()
    assert (q.q0, q.q1) == (2.0, 3.0) and abs(q.q2 - 7.6) < 1e-12


def test_exact_quantiles_in_brackets(spark):
    """Above the size that takes the whole range: spread values, a hot value, nulls, gaps between brackets."""
    import numpy as np

    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0.5).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.rand(3) * F.col("id")).alias("v")
    ).persist()
    probs = [0.0, 0.1, 0.25, 0.5, 0.505, 0.999, 1.0]
    got = list(stats.exact_quantiles(df, "v", probs).first())
    want = np.quantile([r.v for r in df.where("v is not null").collect()], probs)
    df.unpersist()
    assert got == pytest.approx(list(want), rel=1e-12)
    assert list(stats.exact_quantiles(df.limit(0), "v", [0.5]).first()) == [None]
    hot = spark.range(20_000).select(F.when(F.col("id") < 19_990, 7.0).otherwise(F.col("id").cast("double")).alias("v"))
    assert list(stats.exact_quantiles(hot, "v", [0.25, 0.5, 0.75]).first()) == [7.0, 7.0, 7.0]


def test_profile_counts(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b"), (2, "a")], "n int, `odd name` string")
    got = [tuple(r) for r in stats.profile(df).collect()]
    assert sorted(got) == [("n", "int", 3, 1, 2), ("odd name", "string", 3, 1, 2)]
    empty = stats.profile(df.limit(0)).collect()
    assert {(r.non_null, r.nulls, r.distinct_values) for r in empty} == {(0, 0, 0)}


def test_edge_and_adjacency_files(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    small, large, adj = (os.path.join(d, x) for x in ("small.csv", "large.txt", "adj.txt"))
    with open(small, "w") as f:
        f.write("a,b\nb,c\na,b\n")
    with open(large, "w") as f:
        f.write("3 2\n1 2\n2 3\n")
    with open(adj, "w") as f:
        f.write("# comment\n1 2 3 3\n2 1\n")
    assert sorted(tuple(r) for r in files.read_edges(spark, small).collect()) == [("a", "b"), ("b", "c")]
    assert sorted(tuple(r) for r in files.read_edges(spark, large, large=True).collect()) == [("1", "2"), ("2", "3")]
    assert sorted(tuple(r) for r in files.read_adjacency(spark, adj).collect()) == [("1", "2"), ("1", "3"), ("2", "1")]


def test_word_vector_roundtrip(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    v = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [0.5, -1.0])], "word string, vector array<double>")
    counts = spark.createDataFrame([("a", 1), ("b", 5)], "word string, count long")
    files.write_word_vectors(v, d + "/wv", counts)
    back = {r.word: r.vector for r in files.read_word_vectors(spark, d + "/wv").collect()}
    assert back == {"a": [1.0, 2.0], "b": [0.5, -1.0]}


def test_walk_corpus_is_rebuilt_only_when_its_size_differs(spark, tmp_path):
    path = str(tmp_path / "walks")
    walks = lambda *w: spark.createDataFrame([(x,) for x in w], "tokens array<string>")
    assert files.write_walks(walks(["a", "b"], ["c"]), path, expected_lines=2)
    assert not files.write_walks(walks(["x"], ["y"]), path, expected_lines=2)
    assert files.write_walks(walks(["x"], ["y"], ["z"]), path, expected_lines=3)
    assert {r.value for r in files.text_lines(spark, path).collect()} == {"x", "y", "z"}


def test_labelled_texts_and_manifest(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    docs = tables.table(spark, SF_SMALL, "documents").orderBy("doc_id").limit(6).collect()
    for name, chunk in (("pos", docs[:3]), ("neg", docs[3:])):
        with open(os.path.join(d, f"{name}.txt"), "w") as f:
            f.write("\n".join(r.text.replace("\n", " ") for r in chunk) + "\n")
    t = files.read_labelled_texts(spark, {"pos": (d + "/pos.txt", 1), "neg": (d + "/neg.txt", 0)})
    assert t.groupBy("label").count().orderBy("label").collect()[1]["count"] == 3
    os.makedirs(d + "/img")
    os.makedirs(d + "/mask")
    for i in range(3):
        open(f"{d}/img/im{i}.png", "wb").write(b"x")
    open(f"{d}/mask/im0_label.png", "wb").write(b"x")
    with open(d + "/labels.txt", "w") as f:
        f.write("0  1  im0.png  x  im0_label.png\n1  0  im1.png  x  0\n2  0  im9.png  x  0\n")
    m = files.image_manifest(spark, d + "/labels.txt", d + "/img", d + "/mask").orderBy("image").collect()
    assert [r.image for r in m] == ["im0.png", "im1.png"]
    assert m[0].mask_path is not None and m[1].mask_path is None
    assert files.first_match(files.list_files(spark, d + "/img", "*.png"), "im1").first()[0].endswith("im1.png")
    assert files.first_match(files.list_files(spark, d + "/img", "*.png"), "zzz").first()[0] == "No match found"


def test_context_pairs_agree_with_counts(spark):
    from tessera.operators import text as ops

    docs = spark.createDataFrame([(1, ["a", "b", "c", "a"]), (2, ["b"]), (3, ["c", "a"])], "doc_id long, tokens array<string>")
    pairs = ops.context_pairs(docs, 2).groupBy("word").count()
    want = {r.word: r["count"] for r in pairs.collect()}
    got = {r.word: r.contexts for r in ops.context_counts(docs, 2).collect()}
    assert {k: v for k, v in got.items() if v} == want


def test_vector_rating_and_dimension_readers(spark):
    d = tempfile.mkdtemp(dir="/tmp")
    with open(d + "/w.csv", "w") as f:
        f.write("a,b,Yi\n1,2,3\n4,5,6\n")
    with open(d + "/r.dat", "w") as f:
        f.write("userID\tmovieID\trating\tday\n7\t9\t3.5\t1\n")
    with open(d + "/m.dat", "wb") as f:
        f.write(b"id name rest\n12  Alpha Beta\n13 Gam\xffma x\n")
    v = files.csv_vectors(spark, d + "/w.csv").collect()
    assert [(r.x, r.y) for r in v] == [([1.0, 2.0], 3.0), ([4.0, 5.0], 6.0)]
    r = files.read_ratings(spark, d + "/r.dat").first()
    assert (r.user, r.item, r.rating) == (7, 9, 3.5)
    m = {row.key: row.value for row in files.read_dimension(spark, d + "/m.dat").collect()}
    assert m["12"] == "Alpha" and "13" in m


def test_prefix_sum_within_matches_window(spark):
    from pyspark.sql import Window

    from tessera.functions.ordering import prefix_sum_within

    rows = [(k % 3 if k % 5 else None, k, float(k % 7)) for k in range(300)]
    df = spark.createDataFrame(rows, "g long, i long, v double").repartition(7)
    got = {(r.g, r.i): r.p for r in prefix_sum_within(df, "g", ["i"], "v", "p").collect()}
    w = Window.partitionBy("g").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    want = {(r.g, r.i): r.p for r in df.select("g", "i", F.coalesce(F.sum("v").over(w), F.lit(0.0)).alias("p")).collect()}
    assert got == want


def test_hot_key_ranks_are_spread_and_exact(spark):
    """One key holds a third of the rows: per-key ranks stay exact (they come from a
    range-partitioned sort, so at scale the hot key spans many partitions)."""
    from pyspark.sql import Window

    from tessera.functions.ordering import rank_within, with_global_position

    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("k"), F.col("id").alias("v")
    )
    got = rank_within(df, "k", ["v"], "r")
    w = Window.partitionBy("k").orderBy("v")
    want = df.select("k", "v", (F.row_number().over(w) - 1).alias("r"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    pos = with_global_position(df, ["k", "v"], "pos")
    assert sorted(r.pos for r in pos.select("pos").collect()) == list(range(n))


def test_analogies_in_blocks_equal_brute_force(spark):
    import numpy as np

    from tessera.operators.vectors import analogy_predictions

    rng = np.random.default_rng(5)
    words = {k: rng.normal(size=4).round(3) for k in range(40)}
    words[40] = words[7]  # a tie
    rows = [(k, [float(x) for x in v]) for k, v in words.items()] + [(41, [0.0] * 4)]
    asked = [(i, "s", *map(int, rng.choice(41, 3, replace=False)), 0) for i in range(30)] + [(30, "s", 1, 2, 99, 0), (31, "s", 1, 41, 2, 0)]
    v = spark.createDataFrame(rows, "key long, vector array<double>").repartition(3)
    q = spark.createDataFrame(asked, "qid long, section string, a long, b long, c long, expected long")
    got = {r.qid: r.predicted for r in analogy_predictions(v, q, block=7).collect()}
    unit = {k: x / np.linalg.norm(x) for k, x in words.items()}
    want = {}
    for i, _, a, b, c, _ in asked[:30]:
        t = unit[b] - unit[a] + unit[c]
        best = max(float(unit[k] @ t) for k in unit if k not in (a, b, c))
        want[i] = min(k for k in unit if k not in (a, b, c) and float(unit[k] @ t) >= best - 1e-12)
    assert got == want
    assert analogy_predictions(v, q.where("qid > 99")).count() == 0


def test_fixed_width_by_position(spark, tmp_path):
    from tessera.sources import files

    rows = ["  1  one two   x", " 12  three     ", "", "123            y z", "  4  a b"]
    (tmp_path / "f.txt").write_text("\n".join(rows) + "\n")
    path = str(tmp_path / "f.txt")
    got = files.read_fixed_width(spark, path, {"k": 0, "v": 1, "w": 2, "none": 9}, [(0, 4), (5, 14), (14, 20)])
    assert sorted(tuple(r) for r in got.collect()) == sorted([("1", "one two", "x", None), ("12", "three", None, None), ("123", None, "y z", None), ("4", "a b", None, None)], key=str)
    # positions filled in any line make the columns: a blank that all lines share divides
    assert files.fixed_width_spans(spark, path) == [(0, 3), (5, 12), (15, 16), (17, 18)]
    found = files.read_fixed_width(spark, path, {"k": 0})
    assert sorted(r.k for r in found.collect()) == ["1", "12", "123", "4"]
