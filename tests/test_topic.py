"""A topic read by offsets: replay, restart in the middle, unfinished publishes, odd messages."""

import json

from pyspark.sql import functions as F

from tessera.sources import topic


def messages(spark, rows):
    return spark.createDataFrame(rows, "key string, value string, n long")


def copied(spark, path):
    return [tuple(r) for r in spark.read.schema(topic.SCHEMA).parquet(path).select("offset", "key", "value").orderBy("offset").collect()]


def test_offsets_are_dense_over_publishes_and_segments(spark, tmp_path):
    log = str(tmp_path / "log")
    assert topic.end_offset(log) == 0
    assert topic.read_batch(spark, log).collect() == []
    first = [(f"k{i % 3}", f"v{i}", i) for i in range(50)]
    second = [(None, None, 0), ("", "", 1), ("é", 'a "quoted"\nline', 2), ("long", "x" * 300_000, 3)]
    assert topic.publish(messages(spark, first), log, ["n"], segment_rows=7) == 50
    assert topic.publish(messages(spark, first[:0]), log, ["n"]) == 50
    assert topic.publish(messages(spark, second), log, ["n"], segment_rows=3) == 54
    want = [(i, k, v) for i, (k, v, _) in enumerate(first + second)]
    got = topic.read_batch(spark, log)
    assert [tuple(r) for r in got.orderBy("offset").collect()] == want
    for lo, hi in ((0, 1), (6, 8), (13, 51), (49, 54), (52, 99), (54, 60), (9, 9)):
        part = topic.read_batch(spark, log, startingOffset=lo, endingOffset=hi).orderBy("offset").collect()
        assert [tuple(r) for r in part] == want[lo:hi], (lo, hi)


def test_stream_goes_on_from_the_middle_and_sees_new_messages(spark, tmp_path):
    log, base = str(tmp_path / "log"), str(tmp_path / "copy")
    rows = [("k", f"v{i}", i) for i in range(30)]
    topic.publish(messages(spark, rows[:20]), log, ["n"], segment_rows=4)
    out = topic.copy_available(topic.read_stream(spark, log, startingOffset=3, endingOffset=10, group="g"), base)
    assert [r[0] for r in copied(spark, out)] == list(range(3, 10))
    topic.copy_available(topic.read_stream(spark, log, group="g"), base)  # the position is the checkpoint's
    assert [r[0] for r in copied(spark, out)] == list(range(3, 20))
    topic.copy_available(topic.read_stream(spark, log, group="g"), base)  # nothing new
    topic.publish(messages(spark, rows[20:]), log, ["n"], segment_rows=4)
    topic.copy_available(topic.read_stream(spark, log, group="g"), base)
    assert copied(spark, out) == [(i, k, v) for i, (k, v, _) in enumerate(rows)][3:]
    assert spark.read.schema("offset long, batch_id long").parquet(out).select("batch_id").distinct().count() == 3
    committed = json.loads((tmp_path / "log" / "groups" / "g.json").read_text())
    assert committed["offset"] <= 30


def test_unfinished_publish_does_not_count_and_is_written_anew(spark, tmp_path):
    log = tmp_path / "log"
    rows = [("k", f"v{i}", i) for i in range(6)]
    topic.publish(messages(spark, rows[:3]), str(log), ["n"])
    half = log / f"from={3:020d}"
    messages(spark, rows[3:]).select((F.col("n")).alias("offset"), "key", "value").withColumn("segment", F.lit(3)).write.partitionBy("segment").parquet(str(half))
    assert topic.end_offset(str(log)) == 6
    (half / "_SUCCESS").rename(half / "_failed")
    assert topic.end_offset(str(log)) == 3
    assert topic.publish(messages(spark, rows[4:]), str(log), ["n"]) == 5
    assert [r.value for r in topic.read_batch(spark, str(log)).orderBy("offset").collect()] == ["v0", "v1", "v2", "v4", "v5"]
