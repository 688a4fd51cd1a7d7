import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tessera.sources import tables
from tessera.streaming import events as ev
from tessera.streaming import sentiment as st


def test_stream_totals_equal_batch_counts(spark):
    """Four input files → four micro-batches, one without a match; running totals, history and series agree
    with the batch computation over all messages."""
    d = tempfile.mkdtemp(dir="/tmp")
    msgs = [
        ["good day", "bad good", "nothing here"],
        ["good good good", "bad"],
        ["bad bad", "good and bad", "meh"],
        ["no word of either list"],
    ]
    for i, part in enumerate(msgs):
        spark.createDataFrame([(m,) for m in part], "value string").coalesce(1).write.parquet(os.path.join(d, f"in/part{i}"))
    lists = st.word_lists(spark.createDataFrame([("good",)], "word string"), spark.createDataFrame([("bad",)], "word string"))
    stream = (
        spark.readStream.schema("value string").option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true").parquet(os.path.join(d, "in"))
    )
    totals, history = st.run_sentiment_stream(spark, stream, lists)
    got = {r.label: r["count"] for r in spark.read.parquet(totals).collect()}
    batch = spark.createDataFrame([(m,) for part in msgs for m in part], "value string")
    want = {r.label: r["count"] for r in st.label_counts(st.tag_tokens(batch, lists)).collect()}
    assert got == want == {"positive": 6, "negative": 5}
    h = spark.read.parquet(history).select(F.col("batch_id").cast("bigint"), "label", "count")
    assert h.count() == 2 * 4 and h.where("count = 0").count() == 2
    per_label = {r.label: r.s for r in h.groupBy("label").agg(F.sum("count").alias("s")).collect()}
    assert per_label == want
    last = st.running_totals(h).orderBy(F.col("batch_id").desc()).limit(2).collect()
    assert {r.label: r.running for r in last} == want
    series = st.series(h).agg(F.sum("positive").alias("p"), F.sum("negative").alias("n")).first()
    assert (series.p, series.n) == (6, 5)


def test_timed_run_stops_once_and_prints(spark, tmp_path, capsys):
    import time

    spark.createDataFrame([("good",)], "value string").write.parquet(str(tmp_path / "in"))
    lists = st.word_lists(spark.createDataFrame([("good",)], "word string"), spark.createDataFrame([("bad",)], "word string"))
    stream = spark.readStream.schema("value string").parquet(str(tmp_path / "in"))
    started = time.time()
    totals, _ = st.run_sentiment_stream(spark, stream, lists, trigger={"processingTime": "1 second"}, run_seconds=8, console=True)
    assert 8 <= time.time() - started < 20
    assert {r.label: r["count"] for r in spark.read.parquet(totals).collect()} == {"positive": 1, "negative": 0}


def test_event_windows_stream_equals_batch(spark):
    schema = tables.table(spark, SF_SMALL, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(SF_SMALL)
    out = ev.latest_windows(spark, ev.run_windowed_stream(spark, stream))
    got = {(r.window_start, r.event_type): r.n for r in out.collect()}
    e = tables.table(spark, SF_SMALL, "events")
    want = {
        (r.d, r.event_type): r.n
        for r in e.groupBy(F.date_trunc("DAY", "ts").cast("timestamp_ntz").alias("d"), "event_type").count()
        .withColumnRenamed("count", "n").collect()
    }
    assert got == want


def test_folder_tables_in_any_order_lose_nothing(spark, tmp_path):
    """A table of several part files, in no order of time, gives what one file gives."""
    from tessera.plans.registry import QUERIES

    e = tables.table(spark, SF_SMALL, "events")
    e.repartition(3, F.hash("event_id")).write.parquet(str(tmp_path / "events.parquet"))
    key = lambda df: sorted(tuple(map(str, r)) for r in df.collect())
    assert key(QUERIES["stream_event_windows"](spark, str(tmp_path))) == key(QUERIES["stream_event_windows"](spark, SF_SMALL))
