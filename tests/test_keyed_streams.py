"""Keyed stream state over several files and a restart; closed windows with late rows."""

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from tessera.streaming import keyed

WORDS = [("good", "positive"), ("fine", "positive"), ("bad", "negative")]


def messages(spark, folder):
    return spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_totals_equal_batch_twin_and_go_on_after_a_restart(spark, tmp_path):
    lists = spark.createDataFrame(WORDS, "word string, label string")
    texts = [["good bad x", None, "fine good"], ["", "bad bad", "none of these"], ["good fine fine bad"]]
    folder, base = tmp_path / "in", str(tmp_path / "stream")
    for n, part in enumerate(texts):
        spark.createDataFrame([(t,) for t in part], "value string").coalesce(1).write.mode("append").parquet(str(folder))
        if n == 0:
            continue  # two files before the first run, the third after it
        path = keyed.run_keyed_counts(spark, messages(spark, folder), lists, base)
        labels = dict(WORDS)
        want = Counter(labels[w] for p in texts[: n + 1] for t in p for w in (t or "").split(" ") if w in labels)
        assert {r.label: r["count"] for r in keyed.latest_totals(spark, path).collect()} == want
    batches = spark.read.parquet(path).select("batch_id").distinct().count()
    assert batches == 3
    again = keyed.run_keyed_counts(spark, messages(spark, folder), lists, base)  # nothing new
    assert {r.label: r["count"] for r in keyed.latest_totals(spark, again).collect()} == want


def test_on_time_and_late_rows_are_all_rows(spark, tmp_path):
    day = lambda n, h=1: dt.datetime(2024, 1, n, h)
    parts = [[(day(1), "a"), (day(2), "a"), (day(2, 5), "b")], [(day(9), "a"), (day(2), "a")], [(day(9, 3), "d")], [(day(1), "a"), (day(2), "b"), (day(3), "c"), (day(9), "b")], [(day(20), "a")]]
    for i, part in enumerate(parts):
        spark.createDataFrame(part, "ts timestamp_ntz, event_type string").coalesce(1).write.parquet(str(tmp_path / f"in{i}.parquet"))
    stream = spark.readStream.schema("ts timestamp_ntz, event_type string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path) + "/in*.parquet")
    every = spark.read.parquet(*[str(tmp_path / f"in{i}.parquet") for i in range(5)])
    previous = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # windows stay UTC days
        closed = spark.read.parquet(keyed.run_closed_windows(spark, stream, watermark="1 day"))
        rows = keyed.late_rows(closed, every).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)
    first = dt.datetime(2024, 1, 1)
    got = {((r.start_us // 86_400_000_000) - (first - dt.datetime(1970, 1, 1)).days + 1, r.event_type): (r.status, r.on_time, r.late) for r in rows}
    assert all(r.start_us % 86_400_000_000 == 0 for r in rows)
    assert sum(n + late for _, n, late in got.values()) == every.count()
    assert got[20, "a"] == ("open", 1, 0)
    assert got[9, "a"] == ("closed", 1, 0)
    # the watermark passed a batch before the fourth file came: three of its rows are late
    assert {k: v for k, v in got.items() if v[2]} == {(1, "a"): ("closed", 1, 1), (2, "b"): ("closed", 1, 1), (3, "c"): ("closed", 0, 1)}


def test_windows_are_utc_days_in_any_session_zone(spark):
    from tessera.streaming.events import windowed_counts

    rows = [(dt.datetime(2024, m, d, h), "a", 1.0) for m in (1, 3, 7, 11) for d in (3, 10, 11) for h in (0, 2, 23)]
    previous = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        events = spark.createDataFrame(rows, "ts timestamp_ntz, event_type string, value double")
        got = windowed_counts(events).selectExpr("cast(window_start as string) s", "cast(window_end as string) e", "n").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)
    want = {(str(dt.datetime(2024, m, d)), str(dt.datetime(2024, m, d) + dt.timedelta(days=1)), 3) for m in (1, 3, 7, 11) for d in (3, 10, 11)}
    assert {tuple(r) for r in got} == want
