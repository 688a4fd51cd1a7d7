"""Streaming queries: documents and events replayed through file-stream sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.registry import register
from tessera.plans.text import FEATURES_SQL, _features
from tessera.session import cut_lineage
from tessera.sources import tables, topic
from tessera.streaming import events as ev
from tessera.streaming import keyed
from tessera.streaming import sentiment as st


def stream_of(spark, sf_dir, name):
    """The table ``name`` read as a file stream (one file per micro-batch).

    The table is one file or a folder of part files: the glob matches either.
    """
    schema = tables.table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf_dir}/{name}.parquet*")


def sentiment_lists(spark, sf_dir):
    """Word lists learned from the labelled documents: class-skewed feature words."""
    f = _features(spark, sf_dir)
    pos = f.where(F.col("pos_df") >= 2 * F.col("neg_df")).select("word")
    neg = f.where(F.col("neg_df") >= 2 * F.col("pos_df")).select("word")
    return st.word_lists(pos, neg)


LISTS_SQL = f"""
    SELECT DISTINCT word, label FROM (
        SELECT word, 'positive' AS label FROM ({FEATURES_SQL}) f WHERE pos_df >= 2 * neg_df
        UNION ALL SELECT word, 'negative' FROM ({FEATURES_SQL}) f WHERE neg_df >= 2 * pos_df) w
"""
TAGGED_SQL = f"""
    SELECT l.label FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) t JOIN ({LISTS_SQL}) l ON l.word = t.word
"""


BOTH_SQL = "(VALUES ('positive'), ('negative')) b(label)"


def _run(spark, sf_dir, messages=None):
    lists = cut_lineage(sentiment_lists(spark, sf_dir))  # read by every micro-batch
    if messages is None:
        messages = stream_of(spark, sf_dir, "documents").select(F.col("text").alias("value"))
    return st.run_sentiment_stream(spark, messages, lists)


@register("stream_sentiment_running", f"SELECT b.label, COUNT(t.label) AS count FROM {BOTH_SQL} LEFT JOIN ({TAGGED_SQL}) t ON t.label = b.label GROUP BY b.label")
def stream_sentiment_running(spark, sf_dir):
    """Running positive/negative token counts after the whole document stream."""
    totals, _ = _run(spark, sf_dir)
    return spark.read.parquet(totals).select("label", "count")


@register("stream_batch_counts", f"SELECT CAST(0 AS BIGINT) AS batch_id, b.label, COUNT(t.label) AS count FROM {BOTH_SQL} LEFT JOIN ({TAGGED_SQL}) t ON t.label = b.label GROUP BY b.label")
def stream_batch_counts(spark, sf_dir):
    """Per-batch counts with their batch id (one batch per input file)."""
    _, history = _run(spark, sf_dir)
    return spark.read.parquet(history).select(F.col("batch_id").cast("bigint"), "label", "count")


@register(
    "stream_series",
    f"""
    SELECT CAST(0 AS BIGINT) AS batch_id, COUNT(*) FILTER (WHERE label = 'positive') AS positive,
           COUNT(*) FILTER (WHERE label = 'negative') AS negative FROM ({TAGGED_SQL}) t
    """,
)
def stream_series(spark, sf_dir):
    _, history = _run(spark, sf_dir)
    h = spark.read.parquet(history).select(F.col("batch_id").cast("bigint"), "label", "count")
    return st.series(h)


@register(
    "stream_event_windows",
    """
    SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY AS window_end,
           event_type, COUNT(*) AS n, ROUND(SUM(value), 4) AS total_value
    FROM events GROUP BY ALL
    """,
)
def stream_event_windows(spark, sf_dir):
    """Daily event-time windows per event type, in update mode without a watermark (a finite replay)."""
    out = ev.run_windowed_stream(spark, stream_of(spark, sf_dir, "events"))
    return ev.latest_windows(spark, out).select(
        "window_start", "window_end", "event_type", "n", F.round("total_value", 4).alias("total_value")
    )


@register(
    "stream_running_totals",
    f"SELECT CAST(0 AS BIGINT) AS batch_id, b.label, COUNT(t.label) AS running FROM {BOTH_SQL} LEFT JOIN ({TAGGED_SQL}) t ON t.label = b.label GROUP BY b.label",
)
def stream_running_totals(spark, sf_dir):
    """Cumulative count per label after each batch, from the per-batch history."""
    _, history = _run(spark, sf_dir)
    h = spark.read.parquet(history).select(F.col("batch_id").cast("bigint"), "label", "count")
    return st.running_totals(h)


CONV_TAGGED_SQL = f"""
    SELECT l.label FROM (SELECT unnest(string_split(text, ' ')) AS word FROM conversations) t
    JOIN ({LISTS_SQL}) l ON l.word = t.word
"""


@register("stream_conversation_sentiment", f"SELECT b.label, COUNT(t.label) AS count FROM {BOTH_SQL} LEFT JOIN ({CONV_TAGGED_SQL}) t ON t.label = b.label GROUP BY b.label")
def stream_conversation_sentiment(spark, sf_dir):
    """Running positive/negative counts over all turns of the conversations stream,
    with the word lists learned from the labelled documents."""
    totals, _ = _run(spark, sf_dir, stream_of(spark, sf_dir, "conversations").select(F.col("text").alias("value")))
    return spark.read.parquet(totals).select("label", "count")


@register("stream_keyed_totals", f"SELECT label, COUNT(*) AS count FROM ({TAGGED_SQL}) t GROUP BY label")
def stream_keyed_totals(spark, sf_dir):
    """Running counts of the labels held in keyed state, after the whole document stream."""
    lists = cut_lineage(sentiment_lists(spark, sf_dir))
    path = keyed.run_keyed_counts(spark, stream_of(spark, sf_dir, "documents").select(F.col("text").alias("value")), lists)
    return keyed.latest_totals(spark, path)


@register(
    "stream_watermarked_windows",
    """
    SELECT epoch_us(time_bucket(INTERVAL 1 DAY, ts)) AS start_us, epoch_us(time_bucket(INTERVAL 1 DAY, ts) + INTERVAL 1 DAY) AS end_us, event_type, COUNT(*) AS n
    FROM events GROUP BY ALL
    """,
)
def stream_watermarked_windows(spark, sf_dir):
    """Daily windows by a watermark of 2 days in append mode, late rows added back: all rows of events."""
    table = tables.table(spark, sf_dir, "events")
    closed = spark.read.parquet(keyed.run_closed_windows(spark, stream_of(spark, sf_dir, "events")))
    return keyed.late_rows(closed, table).select("start_us", "end_us", "event_type", (F.col("on_time") + F.col("late")).alias("n"))


@register(
    "stream_topic_replay",
    """
    SELECT ROW_NUMBER() OVER (ORDER BY conv_id NULLS FIRST, turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1 AS "offset",
           conv_id, turn, role, text FROM conversations
    """,
)
def stream_topic_replay(spark, sf_dir):
    """All conversations published to a topic, then read by offsets in two runs of one stream: up
    to the middle of the log, and from there, after a restart, to its end."""
    table = tables.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    messages = table.select(*table.columns, F.col("conv_id").alias("key"), F.to_json(F.struct(*table.columns)).alias("value"))
    base = st.stream_folder(spark, "topic")
    end = topic.publish(messages, f"{base}/log", table.columns)
    for last in (end // 2, end):
        out = topic.copy_available(topic.read_stream(spark, f"{base}/log", endingOffset=last), f"{base}/copy")
    rows = spark.read.schema("offset long, key string, value string, batch_id long").parquet(out)
    return rows.select("offset", F.from_json("value", table.schema).alias("m")).select("offset", "m.*")
