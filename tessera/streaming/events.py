"""Event-time windowed counts over an event stream with a watermark.

``events.ts`` is TIMESTAMP_NTZ in the driver tables; watermarks need
TIMESTAMP, so its wall-clock value is read as UTC on the way in and window
bounds are turned back on the way out, whatever the session's time zone.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.streaming.sentiment import stream_folder


EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
#: The instant whose UTC clock shows ``ts``; an interval of seconds, unlike one of days, knows no time zone.
AS_UTC = f"timestamp_micros(cast(cast(cast((ts - {EPOCH}) as interval second) as decimal(18,6)) * 1000000 as bigint))"


def windowed_counts(events: DataFrame, width: str = "1 day", watermark: str | None = None, slide: str | None = None) -> DataFrame:
    """``(window_start, window_end, event_type, n, total_value)`` per event-time window.

    Without ``watermark`` no event is ever late: state holds one row per window and type,
    which a finite replay bounds. An endless stream names the lateness it accepts.
    """
    ev = events.withColumn("ets", F.expr(AS_UTC))
    if watermark:
        ev = ev.withWatermark("ets", watermark)
    win = F.window("ets", width, slide) if slide else F.window("ets", width)
    agg = ev.groupBy(win.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total_value"))
    return agg.select(
        *[F.expr(f"timestampadd(MICROSECOND, unix_micros(w.{side}), {EPOCH})").alias(f"window_{side}") for side in ("start", "end")],
        "event_type", "n", "total_value",
    )


def run_windowed_stream(spark: SparkSession, events: DataFrame, width: str = "1 day", watermark: str | None = None) -> str:
    """Update-mode run to completion; returns the path of the per-batch updates.

    Update mode emits every window whose counts changed in a batch, including
    windows the watermark has not closed yet (append mode would hold back the
    last ones of a finite replay). With a watermark, state older than it is dropped.
    Read the result with :func:`latest_windows`.
    """
    base = stream_folder(spark, "event-windows")
    out = os.path.join(base, "updates")

    def write_batch(batch: DataFrame, batch_id: int):
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
            os.path.join(out, f"batch={batch_id}")
        )

    q = (
        windowed_counts(events, width, watermark).writeStream.outputMode("update").foreachBatch(write_batch)
        .option("checkpointLocation", os.path.join(base, "ck")).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return out


def latest_windows(spark: SparkSession, path: str) -> DataFrame:
    """Final value of every (window, event_type): the row from the latest batch that updated it."""
    u = spark.read.parquet(path)
    keys = ["window_start", "window_end", "event_type"]
    return u.groupBy(*keys).agg(
        F.max_by("n", "batch_id").alias("n"), F.max_by("total_value", "batch_id").alias("total_value")
    )
