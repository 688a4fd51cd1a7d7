"""Running counts in keyed state, and event-time windows with late rows accounted for.

``run_keyed_counts`` keeps one count a label in the stream's state store. Tokens are counted in
their own partition first (``partial_counts``), so a label's group holds a row a partition and
batch, not a row a token. State and position come back from the checkpoint after a restart.

``run_closed_windows`` emits a window once, when the watermark passes its end (append mode);
rows that come later are dropped by the engine. ``late_rows`` counts them from what all rows say.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tessera.functions.joins import fits_broadcast
from tessera.streaming.events import AS_UTC
from tessera.streaming.sentiment import stream_folder, tag_tokens


def _count_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, int] = {}
    for batch in batches:
        for pair in batch.column("label").value_counts().to_pylist():
            counts[pair["values"]] = counts.get(pair["values"], 0) + pair["counts"]
    yield pa.RecordBatch.from_pydict({"label": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})


def partial_counts(tagged: DataFrame) -> DataFrame:
    """``(label, n)``: counts within each partition."""
    return tagged.select("label").mapInArrow(_count_batches, "label string, n long")


def _add_up(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    total = (state.get[0] if state.exists else 0) + sum(int(p["n"].sum()) for p in parts)
    state.update((total,))
    yield pd.DataFrame({"label": [key[0]], "count": [total]})


def run_keyed_counts(spark: SparkSession, messages: DataFrame, lists: DataFrame, folder: str | None = None, text_col: str = "value") -> str:
    """Runs over the available input; returns the folder of the totals, one subfolder a batch.

    Running again with the same ``folder`` goes on from its checkpoint: only new input is read,
    and totals continue from the state. A replayed batch writes the same subfolder again.
    """
    base = folder or stream_folder(spark, "keyed")
    tagged = tag_tokens(messages, lists, text_col, fits_broadcast(lists))
    totals = partial_counts(tagged).groupBy("label").applyInPandasWithState(
        _add_up, "label string, count long", "count long", "update", GroupStateTimeout.NoTimeout)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(base, "totals", f"batch_id={batch_id}"))

    query = (totals.writeStream.outputMode("update").foreachBatch(write_batch)
             .option("checkpointLocation", os.path.join(base, "checkpoint")).trigger(availableNow=True).start())
    query.awaitTermination()
    return os.path.join(base, "totals")


def latest_totals(spark: SparkSession, path: str) -> DataFrame:
    """Each label's count after the last batch that changed it."""
    rows = spark.read.schema("label string, count long, batch_id long").parquet(path)
    return rows.groupBy("label").agg(F.max_by("count", "batch_id").alias("count"))


def _windows(events: DataFrame, width: str, watermark: str | None) -> DataFrame:
    timed = events.withColumn("ets", F.expr(AS_UTC))
    if watermark:
        timed = timed.withWatermark("ets", watermark)
    return timed.groupBy(F.window("ets", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(
        F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "event_type", "n")


def run_closed_windows(spark: SparkSession, events: DataFrame, width: str = "1 day", watermark: str = "2 days") -> str:
    """Append-mode stream of closed windows ``(start_us, end_us, event_type, n)``; returns its folder."""
    base = stream_folder(spark, "closed-windows")
    out = os.path.join(base, "closed")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))

    query = (_windows(events, width, watermark).writeStream.outputMode("append").foreachBatch(write_batch)
             .option("checkpointLocation", os.path.join(base, "checkpoint")).trigger(availableNow=True).start())
    query.awaitTermination()
    return out


def late_rows(closed: DataFrame, events: DataFrame, width: str = "1 day") -> DataFrame:
    """``(start_us, end_us, event_type, status, on_time, late)`` of all rows of ``events`` (a batch): a
    closed window's rows beyond those it was emitted with came late. A window that closed
    without a row in time has only late ones if its end lies before the last closed end; the others are open."""
    every = _windows(events, width, None).withColumnRenamed("n", "every")
    last = closed.agg(F.max("end_us").alias("last"))
    both = every.join(closed.select("start_us", "end_us", "event_type", "n"), ["start_us", "end_us", "event_type"], "left").crossJoin(F.broadcast(last))
    shut = F.col("n").isNotNull() | (F.col("end_us") <= F.col("last"))
    seen = F.when(shut, F.coalesce("n", F.lit(0))).otherwise(F.col("every"))
    return both.select("start_us", "end_us", "event_type", F.when(shut, "closed").otherwise("open").alias("status"), seen.alias("on_time"), (F.col("every") - seen).alias("late"))
