"""Running positive/negative word counts over a message stream.

The same transformation serves batch and streaming DataFrames: split each
message on single spaces, tag tokens found in the word lists (one broadcast
join of a bounded list instead of two passes), and count per label. Per-batch
counts, their history and the running totals are written by ``foreachBatch``
under the batch id.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.joins import fits_broadcast
from tessera.session import ensure_checkpoint_dir


LABELS = ("positive", "negative")


def word_lists(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """``(word, label)`` with label 'positive' / 'negative' (one-word-per-line lists, de-duplicated)."""
    return positive.select(F.col("word"), F.lit("positive").alias("label")).union(
        negative.select(F.col("word"), F.lit("negative").alias("label"))
    ).distinct()


def tag_tokens(messages: DataFrame, lists: DataFrame, text_col: str = "value", broadcast_lists: bool = True) -> DataFrame:
    """``(label)`` per matched token; matching is case-sensitive on single-space tokens."""
    tokens = messages.select(F.explode(F.split(F.col(text_col), " ")).alias("word"))
    side = F.broadcast(lists) if broadcast_lists else lists
    return tokens.join(side, "word").select("label")


def label_counts(tagged: DataFrame) -> DataFrame:
    """``(label, count)`` of both labels, zero where no token matched."""
    one = tagged.agg(*[F.count_if(F.col("label") == name).alias(name) for name in LABELS])
    pairs = F.array(*[F.struct(F.lit(name).alias("label"), F.col(name).alias("count")) for name in LABELS])
    return one.select(F.inline(pairs))


def stream_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for a stream's checkpoint and sinks, inside the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "streams", f"{name}-{uuid.uuid4().hex[:12]}")


def run_sentiment_stream(
    spark: SparkSession, messages: DataFrame, lists: DataFrame, text_col: str = "value", trigger: dict | None = None,
    run_seconds: float | None = None, console: bool = False,
) -> tuple[str, str]:
    """Run the stream and return the paths of the running totals and of the per-batch history.

    One query reads the source once. Each micro-batch writes its counts, zeros included, and
    the running totals (those of the batch before plus its own) into folders named by its id,
    so a replayed batch writes the same again; ``totals`` holds the last batch's.
    By default the available input is processed and the query finishes
    (``availableNow``). For a live source pass e.g. ``trigger={"processingTime": "10 seconds"}``
    and ``run_seconds=100``: the query runs for that long and is then stopped
    gracefully. ``console`` also prints every batch's totals."""
    base = stream_folder(spark, "sentiment")
    totals_path, history_path = os.path.join(base, "totals"), os.path.join(base, "history")
    broadcast_ok = fits_broadcast(lists)

    def of_batch(folder: str, batch_id: int) -> str:
        return os.path.join(base, folder, f"batch_id={batch_id}")

    def write_batch(batch: DataFrame, batch_id: int):
        session = batch.sparkSession
        label_counts(tag_tokens(batch, lists, text_col, broadcast_ok)).write.mode("overwrite").parquet(of_batch("history", batch_id))
        known = session.read.parquet(of_batch("history", batch_id))
        if batch_id > 0:
            known = known.unionByName(session.read.parquet(of_batch("running", batch_id - 1)))
        known.groupBy("label").agg(F.sum("count").alias("count")).write.mode("overwrite").parquet(of_batch("running", batch_id))
        running = session.read.parquet(of_batch("running", batch_id))
        running.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").parquet(totals_path)
        if console:
            running.show(truncate=False)

    query = (
        messages.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", os.path.join(base, "checkpoint")).trigger(**(trigger or {"availableNow": True})).start()
    )
    if run_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(run_seconds):
        query.stop()
    return totals_path, history_path


def running_totals(history: DataFrame) -> DataFrame:
    """Batch twin of the state store: cumulative count per label across batch ids."""
    from pyspark.sql import Window

    w = Window.partitionBy("label").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return history.select("batch_id", "label", F.sum("count").over(w).alias("running"))


def series(history: DataFrame) -> DataFrame:
    """Per-batch positive / negative counts side by side (the numbers behind the plot)."""
    return history.groupBy("batch_id").pivot("label", ["positive", "negative"]).agg(F.first("count")).na.fill(0)
