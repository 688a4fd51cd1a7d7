"""Driver tables and the stand-in inputs derived from them.

Every stand-in is a lazy DataFrame over the parquet tables, so column pruning
and filter pushdown reach the scans and its size grows with the tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def purchase_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item with its buyer: (user, item, qty, line keys).

    ``lineitem`` and ``orders`` are both fact-sized, so this is a shuffle
    (sort-merge) join on the order key; AQE splits skewed partitions.
    """
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("o_custkey").alias("user"),
        F.col("l_partkey").alias("item"),
        F.col("l_quantity").alias("qty"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "o_orderpriority",
        "o_orderdate",
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Play-count stand-in: (user, item, plays = sum of quantity)."""
    return (
        purchase_lines(spark, sf_dir)
        .groupBy("user", "item")
        .agg(F.sum("qty").alias("plays"))
    )


def bipartite_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer–part purchase graph as a directed edge list ``c:<cust> -> p:<part>``."""
    return purchase_lines(spark, sf_dir).select(
        F.concat(F.lit("c:"), F.col("user").cast("string")).alias("src"),
        F.concat(F.lit("p:"), F.col("item").cast("string")).alias("dst"),
    )


def user_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users linked when they follow each other in the event log.

    Consecutive events by (ts, event_id) give an edge between their users. The
    ordering window has no partition key, so it is computed as a self-join on a
    global dense position instead of ``lag`` over one task.
    """
    from tessera.functions.ordering import with_global_position

    ev = table(spark, sf_dir, "events").select("ts", "event_id", "user_id")
    pos = with_global_position(ev, ["ts", "event_id"], "pos")
    nxt = pos.select((F.col("pos") - 1).alias("pos"), F.col("user_id").alias("dst"))
    return (
        pos.join(nxt, "pos")
        .select(F.col("user_id").alias("src"), "dst")
        .where(F.col("src") != F.col("dst"))
    )
