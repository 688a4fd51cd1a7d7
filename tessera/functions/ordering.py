"""Order-dependent helpers that stay distributed.

A window with ``orderBy`` but no ``partitionBy`` runs in a single task. The
helpers here give the same answers (global dense positions, ranks within a key)
with a range-partitioned sort and a per-partition offset table whose size is
bounded by the number of partitions, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage

_ROW_BITS = 33  # monotonically_increasing_id = partition_id << 33 | row_in_partition


def with_global_position(df: DataFrame, order_cols: list, name: str = "pos") -> DataFrame:
    """Add a 0-based dense position following ``order_cols`` (must be a total order).

    Plan: range-partitioned sort, tag rows with their partition and in-partition
    row, freeze that layout with a reliable checkpoint, then add the running
    count of the preceding partitions (a broadcast table of one row per
    partition).
    """
    cols = list(df.columns)
    tagged = df.orderBy(*order_cols).withColumn("_mid", F.monotonically_increasing_id())
    tagged = cut_lineage(tagged)
    tagged = tagged.select(
        *cols,
        F.shiftright("_mid", _ROW_BITS).alias("_pid"),
        F.col("_mid").bitwiseAND((1 << _ROW_BITS) - 1).alias("_row"),
    )
    per_part = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: bounded by the partition count, safe to window and broadcast.
    offsets = per_part.select(
        "_pid",
        F.coalesce(
            F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_off"),
    )
    return tagged.join(F.broadcast(offsets), "_pid").select(
        *cols, (F.col("_off") + F.col("_row")).alias(name)
    )


def rank_within(df: DataFrame, key: str, order_cols: list, name: str = "rank") -> DataFrame:
    """0-based rank of each row inside its ``key`` group, by ``order_cols``.

    Equivalent to ``row_number() over (partition by key order by ...) - 1`` but a
    hot key is spread over many range partitions instead of one task: rank =
    global position - first global position of the key (a partial aggregate).
    """
    pos = with_global_position(df, [key, *order_cols], "_gpos")
    first = pos.groupBy(key).agg(F.min("_gpos").alias("_first"))
    return pos.join(first, key).select(
        *df.columns, (F.col("_gpos") - F.col("_first")).alias(name)
    )


def hash_uniform(*parts: Column | str | int, modulus: int = 2147483647) -> Column:
    """Reproducible integer hash in [0, modulus) from integer parts.

    h = ((p0 mod M) * 1103515245 + p1 * 12345 + p2 ...) mod M, with every
    intermediate kept below 2**63 so ANSI mode never overflows. The same
    arithmetic is written in the SQL oracles, which makes sampling, splits and
    random walks checkable exactly.
    """
    cols = [F.lit(p) if isinstance(p, int) else (F.col(p) if isinstance(p, str) else p) for p in parts]
    acc = F.pmod(cols[0].cast("bigint"), F.lit(modulus)) * F.lit(1103515245)
    for i, c in enumerate(cols[1:]):
        acc = acc + F.pmod(c.cast("bigint"), F.lit(modulus)) * F.lit(12345 + 2 * i)
    return F.pmod(acc, F.lit(modulus))


def hash_mixed(*parts: Column | str | int) -> Column:
    """Reproducible integer in [0, 2**32): the first 8 hex digits of md5 of the parts joined by '|'.

    Unlike ``hash_uniform`` it is not linear, so neighbouring parts (the steps of one walk)
    give unrelated numbers. Both engines have the functions it is made of.
    """
    cols = [F.lit(p) if isinstance(p, int) else (F.col(p) if isinstance(p, str) else p) for p in parts]
    digest = F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def prefix_sum_within(
    df: DataFrame, key: str, order_cols: list, value: str | list[str], name: str | list[str] = "prefix"
) -> DataFrame:
    """Exclusive running sum of ``value`` inside each ``key`` group, by ``order_cols``; several
    values with as many names are summed in one pass.

    Same result as ``sum(value) over (partition by key order by ... rows between
    unbounded preceding and 1 preceding)`` (0 for the first row), but a hot key is
    not processed by one task: rows are range-sorted, each (key, partition) block
    gets its own running sum, and blocks are offset by the sums of the earlier
    blocks of the same key (at most one block per partition and key).
    """
    cols = list(df.columns)
    sums = list(zip([value] if isinstance(value, str) else value, [name] if isinstance(name, str) else name, strict=True))
    placed = cut_lineage(df.orderBy(key, *order_cols).withColumn("_pid", F.spark_partition_id()))
    before = lambda x, w: F.coalesce(F.sum(x).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inner = Window.partitionBy(key, "_pid").orderBy(*order_cols)
    local = placed.withColumns({f"_local_{n}": before(v, inner) for v, n in sums})
    blocks = placed.groupBy(key, "_pid").agg(*[F.sum(v).alias(f"_sum_{n}") for v, n in sums])
    outer = Window.partitionBy(key).orderBy("_pid")
    offsets = blocks.select(
        F.col(key).alias("_okey"), F.col("_pid").alias("_opid"),
        *[before(f"_sum_{n}", outer).alias(f"_off_{n}") for _, n in sums],
    )
    # null-safe on the key: rows without a key (e.g. tree roots) form their own group
    cond = F.col(key).eqNullSafe(F.col("_okey")) & (F.col("_pid") == F.col("_opid"))
    return local.join(offsets, cond).select(*cols, *[(F.col(f"_local_{n}") + F.col(f"_off_{n}")).alias(n) for _, n in sums])
