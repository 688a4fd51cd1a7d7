"""Mixing sources to target weights by a time-varying curriculum (DataFrame functions only).

Every source owns a piecewise-linear weight schedule over training time 0..1. Its
integral, scaled to the source's target, is the source's cumulative token demand; a
document whose words begin at place ``p`` of its source's stream is read at the time at
which that demand reaches ``p``. A stream longer than its source starts over, so a
document may be read twice. Range-sorting by that time gives the training order.

Streams are ordered by md5 of the id. Its first three hex digits name one of 4096
buckets, so places come from a window inside (source, bucket) plus the totals of the
earlier buckets: a source with a third of all rows is 4096 groups, not one.

Defined results: a null source is a source of its own, the last in order; a null or empty
text has size 0, is never taken and has no position; a null id sorts as empty text;
repeated rows are rows of their own; an empty table gives an empty result. Input columns
beyond (doc_id, source, text) are ignored by ``mix`` and carried by ``arrange``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.joins import lookup_join
from tessera.llm.common import WORD_PATTERN
from tessera.session import cut_lineage

#: Weights by place of the source in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words that the mix takes in all, as a share of the words there are.
SHARE_PERCENT = 150
#: No source gives more than this many times its size.
MOST_EPOCHS = 2
#: Tables of up to this many rows (each under 100 bytes) are broadcast.
BROADCAST_ROWS = 500_000
#: Knots (time, relative weight) by place of the source, repeating: rising, level, falling.
SCHEDULES = (((0.0, 1.0), (1.0, 3.0)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 4.0), (0.5, 2.0), (1.0, 1.0)))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share_percent: int = SHARE_PERCENT, most: int = MOST_EPOCHS) -> DataFrame:
    """``(source, source_size, place, target)`` from ``(source, source_size)``, one row a source.

    Targets are ``level * weight`` stopped at ``most`` times the size, with the level at
    which they sum to the share: the end of resharing the excess by weight. Sources are
    ordered by size for their weight, so those that stop are a prefix; the level follows
    from what the prefix leaves. One row a source is all that these windows see.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    w = F.element_at(F.array(*map(F.lit, weights)), F.col("place") % len(weights) + 1)
    ranked = ranked.withColumn("weight", w.cast("long")).withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    all_rows = Window.partitionBy()
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = ranked.select(
        "*",
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"),
        F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
        F.sum("weight").over(all_rows).alias("weight_all"),
        F.sum("source_size").over(all_rows).alias("size_all"),
    ).withColumn(
        "level_here",
        (F.col("size_all") * share_percent / F.lit(100.0) - F.col("cap_before"))
        / (F.col("weight_all") - F.col("weight_before")),
    )
    stops = F.col("cap") <= F.col("level_here") * F.col("weight")
    leveled = placed.withColumn("level", F.min(F.when(~stops, F.struct("cap_before", "level_here"))).over(all_rows)["level_here"])
    target = F.when(stops | F.col("level").isNull(), F.col("cap").cast("double")).otherwise(F.col("level") * F.col("weight"))
    return leveled.select("source", "source_size", "place", target.alias("target"))


def _segments(place: Column, schedules) -> Column:
    """The schedule of a place as an array of (t0, t1, w0, w1, area before), area scaled to 1."""
    made = []
    for knots in schedules:
        areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)]
        total, done, rows = sum(areas), 0.0, []
        for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:], strict=False), areas, strict=True):
            rows.append(F.struct(*[
                F.lit(float(x)).alias(n)
                for n, x in (("t0", t0), ("t1", t1), ("w0", w0 / total), ("w1", w1 / total), ("before", done / total))
            ]))
            done += area
        made.append(F.array(*rows))
    return F.element_at(F.array(*made), place % len(schedules) + 1)


def _position(place: Column, share: Column, schedules) -> Column:
    """The time at which a source has given ``share`` (0..1) of its target."""
    seg = F.element_at(F.filter(_segments(place, schedules), lambda s: s["before"] <= share), -1)
    slope = (seg["w1"] - seg["w0"]) / (seg["t1"] - seg["t0"])
    need = share - seg["before"]
    root = F.sqrt(F.greatest(seg["w0"] * seg["w0"] + 2 * slope * need, F.lit(0.0)))
    step = F.when(need > 0, 2 * need / (seg["w0"] + root)).otherwise(0.0)
    return F.least(seg["t0"] + step, seg["t1"])


def _share(place: Column, time: Column, schedules) -> Column:
    """The share (0..1) of its target that a source has given at ``time``: the inverse of ``_position``."""
    seg = F.try_element_at(F.filter(_segments(place, schedules), lambda s: s["t0"] <= time), F.lit(-1))  # null without a time
    step = time - seg["t0"]
    return seg["before"] + step * (seg["w0"] + step * (seg["w1"] - seg["w0"]) / (seg["t1"] - seg["t0"]) / 2)


def _share(place: Column, time: Column, schedules) -> Column:
    """The share (0..1) of its target that a source has given at a time: the inverse of ``_position``."""
    seg = F.try_element_at(F.filter(_segments(place, schedules), lambda s: s["t0"] <= time), F.lit(-1))  # null without a time
    step = time - seg["t0"]
    return seg["before"] + step * (seg["w0"] + step * (seg["w1"] - seg["w0"]) / (seg["t1"] - seg["t0"]) / 2)


def mix(docs: DataFrame, schedules=SCHEDULES, **targets) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken, position, position_again)``.

    ``taken``: words that the mix takes of the document, repeats counted. A source's taken
    words sum to its target rounded down; the document at the end of a stream is taken in
    part. ``position``, ``position_again``: the times of its first and second reading, or null.
    """
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # written once: sizes, offsets and places all read it, and the texts are counted once
    rows = cut_lineage(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("_key")))
    return place_rows(rows, rows, schedules, **targets).drop("_key", "_first", "_second")


def place_rows(rows: DataFrame, sized: DataFrame, schedules=SCHEDULES, **targets) -> DataFrame:
    """``mix`` for rows that already hold ``size`` and ``_key``; their other columns are carried.

    ``sized`` has (source, size, _key) of the same rows, without what they carry.
    """
    kept = rows.columns
    rows = rows.withColumn("_bucket", F.substring("_key", 1, 3))
    blocks = cut_lineage(
        sized.groupBy("source", F.substring("_key", 1, 3).alias("_bucket")).agg(F.sum("size").alias("_block"))
    )
    sizes = blocks.groupBy("source").agg(F.sum("_block").alias("source_size"))
    earlier = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        F.col("source").alias("_s"), F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_block").over(earlier), F.lit(0)).alias("_offset"),
    )
    goals = source_targets(sizes, **targets).withColumnRenamed("source", "_t")
    inside = Window.partitionBy("source", "_bucket").orderBy("_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # at most 4096 rows of about 40 bytes a source; beyond the bound the join shuffles
    placed = lookup_join(placed, offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")), "inner", BROADCAST_ROWS)
    placed = lookup_join(placed, goals, F.col("source").eqNullSafe(F.col("_t")), "inner", BROADCAST_ROWS)
    quota = F.floor("target")
    start = F.col("_offset") + F.col("_inside")
    again = start + F.col("source_size")
    none = F.lit(0).cast("long")
    def reading(at, begin: str, end: str, words: str):
        """The times at which a reading of the document begins and ends, and the words that the
        demand between them takes: whole places, which doubles give exactly up to some 1e14."""
        n = F.least(F.col("size"), F.greatest(quota - at, none))
        when = lambda x: F.when(n > 0, _position(F.col("place"), x / F.col("target"), schedules))
        given = lambda t: F.round(F.col("target") * _share(F.col("place"), F.col(t), schedules)).cast("long")
        return {begin: when(at), end: when(at + n)}, {words: F.coalesce(given(end) - given(begin), none)}

    first, took = reading(start, "position", "_until", "_first")
    second, took_again = reading(again, "position_again", "_until_again", "_second")
    timed = placed.withColumns(first | second).withColumns(took | took_again)
    return timed.withColumn("taken", F.col("_first") + F.col("_second")).select(
        *kept, "source_size", "target", "taken", "position", "position_again", "_first", "_second")


def arrange(docs: DataFrame, schedules=SCHEDULES, **targets) -> DataFrame:
    """The documents in training order: a row for each reading, with the columns of ``docs``.

    A reading that the end of the stream cuts is kept whole when at least half of its words
    are taken, else left out. One range exchange sorts by time; ties go by md5 of the id.
    """
    names = docs.columns
    carried = docs.select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("_key"),
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
    )
    sized = cut_lineage(carried.select("source", "size", "_key"))
    placed = place_rows(carried, sized, schedules, **targets)
    half = lambda got: got * 2 >= F.col("size")
    times = F.filter(
        F.array(F.when(half(F.col("_first")), F.col("position")), F.when(half(F.col("_second")), F.col("position_again"))),
        lambda t: t.isNotNull(),
    )
    return (
        placed.select("_row", "_key", F.explode(times).alias("_time"))
        .orderBy("_time", "_key")
        .select(*[F.col("_row")[c].alias(c) for c in names])
    )
