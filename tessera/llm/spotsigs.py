"""Document fingerprints by SpotSigs.

A signature is an anchor word together with the CHAIN content words that follow it; a
fingerprint is the set of a text's signatures, as 8 hex digits each, sorted and joined.
Anchors are common words (fixed lists, and one word in RARE by its hash, so that text in
any language or none has anchors). A text too short for a chain is one signature of all its words.

Likeness is the Jaccard index of two sets. It is at most the ratio of their lengths, so
``near`` partitions the sets by length: sets whose classes are not neighbours are not
compared. Inside a partition two sets meet when they share one of their rarest signatures, as
any two of likeness PERCENT do, and the members of a list are compared in bounded blocks.

Defined results: a null text is empty; an empty text has an empty fingerprint, alike (1) to
another empty one and unlike (0) any other, and ``near`` links it with nothing; a null id comes before all ids, equal ids follow
each other by text; repeated rows are rows; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Words, chunks, mix, text_bytes
from tessera.llm.neardup import BLOCK_HASHES, block_links, blocked
from tessera.operators.graph.components import connected_components
from tessera.session import cut_lineage

CHAIN = 3
RARE = 12
#: Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in a is that it for on was with as be by this are from at "
    "der die das und den von zu mit sich ist im nicht ein eine auf für dem des "
    "le la les de des un une et est que en du pour dans qui sur pas au avec "
    "el los las del una por con se no para es su al lo como y"
).split()
#: ``near`` links sets of this likeness.
PERCENT = 80
#: Documents in a range of ids that one task reads through, on average.
RANGE_ROWS = 4000


def _anchor_hashes() -> np.ndarray:
    w = Words([a.encode() for a in ANCHORS])
    return np.unique(w.hash)


def signatures(texts: list[bytes]) -> Iterator[np.ndarray]:
    """For each text the sorted distinct 32-bit signatures."""
    common = _anchor_hashes()
    for a, b in chunks(texts):
        w = Words(texts[a:b])
        h = w.hash
        at = np.minimum(np.searchsorted(common, h), len(common) - 1)
        anchor = (common[at] == h) | (h % np.uint64(RARE) == 0)
        content = np.flatnonzero(~anchor)
        spots = np.flatnonzero(anchor)
        # the first content word after each anchor; the chain must end in the same text
        follow = np.searchsorted(content, spots)
        last = np.minimum(follow + CHAIN - 1, max(len(content) - 1, 0))
        ok = follow + CHAIN <= len(content)
        if len(content):
            ok &= w.doc[content[last]] == w.doc[spots]
        spots, follow = spots[ok], follow[ok]
        sig = h[spots]
        for i in range(CHAIN):
            sig = mix(sig * np.uint64(0xD6E8FEB86659FD93) + h[content[follow + i]]) if len(sig) else sig
        sig = (sig >> np.uint64(32)).astype(np.uint32)
        cuts = np.searchsorted(w.doc[spots], np.arange(b - a + 1))
        for k in range(b - a):
            found = np.unique(sig[cuts[k] : cuts[k + 1]])
            if not len(found) and w.first[k + 1] > w.first[k]:
                own = h[w.first[k] : w.first[k + 1]]
                whole = mix(own * np.uint64(2) + mix(np.arange(len(own), dtype=np.uint64))).sum(dtype=np.uint64, keepdims=True)
                found = (mix(whole) >> np.uint64(32)).astype(np.uint32)
            yield found


def fingerprint(sigs: np.ndarray) -> str:
    return sigs.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, floor: float = 0.0) -> float:
    """Jaccard of two sorted sets; 0 without comparing when the lengths bound it under ``floor``."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < floor * large or not small:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (small + large - common)


def edited(text: str, following: str) -> str:
    """The last quarter of a text's code points replaced by as many of the next text's first."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k] if k else text


def _walk(floor: float):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows read, whose fingerprint is made with the rows that follow
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc_id", "text", "_range", "_own")]
            rows = list(zip(*columns, strict=True))
            for a in range(0, len(rows), 500):
                held += rows[a : a + 500]
                yield from emit(held)
                held = held[-1:]

    def emit(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        texts = [r[1] or "" for r in rows]
        sets = list(signatures([t.encode() for t in texts]))
        owners = [i for i in range(len(rows) - 1) if rows[i][3] and rows[i][2] == rows[i + 1][2]]
        changed = [edited(texts[i], texts[i + 1]) for i in owners]
        changed_sets = list(signatures([t.encode() for t in changed]))
        if owners:
            yield pa.RecordBatch.from_arrays([
                pa.array([rows[i][0] for i in owners], pa.int64()),
                pa.array([len(texts[i]) for i in owners], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                pa.array([fingerprint(sets[i]) for i in owners]),
                pa.array([fingerprint(s) for s in changed_sets]),
                pa.array([likeness(sets[i], s, floor) for i, s in zip(owners, changed_sets, strict=True)]),
                pa.array([likeness(sets[i], sets[i + 1], floor) for i in owners]),
            ], schema=schema)

    return run


def fingerprints(docs: DataFrame, floor: float = 0.0) -> DataFrame:
    """A row for each document: its fingerprint, its edited text's, and their likenesses.

    Documents are dealt to ranges of ids, each read in order by one task; the first row of a
    range goes to the range before as well (the first of all to the last), so that every row
    meets its successor and texts move once. Only range bounds, one a RANGE_ROWS rows, and
    first ids are read by the driver.
    """
    lowest = -(1 << 63)
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(lowest)).alias("_k"))
    total = keyed.count()
    if not total:
        return keyed.select("doc_id", "text", F.lit(0).alias("_range"), F.lit(True).alias("_own")).mapInArrow(_walk(floor), _TYPES)
    ranges = max(1, min(total // RANGE_ROWS, 20_000))
    cuts = keyed.select(F.percentile_approx("_k", [i / ranges for i in range(1, ranges)] or [0.5], 10 * ranges).alias("q")).first()["q"]
    cuts = sorted(set(cuts)) if ranges > 1 else []
    # the range of a key: how many cuts lie below it
    place = F.lit(0)
    if cuts:
        bounds = F.array(*[F.lit(c) for c in cuts])
        place = F.aggregate(
            F.sequence(F.lit(0), F.lit(max(1, len(cuts).bit_length()) - 1)), F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi")),
            lambda s, _: F.when(s["lo"] >= s["hi"], s).otherwise(
                F.when(F.element_at(bounds, F.floor((s["lo"] + s["hi"]) / 2).cast("int") + 1) < F.col("_k"),
                       F.struct((F.floor((s["lo"] + s["hi"]) / 2) + 1).cast("int").alias("lo"), s["hi"].alias("hi")))
                .otherwise(F.struct(s["lo"].alias("lo"), F.floor((s["lo"] + s["hi"]) / 2).cast("int").alias("hi")))),
        )["lo"]
    dealt = keyed.withColumn("_range", place.cast("int"))
    firsts = sorted((r["_range"], r["k"]) for r in dealt.groupBy("_range").agg(F.min("_k").alias("k")).collect())
    first = {k: (r, firsts[i - 1][0]) for i, (r, k) in enumerate(firsts)}  # key -> its range, the range before
    spark = docs.sparkSession
    # one row a range: bounded by the number of ranges
    doors = F.broadcast(spark.createDataFrame([(k, before) for k, (_, before) in first.items()], "_fk long, _before int"))
    joined = dealt.join(doors, F.col("_k") == F.col("_fk"), "left")
    last = firsts[-1][0]
    copies = F.when(F.col("_before").isNull(), F.array(F.struct(F.col("_range").alias("r"), F.lit(True).alias("own"), F.lit(0).alias("late")))).otherwise(
        F.array(F.struct(F.col("_range").alias("r"), F.lit(True).alias("own"), F.lit(0).alias("late")),
                F.struct(F.col("_before").alias("r"), F.lit(False).alias("own"), F.lit(1).alias("late"))))
    out = joined.select("doc_id", "text", "_k", F.explode(copies).alias("_c"))
    out = out.select("doc_id", "text", "_k", F.col("_c.r").alias("_range"), F.col("_c.own").alias("_own"), F.col("_c.late").alias("_late"))
    parts = last + 1
    return (
        out.repartition(max(1, min(parts, 4096)), "_range").sortWithinPartitions("_range", "_late", "_k", "text")
        .select("doc_id", "text", "_range", "_own").mapInArrow(_walk(floor), _TYPES)
    )


_TYPES = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def _sets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(signatures([t or b"" for t in text_bytes(batch)]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.astype(np.uint64).tobytes() for x in sets], pa.binary())],
            names=["doc_id", "n", "hashes"])


def _unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(x, np.int64) for x in batch.column("hashes").to_pylist()]
        sizes = [len(x) for x in sets]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(np.repeat(np.arange(len(sets)), sizes))) for c in ("id", "set_key", "n")), pa.array(np.concatenate(sets))],
                names=["id", "set_key", "n", "sig"])


def near(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_signatures, component_id)``, a row for each row of ``docs``: the smallest id that
    links of 100 * intersection >= percent * union connect it with. A null id has no component."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = cut_lineage(plain.mapInArrow(_sets, "doc_id long, n long, hashes binary").withColumn("set_key", F.sha2("hashes", 256)))
    usable = made.where("n > 0 and doc_id is not null")
    reps = cut_lineage(usable.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("hashes").alias("hashes")))

    # a set's rarest signatures, as many as leave fewer than the intersection needs
    each = cut_lineage(reps.select("id", "set_key", "n", "hashes").mapInArrow(_unpack, "id long, set_key string, n long, sig long"))
    order = Window.partitionBy("set_key").orderBy("owners", "sig")  # the signatures of one text
    rarest = each.join(each.groupBy("sig").agg(F.count(F.lit(1)).alias("owners")), "sig").where("owners > 1").withColumn(
        "place", F.row_number().over(order))
    # a signature of one owner alone sorts first and meets nothing: it only uses up places
    single = F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("set_key"))
    rarest = rarest.withColumn("place", F.col("place") + single).where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)

    # a set is filed with its own length class and the next: classes further apart cannot link
    own = F.floor(F.log("n") / -np.log(percent / 100) + 1e-9)
    filed = rarest.select("id", "sig", F.explode(F.array(own, own + 1)).alias("length_class"))
    heads = filed.groupBy("sig", "length_class").agg(F.min("id").alias("center"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    members = filed.join(heads, ["sig", "length_class"]).select("center", "id").distinct()
    links = cut_lineage(
        blocked(members.join(reps.select("id", "n", "hashes"), "id"), "n", BLOCK_HASHES)
        .select("center", "_i", "_j", "_b", "id", "n", "hashes").mapInArrow(block_links(percent), "src long, dst long").distinct())
    # equal sets link their ids; an id that owns several sets joins them
    same = usable.join(reps.select("set_key", "id"), "set_key").where("id <> doc_id").select(F.col("id").alias("src"), F.col("doc_id").alias("dst"))
    component = connected_components(links.where("src <> dst").union(same.distinct()))
    return made.join(component.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_signatures"), F.coalesce("component", "doc_id").alias("component_id"))
