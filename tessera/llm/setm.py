"""Phrase collocation mining by SETM: relations of occurrences, joined by adjacent position.

A text is lower-cased (A-Z), split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and those into words
``[^\\x20\\x09]+``. The relation R_k holds every place where a frequent phrase of k words
begins. Each round (a) merge-joins R_k with itself by piece and adjacent position, since a
phrase of k+1 words is two overlapping phrases of k words, (b) counts the groups, (c) keeps
the frequent groups and semi-joins the occurrences with them, which gives R_{k+1}.

Relations are persisted sorted by place, in blocks: a block is a run of texts of one
language, its places a bitmap (a gap stands between two pieces) and its phrases small codes
of the block's own dictionary, all packed. Counting moves a block's distinct phrases, with their counts,
to the part that their key hashes to; a phrase comes at most once from a block, so no key is
hot, and a part tells each block which of its phrases are frequent. No list of phrases is
broadcast and nothing is collected but the number of places.

Null text counts as empty, null language as ``und``; repeated rows count each; an empty table
gives no rows; columns other than text and lang are not read. A text's words are held
in one task as 4-byte codes; its bytes are cut up in slices of SLICE.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import groups, mix
from tessera.session import ensure_checkpoint_dir

#: Words a block holds before it is written, and bytes of text cut up at once.
BLOCK_WORDS, SLICE = 1 << 21, 1 << 22
#: Places that one part of the counting stands for, about.
PART_PLACES = 1 << 22


def pack(values: np.ndarray) -> bytes:
    """Compressed bytes of an integer array: first all lowest bytes, then the next ones, and so on."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(packed: bytes, kind) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def _steps(rising: np.ndarray) -> bytes:
    return pack(np.diff(rising, prepend=0).astype(np.int32))


def _unsteps(packed: bytes) -> np.ndarray:
    return np.cumsum(unpack(packed, np.int32), dtype=np.int64)


_CUT = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
_SIGNS = bytes(ord("\n") if chr(i) in ".,;:!?\n\x0b\x0c\r" else ord(" ") if chr(i) in " \t" else i for i in range(256))

_RELATION = "block long, lang string, size long, places binary, codes binary, ids binary"
_ASK = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("lang", pa.string()), ("at", pa.binary()),
                  ("left", pa.binary()), ("right", pa.binary()), ("counts", pa.binary())])
_ASK_DDL = "part int, block long, lang string, at binary, left binary, right binary, counts binary"
_FOUND = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("at", pa.binary()), ("ids", pa.binary()),
                    ("id", pa.int64()), ("left", pa.int64()), ("right", pa.int64()), ("lang", pa.string()),
                    ("word", pa.string()), ("a", pa.int64())])
_FOUND_DDL = "kind string, block long, at binary, ids binary, id long, left long, right long, lang string, word string, a long"


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, slice by slice, with a line end for every end of a piece."""
    begin, n = 0, len(text)
    while begin < n:
        end = begin + SLICE
        if end < n:
            cut = _CUT.search(text, end)
            end = cut.start() if cut else n
        part = text[begin:end].lower().translate(_SIGNS).replace(b"\n", b" \n ")
        yield [w for w in part.split(b" ") if w]
        begin = end


class _Block:
    def __init__(self):
        self.dictionary: defaultdict = defaultdict(count().__next__)
        self.dictionary[b"\n"]  # noqa: B018  the gap has code 0
        self.codes: list[np.ndarray] = []
        self.size = 0

    def add(self, text: bytes) -> None:
        for words in words_of(text):
            self.codes.append(np.fromiter(map(self.dictionary.__getitem__, words), np.int32, len(words)))
            self.size += len(words)
        self.codes.append(np.zeros(1, np.int32))
        self.size += 1


_BLOCKS = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("codes", pa.binary()), ("words", pa.binary()), ("counts", pa.binary()), ("n", pa.int64())])


def _read_blocks(limit: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = count(TaskContext.get().partitionId() << 33)
        held: defaultdict = defaultdict(_Block)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, b in held.items():
                codes = np.concatenate(b.codes)
                counts = np.bincount(codes, minlength=len(b.dictionary)).astype(np.int64)
                row = [next(number), lang, pack(codes), b"\n".join(list(b.dictionary)[1:]), pack(counts[1:]), int(counts[1:].sum())]
                yield pa.RecordBatch.from_arrays([pa.array([x], type=f.type) for x, f in zip(row, _BLOCKS, strict=True)], schema=_BLOCKS)
            held.clear()

        total = 0
        for batch in batches:
            langs, texts = batch.column("lang"), batch.column("text").cast(pa.binary())
            for lang, text in zip(langs, texts, strict=True):
                b = held["und" if not lang.is_valid else lang.as_py()]
                before = b.size
                b.add(text.as_py() or b"")
                total += b.size - before
                if total >= limit:
                    yield from flush()
                    total = 0
        yield from flush()

    return run


def _rows(rows: list[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], type=f.type) for f in schema], schema=schema)


def _ask_words(parts: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                words = r["words"].split(b"\n") if r["words"] else []
                part = np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words))
                counts = unpack(r["counts"], np.int64)
                out = []
                for p in np.unique(part).tolist():
                    at = np.flatnonzero(part == p)
                    out.append({"part": p, "block": r["block"], "lang": r["lang"], "at": _steps(at + 1),
                                "left": b"\n".join([words[i] for i in at.tolist()]), "counts": pack(counts[at])})
                yield from _rows(out, _ASK)

    return run


def _count_words(least: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["part"]):
            rows = table.select(["part", "block", "lang", "at", "left", "counts"]).to_pylist()
            total: defaultdict = defaultdict(int)
            for r in rows:
                for w, n in zip(r["left"].split(b"\n"), unpack(r["counts"], np.int64).tolist(), strict=True):
                    total[r["lang"], w] += n
            ids = {key: (rows[0]["part"] << 40) + i for i, key in enumerate(k for k, n in total.items() if n >= least)}
            yield from _rows([{"kind": "frequent", "id": i, "lang": lang, "word": w.decode("utf-8", "replace"), "a": total[lang, w]}
                              for (lang, w), i in ids.items()], _FOUND)
            for r in rows:
                found = np.array([ids.get((r["lang"], w), -1) for w in r["left"].split(b"\n")], np.int64)
                keep = found >= 0
                yield from _rows([{"kind": "answer", "block": r["block"], "at": _steps(_unsteps(r["at"])[keep]),
                                   "ids": pack(found[keep])}], _FOUND)

    return run


def _answers(rows: list[dict], size: int) -> tuple[np.ndarray, np.ndarray]:
    """New small code (or -1) of each old one, and the ids of the new codes."""
    at = np.concatenate([_unsteps(r["at"]) for r in rows] or [np.zeros(0, np.int32)])
    ids = np.concatenate([unpack(r["ids"], np.int64) for r in rows] or [np.zeros(0, np.int64)])
    new = np.full(size, -1, np.int32)
    new[at] = np.arange(len(at), dtype=np.int32)
    return new, ids


def _relation(block: int, lang: str, size: int, places: np.ndarray, codes: np.ndarray, ids: np.ndarray) -> dict:
    held = np.zeros(size, bool)
    held[places] = True
    return {"block": block, "lang": lang, "size": size, "places": pack(np.packbits(held)), "codes": pack(codes.astype(np.int32)), "ids": pack(ids)}


_RELATION_SCHEMA = pa.schema([("block", pa.int64()), ("lang", pa.string()), ("size", pa.int64()), ("places", pa.binary()), ("codes", pa.binary()), ("ids", pa.binary())])


def _first_relation(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """R_1 of each block: its words' codes, semi-joined with the frequent words."""
    for table in groups(batches, ["block"]):
        rows = table.to_pylist()
        own = next(r for r in rows if r["codes"] is not None)
        codes = unpack(own["codes"], np.int32)
        new, ids = _answers([r for r in rows if r["at"] is not None], int(codes.max(initial=0)) + 1)
        codes = new[codes]
        places = np.flatnonzero(codes >= 0)
        yield from _rows([_relation(own["block"], own["lang"], len(codes), places, codes[places], ids)], _RELATION_SCHEMA)


def _joined(r: dict) -> tuple:
    """R_k joined with itself by adjacent position: places, each one's group, the groups' ids and counts."""
    places = np.flatnonzero(np.unpackbits(unpack(r["places"], np.uint8), count=r["size"]))
    codes, ids = unpack(r["codes"], np.int32), unpack(r["ids"], np.int64)
    first = np.flatnonzero(places[1:] == places[:-1] + 1)
    keys = codes[first].astype(np.int64) * max(len(ids), 1) + codes[first + 1]
    keys, group, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return places[first], group, ids[keys // max(len(ids), 1)], ids[keys % max(len(ids), 1)], counts


def _ask_pairs(parts: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                _, _, left, right, counts = _joined(r)
                with np.errstate(over="ignore"):
                    part = (mix(left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                cuts = np.flatnonzero(np.diff(part[order], prepend=-1, append=-1)) if len(order) else []
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    at = order[a:b]
                    yield from _rows([{"part": int(part[at[0]]), "block": r["block"], "at": _steps(at), "left": pack(left[at]),
                                       "right": pack(right[at]), "counts": pack(counts[at].astype(np.int64))}], _ASK)

    return run


def _count_pairs(least: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["part"]):
            part, blocks = table.column("part")[0].as_py(), table.column("block").to_pylist()
            flat = lambda name, kind: [unpack(x, kind) for x in table.column(name).to_pylist()]
            at, left, right, counts = [_unsteps(x) for x in table.column("at").to_pylist()], np.concatenate(flat("left", np.int64)), np.concatenate(flat("right", np.int64)), np.concatenate(flat("counts", np.int64))
            order = np.lexsort((right, left))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(left[order]) != 0) | (np.diff(right[order]) != 0)
            begin = np.flatnonzero(new)
            total = np.add.reduceat(counts[order], begin)
            frequent = total >= least
            ids = np.where(frequent, (part << 40) + np.cumsum(frequent) - 1, -1)
            heads = order[begin[frequent]]
            n = len(heads)
            made = {"kind": ["frequent"] * n, "id": ids[frequent], "left": left[heads], "right": right[heads], "a": total[frequent]}
            yield pa.RecordBatch.from_arrays([pa.array(made[f.name], type=f.type) if f.name in made else pa.nulls(n, f.type) for f in _FOUND], schema=_FOUND)
            told = np.empty(len(order), np.int64)
            told[order] = ids[np.cumsum(new) - 1]
            begin = 0
            for block, places in zip(blocks, at, strict=True):
                own = told[begin : begin + len(places)]
                begin += len(places)
                if (own >= 0).any():
                    yield from _rows([{"kind": "answer", "block": block, "at": _steps(places[own >= 0]), "ids": pack(own[own >= 0])}], _FOUND)

    return run


def _next_relation(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """R_{k+1} of each block: the joined occurrences, semi-joined with the frequent groups."""
    for table in groups(batches, ["block"]):
        rows = table.to_pylist()
        own = next((r for r in rows if r["codes"] is not None), None)
        answers = [r for r in rows if r["at"] is not None]
        if own is None or not answers:
            continue  # no frequent phrase begins in this block
        places, group, left, _, _ = _joined(own)
        new, ids = _answers(answers, len(left))
        codes = new[group]
        keep = codes >= 0
        yield from _rows([_relation(own["block"], own["lang"], own["size"], places[keep], codes[keep], ids)], _RELATION_SCHEMA)


def _with_answers(relation: DataFrame, answers: DataFrame, make, schema: str) -> DataFrame:
    """``make`` over the blocks, each with the answers to it."""
    fields = [f for f in relation.columns if f != "ids"]
    a = relation.select(*fields, F.col("ids") if "ids" in relation.columns else F.lit(None).cast("binary").alias("ids"), F.lit(None).cast("binary").alias("at"))
    names = [c for c in a.columns if c not in ("block", "at", "ids")]
    b = answers.select("block", *[F.lit(None).cast(a.schema[c].dataType).alias(c) for c in names], "ids", "at")
    both = a.select("block", *names, "ids", "at").unionByName(b)
    return both.repartition("block").sortWithinPartitions("block").mapInArrow(make, schema)


def _write(df: DataFrame, *by: str) -> DataFrame:
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "setm", uuid.uuid4().hex)
    writer = df.write.partitionBy(*by) if by else df.write
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def frequent_phrases(docs: DataFrame, least: int = 100, longest: int = 5, block_words: int = BLOCK_WORDS) -> tuple[list[DataFrame], DataFrame]:
    """Per length the phrases that occur ``least`` times or more in their language, and words a language.

    A phrase has ``id, lang, phrase, last`` (its last word), ``a`` (occurrences), ``firsts``
    and ``lasts`` (occurrences of its first and of its last 1, 2, ... words, itself included).
    """
    blocks = _write(docs.select("lang", "text").mapInArrow(_read_blocks(block_words), "block long, lang string, codes binary, words binary, counts binary, n long"))
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    places = blocks.agg(F.sum("n")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), places // PART_PLACES + 1)

    asked = blocks.select("block", "lang", "words", "counts").mapInArrow(_ask_words(parts), _ASK_DDL)
    found = _write(_by_part(asked, parts).mapInArrow(_count_words(least), _FOUND_DDL), "kind")
    one = F.array("a")
    levels = [found.where("kind = 'frequent'").select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a", one.alias("firsts"), one.alias("lasts"))]
    relation = _write(_with_answers(blocks.select("block", "lang", "codes"), found.where("kind = 'answer'"), _first_relation, _RELATION))
    for length in range(2, longest + 1):
        asked = relation.mapInArrow(_ask_pairs(parts), _ASK_DDL)
        found = _write(_by_part(asked, parts).mapInArrow(_count_pairs(least), _FOUND_DDL), "kind")
        levels.append(_write(_spelled(found.where("kind = 'frequent'"), levels[-1])))
        if length < longest:
            relation = _write(_with_answers(relation, found.where("kind = 'answer'"), _next_relation, _RELATION))
    return levels, totals


def _by_part(asked: DataFrame, parts: int) -> DataFrame:
    return asked.repartition(parts, "part").sortWithinPartitions("part")


def _spelled(pairs: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases of two overlapping shorter ones, with their words and counts."""
    left = shorter.select(F.col("id").alias("left"), F.col("lang").alias("l_lang"), F.col("phrase").alias("head"), "firsts")
    right = shorter.select(F.col("id").alias("right"), "last", "lasts")
    both = pairs.select("id", "left", "right", "a").join(left, "left").join(right, "right")
    return both.select(
        "id", F.col("l_lang").alias("lang"), F.concat_ws(" ", "head", "last").alias("phrase"), "last", "a",
        F.concat("firsts", F.array("a")).alias("firsts"), F.concat("lasts", F.array("a")).alias("lasts"))


def _lowest_cut(length: int) -> Column:
    """Over the cuts after k words, the struct of lowest score and then smallest k.

    38 digits hold the products; a is at most l and r, so the quotient fits a long.
    """
    wide = "cast({} as decimal(38,0))".format
    made = []
    for k in range(1, length):
        l, r = f"firsts[{k - 1}]", f"lasts[{length - k - 1}]"
        score = F.expr(f"({wide(1000)} * {wide('a')} * {wide('n')}) div ({wide(l)} * {wide(r)})")
        made.append(F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), F.expr(l).alias("l"), F.expr(r).alias("r")))
    return made[0] if length == 2 else F.least(*made)


def _parts_of(phrase: str, length: int) -> Column:
    """All runs of 2 to length - 1 words of a phrase."""
    words = F.split(phrase, " ")
    return F.array(*[F.array_join(F.slice(words, i, n), " ") for n in range(2, length) for i in range(1, length - n + 2)])


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, share: int = 100, top: int = 2000, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's ``top`` phrases of 2 to ``longest`` words.

    A phrase's score is the lowest over its cuts of floor(1000*a*n/(l*r)), ties to the shortest
    first part. A phrase inside a longer frequent one goes if 100*f(longer) >= share*a.
    """
    levels, totals = frequent_phrases(docs, least, longest, block_words)
    scored, inner = None, None
    for length in range(2, longest + 1):
        level = levels[length - 1]
        own = level.join(totals, "lang").select("lang", "phrase", "a", "n", _lowest_cut(length).alias("cut"))
        scored = own if scored is None else scored.unionByName(own)
        if length > 2:
            held = level.select("lang", F.explode(_parts_of("phrase", length)).alias("phrase"), F.col("a").alias("longer"))
            inner = held if inner is None else inner.unionByName(held)
    if inner is not None:
        inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
        scored = scored.join(inner, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    rows = scored.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
