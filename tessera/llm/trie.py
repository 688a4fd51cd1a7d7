"""Prefix trie of conversations, by union-find over the edges of sorted neighbours.

Every conversation is the sequence of its turns' digests. All are sorted; an edge joins two
neighbours and is as deep as their common first turns (LCP). A task takes one range of the
order and works its edges off in descending depth: a component stands for one node, rises
turn by turn to the depth of its edge (each turn that it leaves is a node) and merges there
with its neighbour, which makes a branching node. Nodes on the path of a range's first or
last conversation may go on in the next range; they stay open. A range is contracted to
those two paths, with what is known so far at each turn, and the paths of FAN ranges are
merged by the same procedure, until one range is left.

Conversations are sorted by (digests, id), so copies of one conversation spread over ranges.
The ids that end in one node are hashed as a stream of packed runs, a row a range.

Rows without conv_id belong to no conversation; a null turn number comes first, equal turn
numbers go by the digest of role and text; null role or text counts as empty; repeated rows are
turns of their own; an empty table gives no rows; other columns are not read. A conversation's
digests (not its texts) must fit one row.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import groups
from tessera.session import cut_lineage, ensure_checkpoint_dir

#: Hex digits of a turn's digest, and contracted ranges that one task merges.
DIGITS, FAN = 32, 256
NOTHING = hashlib.sha256(b"").hexdigest()

_PATHS = ["ns", "mins", "kids", "leaves", "saved"]
_OUT = pa.schema([
    ("kind", pa.string()), ("part", pa.int64()), ("side", pa.int32()), ("key", pa.string()), ("cps", pa.list_(pa.int64())),
    *[(c, pa.list_(pa.int64())) for c in _PATHS],
    ("own", pa.string()), ("up", pa.string()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()), ("ids", pa.binary())])
_OUT_DDL = ("kind string, part long, side int, key string, cps array<long>, " + ", ".join(f"{c} array<long>" for c in _PATHS)
            + ", own string, up string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ids binary")
_RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_FAR = 1 << 62


def turns_of(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: a conversation's turns in order, each ``(digest, cp)``."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(
        "turn", digest.alias("digest"), F.length(text).cast("long").alias("cp")).alias("t"))
    ordered = F.sort_array(F.collect_list("t"))  # nulls first
    return rows.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["digest"], t["cp"])).alias("turns"))


def share_first_turns(turns: DataFrame, among: int = 100, modulus: int = 6) -> DataFrame:
    """Conversation c begins with the first h turns of c - c%among in place of its own first h;
    h is crc32 of the decimal c, modulo ``modulus``."""
    base = F.col("conv_id") - F.col("conv_id") % among
    heads = turns.where(F.col("conv_id") % among == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, modulus - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % modulus).cast("int")
    both = turns.withColumn("base", base).join(heads, "base", "left").withColumn("h", h)
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return both.select("conv_id", F.concat(head, own).alias("turns"))


def _name(key: str, depth: int) -> str:
    return hashlib.md5(f"{depth}:{key[: depth * DIGITS]}".encode()).hexdigest()


def _lcp(a: str, b: str) -> int:
    n = min(len(a), len(b)) // DIGITS
    if a[: n * DIGITS] == b[: n * DIGITS]:
        return n
    low, high = 0, n - 1  # the first turn that differs lies in low..high
    while low < high:
        mid = (low + high) // 2
        if a[low * DIGITS : (mid + 1) * DIGITS] == b[low * DIGITS : (mid + 1) * DIGITS]:
            low = mid + 1
        else:
            high = mid
    return low


class _Node:
    """A component: the node at ``depth`` on the path of ``item``, and what is known below it."""

    __slots__ = ("item", "depth", "first", "last", "n", "least", "kids", "leaves", "saved", "below", "ends", "paths")

    def __init__(self, item: int, depth: int, paths: list | None):
        self.item, self.depth, self.first, self.last = item, depth, item, item
        self.below: list[dict] = []
        self.ends: np.ndarray | None = None
        self.paths = [paths] if paths else []
        self.clear()

    def clear(self) -> None:
        self.n, self.least, self.kids, self.leaves, self.saved = 0, _FAR, 0, 0, 0

    def gather(self) -> None:
        """Add what the contracted paths know at this depth."""
        for ns, mins, kids, leaves, saved in self.paths:
            if self.depth < len(ns):
                d = self.depth
                self.n, self.least, self.kids = self.n + ns[d], min(self.least, mins[d]), self.kids + kids[d]
                self.leaves, self.saved = self.leaves + leaves[d], self.saved + saved[d]

    def merge(self, other: _Node) -> None:
        self.last, self.n, self.least, self.kids = other.last, self.n + other.n, min(self.least, other.least), self.kids + other.kids
        self.leaves, self.saved, self.paths = self.leaves + other.leaves, self.saved + other.saved, self.paths + other.paths
        self.ends = other.ends if self.ends is None else self.ends
        if len(self.below) < len(other.below):
            self.below, other.below = other.below, self.below
        self.below += other.below


class _Range:
    """One range's forest. ``items``: (key, code points a turn, ids or None, paths or None), in order."""

    def __init__(self, part: int, items: list[tuple], whole: bool, contracted: bool):
        self.part, self.items, self.whole, self.contracted = part, items, whole, contracted
        self.rows: list[dict] = []
        self.sides = [self._blank(items[0]), self._blank(items[-1])]

    @staticmethod
    def _blank(item: tuple) -> list[list[int]]:
        size = len(item[1]) + 1
        return [[0] * size, [_FAR] * size, [0] * size, [0] * size, [0] * size]

    def leave(self, c: _Node) -> None:
        """The component's node is complete as far as this range goes; rise by one turn."""
        key, cps = self.items[c.item][:2]
        open_ = not self.whole and (c.first == 0 or c.last == len(self.items) - 1)
        name = _name(key, c.depth) if open_ or self.contracted else None
        for row in c.below:
            row |= {"kind": "child", "part": self.part, "up": name} if open_ else {"kind": "node", "parent_conv_id": c.least}
        self.rows += c.below
        c.below = []
        if open_:
            side = self.sides[c.last == len(self.items) - 1]
            for known, value in zip(side, (c.n, c.least, c.kids, c.leaves, c.saved), strict=True):
                known[c.depth] = value
            if c.ends is not None:
                self.rows.append({"kind": "ends", "part": self.part, "own": name, "ids": ",".join(map(str, c.ends.tolist())).encode()})
            c.clear()
        else:
            c.saved += (c.n - 1) * cps[c.depth - 1] if c.depth else 0
            c.leaves += c.kids == 0
            ends = None if self.contracted else NOTHING if c.ends is None else hashlib.sha256(",".join(map(str, c.ends.tolist())).encode()).hexdigest()
            row = {"own": name, "conv_id": c.least, "depth": c.depth, "n_convs": c.n, "n_children": c.kids, "n_leaves": c.leaves, "saved_tokens": c.saved, "ends_sha256": ends}
            c.below.append(row)
            c.kids = 1
        c.ends = None
        c.depth -= 1
        if c.depth >= 0:
            c.gather()

    def run(self) -> list[dict]:
        items = self.items
        nodes = []
        for i, (_, cps, ids, paths) in enumerate(items):
            c = _Node(i, len(cps), paths)
            if ids is not None:
                c.n, c.least, c.ends = len(ids), int(ids[0]), ids
            c.gather()
            nodes.append(c)
        root = list(range(len(items)))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        depth = np.array([_lcp(a[0], b[0]) for a, b in zip(items[:-1], items[1:], strict=True)], np.int64)
        for e in np.argsort(-depth, kind="stable").tolist():
            a, b = find(e), find(e + 1)
            for x in (nodes[a], nodes[b]):
                while x.depth > depth[e]:
                    self.leave(x)
            nodes[a].merge(nodes[b])
            nodes[b], root[b] = None, a
        top = nodes[find(0)]
        while top.depth >= 0:
            self.leave(top)
        if self.whole:
            for row in top.below:
                self.rows.append(row | {"kind": "node", "parent_conv_id": None})
        else:
            for side in (0, 1) if len(items) > 1 else (1,):
                key, cps = items[-side][:2]
                self.rows.append({"kind": "path", "part": self.part, "side": side, "key": key, "cps": cps, **dict(zip(_PATHS, self.sides[side], strict=True))})
        return self.rows


def _emit(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), 4096):
        some = rows[at : at + 4096]
        yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in some], type=f.type) for f in _OUT], schema=_OUT)


def _forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    items: list[tuple] = []
    for batch in batches:
        for key, conv, cps in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist(), batch.column("cps").to_pylist(), strict=True):
            if items and items[-1][0] == key:
                items[-1][2].append(conv)
            else:
                items.append((key, cps, [conv], None))
    if items:
        yield from _emit(_Range(TaskContext.get().partitionId(), [(k, c, np.array(i), p) for k, c, i, p in items], False, False).run())


def _merge(level: int, whole: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, ["part"]):
            items = [(r["key"], r["cps"], None, [r[c] for c in _PATHS]) for r in table.to_pylist()]
            rows = _Range(table.column("part")[0].as_py(), items, whole, True).run()
            for r in rows:
                if r["kind"] == "child":
                    r["part"] += level << 40
            yield from _emit(rows)

    return run


def _hash_ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest of each node's runs of ids; only the digest's state is held."""
    schema = pa.schema([("own", pa.string()), ("ends_sha256", pa.string())])
    last, state = None, None
    for batch in batches:
        done = []
        for own, ids in zip(batch.column("own").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if own == last:
                state.update(b"," + ids)
            else:
                if last is not None:
                    done.append((last, state.hexdigest()))
                last, state = own, hashlib.sha256(ids)
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], schema=schema)
    if last is not None:
        yield pa.RecordBatch.from_arrays([pa.array([last]), pa.array([state.hexdigest()])], schema=schema)


def _written(df: DataFrame) -> DataFrame:
    path = os.path.join(ensure_checkpoint_dir(df.sparkSession), "trie", uuid.uuid4().hex)
    df.write.partitionBy("kind").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build(sequences: DataFrame, fan: int = FAN) -> DataFrame:
    """The trie's nodes over ``conv_id, turns`` (each turn its ``digest`` and ``cp``), a row a node."""
    flat = cut_lineage(sequences.select(
        F.array_join(F.transform("turns", lambda t: t["digest"]), "").alias("key"), "conv_id", F.transform("turns", lambda t: t["cp"]).alias("cps")))
    sorted_ = flat.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    made = [_written(sorted_.mapInArrow(_forest, _OUT_DDL))]
    level, ranges = 0, (made[0].where("kind = 'path'").agg(F.max("part")).first()[0] or 0) + 1
    while True:
        level, ranges = level + 1, -(-ranges // fan)
        paths = made[-1].where("kind = 'path'").withColumn("was", F.col("part")).withColumn("part", F.floor(F.col("part") / fan).cast("long"))
        dealt = paths.repartition(ranges, "part").sortWithinPartitions("part", "was", "side").select("part", "key", "cps", *_PATHS)
        made.append(_written(dealt.mapInArrow(_merge(level, ranges == 1), _OUT_DDL)))
        if ranges == 1:
            break
    rows = made[0]
    for more in made[1:]:
        rows = rows.unionByName(more)

    # nodes that went over a range's edge: their ids and their children's parent come from afar
    opened = rows.where("own is not null and kind in ('node', 'child')").select("own", F.col("conv_id").alias("above"))
    wanted = rows.where("kind = 'child'").groupBy("part", "up").agg(F.lit(1).alias("one"))
    parents = wanted.join(opened.withColumnRenamed("own", "up"), "up").select("part", "up", "above")
    child = rows.where("kind = 'child'").join(parents, ["part", "up"]).withColumn("parent_conv_id", F.col("above"))
    nodes = rows.where("kind = 'node'").select("own", *_RESULT).unionByName(child.select("own", *_RESULT))
    ends = rows.where("kind = 'ends'").select("own", "part", "ids").repartition("own").sortWithinPartitions("own", "part")
    ends = ends.select("own", "ids").mapInArrow(_hash_ends, "own string, ends_sha256 string")
    far = nodes.where("own is not null").drop("ends_sha256").join(ends, "own", "left")
    far = far.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    return nodes.where("own is null").select(_RESULT).unionByName(far.select(_RESULT))


def conversation_trie(conversations: DataFrame, fan: int = FAN) -> DataFrame:
    """The trie of the conversations with shared first turns; see ``share_first_turns`` and ``build``."""
    return build(share_first_turns(turns_of(conversations)), fan)
