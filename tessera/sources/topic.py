"""A topic: an append-only log of messages with dense offsets, and a stream source that reads it by offset.

``publish`` appends the rows of a table: each gets the next offset in the order given, and the
log is written as parquet segments of bounded length. A publish has a folder of its own, named
by its first offset; it counts once Spark has marked it complete, and one that failed is written
anew by the next publish. One publisher at a time.

``TopicSource`` (format ``topic``) reads the log as a batch or as a stream. A position is one
number: offsets from ``startingOffset`` up to, but without, ``endingOffset`` (the log's end if not
given). A stream keeps its position in its checkpoint; a restart goes on from there, and a batch
that was cut off is read again by the same offsets. With the option ``group`` the committed
position is also written beside the log, for whoever watches how far a consumer is.

The folder has to be one that Arrow can open on every machine (a shared file system, HDFS, an
object store). The driver lists segments and reads footers; tasks read the rows, a segment each.

Defined results: null keys and values stay null, empty ones empty; an empty publish adds
nothing; a topic without messages gives an empty table; offsets beyond the end are not waited for
by a batch.
"""

from __future__ import annotations

import json
import posixpath
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from tessera.functions.ordering import with_global_position
from tessera.session import ship_package

SCHEMA = "offset long, key string, value string"
#: Messages of a segment, which is what one task reads; messages of a batch of rows inside a task.
SEGMENT_ROWS, READ_ROWS = 1 << 20, 512


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", folder)
    return fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)


class Segment(InputPartition):
    """A file of the log with its first offset and the offset after its last."""

    def __init__(self, path: str, first: int, end: int):
        self.path, self.first, self.end = path, first, end


class Log:
    """The complete segments of a topic's folder; those known already are not opened again."""

    def __init__(self, folder: str):
        self.store, self.root = _open(folder)
        self.known: dict[str, Segment] = {}

    def segments(self) -> list[Segment]:
        listed = self.store.get_file_info(fs.FileSelector(self.root, recursive=True, allow_not_found=True))
        complete = {posixpath.dirname(f.path) for f in listed if f.base_name == "_SUCCESS"}
        for f in listed:
            published = posixpath.dirname(posixpath.dirname(f.path))
            if f.extension == "parquet" and published in complete and f.path not in self.known:
                self.known[f.path] = self._segment(f.path)
        return sorted((s for s in self.known.values() if s.end > s.first), key=lambda s: s.first)

    def _segment(self, path: str) -> Segment:
        with self.store.open_input_file(path) as handle:
            meta = pq.ParquetFile(handle).metadata
        spans = [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups) if meta.row_group(i).num_rows]
        return Segment(path, min((s.min for s in spans), default=0), max((s.max + 1 for s in spans), default=0))

    def end(self) -> int:
        return max((s.end for s in self.segments()), default=0)

    def between(self, start: int, end: int) -> list[Segment]:
        return [Segment(s.path, max(s.first, start), min(s.end, end)) for s in self.segments() if s.first < end and s.end > start]


def end_offset(folder: str) -> int:
    """The offset that the next message will get."""
    return Log(folder).end()


def publish(messages: DataFrame, folder: str, order_cols: list, segment_rows: int = SEGMENT_ROWS) -> int:
    """Appends ``(key, value)`` of ``messages`` in the order given (a total order, up to equal
    messages); returns the log's new end."""
    start = end_offset(folder)
    placed = with_global_position(messages, order_cols, "_pos")
    first = F.lit(start) + F.floor(F.col("_pos") / segment_rows).cast("long") * segment_rows
    rows = placed.select((F.lit(start) + F.col("_pos")).cast("long").alias("offset"), F.col("key").cast("string").alias("key"),
                         F.col("value").cast("string").alias("value"), first.alias("segment"))
    dealt = rows.repartition("segment").sortWithinPartitions("segment", "offset")
    dealt.write.mode("overwrite").partitionBy("segment").parquet(posixpath.join(folder, f"from={start:020d}"))
    return end_offset(folder)


def read_segment(store: fs.FileSystem, part: Segment) -> Iterator[pa.RecordBatch]:
    """The messages of a segment from ``first`` up to ``end``; row groups outside are not read."""
    with store.open_input_file(part.path) as handle:
        file = pq.ParquetFile(handle)
        spans = [(i, file.metadata.row_group(i).column(0).statistics) for i in range(file.metadata.num_row_groups)]
        wanted = [i for i, s in spans if s is not None and s.max >= part.first and s.min < part.end]
        for batch in file.iter_batches(READ_ROWS, row_groups=wanted, columns=["offset", "key", "value"]):
            at = batch.column("offset")
            yield batch.filter(pc.and_(pc.greater_equal(at, part.first), pc.less(at, part.end)))


class _Range:
    """What the batch and the stream reader share: the log, and the range of offsets wanted."""

    def __init__(self, options: dict):
        self.folder = options["path"]
        self.first, last = int(options.get("startingoffset", 0)), options.get("endingoffset")
        self.last, self.group, self.log = None if last is None else int(last), options.get("group"), None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"log": None}  # file handles stay where they are

    def opened(self) -> Log:
        self.log = self.log or Log(self.folder)
        return self.log

    def limit(self) -> int:
        end = self.opened().end()
        return max(self.first, end if self.last is None else min(end, self.last))

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        yield from read_segment(_open(self.folder)[0], partition)


class TopicReader(_Range, DataSourceReader):
    def partitions(self) -> Sequence[InputPartition]:
        return self.opened().between(self.first, self.limit()) or [Segment("", 0, 0)]

    def read(self, partition: Segment) -> Iterator[pa.RecordBatch]:
        if partition.path:
            yield from super().read(partition)


class TopicStream(_Range, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"offset": self.first}

    def latestOffset(self) -> dict:
        return {"offset": self.limit()}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return self.opened().between(start["offset"], end["offset"])

    def commit(self, end: dict) -> None:
        if self.group:
            store, root = _open(self.folder)
            store.create_dir(posixpath.join(root, "groups"))
            with store.open_output_stream(posixpath.join(root, "groups", f"{self.group}.json")) as out:
                out.write(json.dumps(end).encode())


class TopicSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "topic"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TopicReader:
        return TopicReader(self.options)

    def streamReader(self, schema) -> TopicStream:
        return TopicStream(self.options)


def register(spark: SparkSession) -> None:
    """Makes the format ``topic`` known to the session."""
    ship_package(spark)
    spark.dataSource.register(TopicSource)


def read_stream(spark: SparkSession, folder: str, **options) -> DataFrame:
    """``(offset, key, value)`` as a stream; options as in the module's text."""
    register(spark)
    return spark.readStream.format("topic").options(**options).load(folder)


def read_batch(spark: SparkSession, folder: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("topic").options(**options).load(folder)


def copy_available(stream: DataFrame, base: str) -> str:
    """Writes what the stream has to offer now, a folder a batch; goes on where the last run with the
    same ``base`` ended. Returns the folder of the messages."""
    out = posixpath.join(base, "messages")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(posixpath.join(out, f"batch_id={batch_id}"))

    query = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", posixpath.join(base, "checkpoint"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return out
