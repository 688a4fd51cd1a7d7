"""Token counts as delta-maintained rollups.

A change batch holds inserts, deletes and revised counts of documents. It is turned into
signed rows: an insert adds a document's count, a delete takes back what the ledger holds,
a revision takes back the old and adds the new count. A ledger of signed rows and its sums
by (source, lang, tokenizer) are kept in one folder each, partitioned by batch id, and a
third folder holds the committed ids in order; a batch counts once its id is there, so one
that was cut off counts once it is committed again.

Batches apply in the order of their first commits. A batch takes back only what the batches
before it left standing. Committing it again replaces its own partition, at its own place in
the order, and derives anew what each later batch takes back, so that committing any batch again
with the same changes changes nothing, and with other changes gives what those would have
given then. The order is read from the folder, so a rollup goes on in a new session; one
process at a time may commit.

Defined results: null sources and languages are groups of their own; null ids are ignored
(they cannot be revised); a null text counts 0 tokens; repeated rows of a change batch are
one change; deletes and revisions of unknown documents do nothing and add the document
respectively; an empty batch changes no totals; other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import WORD_PATTERN
from tessera.session import cut_lineage, ensure_checkpoint_dir

GROUP = ["source", "lang", "tokenizer"]
#: Tokenizer versions: white-space words, and words with their marks apart.
TOKENIZERS: dict[str, Callable[[Column], Column]] = {
    "words-1": lambda text: F.regexp_count(text, F.lit(WORD_PATTERN)),
    "words-2": lambda text: F.regexp_count(text, F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+|[!-/:-@\[-`{-~]")),
}
_LEDGER = "doc_id long, source string, lang string, tokenizer string, docs long, tokens long, batch_id string"


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(doc_id, source, lang, tokenizer, tokens)`` of the documents that have an id."""
    counted = F.coalesce(TOKENIZERS[tokenizer](F.col("text")), F.lit(0)).cast("long")
    return docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.lit(tokenizer).alias("tokenizer"), counted.alias("tokens"))


class Rollup:
    """The ledger and totals in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or os.path.join(ensure_checkpoint_dir(spark), "rollups", uuid.uuid4().hex)
        self.batches: list[str] = self._committed() if folder else []

    def _committed(self) -> list[str]:
        """The ids of the folder's committed batches, in order; none in a folder without them."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/batches")
        if not path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(path):
            return []
        rows = self.spark.read.schema("place long, batch_id string").parquet(f"{self.folder}/batches")
        return [r["batch_id"] for r in rows.orderBy("place").collect()]

    def _read(self, name: str, batches: list[str]) -> DataFrame:
        schema = _LEDGER if name == "ledger" else _LEDGER.replace("doc_id long, ", "")
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}").where(F.col("batch_id").isin(batches))

    def _write(self, rows: DataFrame, name: str, batch_id: str) -> None:
        (rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(f"{self.folder}/{name}"))

    def _taken_back(self, before: list[str], ids: DataFrame) -> DataFrame:
        """Signed rows that take back all that stands of the documents after the batches ``before``."""
        rows = self._read("ledger", before).groupBy("doc_id", *GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        stands = rows.where("docs <> 0").join(ids, "doc_id", "left_semi")
        return stands.select("doc_id", *GROUP, (-F.col("docs")).alias("docs"), (-F.col("tokens")).alias("tokens"))

    def _sum(self, batch_id: str) -> None:
        mine = self._read("ledger", [batch_id])
        self._write(mine.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")), "deltas", batch_id)

    def _zeros(self, ids: DataFrame) -> DataFrame:
        """Rows that count nothing: a batch's ledger names every document that the batch deletes."""
        nothing = [F.lit(None).cast("string").alias(c) for c in GROUP]
        return ids.select("doc_id", *nothing, F.lit(0).cast("long").alias("docs"), F.lit(0).cast("long").alias("tokens"))

    def commit(self, batch_id: str, inserts: DataFrame | None = None, deletes: DataFrame | None = None) -> None:
        """Commits a batch. ``inserts``: counted documents, new or revised (a revision replaces all
        that stands of the document); ``deletes``: doc_id. Committing it again replaces it."""
        if inserts is None and deletes is None:
            return
        again = batch_id in self.batches
        place = self.batches.index(batch_id) if again else len(self.batches)
        before, after = self.batches[:place], self.batches[place + 1 :]
        # a row without a document keeps an empty batch's partition, so that it replaces what was there
        rows = self._zeros(self.spark.range(1).select(F.lit(None).cast("long").alias("doc_id")))
        touched = []
        if inserts is not None:
            new = inserts.groupBy("doc_id", *GROUP).agg(F.max("tokens").alias("tokens"))
            rows = rows.unionByName(new.select("doc_id", *GROUP, F.lit(1).cast("long").alias("docs"), "tokens"))
            touched.append(inserts.select(F.col("doc_id").cast("long").alias("doc_id")))
        if deletes is not None:
            gone = cut_lineage(deletes.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct())
            rows = rows.unionByName(self._zeros(gone))
            touched.append(gone)
        if before:
            ids = touched[0] if len(touched) == 1 else touched[0].union(touched[1])
            rows = rows.unionByName(self._taken_back(before, ids.distinct()))
        self._write(rows, "ledger", batch_id)
        self._sum(batch_id)
        if not again:
            mark = self.spark.range(1).select(F.lit(place).cast("long").alias("place"), F.lit(batch_id).alias("batch_id"))
            mark.write.mode("append").parquet(f"{self.folder}/batches")
            self.batches.append(batch_id)
        for k, later in enumerate(after, place + 1):
            self._derive(later, self.batches[:k])

    def _derive(self, batch_id: str, before: list[str]) -> None:
        """Writes a committed batch anew: its own counts as they are, what it takes back as ``before`` stands now."""
        mine = self._read("ledger", [batch_id]).drop("batch_id")
        ids = mine.where("doc_id is not null").select("doc_id").distinct()
        rows = mine.where("docs >= 0").unionByName(self._taken_back(before, ids))
        self._write(cut_lineage(rows), "ledger", batch_id)  # it reads the partition that it replaces
        self._sum(batch_id)

    def totals(self) -> DataFrame:
        """``(source, lang, tokenizer, docs, tokens)``: sums of the committed deltas."""
        if not self.batches:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer string, docs long, tokens long")
        sums = self._read("deltas", self.batches).groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs <> 0 or tokens <> 0")
