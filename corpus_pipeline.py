"""A training corpus from raw documents: filters, near-dedup, mixing and packing as stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet
and read again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import mixing, neardup, packing, quality, toxicity
from tessera.llm.common import fold, ship, table
from tessera.llm.queries import TOKENIZER
from tessera.session import ensure_checkpoint_dir

#: The packing stage's rows depend on every stage before it; SQL cannot express the classifiers.
ORACLE_SQL = None


def _keep(docs: DataFrame, verdicts: DataFrame, keep) -> DataFrame:
    """The rows of ``docs`` whose id has a verdict to keep, and the rows without an id."""
    rejected = verdicts.where(F.col("doc_id").isNotNull() & ~keep).select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti").select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not predict toxic."""
    ship(spark)
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    found = toxicity.classify(docs.select("doc_id", "text"), labels, fold(F.col("doc_id"), 4) != 2)
    return _keep(docs, found, F.col("predicted") == 0)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts good."""
    ship(spark)
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    found = quality.classify(docs.select("doc_id", "text"), labels, fold(F.col("doc_id"), 5) != 0)
    return _keep(docs, found, F.col("predicted") == 1)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each class of near duplicates."""
    ship(spark)
    ensure_checkpoint_dir(spark)
    return _keep(docs, neardup.classes(docs.select("doc_id", "text")), F.col("kept"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix reads, once for each reading, in training order."""
    ensure_checkpoint_dir(spark)
    return mixing.arrange(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mix's documents with their sequences and places."""
    ship(spark)
    ensure_checkpoint_dir(spark)
    return packing.pack(docs.select("doc_id", "text"), TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", drop_near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents, each through a table in the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = os.path.join(ensure_checkpoint_dir(spark), "pipeline", uuid.uuid4().hex)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
