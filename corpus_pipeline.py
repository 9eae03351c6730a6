"""A training corpus from raw documents, as a chain of stages.

Every stage takes all documents that the one before kept and returns the columns of
``documents``, except the last, which returns each document's place in the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm import decontam, mixing, near_dedup, quality, queries
from ledgerspark.llm.storage import drop, steps
from ledgerspark.llm.text import word_count


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained quality classifier accepts.

    Null, empty and blank texts go; a null id, source or language stays a document like
    any other; rows that repeat are judged one by one; an empty table stays empty; other
    columns are carried along under any name.
    """
    return quality.accepted(docs, queries.table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each near-duplicate group.

    Texts without words stay; a null id comes last in its group; of rows that repeat id
    and text one stays; an empty table stays empty; other columns are carried along.
    """
    return near_dedup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark.

    Rows are known by id and text: each that repeats an id, or has none, is judged by its
    own text. Null and empty texts stay; an empty table stays empty; other columns are
    carried along.
    """
    return decontam.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    A null source is a source of its own; a null or empty text has no words and may be
    taken or not; null and repeated ids are rows of their own; an empty table stays
    empty; other columns are carried along.
    """
    return mixing.mixed_documents(docs, word_count(F.col("text")))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document along the Hilbert curve.

    Null sources and languages are the last of theirs, null texts have 16 bytes, null ids
    sort first, and rows that repeat have slots of their own; an empty table gives an
    empty result; other columns are not read.
    """
    return queries.sharded(docs)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The classifier and the near-duplicate components cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``.

    Each result is written before the next stage reads it; what a stage wrote besides is
    deleted then, and a result when the next one is written.
    """
    docs = queries.table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES[:-1]:
        with steps() as own:
            docs = own.keep(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
