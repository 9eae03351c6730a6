"""Exact deduplication: group by a 128-bit content hash, compare bytes inside the groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import without
from .text import ascii_lower


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when their bytes are, after A-Z are lower-cased. Groups are keyed by
    the MD5 of that text and by the text itself, so Spark's own aggregation compares the
    bytes and two texts with one hash never share a group. Copies collapse inside each
    map task before the shuffle; of a group of any size one row per task leaves it. What
    is joined back are groups of two and more, by hash only, and a hot hash is split by
    adaptive skew handling, as no other operation needs its rows together.

    Null texts count as empty. ``keep`` is ``"largest"`` or ``"smallest"`` id of a group.
    Rows that repeat an id each count in ``group_size`` and share a decision; rows with a
    null id count too, and are kept only where their whole group has null ids. An empty
    table gives an empty result. Other columns of ``docs`` are not read.
    """
    best = {"largest": F.max, "smallest": F.min}[keep]
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_norm"),
    )
    groups = (
        rows.groupBy(F.unhex(F.md5("_norm")).alias("_key"), "_norm")
        .agg(F.count(F.lit(1)).alias("_n"), best("doc_id").alias("_keep"))
        .where("_n > 1")
        .select("_key", F.sha2("_norm", 256).alias("text_sha256"), "_n", "_keep")
    )
    return (
        rows.select("doc_id", F.unhex(F.md5("_norm")).alias("_key"), F.sha2("_norm", 256).alias("text_sha256"))
        .join(groups, ["_key", "text_sha256"], "left")
        .select(
            "doc_id",
            F.when(F.col("_n").isNull(), F.col("doc_id")).otherwise(F.col("_keep")).alias("keep_id"),
            F.coalesce("_n", F.lit(1).cast("long")).alias("group_size"),
            F.when(F.col("_n").isNull(), True).otherwise(F.col("doc_id").eqNullSafe(F.col("_keep"))).alias("kept"),
            "text_sha256",
        )
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """``docs`` without the rows that exact_groups() does not keep."""
    lost = exact_groups(docs, id_col, text_col, keep).where("not kept").select(F.col("doc_id").alias(id_col))
    return without(docs, lost.where(F.col(id_col).isNotNull()), [id_col])
