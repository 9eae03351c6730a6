"""Rows known by id and text, and keeping wide rows out of a shuffle when few have a partner."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hash buckets of a prefilter: the most rows that it ever broadcasts (8 bytes each).
BUCKETS = 1 << 20
#: Stands for a null id.
NO_ID = -(1 << 63)
#: What a row is known by.
KEY = ["row", "text_hash"]


def key_columns(id_col: str, text_col: str) -> list[Column]:
    """``row, text_hash``: a row's id (null: the least long) and the hash of its text (null: empty)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("row"), F.xxhash64(text).alias("text_hash")]


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, text_hash, text`` of every row; null texts are empty."""
    return docs.select(*key_columns(id_col, text_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def bundled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, text_hash`` and the whole row as ``doc``, so that no column name can clash."""
    return docs.select(*key_columns(id_col, text_col), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))


def original_id() -> Column:
    """The id that ``row`` stands for."""
    return F.nullif("row", F.lit(NO_ID))


def _bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).alias("_bucket")


def with_partner(wide: DataFrame, thin: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``wide`` whose keys may occur in ``thin``; an exact join on ``keys`` must follow.

    The hash buckets that ``thin`` occupies, BUCKETS rows at most whatever its size, are
    broadcast, and rows of other buckets stop before they are shuffled. Where ``thin``
    fills all buckets nothing is gained and nothing is lost.
    """
    used = thin.select(_bucket(keys)).distinct()
    return wide.withColumn("_bucket", _bucket(keys)).join(F.broadcast(used), "_bucket", "left_semi").drop("_bucket")


def attached(wide: DataFrame, thin: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of ``wide`` and ``thin`` on ``keys`` (no nulls) in which only rows that may have a partner are shuffled."""
    used = F.broadcast(thin.select(_bucket(keys)).distinct())  # BUCKETS rows at most
    marked = wide.withColumn("_bucket", _bucket(keys))
    maybe = marked.join(used, "_bucket", "left_semi").join(thin, keys, "left")
    return marked.join(used, "_bucket", "left_anti").unionByName(maybe, allowMissingColumns=True).drop("_bucket")


def without(wide: DataFrame, lost: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``wide`` whose ``keys`` are not in ``lost`` (same column names); a row with a null key stays.

    Only rows in a hash bucket that ``lost`` occupies are shuffled for the exact test.
    """
    lost = lost.select(*keys).distinct()
    used = F.broadcast(lost.select(_bucket(keys)).distinct())  # BUCKETS rows at most
    marked = wide.withColumn("_bucket", _bucket(keys))
    sure = marked.join(used, "_bucket", "left_anti")
    maybe = marked.join(used, "_bucket", "left_semi").join(lost, keys, "left_anti")
    return sure.unionByName(maybe).drop("_bucket")


def without_rows(docs: DataFrame, lost: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose ``row, text_hash`` are in ``lost``."""
    return without(bundled(docs, id_col, text_col), lost, KEY).select("doc.*")
