"""A global row number without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize

#: monotonically_increasing_id() keeps the partition above this bit and the row below it.
_PARTITION_BIT = 33

RANK = "_rank"
TOTAL = "_total"


def globally_ranked(df: DataFrame, order: list[Column], tag: str) -> DataFrame:
    """``df`` with ``_rank`` (0-based position under ``order``) and ``_total`` (number of rows).

    The rows are dealt by range and sorted inside each partition, so a value that holds
    a third of all rows still spreads over many tasks as long as ``order`` ends in an
    identifier. The sorted rows are written once; a count per partition then gives each
    partition's first rank. That count table has one row per partition, which bounds
    both its window and its broadcast. Rows that tie on all of ``order`` are ranked in
    either order.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_row", F.monotonically_increasing_id()),
        tag,
    )
    part = F.shiftright("_row", _PARTITION_BIT).alias("_part")
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "_part",
        F.coalesce(F.sum("_n").over(upto), F.lit(0).cast("long")).alias("_start"),
        F.sum("_n").over(Window.partitionBy()).alias(TOTAL),
    )
    row = F.col("_row").bitwiseAND(F.lit((1 << _PARTITION_BIT) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")  # one row per partition
        .withColumn(RANK, F.col("_start") + row)
        .drop("_part", "_start", "_row")
    )
