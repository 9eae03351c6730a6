"""Filling requests with attachments in the order they arrive, over all filings.

A request ends where the next attachment would pass a limit, so each cut depends on the
one before it. But where a request that begins at an attachment would end is known from
prefix sums alone. So the attachments are dealt by range into blocks; each block finds,
for every place in front of it where the open request may have begun, where the request
open at its own end begins; these small maps are composed from block to block; and then
every block knows its requests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.scratch import written

# What a request holds at most.
REQUEST_TABLE_ROWS, REQUEST_ATTACHMENTS, REQUEST_PAGES = 40, 10, 10

#: monotonically_increasing_id() keeps the partition above this bit and the row below it.
_BIT = 33

#: A limit by column, and whether an attachment that adds nothing to it always fits.
Limits = dict[str, tuple[int, bool]]


def _ends(weights: np.ndarray, limits: list[tuple[int, bool]], most: int) -> np.ndarray:
    """For each attachment, the one before which a request that begins with it ends. ``weights``: a row for each limit."""
    n = weights.shape[1]
    here = np.arange(n)
    ends = here + most
    for w, (limit, nothing_fits) in zip(weights, limits, strict=True):
        upto = np.concatenate([[0], np.cumsum(w)])
        room = upto[:-1] + limit
        if nothing_fits:
            room = np.maximum(room, upto[1:])
        ends = np.minimum(ends, np.searchsorted(upto, room, "right") - 1)
    return np.maximum(ends, here + 1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Block, places and weights, one block at a time, from rows ``block, at, weights...`` sorted by the first two."""
    held: list[np.ndarray] = []
    for batch in batches:
        rows = np.stack([np.asarray(c, dtype=np.int64) for c in batch.columns])
        cuts = np.flatnonzero(rows[0, 1:] != rows[0, :-1]) + 1
        for part in np.split(rows, cuts, axis=1):
            if not part.shape[1]:
                continue
            if held and held[0][0, 0] != part[0, 0]:
                whole = np.concatenate(held, axis=1)
                yield int(whole[0, 0]), whole[1], whole[2:]
                held = []
            held.append(part)
    if held:
        whole = np.concatenate(held, axis=1)
        yield int(whole[0, 0]), whole[1], whole[2:]


def _maps(before: dict[int, np.ndarray], limits: list[tuple[int, bool]], most: int):
    """``block, start, open, begun``: of a request that begins ``start`` attachments before the block, where the last one in it begins, from its first attachment, and how many begin there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, weights in _blocks(batches):
            ahead = before[block]
            ends = _ends(np.concatenate([ahead, weights], axis=1), limits, most).tolist()
            n, k = len(ends), ahead.shape[1]
            last, begun = list(range(n)), [0] * n
            for i in range(n - 1, -1, -1):
                if ends[i] < n:
                    last[i], begun[i] = last[ends[i]], begun[ends[i]] + 1
            starts = range(k + 1)  # k: with the block's first attachment
            out = [np.array(x, dtype=np.int64) for x in ([block] * (k + 1), [k - s for s in starts], [last[s] - k for s in starts], [begun[s] + (s == k) for s in starts])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["block", "start", "open", "begun"])

    return work


def _numbers(before: dict[int, np.ndarray], entry: dict[int, tuple[int, int]], limits: list[tuple[int, bool]], most: int):
    """``at, request`` of every attachment. ``entry``: attachments before a block with which its open request begins, and that request's number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, at, weights in _blocks(batches):
            ahead = before[block]
            start, number = entry[block]
            ends = _ends(np.concatenate([ahead, weights], axis=1), limits, most).tolist()
            n, k = len(ends), ahead.shape[1]
            begins = np.zeros(n, np.int64)
            i = ends[k - start] if start else k
            while i < n:
                begins[i] = 1
                i = ends[i]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(number + np.cumsum(begins[k:]))], names=["at", "request"])

    return work


def pack(attachments: DataFrame, order: list[Column], limits: Limits, most: int = REQUEST_ATTACHMENTS) -> DataFrame:
    """``attachments`` with ``request``, from 0, in their order.

    A request takes attachments until the next would be one more than ``most`` or would
    pass one of ``limits`` (columns of whole numbers, none negative); the first of a
    request is always taken. ``order`` must not leave ties. What reaches the driver is
    ``most`` rows a block, as many blocks as the shuffle has partitions; a block's
    weights are held by one task.
    """
    if most < 1:
        raise ValueError("a request holds at least one attachment")
    spark = attachments.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed, _ = written(attachments.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "placed")
    names, rules = list(limits), list(limits.values())
    thin = placed.select(F.shiftright("_at", _BIT).alias("block"), F.col("_at").alias("at"), *[F.col(c).cast("long").alias(f"w{i}") for i, c in enumerate(names)])
    row = F.col("at").bitwiseAND(F.lit((1 << _BIT) - 1))
    sizes = thin.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    tails = thin.join(F.broadcast(sizes), "block").where(row >= F.col("n") - most).orderBy("at").drop("n").collect()  # ``most`` rows a block
    before: dict[int, np.ndarray] = {}
    seen = np.zeros((len(names), 0), np.int64)
    for block in sorted({t.block for t in tails}):
        before[block] = seen
        own = np.array([t[2:] for t in tails if t.block == block], dtype=np.int64).T.reshape(len(names), -1)
        seen = np.concatenate([seen, own], axis=1)[:, -most:]
    dealt = thin.repartition("block").sortWithinPartitions("block", "at")
    maps: dict[int, dict[int, tuple[int, int]]] = {}
    for m in dealt.mapInArrow(_maps(before, rules, most), "block long, start long, open long, begun long").collect():  # ``most`` rows a block
        maps.setdefault(m.block, {})[m.start] = (m.open, m.begun)
    sized = {b.block: b.n for b in sizes.collect()}
    entry, start, number = {}, 0, -1
    for block in sorted(maps):
        entry[block] = (start, number)
        open_, begun = maps[block][start]
        start, number = sized[block] - open_, number + begun
    numbered = dealt.mapInArrow(_numbers(before, entry, rules, most), "at long, request long")
    return placed.join(numbered.withColumnRenamed("at", "_at"), "_at").drop("_at")


def text_requests(windows: DataFrame, order: list[Column], rows: int = REQUEST_TABLE_ROWS, most: int = REQUEST_ATTACHMENTS) -> DataFrame:
    """Requests of windows ``..., table_rows``; a window without table rows weighs as one."""
    weighed = windows.withColumn("rows", F.greatest(F.lit(1), F.col("table_rows")).cast("long"))
    return pack(weighed, order, {"rows": (rows, False)}, most)


def estimated_rows(estimate: Column, pages: Column, total: Column) -> Column:
    """A page range's share of a filing's estimated rows, rounded up; 0 without an estimate."""
    return F.when(estimate.isNotNull() & (total > 0), F.ceil(estimate * pages / total)).otherwise(F.lit(0)).cast("long")


def page_requests(ranges: DataFrame, order: list[Column], pages: int = REQUEST_PAGES, rows: int | None = REQUEST_TABLE_ROWS, most: int = REQUEST_ATTACHMENTS) -> DataFrame:
    """Requests of page ranges ``..., page_start, page_end, total_pages, estimated_rows`` (null: unknown, which no limit on rows keeps out)."""
    size = F.col("page_end") - F.col("page_start") + 1
    weighed = ranges.withColumns({"pages": size, "rows": estimated_rows(F.col("estimated_rows"), size, F.col("total_pages"))})
    limits: Limits = {"pages": (pages, False)}
    if rows is not None:
        limits["rows"] = (rows, True)
    return pack(weighed, order, limits, most)


def source_read_requests(pages: DataFrame, order: list[Column], rows: int = REQUEST_TABLE_ROWS, images: int | None = REQUEST_PAGES, most: int = REQUEST_ATTACHMENTS) -> DataFrame:
    """Requests of single filed pages ``..., table_rows, images``; a page without table rows weighs as one."""
    weighed = pages.withColumn("rows", F.greatest(F.lit(1), F.col("table_rows")).cast("long"))
    limits: Limits = {"rows": (rows, False)}
    if images is not None:
        limits["images"] = (images, False)
    return pack(weighed, order, limits, most)
