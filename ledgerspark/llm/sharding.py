"""Sharding along a Hilbert curve over several metadata dimensions."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import RANK, TOTAL, globally_ranked

#: Bits of each dimension's cell.
BITS = 6


@lru_cache
def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """Digit and next state of the curve, by ``state * 2**dims + cell bits``.

    A state is an entry corner and a direction. The digit of a cell in its state is the
    inverse Gray code of its bits, turned into the state's frame; the next state follows
    from the entry corner and direction of that digit's sub-cube.
    """
    full = (1 << dims) - 1

    def rotated(x: int, by: int) -> int:
        by %= dims
        return ((x << by) | (x >> (dims - by))) & full

    def gray(x: int) -> int:
        return x ^ (x >> 1)

    def ungray(x: int) -> int:
        out = 0
        while x:
            out ^= x
            x >>= 1
        return out

    def entry(w: int) -> int:
        return 0 if w == 0 else gray(2 * ((w - 1) // 2))

    def trailing_ones(w: int) -> int:
        n = 0
        while w & 1:
            n, w = n + 1, w >> 1
        return n

    def direction(w: int) -> int:
        if w == 0:
            return 0
        return trailing_ones(w - 1 if w % 2 == 0 else w) % dims

    digits, following = [], []
    for corner in range(full + 1):
        for axis in range(dims):
            for cell in range(full + 1):
                w = ungray(rotated(cell ^ corner, dims - (axis + 1)))
                digits.append(w)
                to = corner ^ rotated(entry(w), axis + 1)
                following.append(to * dims + (axis + direction(w) + 1) % dims)
    return digits, following


def hilbert_index(cells: list[Column], bits: int = BITS) -> Column:
    """Place of a cell on the curve; ``cells`` are integers of ``bits`` bits."""
    dims = len(cells)
    digits, following = curve_tables(dims)
    wide = 1 << dims

    def corner(level: Column) -> Column:
        out = F.lit(0)
        for i, c in enumerate(cells):
            bit = F.call_function("shiftright", c.cast("int"), level).bitwiseAND(F.lit(1))
            out = out + bit * F.lit(1 << i)
        return out

    corners = F.transform(F.sequence(F.lit(bits - 1), F.lit(0)), corner)
    digit_of, next_of = F.array(*map(F.lit, digits)), F.array(*map(F.lit, following))
    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))

    def step(acc: Column, cell: Column) -> Column:
        at = acc["state"] * F.lit(wide) + cell
        return F.struct(F.get(next_of, at).alias("state"), (acc["index"] * F.lit(wide) + F.get(digit_of, at)).cast("long").alias("index"))

    return F.aggregate(corners, start, step, lambda acc: acc["index"])


def ordinal_cells(df: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """``_value, _cell``: each value's place among the distinct values, cut into cells.

    One row per distinct value; equal order of values and cells lets a shard's smallest
    and largest value exclude it. Null is the last value.
    """
    by_value = Window.orderBy(F.col("_value").asc_nulls_last())
    n = F.count(F.lit(1)).over(Window.partitionBy())
    return df.select(F.col(column).alias("_value")).groupBy("_value").agg(F.count(F.lit(1)).alias("_n")).select(
        "_value", F.floor((F.row_number().over(by_value) - 1) * (1 << bits) / n).cast("int").alias("_cell")
    )


def size_cell(size: Column, bits: int = BITS) -> Column:
    """Three cells for each doubling of the size."""
    return F.least(F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double")) * 3), F.lit((1 << bits) - 1)).cast("int")


def hilbert_shards(
    rows: DataFrame,
    shards: int,
    categories: list[str],
    size_col: str = "size",
    id_col: str = "doc_id",
    bits: int = BITS,
) -> DataFrame:
    """``rows`` with ``hilbert long, shard int, slot long``.

    Dimensions are ``categories`` (cells by the order of their values) and the size
    (cells by its logarithm). Rows are ordered by curve index and id, and that order is
    cut into runs whose row counts differ by at most one; ``slot`` counts from 0 inside
    each. Neighbours on the curve are neighbours in every dimension, so each shard holds
    a small box of the metadata and its files' statistics exclude it from queries on any
    of the columns.

    The rank is found by range partitions over index and id, so a cell with most rows is
    spread. Nulls form the last category; a null size counts as 0; a null id sorts first;
    equal rows take either order. With fewer rows than shards some shards are empty; an
    empty table gives an empty result. Other columns are carried along; those named like
    a result are replaced.
    """
    out = rows.drop("hilbert", "shard", "slot")
    for i, name in enumerate(categories):
        cells = ordinal_cells(rows, name, bits).select(F.col("_value").alias(f"_v{i}"), F.col("_cell").alias(f"_c{i}"))
        out = out.join(cells, F.col(name).eqNullSafe(F.col(f"_v{i}"))).drop(f"_v{i}")
    cells = [F.col(f"_c{i}") for i in range(len(categories))] + [size_cell(F.coalesce(size_col, F.lit(0)), bits)]
    out = out.withColumn("hilbert", hilbert_index(cells, bits)).drop(*[f"_c{i}" for i in range(len(categories))])
    ranked = globally_ranked(out, [F.col("hilbert"), F.col(id_col)], "hilbert")
    shard = F.expr(f"({RANK} * {shards}L) div {TOTAL}")
    return (
        ranked.withColumn("shard", shard.cast("int"))
        .withColumn("slot", F.col(RANK) - F.expr(f"(shard * {TOTAL} + {shards - 1}L) div {shards}L"))
        .drop(RANK, TOTAL)
    )
