"""Keys that occur often enough, streamed from range partitions of any skew."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize

#: Rows of a key of too few units that a task holds before it sends them on as undecided.
HELD = 200_000
#: Row kinds that a partition emits: found, undecided at its edge, count of a key at its edge.
_FOUND, _OPEN, _COUNT = 0, 1, 2


def _stream(keys: int, ids: int, carried: int, least: int, by_position: bool):
    """mapInArrow function over rows sorted by key, ids and position.

    Reads each run of one key and emits its rows once it has ``least`` units; until then
    it holds rows of fewer units, HELD and a batch at most: more are emitted as undecided,
    and then the run's count is. A unit is a row, or all rows of a run with equal ids.
    A partition's first and last run may go on in the next one, so where such a run is
    short its rows are emitted as undecided, and its count always is.
    """
    names = [f"k{i}" for i in range(keys)] + [f"i{i}" for i in range(ids)] + ["pos"] + [f"c{i}" for i in range(carried)] + ["kind", "units"]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def out(rows: np.ndarray, kind: int, units: int = 0) -> pa.RecordBatch:
        n = rows.shape[1]
        if kind == _FOUND:
            rows = np.concatenate([np.zeros((keys, n), np.int64), rows[keys:]])  # keys are not needed any more
        extra = [np.full(n, kind, np.int64), np.full(n, units, np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in [*rows, *extra]], schema=schema)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the run that the last batch ended in
        counted = 0  # its units before ``held``, once its rows are out
        first = True  # whether that run is the partition's first
        last_id = None  # the ids that ended the rows already out
        undecided = False  # whether rows of that run are out as undecided

        def close(final: bool) -> Iterator[pa.RecordBatch]:
            """The held run is over, or the partition is, with ``final``."""
            if held is None:
                return
            units = counted + (_units(held, last_id) if held.shape[1] else 0)
            edge = first or final or undecided
            if held.shape[1] and (units >= least):
                yield out(held, _FOUND)
            elif held.shape[1] and edge:
                yield out(held, _OPEN)
            if edge:
                yield out(np.concatenate([key, np.zeros(ids + 1 + carried, np.int64)])[:, None], _COUNT, units)

        def _units(rows: np.ndarray, before) -> int:
            if by_position:
                return rows.shape[1]
            change = (rows[keys : keys + ids, 1:] != rows[keys : keys + ids, :-1]).any(axis=0).sum() + 1
            return int(change) - int(before is not None and bool((rows[keys : keys + ids, 0] == before).all()))

        key = None
        for batch in batches:
            if not len(batch):
                continue
            rows = np.stack([np.asarray(c) for c in batch.columns])
            starts = np.flatnonzero((rows[:keys, 1:] != rows[:keys, :-1]).any(axis=0)) + 1
            bounds = np.concatenate([[0], starts, [rows.shape[1]]])
            if held is not None and not (rows[:keys, 0] == key).all():
                yield from close(False)
                held, counted, first, last_id, undecided = None, 0, False, None, False
            # The first run goes on from what is held; the last one stays held.
            if held is None:
                held, key = rows[:, : bounds[1]], rows[:keys, 0].copy()
            else:
                held = np.concatenate([held, rows[:, : bounds[1]]], axis=1)
            if len(bounds) > 2:
                yield from close(False)
                first, counted, last_id, undecided = False, 0, None, False
                lo, hi = bounds[1], bounds[-2]
                if hi > lo:
                    inner = rows[:, lo:hi]
                    at = bounds[1:-2] - lo
                    unit = np.ones(hi - lo, np.int64)
                    if not by_position:
                        unit[1:] = (inner[keys : keys + ids, 1:] != inner[keys : keys + ids, :-1]).any(axis=0)
                        unit[at] = 1
                    often = np.add.reduceat(unit, at) >= least
                    pick = np.repeat(often, np.diff(np.append(at, hi - lo)))
                    if pick.any():
                        yield out(inner[:, pick], _FOUND)
                held, key = rows[:, hi:], rows[:keys, hi].copy()
            units = counted + _units(held, last_id) if held.shape[1] else counted
            if held.shape[1] and (units >= least or held.shape[1] >= HELD):
                yield out(held, _FOUND if units >= least else _OPEN)
                undecided |= units < least
                counted, last_id, held = units, held[keys : keys + ids, -1].copy(), held[:, :0]
        yield from close(True)

    return work, names


def frequent(df: DataFrame, keys: list[str], ids: list[str], pos: str, least: int, tag: str, by_position: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """``ids``, ``pos`` and ``carry`` of the rows of ``df`` (all long) whose key has at least ``least`` units.

    Rows are dealt by ranges of key, ids and position with those as a secondary sort, and
    every partition streams its runs. A key of any number of rows spreads over as many
    partitions as its rows fill. Where a run reaches a partition's edge, the partitions'
    counts of that key are summed: at most two keys and fewer than ``least`` units a
    partition take part in that. Units are distinct ``ids`` of a key, or its rows with
    ``by_position``.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    work, names = _stream(len(keys), len(ids), len(carry), least, by_position)
    # Equal ids of one key share a partition, so that their units are counted once.
    deal = [*keys, *ids, pos] if by_position else [*keys, *ids]
    found = materialize(
        df.select(*keys, *ids, pos, *carry).repartitionByRange(n, *deal).sortWithinPartitions(*keys, *ids, pos)
        .mapInArrow(work, ", ".join(f"{c} long" for c in names)),
        tag,
    )
    k = [f"k{i}" for i in range(len(keys))]
    often = found.where(F.col("kind") == _COUNT).groupBy(*k).agg(F.sum("units").alias("u")).where(F.col("u") >= least).select(*k)
    cols = [F.col(f"i{i}").alias(c) for i, c in enumerate(ids)] + [F.col("pos").alias(pos)] + [F.col(f"c{i}").alias(c) for i, c in enumerate(carry)]
    rest = found.where(F.col("kind") == _OPEN).join(often, k, "left_semi")
    return found.where(F.col("kind") == _FOUND).select(*cols).unionByName(rest.select(*cols))
