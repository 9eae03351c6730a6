"""Positions whose name occurs more than once anywhere, matched in blocks of arrays.

Names are far too many to be rows: a task packs those of its documents into one array
for each range of names, the ranges are shuffled, sorted and compared, and only the
positions that matched travel back to where their documents are put together again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import U

#: Names that a task holds before it sends them on, and documents among them.
HELD, HELD_DOCS = 500_000, 60_000

#: A name's arrays: 64 and 32 bits of hash, document in its block, position; packed side by side.
_NAME = np.dtype([("h", "<u8"), ("h2", "<u4"), ("doc", "<u2"), ("pos", "<u4")])
#: ``doc`` of a name that its own block repeats already: it matches others and needs no answer.
_SETTLED = 0xFFFF
_HIT = np.dtype([("doc", "<u2"), ("pos", "<u4")])

_NAMES, _IDS, _HITS = 0, 1, 2
_SCHEMA = pa.schema([("range", pa.int64()), ("kind", pa.int32()), ("block", pa.int64()), ("data", pa.binary())])
_DDL = "range long, kind int, block long, data binary"

#: Yields ``(uid, h, h2, pos)`` of the documents of a batch; ``h2`` may be None.
Namer = Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, np.ndarray, np.ndarray | None, np.ndarray]]]


def _changes(a: np.ndarray) -> np.ndarray:
    new = np.ones(len(a), bool)
    new[1:] = (a["h"][1:] != a["h"][:-1]) | (a["h2"][1:] != a["h2"][:-1])
    return new


def _ordered(a: np.ndarray) -> np.ndarray:
    """Sorted by name. Names of equal ``h`` are put in order of ``h2`` only where there are any."""
    a = a[np.argsort(a["h"], kind="stable")]
    same = a["h"][1:] == a["h"][:-1]
    if same.any() and (a["h2"][1:] != a["h2"][:-1])[same].any():
        a = a[np.lexsort((a["h2"], a["h"]))]
    return a


def _sender(namer: Namer, ranges: int):
    def flush(block: int, uids: list[int], parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        a = _ordered(np.concatenate(parts))
        new = _changes(a)
        group = np.cumsum(new) - 1
        often = np.bincount(group)[group] > 1
        hits = np.empty(int(often.sum()), _HIT)
        hits["doc"], hits["pos"] = a["doc"][often], a["pos"][often]
        a["doc"][often] = _SETTLED
        a = a[new | ~often]
        width = (1 << 64) // ranges + 1
        cuts = np.searchsorted(a["h"], np.array([min(r * width, (1 << 64) - 1) for r in range(ranges)], dtype=U)).tolist() + [len(a)]
        rows = [(r, _NAMES, block, a[cuts[r] : cuts[r + 1]].tobytes()) for r in range(ranges) if cuts[r + 1] > cuts[r]]
        home = block % ranges
        rows += [(home, _IDS, block, np.array(uids, np.int64).tobytes()), (home, _HITS, block, hits.tobytes())]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), _SCHEMA.types, strict=True)], schema=_SCHEMA)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uids: list[int] = []
        parts: list[np.ndarray] = []
        held, block = 0, TaskContext.get().partitionId() << 32
        for uid, h, h2, pos in namer(batches):
            for at in range(0, len(h), HELD):  # a document of very many names takes several blocks
                a = np.empty(len(h[at : at + HELD]), _NAME)
                a["h"], a["h2"], a["doc"], a["pos"] = h[at : at + HELD], 0 if h2 is None else h2[at : at + HELD], len(uids), pos[at : at + HELD]
                uids.append(uid)
                parts.append(a)
                held += len(a)
                if held >= HELD or len(uids) >= HELD_DOCS:
                    yield from flush(block, uids, parts)
                    uids, parts, held, block = [], [], 0, block + 1
        if uids:
            yield from flush(block, uids, parts)

    return work


def _groups(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[tuple[int, list[tuple[int, int, int, bytes]]]]:
    """Rows of one key at a time, from batches sorted by it."""
    held: list[tuple[int, int, int, bytes]] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][key] != row[key]:
                yield held[0][key], held
                held = []
            held.append(row)
    if held:
        yield held[0][key], held


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for r, rows in _groups(batches, 0):
        out = [x for x in rows if x[1] != _NAMES]
        named = [x for x in rows if x[1] == _NAMES]
        if named:
            a = np.concatenate([np.frombuffer(x[3], _NAME) for x in named])
            block = np.repeat(np.arange(len(named), dtype=np.int64), [len(x[3]) // _NAME.itemsize for x in named])
            order = np.lexsort((a["h2"], a["h"])) if a["h2"].any() else np.argsort(a["h"], kind="stable")
            a, block = a[order], block[order]
            group = np.cumsum(_changes(a)) - 1
            hit = (np.bincount(group)[group] > 1) & (a["doc"] != _SETTLED)
            a, block = a[hit], block[hit]
            order = np.argsort(block, kind="stable")
            a, block = a[order], block[order]
            found = np.empty(len(a), _HIT)
            found["doc"], found["pos"] = a["doc"], a["pos"]
            for i in np.unique(block):
                lo, hi = np.searchsorted(block, [i, i + 1])
                out.append((r, _HITS, named[i][2], found[lo:hi].tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), _SCHEMA.types, strict=True)], schema=_SCHEMA)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _groups(batches, 2):
        ids = [np.frombuffer(x[3], np.int64) for x in rows if x[1] == _IDS]
        hits = np.concatenate([np.frombuffer(x[3], _HIT) for x in rows if x[1] == _HITS])
        if not len(hits):
            continue
        hits = hits[np.lexsort((hits["pos"], hits["doc"]))]
        docs, first = np.unique(hits["doc"], return_index=True)
        ends = np.append(first, len(hits)).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[0][docs]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(hits["pos"].astype(np.int64)))], names=["uid", "positions"]
        )


def repeated_positions(docs: DataFrame, namer: Namer) -> DataFrame:
    """``uid, positions array<long>`` of all positions of ``docs`` whose name occurs at least twice.

    A document's positions may come in more than one row. A name that a block repeats is
    settled there and goes on once, so what a range receives of one name is bounded by
    the number of blocks and not by the name's occurrences. Positions are below 2**32.
    Every block is a function of its task's rows alone, so repeated tasks give the same.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = docs.mapInArrow(_sender(namer, 2 * n), _DDL)
    matched = sent.repartition(n, "range").sortWithinPartitions("range").mapInArrow(_match, _DDL)
    return matched.repartition(n, "block").sortWithinPartitions("block").mapInArrow(_gather, "uid long, positions array<long>").where(F.size("positions") > 0)
