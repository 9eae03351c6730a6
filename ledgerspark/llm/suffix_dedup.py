"""Removal of long repeated byte strings by difference-cover sampling and hash matching.

No suffix is ordered: removal needs only to know which strings of ``length`` bytes are
equal. A cover of period v has a residue pair for every shift: of two equal strings of
``length`` bytes, some offset below v lands on sampled positions in both. So

1. sampled positions are matched by the name (hash) of their ``length - v + 1`` bytes,
   and those that share a name stay;
2. the positions up to v - 1 bytes before such a sample are matched by the name of their
   first ``length`` bytes, and equal ones are the repeated strings.

A perfect difference set makes the sample as small as it can be: 18 of 307 positions
for 400 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import with_partner
from .names import repeated_positions
from .storage import materialize
from .tokens import BLOCK, U, blocks, mix, powers, prefix_sums, texts_of

#: Bytes of a string that may not repeat.
LENGTH = 400
#: Rounds in which the remaining suffixes are merged, by a residue of their name; the shuffle's disk falls in proportion.
PASSES = 5


@lru_cache
def difference_cover(period_at_most: int) -> tuple[int, np.ndarray]:
    """A perfect difference set: period q*q + q + 1 for the largest prime q that fits, q + 1 residues.

    The powers of a primitive element of the field of q**3 elements that lie in a plane,
    by Singer's construction.
    """
    primes = [q for q in range(2, 1000) if all(q % d for d in range(2, int(q**0.5) + 1))]
    q = max([q for q in primes if q * q + q + 1 <= period_at_most], default=2)
    v = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                x, plane = (1, 0, 0), []
                for i in range(v):
                    if i and x[1] == x[2] == 0:
                        break
                    if x[2] == 0:
                        plane.append(i)
                    x = (c * x[2] % q, (x[0] + b * x[2]) % q, (x[1] + a * x[2]) % q)
                else:
                    if len(plane) == q + 1 and len({(i - j) % v for i in plane for j in plane}) == v:
                        return v, np.array(plane, dtype=np.int64)
    raise ValueError("no cover found")


def cover_for(length: int) -> tuple[int, np.ndarray, int]:
    """Period, residues and bytes of a name for strings of ``length``."""
    v, residues = difference_cover(max(7, length * 77 // 100))
    return v, residues, length - v + 1


def _parts(data: np.ndarray, overlap: int) -> Iterator[tuple[int, np.ndarray]]:
    """Pieces of a text with the bytes that windows at their end need."""
    for i in range(0, max(1, len(data)), BLOCK):
        yield i, data[i : i + BLOCK + overlap]


def _names(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    c = prefix_sums(data)
    _, down = powers(len(data) + 1)
    return mix((c[at + width] - c[at]) * down[at])


def _samples(length: int):
    v, residues, width = cover_for(length)

    def places(n: int, template: np.ndarray) -> np.ndarray:
        return template[: np.searchsorted(template, n - width, "right")]

    def namer(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        template = (np.arange(0, BLOCK + 2 * length, v)[:, None] + residues).ravel()
        step = BLOCK // v * v  # long texts go in pieces that start on the period
        for batch in batches:
            uid = batch.column(0).to_pylist()
            data, offsets = texts_of(batch.column(1))
            for i, j in blocks(offsets):
                if j - i == 1 and offsets[j] - offsets[i] > BLOCK:
                    whole = data[offsets[i] : offsets[j]]
                    for k in range(0, len(whole), step):
                        p = places(len(whole) - k, template)
                        p = p[p < step]
                        yield uid[i], _names(whole[k : k + step + width], p, width), None, p + k
                    continue
                part = data[offsets[i] : offsets[j]]
                c = prefix_sums(part)
                _, down = powers(len(part) + 1)
                for k in range(i, j):
                    start, n = offsets[k] - offsets[i], offsets[k + 1] - offsets[k]
                    if n >= length:
                        p = places(n, template)
                        at = p + start
                        yield uid[k], mix((c[at + width] - c[at]) * down[at]), None, p

    return namer


def _merged(length: int, rounds: int, r: int):
    """Names of the suffixes near repeated samples whose name leaves ``r``."""
    v, _, _ = cover_for(length)

    def namer(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            data, offsets = texts_of(batch.column(1))
            for k, uid in enumerate(batch.column(0).to_pylist()):
                text, near = data[offsets[k] : offsets[k + 1]], np.asarray(batch.column(2)[k].values)
                last = len(text) - length
                edge = np.zeros(last + 2, np.int32)
                np.add.at(edge, np.maximum(0, near - v + 1).clip(max=last + 1), 1)
                np.add.at(edge, near.clip(max=last) + 1, -1)
                wanted = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                for start, part in _parts(text, length):
                    at = wanted[(wanted >= start) & (wanted < start + BLOCK)] - start
                    if not len(at):
                        continue
                    h = _names(part, at, length)
                    own = h % U(rounds) == U(r)
                    at, h = at[own], h[own]
                    # A second hash, of other letters, makes 96 bits.
                    yield uid, h, (_names(_OTHER[part], at, length) >> U(32)).astype(np.uint32), at + start

    return namer


#: A fixed shuffle of the byte values.
_OTHER = np.random.Generator(np.random.PCG64(5)).permutation(256).astype(np.uint8)

SPANS_DDL = "uid long, starts array<long>, stops array<long>"


def _union(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of a union of spans."""
    order = np.argsort(starts, kind="stable")
    a, b = starts[order], np.maximum.accumulate(stops[order])
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > b[:-1]
    first = np.flatnonzero(new)
    return a[first], b[np.append(first[1:], len(a)) - 1]


def _covered(length: int):
    """Spans from positions where repeated strings start, or from spans of several rounds."""
    schema = pa.schema([("uid", pa.int64()), ("starts", pa.list_(pa.int64())), ("stops", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k in range(len(batch)):
                starts = np.asarray(batch.column(1)[k].values)
                stops = starts + length if length else np.asarray(batch.column(2)[k].values)
                out.append(_union(starts, stops))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([a for a, _ in out], pa.list_(pa.int64())), pa.array([b for _, b in out], pa.list_(pa.int64()))], schema=schema)

    return work


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``uid, doc_id, text``. The uid is the id, or a hash of id and text where ids repeat or are null."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    twice = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").limit(1).count()
    uid = F.xxhash64(F.coalesce("doc_id", F.lit(-1)), F.col("doc_id").isNull(), "text") if twice else F.col("doc_id")
    return rows.withColumn("uid", uid)


def _spans(rows: DataFrame, copies: DataFrame, length: int, rounds: int) -> tuple[DataFrame, DataFrame]:
    """Spans by uid of texts that are no later copy, and the texts concerned."""
    found = repeated_positions(rows.select("uid", "text"), _samples(length))
    near = found.groupBy("uid").agg(F.flatten(F.collect_list("positions")).alias("near")).join(copies.where("uid <> rep").select("uid"), "uid", "left_anti")
    near = materialize(near, "near")
    texts = materialize(with_partner(rows.select("uid", "text"), near, ["uid"]).join(near, "uid"), "near-texts")
    spans = None
    for r in range(rounds):
        own = repeated_positions(texts, _merged(length, rounds, r)).mapInArrow(_covered(length), SPANS_DDL)
        own = materialize(own, "spans")
        spans = own if spans is None else spans.unionByName(own)
    spans = spans.groupBy("uid").agg(F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("stops")).alias("stops")).mapInArrow(_covered(0), SPANS_DDL)
    return spans, texts.select("uid", "text")


def _copies(rows: DataFrame, length: int) -> DataFrame:
    """``uid, rep`` of texts of at least ``length`` bytes that occur more than once; rep is the least uid of the text."""
    thin = materialize(rows.where(F.octet_length("text") >= length).select("uid", F.unhex(F.sha2("text", 256)).alias("m"), F.octet_length("text").alias("n")), "digests")
    often = thin.groupBy("m", "n").agg(F.min("uid").alias("rep"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    often = materialize(often, "often")  # written, so that the join's hot groups can be split
    return materialize(thin.join(often.hint("merge"), ["m", "n"]).select("uid", "rep").distinct(), "copies")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("uid", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
    for batch in batches:
        lost, runs, kept = [], [], []
        for text, starts, stops in zip(*batch.columns[1:4], strict=True):
            data = memoryview(text.as_buffer())
            a, b = np.asarray(starts.values), np.asarray(stops.values)
            lost.append(int((b - a).sum()))
            runs.append(len(a))
            kept.append(b"".join(data[i:j] for i, j in zip([0, *b.tolist()], [*a.tolist(), len(data)], strict=True)))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lost, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())], schema=schema)


def remove_repeats(docs: DataFrame, length: int = LENGTH, rounds: int = PASSES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, n_bytes, n_removed, n_spans, starts, stops, kept_sha256``.

    Every byte covered by a string of ``length`` bytes that also starts anywhere else, in
    the same document or another, is removed; strings are judged on the input. ``starts``
    and ``stops`` are the removed runs (null where nothing is). Cut them with cut().

    Texts that occur more than once are removed whole, and one of them takes part in the
    rest. Sampled suffixes are named by 64 bits, which only proposes; removal rests on 96
    bits of a ``length``-byte prefix. Names are sorted in ranges (see
    names.repeated_positions), which receive a passage that a third of the documents
    share once from each block of documents. Whole texts never enter a shuffle unless they hold a
    repeated sample.

    Null counts as empty; texts shorter than ``length`` lose nothing. Rows that repeat an
    id are treated one by one; equal rows are copies of each other. An empty table gives
    an empty result. Other columns are not read.
    """
    rows = _identified(docs, id_col, text_col)
    copies = _copies(rows, length)
    spans, texts = _spans(rows, copies, length, rounds)
    thin = rows.select("uid", "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("_whole"))
    cut_ = (
        texts.join(spans, "uid").join(copies.select("uid"), "uid", "left_anti").dropDuplicates(["uid"])
        .select("uid", "text", "starts", "stops")
    )
    changed = cut_.mapInArrow(_kept, "uid long, n_removed long, n_spans long, kept binary").select("uid", "n_removed", "n_spans", F.sha2("kept", 256).alias("_sha"))
    changed = materialize(changed.join(spans, "uid"), "changed")
    out = thin.join(changed, "uid", "left").join(copies.select("uid", F.lit(True).alias("_copy")), "uid", "left")
    copy = F.col("_copy").isNotNull()
    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id",
        "n_bytes",
        F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", zero)).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", zero)).alias("n_spans"),
        F.when(copy, F.array(zero)).otherwise(F.col("starts")).alias("starts"),
        F.when(copy, F.array("n_bytes")).otherwise(F.col("stops")).alias("stops"),
        F.when(copy, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("_sha", "_whole")).alias("kept_sha256"),
    )


def cut(rows: DataFrame) -> DataFrame:
    """``uid, n_removed, n_spans, kept`` from columns ``uid, text, starts, stops``: the remaining bytes."""
    return rows.select("uid", "text", "starts", "stops").mapInArrow(_kept, "uid long, n_removed long, n_spans long, kept binary")
