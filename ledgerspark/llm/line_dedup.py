"""Line deduplication that returns keep bitmaps instead of text."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import KEY, attached, identified, original_id
from .runs import frequent
from .storage import steps

#: White space stripped from both ends of a line's key.
BLANKS = " \t\n\x0b\x0c\r"
#: Documents from which on a line is dropped everywhere.
MIN_DOCS = 10
#: Code points from which on a key counts.
MIN_CHARS = 1


def _lines(min_chars: int):
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("row", pa.int64()), ("text_hash", pa.int64()), ("pos", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.slice(at, 512)
                lines = pc.split_pattern(part.column(2), "\n")
                keys = pc.ascii_lower(pc.ascii_trim(lines.flatten(), BLANKS))
                counts = np.asarray(lines.value_lengths())
                owner = np.repeat(np.arange(len(part)), counts)
                first = np.repeat(np.cumsum(counts) - counts, counts)
                pos = np.arange(len(owner)) - first
                long_enough = np.asarray(pc.greater_equal(pc.utf8_length(keys), min_chars))
                digest = xxhash.xxh3_128_digest
                kept = keys.filter(pa.array(long_enough)).cast(pa.binary()).to_pylist()
                h = np.frombuffer(b"".join(map(digest, kept)), np.int64).reshape(-1, 2)
                o = owner[long_enough]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), part.column(0).take(pa.array(o)), part.column(1).take(pa.array(o)), pa.array(pos[long_enough])], schema=schema
                )

    return work


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("row", pa.int64()), ("text_hash", pa.int64()), ("keep", pa.binary())])
    for batch in batches:
        maps = []
        for dropped in batch.column(2):
            d = np.asarray(dropped.values)
            keep = np.ones((int(d.max()) + 8) // 8 * 8, dtype=bool)  # whole bytes
            keep[d] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.binary())], schema=schema)


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, text_hash, keep`` for each document that loses lines.

    ``keep`` is a zlib-compressed bitmap, one bit a line, most significant first; lines
    beyond its end are kept. ``row`` is the id (null as the least long), ``text_hash`` the
    text's xxhash64, so rows that repeat an id with other texts stay apart; they count as
    one document.

    Lines are hashed to 128 bits of their key: stripped of ASCII white space at both
    ends, A-Z lower-cased. The hashes are dealt by range, sorted by document and
    position inside each range, and streamed (see runs.frequent); keys of fewer than
    ``min_chars`` code points never count. Text is not shuffled here. A null or empty
    text is one empty line. An empty table gives an empty result.
    """
    rows = identified(docs, id_col, text_col)
    lines = rows.mapInArrow(_lines(min_chars), "h1 long, h2 long, row long, text_hash long, pos long")
    found = frequent(lines, ["h1", "h2"], ["row"], "pos", min_docs, "lines", carry=("text_hash",))
    return (
        found.groupBy("row", "text_hash").agg(F.collect_set("pos").alias("dropped"))
        .mapInArrow(_bitmaps, "row long, text_hash long, keep binary")
    )


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("row", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_text", pa.string())])
    for batch in batches:
        n, lost, texts = [], [], []
        for text, keep in zip(batch.column(1), batch.column(2), strict=True):
            lines = text.as_py().split("\n")
            n.append(len(lines))
            if not keep.is_valid:
                lost.append(0)
                texts.append(text.as_py())
                continue
            bits = np.unpackbits(np.frombuffer(zlib.decompress(keep.as_py()), np.uint8))
            left = [x for i, x in enumerate(lines) if i >= len(bits) or bits[i]]
            lost.append(len(lines) - len(left))
            texts.append("\n".join(left))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(lost, pa.int64()), pa.array(texts, pa.string())], schema=schema)


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_lines, n_dropped, kept_text``.

    Applies keep_bitmaps() to the texts; those that lose nothing are not shuffled. Remaining lines are joined by line feeds; a
    document that loses all lines keeps the empty text.
    """
    with steps() as own:
        maps = own.keep(keep_bitmaps(docs, min_docs, min_chars, id_col, text_col), "bitmaps")
    rows = identified(docs, id_col, text_col)
    out = attached(rows, maps, KEY).select("row", "text", "keep").mapInArrow(_apply, "row long, n_lines long, n_dropped long, kept_text string")
    return out.select(original_id().alias("doc_id"), "n_lines", "n_dropped", "kept_text")
