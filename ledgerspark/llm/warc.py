"""WARC archives from pages, as a table of record chunks, and back."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import attached
from .storage import materialize, shared_path, steps

#: Bytes of a payload chunk.
CHUNK = 256 * 1024
#: Smallest payload that a revisit record may replace.
MIN_REVISIT = 0

_VERSION = b"WARC/1.1"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Digits of a base-32 number, then the base32 alphabet (RFC 4648).
_BASE32_FROM, _BASE32_TO = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(data: Column) -> Column:
    """SHA-1 in upper-case base32: 160 bits are eight groups of 20 bits, four digits each."""
    h = F.sha1(data)
    digits = F.concat(*[F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)])
    return F.translate(digits, _BASE32_FROM, _BASE32_TO)


def payloads(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url") -> DataFrame:
    """``page, url, body, payload_bytes, digest, same``: payloads with their SHA-1 and SHA-256."""
    body = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    return pages.select(
        F.col(id_col).cast("long").alias("page"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), body.alias("body"),
        F.octet_length(body).cast("long").alias("payload_bytes"), base32_sha1(body).alias("digest"), F.unhex(F.sha2(body, 256)).alias("same"),
    )


#: Payloads are equal when all of these are.
_SAME = ["same", "digest", "payload_bytes"]


def first_pages(records: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """``same, digest, payload_bytes, first`` of payloads that occur more than once: the smallest page id of each.

    ``records`` as from payloads(); only those of at least ``min_revisit`` bytes count.
    Found by an aggregation over digests that combines before the shuffle.
    """
    return records.where(F.col("payload_bytes") >= min_revisit).groupBy(*_SAME).agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")


def _record_urn(page: Column) -> Column:
    """The same for rows that share page id and payload."""
    return F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(":"), F.col("digest"))


def chunk_table(records: DataFrame, first: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The archives as rows ``page, chunk_no, chunks, data, digest``, records in any order, chunks of a record in order.

    The row with the smallest id of equal payloads is the response (every such row, where
    the id repeats), the others revisit it. Chunk 0 holds the record's headers, chunks
    1.. its payload in pieces of ``chunk`` bytes. A revisit has no payload. A writer
    holds one chunk at a time. Only payloads that may have a copy are shuffled.
    """
    crlf = "\r\n"
    full = attached(records, first, _SAME)
    revisit = F.col("first").isNotNull() & ~F.col("page").eqNullSafe(F.col("first"))
    full = full.withColumns({"record_type": F.when(revisit, "revisit").otherwise("response"), "length": F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))})
    head = F.concat(
        F.lit(_VERSION.decode() + crlf),
        F.lit("WARC-Type: "), F.col("record_type"),
        F.lit(f"{crlf}WARC-Record-ID: <"), _record_urn(F.col("page")),
        F.lit(f">{crlf}WARC-Date: 1970-01-01T00:00:00Z{crlf}WARC-Target-URI: "), F.regexp_replace("url", r"[\x00-\x20\x7F]", ""),
        F.lit(f"{crlf}Content-Type: text/html; charset=utf-8{crlf}WARC-Payload-Digest: sha1:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"{crlf}WARC-Profile: {_REVISIT_PROFILE}{crlf}WARC-Refers-To: <"), _record_urn(F.col("first")), F.lit(f">{crlf}X-Payload-Length: "), F.col("payload_bytes").cast("string"))).otherwise(F.lit("")),
        F.lit(f"{crlf}Content-Length: "), F.col("length").cast("string"),
        F.lit(crlf * 2),
    )
    pieces = F.ceil(F.col("length") / F.lit(chunk)).cast("int")
    rows = full.select("page", head.cast("binary").alias("_head"), "body", pieces.alias("chunks"), "digest", F.explode(F.sequence(F.lit(0), pieces)).alias("chunk_no"))
    data = F.when(F.col("chunk_no") == 0, F.col("_head")).otherwise(F.expr(f"substring(body, (chunk_no - 1) * {chunk} + 1, {chunk})"))
    return rows.select("page", "chunk_no", "chunks", data.alias("data"), "digest")


def _writer(folder: str):
    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = name = None
        at = start = 0
        try:
            for batch in batches:
                index = []
                for page, no, chunks, data, digest in zip(*batch.columns, strict=True):
                    no, chunks = no.as_py(), chunks.as_py()
                    if out is None:
                        # A name of its own for each attempt: a repeated task leaves the first file unused.
                        name = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                        filesystem, path = fs.FileSystem.from_uri(name)
                        filesystem.create_dir(path.rpartition("/")[0])
                        out, at = filesystem.open_output_stream(path, compression=None), 0
                    if no == 0:
                        start, member, sha = at, zlib.compressobj(1, zlib.DEFLATED, 31), hashlib.sha1()
                    else:
                        sha.update(data.as_buffer())
                    at += out.write(member.compress(data.as_buffer()))
                    if no == chunks:
                        if chunks and base64.b32encode(sha.digest()).decode() != digest.as_py():
                            raise ValueError(f"payload digest of page {page} differs from its header")
                        at += out.write(member.compress(b"\r\n\r\n") + member.flush())
                        index.append((name, start, at - start, page.as_py()))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*index, strict=True), schema.types, strict=True)] if index else [pa.array([], t) for t in schema.types], schema=schema)
        finally:
            if out is not None:
                out.close()

    return work


def write_archives(chunks: DataFrame, folder: str) -> DataFrame:
    """Write gzipped WARC files, one for each partition that has rows; returns the index ``file, offset, length, page``.

    Every record is a gzip member of its own. The index is written to the shared folder
    before it is returned and names only files of attempts that Spark accepted, so lost
    executors and repeated tasks leave nothing but unreferenced files. ``folder`` is a
    URI that pyarrow can open on every executor.
    """
    rows = chunks.mapInArrow(_writer(folder), "file string, offset long, length long, page long")
    return materialize(rows, "warc-index")


_HEADER = re.compile(rb"^([!-9;-~]+):[ \t]*(.*?)[ \t]*$")


def parse_headers(block: bytes) -> dict[str, str]:
    """Named fields of a record's header block, names lower-cased."""
    lines = block.split(b"\r\n")
    if not lines[0].startswith(b"WARC/"):
        raise ValueError("a record does not start with its version")
    out = {}
    for line in lines[1:]:
        if m := _HEADER.match(line):
            out[m[1].decode().lower()] = m[2].decode("utf-8", "replace")
    return out


def _inflated(stream, length: int) -> Iterator[bytes]:
    """The bytes of one gzip member of ``length`` bytes, at most CHUNK at once however far they inflate."""
    member, left, raw = zlib.decompressobj(31), length, b""
    while not member.eof:
        if not raw:
            raw = stream.read(min(left, CHUNK))
            left -= len(raw)
        data = member.decompress(raw, CHUNK)
        if not data and not raw and not member.eof:
            raise ValueError("an archive ends inside a record")
        raw = member.unconsumed_tail
        if data:
            yield data


def _read_record(stream, length: int) -> tuple[dict[str, str], int, str]:
    """Headers, payload bytes and payload digest, without holding the payload."""
    head, fields, size, sha, expected = b"", None, 0, hashlib.sha1(), 0
    for data in _inflated(stream, length):
        if fields is None:
            head += data
            end = head.find(b"\r\n\r\n")
            if end < 0:
                continue
            fields, data = parse_headers(head[:end]), head[end + 4 :]
            expected = int(fields["content-length"])
        take = data[: max(0, expected - size)]
        sha.update(take)
        size += len(take)
    if fields is None:
        raise ValueError("a record ends in its headers")
    if size != expected:
        raise ValueError(f"a record has {size} of {expected} bytes")
    return fields, size, base64.b32encode(sha.digest()).decode()


def _page_of(urn: str) -> int | None:
    page = urn.strip("<>").split(":")[2]
    return None if page == "none" else int(page)


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("target_uri", pa.string())])
    stream = name = None
    for batch in batches:
        rows = []
        for file, offset, length in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
            if file != name:
                filesystem, path = fs.FileSystem.from_uri(file)
                stream, name = filesystem.open_input_file(path), file
            stream.seek(offset)
            fields, size, digest = _read_record(stream, length)
            kind = fields["warc-type"]
            if kind == "revisit":
                size, digest = int(fields["x-payload-length"]), fields["warc-payload-digest"].removeprefix("sha1:")
                refers = _page_of(fields["warc-refers-to"])
            else:
                refers = None
                if fields["warc-payload-digest"] != f"sha1:{digest}":
                    raise ValueError(f"payload of {fields['warc-record-id']} does not have its digest")
            rows.append((_page_of(fields["warc-record-id"]), size, digest, kind, refers, fields["warc-target-uri"]))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)] if rows else [pa.array([], t) for t in schema.types], schema=schema)


def read_archives(index: DataFrame) -> DataFrame:
    """Records of indexed archives: ``page_id, payload_bytes, payload_digest, record_type, refers_to, target_uri``.

    Records are read by offset, so a large archive is read by many tasks. Each is
    inflated in pieces with an incremental digest that must match the header.
    """
    return index.select("file", "offset", "length").mapInArrow(
        _reader, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string"
    )


def round_trip(pages: DataFrame, min_revisit: int = MIN_REVISIT, chunk: int = CHUNK) -> DataFrame:
    """Write ``pages`` (``page_id, url, html``) as archives in the shared folder and read them back.

    Every row has a record of its own. A null payload is empty; a null URL leaves the
    target empty. Rows that repeat an id are archived one by one; those that share the
    smallest id of equal payloads are all responses. A null id stays null and revisits a
    page that has an id; where no page of a payload has one, all are responses. An empty
    table writes no archive and reads none. Other columns are not read.
    """
    records = payloads(pages)
    with steps() as own:
        first = materialize(first_pages(records, min_revisit), "warc-first")
        index = write_archives(chunk_table(records, first, chunk), shared_path(pages.sparkSession, "warc"))
        return own.keep(read_archives(index), "warc-read")
