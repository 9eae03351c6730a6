"""Readers of official indexes, search results, manifests and legislators."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser
from io import BytesIO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.functions import scalars as S

# Column names, URL forms and patterns of the sources.
INDEX_COLUMNS = ["prefix", "last", "first", "suffix", "filingtype", "statedst", "year", "filingdate", "docid"]
SENATE_PATH = r"(?i)\A/search/view/(ptr|paper)/([0-9a-f-]{36})/\z"
TRANSACTION_HEADERS = ["#", "Transaction Date", "Owner", "Ticker", "Asset Name", "Asset Type", "Type", "Amount", "Comment"]
TEXT_LAYER_LETTERS = 80
HOUSE_FILES = "https://disclosures-clerk.house.gov/public_disc"
MANIFEST_DDL = "tables map<string, struct<rows: long, years: array<int>, manifests: array<struct<year: int, files: array<struct<path: string, size: long, sha256: string, rows: long>>>>>>"


def index_zip_url(year: Column) -> Column:
    """Where a year's index lies."""
    return F.concat(F.lit(f"{HOUSE_FILES}/financial-pdfs/"), year.cast("string"), F.lit("FD.zip"))


def report_pdf_url(year: Column, doc_id: Column) -> Column:
    """Where a report lies."""
    return F.concat(F.lit(f"{HOUSE_FILES}/ptr-pdfs/"), year.cast("string"), F.lit("/"), doc_id.cast("string"), F.lit(".pdf"))


def house_index(raw: DataFrame, index_year: int) -> DataFrame:
    """Rows of an index file read with its header, whatever the order and case of its columns.

    A missing column raises; so does, when the row is read, a document number that is
    none. Cells are trimmed and blank lines are left out.
    """
    named = {c.lstrip("﻿").strip().lower(): c for c in raw.columns}
    if missing := [c for c in INDEX_COLUMNS if c not in named]:
        raise ValueError(f"index {index_year} lacks columns {missing}")
    cells = raw.select(*[F.trim(F.coalesce(F.col(f"`{named[c]}`").cast("string"), F.lit(""))).alias(c) for c in INDEX_COLUMNS])
    filled = cells.where(F.concat(*INDEX_COLUMNS) != "")
    number = F.when(F.col("docid").rlike(r"\A\d+\z"), F.col("docid")).otherwise(F.raise_error(F.concat(F.lit("no document number: "), "docid")))
    return filled.select(F.lit(index_year).alias("index_year"), *INDEX_COLUMNS[:4], F.upper("filingtype").alias("filing_type"), F.col("statedst").alias("state_district"), "year", F.col("filingdate").alias("filing_date"), number.alias("doc_id"))


def read_house_index(spark: SparkSession, path: str, index_year: int) -> DataFrame:
    return house_index(spark.read.csv(path, sep="\t", header=True, quote=""), index_year)


def transaction_reports(index: DataFrame) -> DataFrame:
    return index.where("filing_type = 'P'")


def unzip_index(files: DataFrame) -> DataFrame:
    """``path, name, text`` of the index texts in ZIP archives that spark.read.format("binaryFile") has read."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                with zipfile.ZipFile(BytesIO(content)) as z:
                    out += [(path, n, z.read(n).decode("utf-8-sig")) for n in z.namelist() if n.lower().endswith("fd.txt")]
            yield pd.DataFrame(out, columns=["path", "name", "text"])

    return files.select("path", "content").mapInPandas(work, "path string, name string, text string")


def senate_path(path: Column) -> Column:
    """``struct<kind, id>`` of a report's path; null for any other path."""
    kind = F.when(F.lower(F.regexp_extract(path, SENATE_PATH, 1)) == "ptr", "electronic").otherwise("paper")
    return F.when(path.rlike(SENATE_PATH), F.struct(kind.alias("kind"), F.regexp_extract(path, SENATE_PATH, 2).alias("id")))


def senate_search(pages: DataFrame) -> DataFrame:
    """``first, last, office, link, submitted`` of search result pages (``body``: JSON with rows of five strings)."""
    rows = pages.select(F.explode(F.from_json("body", "struct<data: array<array<string>>>")["data"]).alias("r")).where(F.size("r") >= 5)
    return rows.select(*[F.trim(F.get("r", F.lit(i))).alias(c) for i, c in enumerate(("first", "last", "office", "link", "submitted"))])


class _Tables(HTMLParser):
    """Cell texts of every table, row by row."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[str]]] = []
        self.cell: list[str] | None = None

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag == "table":
            self.tables.append([])
        elif tag == "tr" and self.tables:
            self.tables[-1].append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1]:
            self.cell = []

    def handle_endtag(self, tag: str) -> None:
        if tag in ("td", "th") and self.cell is not None:
            self.tables[-1][-1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_data(self, data: str) -> None:
        if self.cell is not None:
            self.cell.append(data)


#: A tag without attributes, or with quoted ones, and tags whose content is no markup.
_TAG = re.compile(r'<(/?[a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n]+[a-zA-Z][a-zA-Z0-9-]*="[^"<>]*")*)[ \t\n]*>')
_NO_MARKUP = frozenset({"iframe", "math", "noembed", "noframes", "noscript", "plaintext", "script", "style", "svg", "textarea", "title", "xmp"})


def _tables(page: str) -> list[list[list[str]]]:
    """The tables of a page. One with none but plain tags is cut by one pattern, which is much faster than the parser; any other is parsed."""
    p = _Tables()
    cut = _TAG.split(page)
    tags = [t.lower() for t in cut[1::3]]
    if len(tags) != page.count("<") or not _NO_MARKUP.isdisjoint(tags) or any(more and tag[0] == "/" for tag, more in zip(tags, cut[2::3], strict=True)):
        p.feed(page)
        return p.tables
    for tag, text in zip(tags, cut[3::3], strict=True):
        if tag[0] == "/":
            p.handle_endtag(tag[1:])
        else:
            p.handle_starttag(tag, ())
        if text and p.cell is not None:
            p.handle_data(unescape(text) if "&" in text else text)
    return p.tables


_ROW = T.StructType([T.StructField("error", T.StringType()), T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType())))])


@F.pandas_udf(_ROW)
def _transactions(html: pd.Series) -> pd.DataFrame:
    out = []
    for page in html:
        fit = [t for t in _tables(page or "") if t and "Transaction Date" in t[0] and "Amount" in t[0]]
        if len(fit) != 1:
            out.append((f"{len(fit)} transaction tables", None))
        elif fit[0][0] != TRANSACTION_HEADERS:
            out.append(("unknown headers", None))
        elif any(len(r) != len(TRANSACTION_HEADERS) for r in fit[0][1:]):
            out.append(("a row of other length", None))
        else:
            out.append((None, fit[0][1:]))
    return pd.DataFrame(out, columns=["error", "rows"])


def senate_transactions(pages: DataFrame) -> DataFrame:
    """``doc_id, error, row_number, transaction_date, owner, ticker, asset_name, asset_type, transaction_type, amount, comment`` of report pages.

    A page needs exactly one table with the known headers; otherwise it gives one row with
    an error. ``--`` and blank cells are null for ticker and comment.
    """
    parsed = pages.select("doc_id", _transactions("html").alias("t"))
    each = parsed.select("doc_id", F.col("t.error").alias("error"), F.explode_outer("t.rows").alias("r"))
    cell = lambda i: F.get("r", F.lit(i))
    some = lambda c: F.nullif(F.nullif(c, F.lit("--")), F.lit(""))
    return each.select(
        "doc_id", "error", cell(0).try_cast("int").alias("row_number"), cell(1).alias("transaction_date"), cell(2).alias("owner"), some(cell(3)).alias("ticker"), cell(4).alias("asset_name"),
        cell(5).alias("asset_type"), cell(6).alias("transaction_type"), cell(7).alias("amount"), some(cell(8)).alias("comment"),
    )


def read_path(text: Column) -> Column:
    """Whether a document's own text suffices or its page images must be read."""
    letters = F.length(F.regexp_replace(F.coalesce(text, F.lit("")), "[^A-Za-z]", ""))
    return F.when(letters >= TEXT_LAYER_LETTERS, "text_layer").otherwise("page_image_ocr")


def safe_path(path: Column) -> Column:
    """Whether a manifest path is relative, below data/, and plain."""
    return path.startswith("data/") & ~path.rlike(r"(^|/)\.\.?(/|\z)") & ~path.contains("//") & ~path.contains("\\")


def manifest_files(manifest: DataFrame) -> DataFrame:
    """``table, year, path, size, sha256, rows`` of a manifest (column ``body``, JSON). Unsafe paths and broken digests raise when read."""
    m = manifest.select(F.explode(F.from_json("body", MANIFEST_DDL)["tables"]).alias("table", "t"))
    years = m.select("table", F.explode("t.manifests").alias("m"))
    files = years.select("table", F.col("m.year").alias("year"), F.explode("m.files").alias("f")).select("table", "year", "f.*")
    sound = safe_path(F.col("path")) & F.col("sha256").rlike(r"\A[a-f0-9]{64}\z") & (F.col("size") >= 0) & (F.col("rows") >= 0)
    return files.withColumn("path", F.when(sound, F.col("path")).otherwise(F.raise_error(F.concat(F.lit("unsound manifest entry: "), F.coalesce("path", F.lit("null"))))))


def prune(files: DataFrame, table: str | None = None, year: int | None = None) -> DataFrame:
    """Files of one table or year, or both."""
    out = files if table is None else files.where(F.col("table") == table)
    return out if year is None else out.where(F.col("year") == year)


def verify(files: DataFrame, stored: DataFrame) -> DataFrame:
    """``path, state``: ok, missing, size or digest, against ``stored`` (``path, content``, as binaryFile reads them)."""
    have = stored.select("path", F.octet_length("content").cast("long").alias("_size"), F.sha2("content", 256).alias("_sha"))
    j = files.join(have, "path", "left")
    return j.select("path", F.when(F.col("_sha").isNull(), "missing").when(F.col("_size") != F.col("size"), "size").when(F.col("_sha") != F.col("sha256"), "digest").otherwise("ok").alias("state"))


def legislators(spark: SparkSession, *paths: str) -> DataFrame:
    """``bioguide, first, middle, last, nickname, official_full, terms`` of JSON files of people."""
    ddl = "id struct<bioguide: string>, name struct<first: string, middle: string, last: string, nickname: string, official_full: string>, terms array<struct<type: string, start: string, end: string, state: string, district: int>>"
    raw = spark.read.schema(ddl).json(list(paths), multiLine=True)
    return raw.select("id.bioguide", "name.*", "terms")


def decode_guard(rows: DataFrame, enums: dict[str, list[str]], required: list[str]) -> DataFrame:
    """``rows`` with ``violation``: the first required column that is null or closed set that is left, else null."""
    tests = [F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in required]
    tests += [F.when(F.col(c).isNotNull() & ~F.col(c).isin(v), F.concat(F.lit(f"{c} is "), F.col(c))) for c, v in enums.items() if c in rows.columns]
    return rows.withColumn("violation", F.coalesce(*tests))
