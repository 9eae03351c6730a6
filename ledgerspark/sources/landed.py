"""Landed index archives and report pages as data sources of Spark.

``spark.dataSource.register(LandedIndex)``, then ``spark.read.format("landed_index")
.load(folder)``: one partition an archive, so a year is read, checked and retried by
itself. Files are opened by the tasks through Arrow's file systems (local paths, ``hdfs://``,
``s3://``); where only Spark can open a store, use readers.unzip_index() over
``binaryFile``.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

# Names of archives and their index, columns of an index, where report images may lie, and how files of images begin.
_ARCHIVE = re.compile(r"(\d{4})FD\.zip")
INDEX_COLUMNS = ("prefix", "last", "first", "suffix", "filingtype", "statedst", "year", "filingdate", "docid")
MEDIA_BASE = "https://efdsearch.senate.gov"
MEDIA_ORIGINS = (MEDIA_BASE, "https://efd-media-public.senate.gov")
REPORT_PATH = re.compile(r"/search/view/(ptr|paper)/[0-9a-f-]{36}/", re.IGNORECASE)
IMAGE_STARTS = {"gif": (b"GIF8",), "png": (b"\x89PNG",), "jpg": (b"\xff\xd8",), "tiff": (b"II*\x00", b"MM\x00*")}

INDEX_DDL = "index_year int, prefix string, last string, first string, suffix string, filing_type string, state_district string, year string, filing_date string, doc_id string, archive string"
REPORTS_DDL = "file string, kind string, report_id string, html string, images array<string>"


def media_url(value: str, base: str = MEDIA_BASE) -> str:
    """The whole address of a report's image; ValueError unless it lies where report images may, without credentials."""
    url = urljoin(base, value.strip())
    parts = urlsplit(url)
    if f"{parts.scheme}://{parts.netloc}" not in MEDIA_ORIGINS:
        raise ValueError(f"not an address of report images: {url}")
    return url


class _Tags(HTMLParser):
    def __init__(self, tag: str, attribute: str, of_class: str | None = None):
        super().__init__()
        self.tag, self.attribute, self.of_class, self.found = tag, attribute, of_class, []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        known = dict(attrs)
        if tag == self.tag and (self.of_class is None or self.of_class in (known.get("class") or "").split()):
            self.found.append((known.get(self.attribute) or "").strip())


def _attributes(html: str, tag: str, attribute: str, of_class: str | None = None) -> list[str]:
    parser = _Tags(tag, attribute, of_class)
    parser.feed(html)
    parser.close()
    return parser.found


def image_urls(html: str) -> list[str]:
    """Addresses of a paper report's page images, in order."""
    return [media_url(src) for src in _attributes(html, "img", "src", "filingImage") if src]


def link_path(link: str) -> str:
    """The report path of a search result's link; ValueError without one that names a report of the same site and nothing else."""
    found = [h for h in _attributes(link, "a", "href") if h]
    url = urlsplit(urljoin(MEDIA_BASE, found[0])) if found else urlsplit("")
    if f"{url.scheme}://{url.netloc}" != MEDIA_BASE or url.query or url.fragment or not REPORT_PATH.fullmatch(url.path):
        raise ValueError(f"no report link: {link[:80]}")
    return url.path


def image_kind(content: Column) -> Column:
    """The kind of image that bytes begin as; null for none known."""
    starts = [(kind, s) for kind, all_ in IMAGE_STARTS.items() for s in all_]
    out = F.lit(None).cast("string")
    for kind, s in starts:
        out = F.when(F.substring(content, 1, len(s)) == F.lit(s), kind).otherwise(out)
    return out


@F.pandas_udf(ArrayType(StringType()))
def page_images(html: pd.Series) -> pd.Series:
    """image_urls() of a column of pages; null for null."""
    return html.map(lambda h: None if h is None else image_urls(h))


@F.pandas_udf(StringType())
def report_path(link: pd.Series) -> pd.Series:
    """link_path() of a column of links; null for null."""
    return link.map(lambda x: None if x is None else link_path(x))


def index_rows(year: int, content: bytes) -> Iterator[tuple]:
    """Rows of a year's archive, as INDEX_DDL without the archive.

    It must hold ``{year}FD.txt`` with all columns, in any order and case, and every row a
    document number. Cells are trimmed and blank rows left out.
    """
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        name = f"{year}FD.txt"
        if name not in z.namelist():
            raise ValueError(f"the index archive of {year} has no {name}")
        text = z.read(name).decode("utf-8-sig")
    lines = csv.reader(io.StringIO(text), delimiter="\t", quoting=csv.QUOTE_NONE)
    head = [c.strip().lower() for c in next(lines, [])]
    if missing := [c for c in INDEX_COLUMNS if c not in head]:
        raise ValueError(f"index {year} lacks columns {missing}")
    at = [head.index(c) for c in INDEX_COLUMNS]
    for line in lines:
        cells = [line[i].strip() if i < len(line) else "" for i in at]
        if any(cells):
            if not re.fullmatch(r"[0-9]+", cells[-1]):
                raise ValueError(f"index {year}: no document number: {cells[-1]}")
            cells[4] = cells[4].upper()
            yield (year, *cells)


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _Files(DataSourceReader):
    """One partition for each file of a folder whose name matches."""

    names = re.compile(r".*")

    def __init__(self, options: dict):
        if not options.get("path"):
            raise ValueError("load() needs the folder of the landed files")
        self.folder = options["path"]

    def _open(self):
        from pyarrow import fs

        if "://" in self.folder or self.folder.startswith("file:"):
            return fs.FileSystem.from_uri(self.folder)
        return fs.LocalFileSystem(), self.folder

    def partitions(self) -> Sequence[InputPartition]:
        from pyarrow import fs

        system, folder = self._open()
        files = system.get_file_info(fs.FileSelector(folder))
        return [_File(f.path) for f in sorted(files, key=lambda f: f.path) if f.is_file and self.names.fullmatch(f.base_name)]

    def content(self, partition: _File) -> bytes:
        with self._open()[0].open_input_stream(partition.path) as f:
            return f.read()


class _IndexReader(_Files):
    names = _ARCHIVE

    def read(self, partition: _File) -> Iterator[tuple]:
        name = partition.path.rsplit("/", 1)[-1]
        for row in index_rows(int(_ARCHIVE.fullmatch(name)[1]), self.content(partition)):
            yield (*row, name)


class _ReportReader(_Files):
    names = re.compile(r"(ptr|paper)-([0-9a-f-]{36})\.html", re.IGNORECASE)

    def read(self, partition: _File) -> Iterator[tuple]:
        name = partition.path.rsplit("/", 1)[-1]
        kind, report = self.names.fullmatch(name).groups()
        html = self.content(partition).decode("utf-8")
        paper = kind.lower() == "paper"
        yield name, "paper" if paper else "electronic", report, html, image_urls(html) if paper else []


_TYPES = {"int": IntegerType(), "string": StringType(), "array<string>": ArrayType(StringType())}


class _Landed(DataSource):
    ddl, read = "", _Files

    def schema(self) -> StructType:
        out = StructType()
        for field in self.ddl.split(", "):
            name, kind = field.split()
            out = out.add(name, _TYPES[kind])
        return out

    def reader(self, schema: StructType) -> DataSourceReader:
        if [(f.name, f.dataType) for f in schema.fields] != [(f.name, f.dataType) for f in self.schema().fields]:
            raise ValueError(f"{self.name()} has the columns {self.ddl}")
        return self.read(dict(self.options))


class LandedIndex(_Landed):
    """Filings of a folder of yearly index archives ``{year}FD.zip``."""

    ddl, read = INDEX_DDL, _IndexReader

    @classmethod
    def name(cls) -> str:
        return "landed_index"


class LandedReports(_Landed):
    """Report pages of a folder, ``ptr-{id}.html`` and ``paper-{id}.html``, with the page images of paper ones."""

    ddl, read = REPORTS_DDL, _ReportReader

    @classmethod
    def name(cls) -> str:
        return "landed_reports"
