"""Landed archives and pages as data sources."""

from __future__ import annotations

import io
import zipfile

import pytest

from ledgerspark.sources import landed as L
from pyspark.sql import functions as F

HEAD = "Prefix\tLast\tFirst\tSuffix\tFilingType\tStateDst\tYear\tFilingDate\tDocID"
REPORT = "0123abcd-0000-4000-8000-0123456789ab"


def archive(folder, year, text, name=None):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr(name or f"{year}FD.txt", text)
        z.writestr(f"{year}FD.xml", "x")
    (folder / f"{year}FD.zip").write_bytes(buffer.getvalue())


def test_index_archives(spark, tmp_path):
    spark.dataSource.register(L.LandedIndex)
    archive(tmp_path, 2023, "﻿" + HEAD + "\n\tLee\tAnn\t\tp\tCA01\t2023\t1/2/2023\t77\n\n Hon. \tDoe\tJo\tJr\tC\tTX02\t2023\t2/2/2023\t78\n")
    archive(tmp_path, 2024, "\t".join(reversed(HEAD.lower().split("\t"))) + "\n79\t3/3/2024\t2024\tNY03\tP\t\tAl\tRay\t\n")
    (tmp_path / "notes.txt").write_text("x")
    for path in (str(tmp_path), f"file://{tmp_path}"):
        df = spark.read.format("landed_index").load(path)
        assert df.rdd.getNumPartitions() == 2
        got = [(r.index_year, r.prefix, r.last, r.filing_type, r.state_district, r.doc_id, r.archive) for r in df.orderBy("doc_id").collect()]
        assert got == [(2023, "", "Lee", "P", "CA01", "77", "2023FD.zip"), (2023, "Hon.", "Doe", "C", "TX02", "78", "2023FD.zip"), (2024, "", "Ray", "P", "NY03", "79", "2024FD.zip")]
    assert spark.read.format("landed_index").load(str(tmp_path)).select("doc_id").where("filing_type = 'P'").count() == 2
    with pytest.raises(Exception, match="has the columns"):
        spark.read.format("landed_index").schema("a string").load(str(tmp_path)).collect()


@pytest.mark.parametrize(("text", "name", "error"), [(HEAD, "2023fd.txt", "has no 2023FD.txt"), ("Last\tDocID\nx\t1", None, "lacks columns"), (HEAD + "\n\ta\tb\t\tP\tCA\t2023\t\tx1", None, "no document number")])
def test_unsound_archives_fail(spark, tmp_path, text, name, error):
    spark.dataSource.register(L.LandedIndex)
    archive(tmp_path, 2023, text, name)
    with pytest.raises(Exception, match=error):
        spark.read.format("landed_index").load(str(tmp_path)).collect()


def test_report_pages(spark, tmp_path):
    spark.dataSource.register(L.LandedReports)
    html = '<img class="filingImage x" src=" /media/1.gif "><img src="/no.gif"><img class="filingImage" src=""><img src="https://efd-media-public.senate.gov/a/2.gif" class="filingImage">'
    (tmp_path / f"paper-{REPORT}.html").write_text(html)
    (tmp_path / f"ptr-{REPORT}.html").write_text("<h1>é</h1>")
    got = {r.kind: r for r in spark.read.format("landed_reports").load(str(tmp_path)).collect()}
    assert got["paper"].images == ["https://efdsearch.senate.gov/media/1.gif", "https://efd-media-public.senate.gov/a/2.gif"]
    assert got["electronic"].images == [] and got["electronic"].html == "<h1>é</h1>" and got["electronic"].report_id == REPORT
    df = spark.createDataFrame([(html, f'<a href="/search/view/ptr/{REPORT}/">x</a>'), (None, None)], "h string, l string")
    assert [tuple(r) for r in df.select(F.size(L.page_images("h")), L.report_path("l")).collect()] == [(2, f"/search/view/ptr/{REPORT}/"), (None, None)]


@pytest.mark.parametrize("bad", ["https://evil.example/x.gif", "http://efdsearch.senate.gov/x.gif", "https://u:p@efdsearch.senate.gov/x.gif"])
def test_images_elsewhere_are_refused(bad):
    with pytest.raises(ValueError, match="not an address"):
        L.media_url(bad)


@pytest.mark.parametrize("bad", ["", "<a>x</a>", f'<a href="https://evil.example/search/view/ptr/{REPORT}/">', f'<a href="/search/view/ptr/{REPORT}/?q=1">', '<a href="/search/view/ptr/1/">'])
def test_links_to_anything_else_are_refused(bad):
    with pytest.raises(ValueError, match="no report link"):
        L.link_path(bad)


def test_kinds_of_images(spark):
    df = spark.createDataFrame([(b"GIF89a",), (b"\x89PNG\r\n",), (b"\xff\xd8\xff",), (b"MM\x00*x",), (b"PDF",), (None,)], "b binary")
    assert [r[0] for r in df.select(L.image_kind(F.col("b"))).collect()] == ["gif", "png", "jpg", "tiff", None, None]


def test_tables_of_plain_pages_equal_the_parsers_and_leave_it_out(monkeypatch):
    import random

    from ledgerspark.sources import readers

    r = random.Random(3)
    bits = ["<table>", "<TABLE class=\"a b\">", "</table>", "<tr>", "</tr>", "<td>", "<td id=\"x\" class=\"y\">", "</td>", "<th>", "</th>", "<b>", "</b>", "<br>", "a &amp; b", " &lt;td&gt; ", "x > y", "&#65;&notin", "\n", "plain"]
    odd = ["<br/>", "<!-- <td> -->", "<script>if (a<b) '<td>'</script>", "<title><td></title>", "a < b", "<td x=1>", "</td x=\"1\">", "<", "<td", "<?x?>"]
    pages = ["".join(r.choices(bits + (odd if i % 2 else []), k=r.randrange(60))) for i in range(3000)]

    def parsed(page):
        parser = readers._Tables()
        parser.feed(page)
        return parser.tables

    def outcome(tables, page):  # a cell that ends in a new table without a row raises, as it did
        try:
            return tables(page)
        except IndexError as e:
            return str(e)

    wanted = [outcome(parsed, page) for page in pages]
    assert [outcome(readers._tables, page) for page in pages] == wanted
    monkeypatch.setattr(readers._Tables, "feed", None)  # plain pages never reach the parser
    assert [outcome(readers._tables, page) for page in pages[::2]] == wanted[::2]
