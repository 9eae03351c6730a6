"""Identity, checks, OCR proofs, votes, store and readers on small tables."""

from __future__ import annotations

import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from ledgerspark import schema
from ledgerspark.functions import scalars as S
from ledgerspark.operators import consensus, identity, integrity, ocr, packing, resume
from ledgerspark.operators.store import LakeStore
from ledgerspark.sources import readers

PEOPLE = "bioguide string, first string, middle string, last string, nickname string, official_full string"
TERMS = "bioguide string, type string, start date, end date, state string, district int"
FILING = "chamber string, doc_id string, filer_first string, filer_last string, state_district string, filing_date date"
OVERRIDE = "chamber string, filer_first string, filer_last string, state_district string, member_id string"


def d(text):
    return dt.date.fromisoformat(text)


def test_schema_names():
    assert (len(schema.FILINGS), len(schema.TRADES), len(schema.EVENTS)) == (26, 36, 28)
    for table in schema.TABLES.values():
        for name in table.names:
            assert schema.camel(schema.snake(name)) == name


def test_resolver(spark):
    people = spark.createDataFrame([
        ("G1", "Luis", None, "Gutiérrez", None, None), ("W1", "Debbie", None, "Wasserman Schultz", None, "Debbie W. Schultz"), ("S1", "Ann", None, "Smith", "Annie", None), ("S2", "Adam", None, "Smith", None, None), ("S3", "Zed", None, "Smith", None, None),
    ], PEOPLE)
    terms = spark.createDataFrame([
        ("G1", "rep", d("2000-01-01"), d("2010-01-01"), "IL", 4), ("W1", "rep", d("2005-01-01"), d("2030-01-01"), "FL", 23), ("S1", "rep", d("2001-01-01"), d("2003-01-01"), "WA", 9), ("S2", "rep", d("2001-01-01"), d("2020-01-01"), "WA", 9), ("S3", "sen", d("2001-01-01"), d("2020-01-01"), "WA", None),
    ], TERMS)
    filings = spark.createDataFrame([
        ("house", "1", "LUIS V.", "GUTIERREZ, Jr.", "IL04", d("2015-01-01")), ("house", "2", "D", "Schultz", "FL23", d("2015-01-01")), ("house", "3", "Hon. Annie", "Smith", "WA09", d("2015-01-01")), ("house", "4", "Q", "Smith", "WA09", d("2015-01-01")),
        ("house", "5", "Q", "Smith", "WA01", d("2015-01-01")), ("senate", "6", "Zed", "Smith", None, d("2015-01-01")), ("house", "7", "Luis", "Gutierrez", "IL04", d("1999-01-01")), ("house", "8", "Staff", "MEMBER , iii", "XX01", d("2015-01-01")), ("house", "9", "Bob", "Over", "IL01", d("2015-01-01")), ("house", "10", "D", "Schultz", "FL25", d("2015-01-01")),
    ], FILING)
    over = spark.createDataFrame([("house", "Bob", "Over", "IL01", "G1"), ("house", "Staff", "Member", "XX01", None)], OVERRIDE)
    got = {r.doc_id: r for r in identity.resolve(filings, people, terms, over).collect()}
    assert {k: (r.member_id, r.identity_source) for k, r in got.items()} == {
        "1": ("G1", "legislators"), "2": ("W1", "legislators"), "3": ("S1", "legislators"), "4": ("S2", "legislators"), "5": ("S2", "legislators"), "6": ("S3", "legislators"),
        "7": (None, "unresolved"), "8": (None, "non_member"), "9": ("G1", "override"), "10": (None, "unresolved"),
    }
    assert got["2"].display_name == "Debbie W. Schultz" and got["7"].filer_key == "house|gutierrez|luis" and got["8"].display_name == "Staff Member Iii"


@pytest.mark.parametrize("name", ["resolve_members", "identify_rows", "reidentify_diff"])
def test_members_and_filings_are_not_sent_through_the_driver(spark, name):
    from ledgerspark.plans import catalogue

    plan = catalogue.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    joins = [x for x in plan.splitlines() if "BroadcastHashJoin [" in x and not any(f"Join [{few}#" in x for few in ("_shape", "_okey"))]
    assert [x for x in joins if any(f"[{key}#" in x for key in ("bioguide", "member_id", "_id", "_a", "chamber"))] == [] and "SortMergeJoin [bioguide#" in plan


def test_audit_of_a_sound_and_an_empty_lake(spark):
    f = spark.createDataFrame([("house", "1", d("2024-06-29"), "ok", "member:A", "A", "legislators")], "chamber string, doc_id string, filing_date date, extraction_status string, filer_key string, member_id string, identity_source string")
    t = spark.createDataFrame([("house", "1", 0, d("2024-06-01"), None, d("2024-06-29"), "printed", None, 1.0, 2.0)], "chamber string, doc_id string, row_index int, transaction_date date, notification_date date, filing_date date, resolution_status string, resolved_ticker string, amount_low double, amount_high double")
    e = spark.createDataFrame([("e", "house", "1", '["1:0"]', "legislators")], "event_id string, chamber string, source_doc_id string, contributor_row_ids string, identity_source string")
    report = integrity.audit(spark, "2024-07-01", f, t, e)
    assert report.count() == 0 and integrity.passed(report).first().passed
    empty = integrity.audit(spark, "2024-07-01", f.limit(0), t.limit(0), e.limit(0)).collect()
    assert [(r.check, r.message) for r in empty] == [("freshness", "political_filings is empty")]
    bad = integrity.audit(spark, "2024-07-05", f, t.union(t), e.withColumn("contributor_row_ids", F.lit('["1:7", 3]'))).collect()
    assert {r.check: r["count"] for r in bad} == {"duplicate_trade_key": 1, "invalid_contributor_row_ids": 1, "freshness": 1}
    assert next(r for r in bad if r.check == "invalid_contributor_row_ids").examples == ["e: invalid 3"]


@pytest.mark.parametrize(("text", "day"), [("6/15/2024", "2024-06-15"), (" 12/1/2024 ", "2024-12-01"), ("2/30/2024", None), ("6/15/24", None), ("", None), (None, None), ("13/1/2024", None)])
def test_slash_date(spark, text, day):
    got = spark.range(1).select(S.parse_slash_date(F.lit(text).cast("string")).cast("string")).first()[0]
    assert got == day


def test_available_at_is_the_end_of_a_new_york_day(spark):
    got = spark.range(1).select(F.date_format(S.available_at(F.lit("2024-06-15").cast("date")), "yyyy-MM-dd HH:mm:ss.SSS")).first()[0]
    assert got == "2024-06-16 03:59:59.999"


def test_shards_partition_identities(spark):
    ids = spark.range(500).select(F.col("id").cast("string").alias("identity"))
    none = ids.limit(0)
    parts = [{r.identity for r in resume.pending(ids, none, i, 7).collect()} for i in range(7)]
    assert sum(map(len, parts)) == 500 and len(set.union(*parts)) == 500
    assert sum(r.n for r in resume.progress(ids, 7).collect()) == 500


def test_coverage_and_gap_merge(spark):
    w = spark.createDataFrame([("a", "f", 1, 6, 8), ("b", "f", 7, 8, 8)], "source_id string, filing_id string, first int, last int, row_count int")
    m = spark.createDataFrame([("a", 1, 2, "row"), ("a", 1, 3, "row"), ("a", None, 1, "non"), ("a", None, 6, "non"), ("b", None, 7, "cont"), ("b", 1, 8, "row")], "source_id string, tx int, label int, role string")
    assert {(r.source_id, r.first, r.last) for r in ocr.gap_ranges(w, m).collect()} == {("a", 4, 5)}
    assert {(r.source_id, r.problem, r.label) for r in ocr.coverage_filing(w, m).collect()} == {("b", "continuation that nothing backs", 7)}
    fill = spark.createDataFrame([("a", 4, None, 4, "cont"), ("a", 4, 1, 5, "row")], "source_id string, gap_first int, tx int, label int, role string")
    merged, problems = ocr.merge_gaps(m, w, fill)
    assert problems.count() == 0 and ocr.coverage_gaps(w, merged).count() == 0
    assert {(r.tx, r.label) for r in merged.where("role = 'row' and source_id = 'a'").collect()} == {(1, 2), (1, 3), (1, 4), ((4 << 32) + 1, 5)}


def test_owners_above_a_gap(spark):
    w = spark.createDataFrame([(s, "f", 1, 6, 6) for s in "abc"], "source_id string, filing_id string, first int, last int, row_count int")
    m = spark.createDataFrame([("a", 1, 3, "row"), ("a", 2, 3, "row"), ("b", None, 3, "non"), ("c", 7, 3, "row"), ("c", 7, 3, "row"), ("c", 8, 2, "row")], "source_id string, tx int, label int, role string")
    fill = spark.createDataFrame([(s, 4, None, n, "cont") for s in "abc" for n in (4, 5)] + [("c", 1, None, 1, "cont")], "source_id string, gap_first int, tx int, label int, role string")
    merged, problems = ocr.merge_gaps(m, w, fill)
    assert sorted(map(tuple, problems.collect())) == [("a", 3, "more than one transaction"), ("b", 3, "no transaction")]
    assert sorted((r.tx, r.label, r.role) for r in merged.where("source_id = 'c' and role = 'row'").collect()) == [(7, 3, "row"), (7, 4, "row"), (7, 5, "row"), (8, 2, "row")]
    assert [(r.source_id, r.label) for r in merged.where("role = 'cont'").collect()] == [("c", 1)]


def test_merged_gaps_split_the_texts_once(spark, tmp_path):
    from ledgerspark.plans import catalogue, extraction

    texts = [(0, "a\n\n \u2003\nb"), (1, "| c |\n|---|\n" + "d\n" * 40), (4, None), (5, " \t"), (8, "|:---\n |---\ne")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    k = extraction.Lake(spark, str(tmp_path))
    last = {r.filing_id: r.n for r in ocr.number_lines(k.ocr).groupBy("filing_id").agg(F.max("label").alias("n")).collect()}
    assert last == {"0": 43, "2": 2} == {r.filing_id: r.n for r in ocr.label_counts(k.ocr).collect()}
    merged = catalogue.QUERIES["merge_gaps"](spark, str(tmp_path))
    assert merged.inputFiles() and not any("documents.parquet" in f for f in merged.inputFiles())
    assert {(r.tx, r.label) for r in merged.where("source_id = '0:w1' and role = 'row' and label between 25 and 31").collect()} == {(8, 25), ((29 << 32) + 1, 30), (10, 30), (10, 31)}
    assert extraction.marks(k.spark.range(3 * extraction.WINDOWS_A_TASK).selectExpr("cast(id AS string) AS source_id", "1 AS first", "1 AS last")).rdd.getNumPartitions() > 3


@pytest.mark.parametrize("name", ["gap_ranges", "normalize_read", "coverage_problems"])
def test_windows_of_many_tasks_read_as_those_of_one(spark, tmp_path, monkeypatch, name):
    from ledgerspark.plans import catalogue, extraction

    spark.createDataFrame([(i, "a line\n" * (20 + 37 * i % 300)) for i in range(120)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(extraction, "WINDOWS_A_TASK", 1_000_000)
    whole = sorted(map(str, catalogue.QUERIES[name](spark, str(tmp_path)).collect()))
    monkeypatch.setattr(extraction, "WINDOWS_A_TASK", 50)
    dealt = catalogue.QUERIES[name](spark, str(tmp_path))
    assert whole and sorted(map(str, dealt.collect())) == whole
    assert "Union" not in dealt._jdf.queryExecution().optimizedPlan().toString()


def test_planners(spark):
    lines = spark.createDataFrame([("f", i, i % 2 == 0) for i in range(1, 26)], "filing_id string, label int, is_table boolean")
    got = sorted((r.first, r.last) for r in ocr.plan_windows(lines, labels=10, table_rows=4).collect())
    assert got[0] == (1, 9) and got[-1][1] == 25 and all(b[0] == a[1] + 1 for a, b in zip(got, got[1:], strict=False))
    parts = spark.createDataFrame([(f"s{i}", 15) for i in range(5)], "source_id string, table_rows long")
    assert sorted(r.request for r in packing.text_requests(parts, [parts.source_id]).collect()) == [0, 0, 1, 1, 2]


def test_votes_and_decisions(spark):
    reads = spark.createDataFrame([("s", 0, None), ("s", 1, None), ("s", 2, None), ("s", 3, "cut"), ("t", 0, None), ("t", 1, None)], "source_id string, read_idx int, error string")
    rows = spark.createDataFrame([("s", 0, 0, "a"), ("s", 0, 1, "a"), ("s", 1, 0, "a"), ("s", 2, 0, "a"), ("s", 2, 1, "a"), ("s", 2, 2, "b"), ("s", 3, 0, "b"), ("t", 0, 0, "x"), ("t", 1, 0, "x")], "source_id string, read_idx int, row_idx int, sig string")
    assert {(r.source_id, r.sig, r.copies) for r in consensus.vote_window(reads, rows).collect()} == {("s", "a", 2), ("t", "x", 1)}
    sigs = consensus.signatures(reads, rows)
    assert {(r.source_id, r.outcome) for r in consensus.decide(sigs).collect()} == {("s", "failed"), ("t", "agreed")}
    assert [r.source_id for r in consensus.third_reads(sigs).collect()] == ["s"]


def test_reads_are_compared_by_their_whole_texts(spark, tmp_path):
    from ledgerspark.plans import catalogue

    said = ["Same start, one end", "Same start, other\nEND"]
    spark.createDataFrame([(c, t, "user", said[t]) for c in (1, 2, 3) for t in (0, 1)], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    view = catalogue.QUERIES
    assert {(r.source_id, r.outcome, r.read_idx) for r in view["consensus_whole"](spark, str(tmp_path)).collect()} == {("3", "agreed", 0), ("1", "arbitrated", 2), ("2", "failed", None)}
    assert {r.source_id for r in view["third_reads_whole"](spark, str(tmp_path)).collect()} == {"1", "2"}
    votes = {(r.source_id, r.sig) for r in view["vote_window_whole"](spark, str(tmp_path)).collect()}
    assert {("3", "end"), ("1", "end"), ("2", "end")} <= votes and ("2", "other") not in votes
    assert {r.filing_id for r in view["disputed_pages_whole"](spark, str(tmp_path)).collect()} == {"1", "2"}


def test_every_response_is_parsed(spark, tmp_path):
    from ledgerspark.plans import catalogue

    events = [(500 + i, dt.datetime(2024, 1, 1 + i // 2 * 3, 12), 7) for i in range(4)] + [(1000 + i, dt.datetime(2024, 2, 1 + 3 * i, 12), 8) for i in range(5)]
    spark.createDataFrame([(*e, "view", 1.0, "{}") for e in events], "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.source_id: (r.error, r.rows) for r in catalogue.QUERIES["parse_reads_all"](spark, str(tmp_path)).collect()}
    assert got["7:2024-01-01"] == ("answered more than once", "") and got["7:2024-01-02"] == ("no answer", "")
    assert [got[f"8:2024-02-{1 + 3 * i:02}"] for i in range(5)] == [("cut off", ""), ("does not parse", ""), ("empty without a statement", ""), (None, "a1003,b"), (None, "a1004,b")]


def test_store_commits_and_drops_emptied_years(spark, tmp_path):
    from .test_events import TRADE, TRADE_DDL

    ddl = FILING + ", report_date date, amended_report_date date, available_at timestamp, extraction_status string, filer_key string, member_id string, display_name string, identity_source string"
    row = lambda doc, y: ("house", doc, "Ann", "Lee", "CA01", dt.date(y, 1, 1), None, None, dt.datetime(y, 1, 2), "ok", "member:A", "A", "Ann Lee", "legislators")
    filings = spark.createDataFrame([row("1", 2020), row("2", 2021)], ddl)
    trades = spark.createDataFrame([tuple({**TRADE, "doc_id": "1", "available_at": dt.datetime(2020, 1, 2)}[k] for k in TRADE), tuple({**TRADE, "doc_id": "2", "available_at": dt.datetime(2021, 1, 2)}[k] for k in TRADE)], TRADE_DDL)
    store = LakeStore(spark, f"file://{tmp_path}/lake")
    assert store.read("political_filings") is None
    store.upsert(filings, trades)
    assert set(store.manifest()["political_filings"]) == {"2020", "2021"} and store.read("political_trade_events").count() == 1
    moved = spark.createDataFrame([row("1", 2021)], ddl)
    store.upsert(moved, trades.where("doc_id = '1'").withColumn("available_at", F.lit("2021-01-02").cast("timestamp")))
    assert set(store.manifest()["political_filings"]) == {"2021"} and store.read("political_filings").count() == 2
    same = store.read("political_filings").select("chamber", "doc_id", *schema.IDENTITY)
    assert store.reidentify(same) == 0
    versions = len(store._versions())
    assert store.reidentify(same.withColumn("display_name", F.lit("A. Lee"))) == 2 and len(store._versions()) == versions + 1
    assert {r.display_name for r in store.read("political_trades").collect()} == {"A. Lee"}


def test_readers(spark, tmp_path):
    path = tmp_path / "i.txt"
    path.write_text("﻿Prefix\tLast\tFirst\tSuffix\tFilingType\tStateDst\tYear\tFilingDate\tDocID\n\tLee\tAnn\t\tp\tCA01\t2024\t1/2/2024\t77\n\n")
    rows = readers.read_house_index(spark, str(path), 2024).collect()
    assert [(r.last, r.filing_type, r.doc_id) for r in rows] == [("Lee", "P", "77")]
    (tmp_path / "bad.txt").write_text("Last\tDocID\nx\t1\n")
    with pytest.raises(ValueError, match="lacks columns"):
        readers.read_house_index(spark, str(tmp_path / "bad.txt"), 2024)
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("2024FD.txt", "a\tb")
        z.writestr("2024FD.xml", "x")
    (tmp_path / "i.zip").write_bytes(buffer.getvalue())
    files = spark.read.format("binaryFile").load(str(tmp_path / "i.zip"))
    assert [(r.name, r.text) for r in readers.unzip_index(files).collect()] == [("2024FD.txt", "a\tb")]
    manifest = spark.createDataFrame([('{"tables":{"t":{"rows":1,"years":[2020],"manifests":[{"year":2020,"files":[{"path":"data/../x","size":1,"sha256":"%s","rows":1}]}]}}}' % ("a" * 64),)], "body string")
    with pytest.raises(Exception, match="unsound manifest entry"):
        readers.manifest_files(manifest).collect()
    page = "<table><tr>" + "".join(f"<th>{h}</th>" for h in readers.TRANSACTION_HEADERS) + "</tr><tr><td>1</td><td>1/2/2024</td><td>Self</td><td>--</td><td>A\n B</td><td>Stock</td><td>Purchase</td><td>x</td><td></td></tr></table>"
    out = readers.senate_transactions(spark.createDataFrame([("d", page), ("e", "<p>")], "doc_id string, html string")).orderBy("doc_id").collect()
    assert (out[0].asset_name, out[0].ticker, out[0].comment, out[1].error) == ("A B", None, None, "0 transaction tables")


def test_entry_and_names(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 100
    out = entry.entry(spark)
    assert out.count() > 0


def test_numbered_lines_know_tables_by_their_first_letter(spark):
    pages = spark.createDataFrame([("f", 1, "a\n\t\n  | b\n | --- |\nc\n| d |\n|---|\n\u00a0\r")], "filing_id string, page int, text string")
    got = [(r.label, r.is_table, r.text) for r in ocr.number_lines(pages).orderBy("label").collect()]
    assert got == [(1, False, "a"), (2, False, "  | b"), (3, False, " | --- |"), (4, False, "c"), (5, True, "| d |")]


def test_windows_are_cut_by_pages_and_go_with_their_neighbours(spark):
    lines = spark.createDataFrame([("f", p, 0, i + 1, False, "x") for i, p in enumerate([1, 1, 2, 3, 3, 5])] + [("g", 1, 0, 1, True, "y")], "filing_id string, page int, line int, label int, is_table boolean, text string")
    pages = spark.createDataFrame([("f", p, "x") for p in range(1, 6)] + [("g", 1, "y"), ("h", 1, None)], "filing_id string, page int, text string")
    planned = ocr.plan_windows(lines, max_pages=4)
    assert sorted((r.source_id, r.first, r.last) for r in planned.collect()) == [("f:w1", 1, 3), ("f:w2", 4, 5), ("f:w3", 6, 6), ("g:w1", 1, 1)]
    got = sorted((r.source_id, r.page_start, r.page_end, r.first, r.table_rows) for r in ocr.window_attachments(planned, lines, pages, 4).collect())
    assert got == [("f:w1", 1, 3, 1, 0), ("f:w2", 2, 4, 4, 0), ("f:w3", 4, 5, 6, 0), ("g", 1, 1, 1, 1), ("h", 1, 1, None, 0)]
    with pytest.raises(ValueError, match="at least 3"):
        ocr.plan_windows(lines, max_pages=2)


def test_members_without_a_name_and_unknown_overrides(spark):
    filings = spark.createDataFrame([("house", "1", "Ann", "Lee", "CA01", dt.date(2024, 1, 2)), ("house", "2", None, None, None, dt.date(2024, 1, 2))], "chamber string, doc_id string, filer_first string, filer_last string, state_district string, filing_date date")
    people = spark.createDataFrame([("B1", "Ann", None, None, "Lee", None), ("B2", "X", None, None, "...", None)], "bioguide string, first string, middle string, nickname string, last string, official_full string")
    terms = spark.createDataFrame([(b, "rep", dt.date(2020, 1, 1), dt.date(2026, 1, 1), "CA", 1) for b in ("B1", "B2")], "bioguide string, type string, start date, end date, state string, district int")
    ddl = "chamber string, filer_first string, filer_last string, state_district string, member_id string"
    got = {r.doc_id: r.member_id for r in identity.resolve(filings, people, terms, spark.createDataFrame([("house", "Ann", "Lee", "CA01", None)], ddl).limit(0)).collect()}
    assert got == {"1": "B1", "2": None}
    with pytest.raises(Exception, match="unknown member: B9"):
        identity.resolve(filings, people, terms, spark.createDataFrame([("house", "Ann", "Lee", "CA01", "B9")], ddl)).collect()


def _small_lake(spark, docs):
    """``(filings, trades)`` of one trade each: document, filer, year."""
    from .test_events import TRADE, TRADE_DDL

    ddl = FILING + ", report_date date, amended_report_date date, available_at timestamp, extraction_status string, filer_key string, member_id string, display_name string, identity_source string"
    filings = spark.createDataFrame([("house", d, "Ann", "Lee", "CA01", dt.date(y, 1, 1), None, None, dt.datetime(y, 1, 2), "ok", f"member:{w}", w, "Ann Lee", "legislators") for d, w, y in docs], ddl)
    trades = spark.createDataFrame([tuple({**TRADE, "doc_id": d, "filer_key": f"member:{w}", "member_id": w, "available_at": dt.datetime(y, 1, 2), "printed_ticker": d}[k] for k in TRADE) for d, w, y in docs], TRADE_DDL)
    return filings, trades


def test_two_upserts_at_once_both_survive(spark, tmp_path, monkeypatch):
    store, other = (LakeStore(spark, f"file://{tmp_path}/lake") for _ in range(2))
    store.upsert(*_small_lake(spark, [("1", "A", 2020), ("2", "B", 2020)]))
    write, began = LakeStore._write, []

    def second_commits_first(self, run, table, df):
        if self is store and not began:
            began.append(True)
            other.upsert(*_small_lake(spark, [("4", "B", 2020)]))
        return write(self, run, table, df)

    monkeypatch.setattr(LakeStore, "_write", second_commits_first)
    store.upsert(*_small_lake(spark, [("3", "A", 2020)]))
    assert began and sorted(r.doc_id for r in store.read("political_filings").collect()) == ["1", "2", "3", "4"]
    assert sorted(r.source_doc_id for r in store.read("political_trade_events").collect()) == ["1", "2", "3", "4"]
    with pytest.raises(RuntimeError, match="another writer"):
        store.publish({"political_filings": _small_lake(spark, [("9", "A", 2020)])[0]}, base=1)
    assert sorted(r.doc_id for r in store.read("political_filings").collect()) == ["1", "2", "3", "4"]


def test_upsert_leaves_other_years_files_alone(spark, tmp_path):
    store = LakeStore(spark, f"file://{tmp_path}/lake")
    store.upsert(*_small_lake(spark, [("1", "A", 2019), ("2", "A", 2020), ("3", "B", 2021), ("4", "C", 2022)]))
    before = store.manifest()
    store.upsert(*_small_lake(spark, [("5", "B", 2023)]))
    after = store.manifest()
    moved = {t: {y for y in after[t] if after[t][y] != before[t].get(y)} for t in after}
    assert moved == {"political_filings": {"2023"}, "political_trades": {"2023"}, "political_trade_events": {"2021", "2023"}}
    assert store.read("political_trade_events").count() == 5


def _matched(filings, people, terms):
    """The rules for who filed, filing by filing and candidate by candidate."""
    words = lambda t: t.lower().split()
    ends = lambda a, b: a[-len(b):] == b or b[-len(a):] == a
    out = {}
    for chamber, doc, first, last, seat, day in filings:
        kind, state, district = ("sen", None, None) if chamber == "senate" else ("rep", seat and seat[:2], int(seat[2:]) if seat else None)
        strict, loose, named = {}, {}, set()
        for b, given, _, name, _, _ in people:
            for other, k, start, end, st, di in terms:
                if other != b or k != kind or start > day or state not in (None, st) or not ends(words(name), words(last)):
                    continue
                until = min(end or day, day)
                if district is None or di in (None, district):
                    strict[b] = max(until, strict.get(b, until))
                if district is not None and words(name) == words(last):
                    loose[b] = max(until, loose.get(b, until))
                if {w[:3] for w in words(given)} & {w[:3] for w in words(first)}:
                    named.add(b)
        left = strict or loose
        left = {b: t for b, t in left.items() if b in named} or left
        left = [b for b, t in left.items() if t == max(left.values())]
        out[doc] = left[0] if len(left) == 1 else None
    return out


def test_members_by_running_counts_are_those_by_candidates(spark):
    import random

    r = random.Random(5)
    day = lambda: dt.date(2000, 1, 1) + dt.timedelta(days=r.randrange(60))
    people = [(f"B{i}", r.choice(["Ann", "Bob Lee", "Zed"]), None, r.choice(["Smith", "De Smith", "Van De Smith", "Roe"]), None, None) for i in range(12)]
    terms = [(p[0], r.choice(["rep", "rep", "sen"]), day(), None if r.random() < 0.1 else day(), r.choice(["CA", "WA"]), r.choice([None, 1, 2])) for p in people for _ in range(r.randrange(4))]
    filings = []
    for i in range(400):
        chamber = r.choice(["house", "house", "senate"])
        filings.append((chamber, str(i), r.choice(["Ann", "Lee", "Otto"]), r.choice(["Smith", "De Smith", "Van De Smith", "Old Roe", "Roe"]), r.choice(["CA01", "CA02", "CA03", "WA01", None]) if chamber == "house" else None, day()))
    f = identity.prepared(spark.createDataFrame(filings, FILING))
    got = {x.doc_id: x.bioguide for x in identity.matches(f, spark.createDataFrame(people, PEOPLE), spark.createDataFrame(terms, TERMS)).collect()}
    want = _matched(filings, people, terms)
    assert got == {k: v for k, v in want.items() if v is not None} and 50 < len(got) < 350


def test_filings_meet_no_candidates_one_by_one(spark):
    """Members of one name, state and chamber: days are compared in no join, as that would grow with filings times members."""
    n = 2000
    people = spark.range(n).selectExpr("concat('B', id) bioguide", "'Ann' first", "cast(null as string) middle", "cast(null as string) nickname", "'Lee' last", "cast(null as string) official_full")
    terms = spark.range(n).selectExpr("concat('B', id) bioguide", "'sen' type", "date '2000-01-01' + cast(id as int) start", "date '2010-01-01' + cast(id as int) end", "'CA' state", "cast(null as int) district")
    filings = spark.range(n).selectExpr("'senate' chamber", "cast(id as string) doc_id", "'Otto' filer_first", "'Lee' filer_last", "cast(null as string) state_district", "date '2015-01-01' + cast(id as int) filing_date")
    out = identity.matches(identity.prepared(filings), people, terms)
    assert {r.bioguide for r in out.collect()} == {f"B{n - 1}"}  # the last one left is alone in office on the last day, and the latest out of it
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert joins and not any("start#" in line or "filing_date#" in line for line in joins)


def test_upsert_writes_what_is_new_and_what_is_gone(spark, tmp_path, monkeypatch):
    """The files of a touched year stay; a document filed again, moved or not, replaces itself alone, however many layers lie over it."""
    from ledgerspark.operators import store as st

    docs = {str(i): ("AB"[i % 2], 2020 + i % 2) for i in range(6)}
    store = LakeStore(spark, f"file://{tmp_path}/lake")
    store.upsert(*_small_lake(spark, [(d, *x) for d, x in docs.items()]))
    first = store.manifest()["political_trades"]["2020"]
    for layers, changed in ((16, {"0": ("A", 2020)}), (3, {"0": ("B", 2020), "2": ("A", 2021), "9": ("A", 2020)})):
        monkeypatch.setattr(st, "LAYERS", layers)
        store.upsert(*_small_lake(spark, [(d, *x) for d, x in changed.items()]))
        docs.update(changed)
        steps = store.manifest()["political_trades"]["2020"]
        assert steps[0] == first and len(steps) == 3 if layers == 16 else isinstance(steps, str)
        want = sorted((d, f"member:{w}", y) for d, (w, y) in docs.items())
        for table, doc in (("political_filings", "doc_id"), ("political_trades", "doc_id"), ("political_trade_events", "source_doc_id")):
            assert sorted((r[doc], r.filer_key, r.available_at.year) for r in store.read(table).collect()) == want
        assert sorted(r.doc_id for r in store.read("political_trades", [2021]).collect()) == sorted(d for d, x in docs.items() if x[1] == 2021)
