"""Passes of reads, halved ranges and marked windows."""

from __future__ import annotations

import math

import pytest

from ledgerspark.operators import ocr, passes
from pyspark.sql import functions as F

READS = "source_id string, error string, statement string, non array<int>, cont array<int>"
ROWS = "source_id string, row_idx int, sig string, labels array<int>"
WINDOWS = "source_id string, filing_id string, first int, last int, row_count int"


class Reader:
    """Answers by source and pass; notes who was asked, and dies where told to."""

    def __init__(self, spark, answers, die=None):
        self.spark, self.answers, self.die, self.asked = spark, answers, die, []

    def __call__(self, pending, n):
        ids = sorted(r.source_id for r in pending.collect())
        self.asked.append((n, ids))
        if n == self.die:
            raise KeyboardInterrupt
        reads = [(i, None, None, [], []) for i in ids if n <= len(self.answers[i])]
        rows = [(i, k, sig, [k + 1]) for i in ids if n <= len(self.answers[i]) for k, sig in enumerate(self.answers[i][n - 1])]
        return self.spark.createDataFrame(reads, READS), self.spark.createDataFrame(rows, ROWS)


ANSWERS = {
    "same": [["a", "b"], ["a", "b"]],
    "third": [["a", "b"], ["a", "c"], ["a", "c"]],
    "voted": [["a", "b"], ["a", "c"], ["x", "b"]],
    "never": [["a", "b"], ["c", "d"], ["e", "f"], ["g", "h"], ["i", "j"], ["k", "l"]],
    "quits": [["a", "b"], ["c", "d"], ["e", "f"]],
}


def test_only_undecided_sources_are_read_again_and_a_killed_pass_resumes(spark, tmp_path):
    sources = spark.createDataFrame([(i,) for i in ANSWERS], "source_id string")
    windows = spark.createDataFrame([(i, i, 1, 2, 2) for i in ANSWERS], WINDOWS)
    state = f"{tmp_path}/state"
    dies = Reader(spark, ANSWERS, die=3)
    with pytest.raises(KeyboardInterrupt):
        passes.read_in_passes(sources, windows, dies, state)
    goes_on = Reader(spark, ANSWERS)
    assert passes.read_in_passes(sources, windows, goes_on, state) == 5
    everybody = sorted(ANSWERS)
    assert dies.asked == [(1, everybody), (2, everybody), (3, ["never", "quits", "third", "voted"])]
    assert goes_on.asked == [(3, ["never", "quits", "third", "voted"]), (4, ["never", "quits"]), (5, ["never"])]
    out, rows, counts = passes.decided(spark, windows, state, 5)
    got = {r.source_id: (r.outcome, r.voted, r.reads) for r in out.collect()}
    assert got == {"same": ("agreed", False, 2), "third": ("arbitrated", False, 3), "voted": ("arbitrated", True, 3), "never": ("failed", False, 5), "quits": ("failed", False, 3)}
    chosen = {}
    for r in rows.orderBy("source_id", "position").collect():
        chosen.setdefault(r.source_id, []).append(r.sig)
    assert chosen == {"same": ["a", "b"], "third": ["a", "c"], "voted": ["a", "b"]}
    assert {r.outcome: (r.n, r.later_reads) for r in counts.collect()} == {"agreed": (1, 0), "arbitrated": (2, 2), "failed": (2, 4)}


def plain_halves(pages, each, rows_of, limit):
    """Ranges that a filing ends with, and those asked for on the way."""
    asked = []
    while True:
        ranges = [(a, min(a + each - 1, pages)) for a in range(1, pages + 1, each)]
        asked += ranges
        cut = [b - a + 1 for a, b in ranges if sum(rows_of(p) for p in range(a, b + 1)) > limit]
        halves = [math.ceil(n / 2) for n in cut if n > 1]
        if not halves:
            return ranges, asked
        each = min(halves)


def test_cut_answers_are_read_again_in_halves(spark, tmp_path):
    filings = {"dense": 8, "long": 4, "short": 2, "uneven": 13, "one": 1, "silent": 3}
    rows_of = {"dense": lambda p: 3, "long": lambda p: 6, "short": lambda p: 1, "uneven": lambda p: p % 5, "one": lambda p: 50, "silent": lambda p: 1}
    asked = []

    def read(ranges, n):
        out = []
        for r in ranges.collect():
            asked.append((r.filing_id, r.page_start, r.page_end))
            if r.filing_id == "silent":
                continue
            rows = [f"{r.filing_id}{p}.{i}" for p in range(r.page_start, r.page_end + 1) for i in range(rows_of[r.filing_id](p))]
            cut = len(rows) > 6
            out.append((r.filing_id, r.page_start, r.page_end, [] if cut else rows, None, "cut off" if cut else None, cut))
        return spark.createDataFrame(out, "filing_id string, page_start int, page_end int, rows array<string>, statement string, error string, truncated boolean")

    df = spark.createDataFrame(list(filings.items()), "filing_id string, pages int")
    ranges, merged = passes.read_by_halves(df, read, f"{tmp_path}/halves")
    got = {}
    for r in ranges.orderBy("page_start").collect():
        got.setdefault(r.filing_id, []).append((r.page_start, r.page_end))
    want, all_asked = {}, []
    for name, pages in filings.items():
        want[name], on_the_way = plain_halves(pages, 10, rows_of[name] if name != "silent" else lambda p: 0, 6)
        all_asked += [(name, a, b) for a, b in on_the_way]
    assert got == want and sorted(asked) == sorted(all_asked)
    assert got["long"] == [(1, 1), (2, 2), (3, 3), (4, 4)] and ("dense", 1, 4) in asked
    result = {r.filing_id: (len(r.rows), r.error) for r in merged.collect()}
    assert result["dense"] == (24, None) and result["one"] == (0, "cut off") and result["silent"] == (0, "no answer")
    again = len(asked)
    passes.read_by_halves(df, read, f"{tmp_path}/halves")
    assert len(asked) == again  # all rounds are written


def test_windows_carry_labels_and_markers(spark):
    page = lambda rows: "\n".join(["NAME: Filer", "", "| Owner | Asset |", "| --- | --- |", *[f"| SP | {r} |" for r in rows]])
    pages = spark.createDataFrame([("long", i, page(r)) for i, r in enumerate((["A1", "A2"], ["B1", "B2"], ["C1", "C2"], ["D1", "D2"]), 1)], "filing_id string, page int, text string")
    lines = ocr.number_lines(pages)
    sent = ocr.window_attachments(ocr.plan_windows(lines, 120, 4), lines, pages, 3)
    text = {(r.source_id, r.page): r.text for r in ocr.marked_windows(sent, pages, lines).collect()}
    windows = {r.source_id: r for r in sent.collect()}
    for name, w in windows.items():
        whole = "\n".join(text[name, p] for p in range(w.page_start, w.page_end + 1))
        assert whole.count("=== ROW WINDOW") == 2
        at = whole.split("\n")
        begin, end = (next(i for i, x in enumerate(at) if x.endswith(f"{edge} ===")) for edge in ("BEGINS", "ENDS"))
        assert at[begin] == f"=== ROW WINDOW R{w.first}-R{w.last} BEGINS ===" and f"R{w.first} " in at[begin + 1].replace("]", " ") and f"R{w.last} " in at[end - 1].replace("]", " ")
    whole = ocr.marked_windows(ocr.window_attachments(ocr.plan_windows(lines), lines, pages, 9), pages, lines).collect()
    assert len(whole) == 4 and not any("ROW WINDOW" in r.text for r in whole) and "| R3 | SP | A1 |" in min(whole, key=lambda r: r.page).text
    ids = spark.range(1).select(ocr.gap_id(F.lit("f:w2"), F.lit(7), F.lit(8)), ocr.page_range_id(F.lit("f"), F.lit(1), F.lit(4)), ocr.source_read_id(F.lit("f"), F.lit(3))).first()
    assert list(ids) == ["f:w2:g7-8", "f:p1-4", "f:s3"]


def test_decisions_are_made_once_for_all_that_read_them(spark, tmp_path):
    sources = spark.createDataFrame([("same",), ("third",)], "source_id string")
    windows = spark.createDataFrame([(i, i, 1, 2, 2) for i in ("same", "third")], WINDOWS)
    n = passes.read_in_passes(sources, windows, Reader(spark, ANSWERS), f"{tmp_path}/state")
    out, rows, _ = passes.decided(spark, windows, f"{tmp_path}/state", n)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.source_id, r.outcome, r.reads) for r in out.collect()) == [("same", "agreed", 2), ("third", "arbitrated", 3)] and rows.count() == 4


def test_a_pass_is_decided_once_and_only_for_those_it_read(spark, tmp_path, monkeypatch):
    sources = spark.createDataFrame([(i,) for i in ANSWERS], "source_id string")
    windows = spark.createDataFrame([(i, i, 1, 2, 2) for i in ANSWERS], WINDOWS)
    seen, decide = [], passes.C.decide_rows

    def noted(reads, rows, windows):
        seen.append((windows is not None, sorted({r.source_id for r in reads.collect()})))
        return decide(reads, rows, windows)

    monkeypatch.setattr(passes.C, "decide_rows", noted)
    state = f"{tmp_path}/state"
    n = passes.read_in_passes(sources, windows, Reader(spark, ANSWERS), state)
    out = passes.decided(spark, windows, state, n)[0]
    third = ["never", "quits", "third", "voted"]
    assert seen == [(False, sorted(ANSWERS)), (True, third), (True, ["never"]), (False, []), (True, ["never"])]
    assert out.count() == len(ANSWERS)
    again = passes.decided(spark, windows, state, n)[0]
    assert len(seen) == 6 and sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


def test_rows_of_reads_are_shuffled_once_for_a_decision(spark):
    reads = spark.createDataFrame([("s", n, None, None, [], []) for n in range(3)], "source_id string, read_idx int, error string, statement string, non array<int>, cont array<int>")
    rows = spark.createDataFrame([("s", n, i, sig, [i + 1]) for n, read in enumerate(("ab", "ac", "xb")) for i, sig in enumerate(read)], "source_id string, read_idx int, row_idx int, sig string, labels array<int>")
    windows = spark.createDataFrame([("s", "s", 1, 2, 2)], WINDOWS)
    out = passes.C.decide_rows(reads, rows, windows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("unhex(md5(") == 1
    assert [tuple(r) for r in out.collect()] == [("s", "arbitrated", None, True, None)]
