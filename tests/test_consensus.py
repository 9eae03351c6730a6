"""Signatures of rows and reads, votes by row, and findings in words."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerspark.functions import scalars as S
from ledgerspark.operators import consensus, integrity

ROW = "k int, transaction_type_code string, transaction_date_iso string, notification_date_iso string, amount_low double, amount_high double, ticker string, asset_type_code string, owner string, partial_sale boolean, source_transaction_id string, ocr_rows array<int>"
READS = "source_id string, read_idx int, error string, statement string, non array<int>, cont array<int>"
ROWS = "source_id string, read_idx int, row_idx int, sig string, labels array<int>"
WINDOWS = "source_id string, first int, last int, row_count int"


def test_row_signature(spark):
    plain = ("P", "2024-02-29", None, 1001.0, 15000.0, "ABC", "ST", "self", False, None, [2, 1])
    rows = [
        plain, (" P\t", *plain[1:]), (*plain[:10], [1, 2]), (*plain[:2], "2024-02-30", *plain[3:]),  # alike
        (*plain[:10], [1, 1, 2]), (*plain[:1], "2023-02-29", *plain[2:]), (*plain[:8], None, *plain[9:]), (*plain[:7], " self", *plain[8:]), (*plain[:10], None),  # each unlike
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], ROW)
    with_labels = [r[0] for r in df.orderBy("k").select(consensus.row_signature(F.col("ocr_rows"))).collect()]
    assert len(set(with_labels[:4])) == 1 and len(set(with_labels[3:])) == 6
    without = [r[0] for r in df.orderBy("k").select(consensus.row_signature()).collect()]
    assert without[0] == without[4] == without[8] and None not in without


def test_document_signatures(spark):
    reads = spark.createDataFrame([
        ("a", 0, None, None, [3, 1], []), ("a", 1, None, "none", [1, 3], None), ("a", 2, None, None, [1], [3]), ("a", 3, "cut off", None, [], []),
        ("b", 0, None, "nothing to report", [], []), ("b", 1, None, "", [], []), ("b", 2, None, "none", None, None),
    ], READS)
    rows = spark.createDataFrame([("a", i, j, s, [j + 1]) for i in range(3) for j, s in enumerate("xy")], ROWS)
    sig = {(r.source_id, r.read_idx): r.sig for r in consensus.document_signatures(reads, rows).collect()}
    assert sig["a", 0] == sig["a", 1] != sig["a", 2] and sig["a", 3] is None
    assert sig["b", 0] == sig["b", 2] != sig["b", 1]


def _vote(spark, sources):
    """Outcome of reads given as lists of ``(sig, labels)``, with the labels listed as no transaction, or None for a failed read."""
    reads = [(s, i, "failed" if r is None else None, None, [] if r is None else r[1], []) for s, rs in sources.items() for i, r in enumerate(rs)]
    rows = [(s, i, j, sig, labels) for s, rs in sources.items() for i, r in enumerate(rs) if r for j, (sig, labels) in enumerate(r[0])]
    args = spark.createDataFrame(reads, READS), spark.createDataFrame(rows, ROWS)
    windows = spark.createDataFrame([(s, 1, 3, 3) for s in sources if s != "no window"], WINDOWS)
    kept = {}
    for r in consensus.voted_rows(*args).orderBy("source_id", "position").collect():
        kept.setdefault(r.source_id, []).append((r.position, r.read_idx, r.row_idx))
    return {r.source_id: (r.outcome, r.read_idx, r.voted, r.reason) for r in consensus.decide_rows(*args, windows).collect()}, kept


def test_votes(spark):
    a, b, c = ("a", [1]), ("b", [2]), ("c", [2])
    three = [([a, b], [3]), ([a, c], [3]), ([b], [3])]
    unlisted = [([a, b], [3]), ([a, c], []), ([b], [])]
    bare = ("d", None)
    out, kept = _vote(spark, {
        "agreed": [([a, b], [3]), ([a, b], [3])], "later": [([a, b], [3]), None, ([a, b], [3])], "two": three[:2], "voted": three, "no window": three, "unlisted": unlisted,
        "lone": [([a, b], [3]), None, None], "order": [([b, a], [3]), ([a, b], []), ([b, a, a], [3])], "bare": [([a, b, bare], [3]), ([a, b, bare], []), ([b, a, bare], [3])],
        "outside": [([a, b, ("z", [4])], [3]), ([a, b, ("z", [4])], []), ([("z", [4])], [3])],
    })
    unread = "voted rows do not account for the window"
    assert out == {
        "agreed": ("agreed", 0, False, None), "later": ("arbitrated", 2, False, None), "two": ("failed", None, False, "no read after the second"), "voted": ("arbitrated", None, True, None),
        "no window": ("failed", None, False, "no two reads agree"), "unlisted": ("failed", None, False, unread), "lone": ("failed", None, False, "fewer than two usable reads"),
        "order": ("arbitrated", None, True, None), "bare": ("failed", None, False, unread), "outside": ("failed", None, False, unread),
    }
    assert kept["order"] == [(0, 0, 1), (1, 0, 0)] and kept["voted"] == [(0, 0, 0), (1, 0, 1)] and kept["bare"][-1] == (2, 0, 2)


def test_voted_statement(spark):
    reads = spark.createDataFrame([("s", 0, "failed", "x", [], []), ("s", 1, None, None, [], []), ("s", 2, None, "none held", [], []), ("t", 0, None, "none", [], []), ("t", 1, None, None, [], [])], READS)
    rows = spark.createDataFrame([("s", 1, 0, "a", [1]), ("t", 0, 0, "a", [1]), ("t", 1, 0, "a", [1])], ROWS)
    assert [tuple(r) for r in consensus.voted_statement(reads, rows).collect()] == [("s", "none held")]


def test_no_reads(spark):
    empty = spark.createDataFrame([], READS), spark.createDataFrame([], ROWS), spark.createDataFrame([], WINDOWS)
    assert consensus.decide_rows(*empty).count() == 0 and consensus.voted_statement(*empty[:2]).count() == 0


def test_findings_in_words(spark):
    d = dt.date.fromisoformat
    df = spark.createDataFrame([(d("2024-05-02"), d("2022-01-01"), d("2024-05-01")), (d("2020-01-01"), d("2024-06-15"), d("2024-05-01")), (None, None, d("2024-05-01"))], "t date, n date, f date")
    assert [r[0] for r in df.select(S.date_sentences(F.col("t"), F.col("n"), F.col("f"))).collect()] == [
        ["transaction date 2024-05-02 is after the report was filed on 2024-05-01", "transaction date 2024-05-02 is more than a month after its notification date 2022-01-01"],
        ["notification date 2024-06-15 is more than a month after the report was filed on 2024-05-01", "transaction date 2020-01-01 is more than a year before its notification date 2024-06-15"],
        [],
    ]
    rows = spark.createDataFrame([([7, 8], 1, "x"), ([], 2, " Bond "), (None, None, "Bond"), (None, 3, " ")], "l array<int>, p int, a string")
    assert [r[0] for r in rows.select(S.describe_row(F.col("l"), F.col("p"), F.col("a"))).collect()] == ["the row labeled 7, 8", "a row on page 2 (Bond)", "a row (Bond)", "a row on page 3"]


def test_recovered(spark):
    previous = spark.createDataFrame([("x", True, None), ("y", False, None)], "run_id string, failed boolean, shares map<int, double>")
    for severity, sent in (("fail", []), ("info", ["x"])):
        findings = spark.createDataFrame([("c", severity)], "check string, severity string")
        assert [r.run_id for r in integrity.recovered(findings, previous).where("send").collect()] == sent


def test_rows_are_shuffled_once_for_each_use_and_without_their_texts(spark):
    """Votes deal rows by source alone, with a digest in place of the text."""
    reads = spark.createDataFrame([("s", r, None, None, [], []) for r in range(3)], "source_id string, read_idx int, error string, statement string, non array<int>, cont array<int>")
    rows = spark.createDataFrame([("s", r, i, f"row {i}" * 50 if i or r else "other", [i + 1]) for r in range(3) for i in range(2)], "source_id string, read_idx int, row_idx int, sig string, labels array<int>")
    windows = spark.createDataFrame([("s", 1, 2, 2)], "source_id string, first int, last int, row_count int")
    votes = consensus.voted_rows(reads, rows)
    assert [(r.position, r.read_idx, r.row_idx) for r in votes.orderBy("position").collect()] == [(0, 1, 0), (1, 0, 1)]
    plan = votes._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in line and "sig" in line.split("Exchange")[1] for line in plan.splitlines()) == 0
    assert consensus.decide_rows(reads, rows, windows).first().asDict() == {"source_id": "s", "outcome": "arbitrated", "read_idx": 2, "voted": False, "reason": None}
