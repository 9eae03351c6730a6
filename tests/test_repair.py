"""Date findings of two reads."""

from __future__ import annotations

import datetime as dt

from ledgerspark.operators import repair


def test_findings_are_said_once_a_page_and_no_sentence_is_shuffled(spark):
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    windows = spark.createDataFrame([("f:w0", "f", day(0), 1, 2, 1, 1)], "source_id string, filing_id string, filed_on date, first int, last int, page_start int, page_end int")
    spans = spark.createDataFrame([("f", 1, 1, 2)], "filing_id string, page int, first_label int, last_label int")
    ddl = "row_idx int, sig string, transaction date, notification date, asset string"
    text = spark.createDataFrame([("f:w0", [1], 1, "p", day(5), day(6), "A"), ("f:w0", [1], 2, "q", day(5), day(7), "A")], "source_id string, labels array<int>, " + ddl)
    page = spark.createDataFrame([("f", 1, i, "p", day(5), day(6 + i), "A") for i in (1, 2)], "filing_id string, page int, " + ddl)
    reads = spark.createDataFrame([("f:w0", None)], "source_id string, error string"), spark.createDataFrame([("f", 1, None)], "filing_id string, page int, error string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = repair.date_findings_by_page(windows, spans, reads[0], text, reads[1], page)
        found = sorted(r.finding for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(found) == 2 and found[0].startswith(repair.TEXT_READ) and found[1].startswith(repair.PAGE_READ)
    assert "Exchange" in plan and not any("Exchange" in line and "finding#" in line for line in plan.splitlines())
