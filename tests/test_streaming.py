"""Streams drained once give what the batch gives."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerspark.operators import resume
from ledgerspark.operators.store import LakeStore
from ledgerspark.streaming import flows

from .test_events import TRADE, TRADE_DDL

FILING = (
    "chamber string, doc_id string, filer_first string, filer_last string, filing_date date, report_date date, amended_report_date date, available_at timestamp, extraction_status string, "
    "filer_key string, member_id string, display_name string, identity_source string"
)


def test_streamed_filings_equal_one_batch(spark, tmp_path):
    filing = lambda i: ("house", str(i), "Ann", "Lee", dt.date(2024, 1, i), None, None, dt.datetime(2024, 1, i), "ok", "member:A", "A", "Ann Lee", "legislators")
    trade = lambda i: tuple({**TRADE, "doc_id": str(i), "source_transaction_id": "X", "available_at": dt.datetime(2024, 1, i), "amount_high": 1000.0 * i}[k] for k in TRADE)
    trades = spark.createDataFrame([trade(i) for i in range(1, 5)], TRADE_DDL)
    for i in range(1, 5):
        spark.createDataFrame([filing(i)], FILING).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    one, many = LakeStore(spark, f"file://{tmp_path}/one"), LakeStore(spark, f"file://{tmp_path}/many")
    one.upsert(spark.read.parquet(f"{tmp_path}/in"), trades)
    flows.consolidate(flows.open_stream(spark, f"{tmp_path}/in"), trades, many, f"{tmp_path}/state")
    rows = [sorted((r.event_id, r.version, str(r.superseded_at), r.amount_high) for r in s.read("political_trade_events").collect()) for s in (one, many)]
    assert rows[0] == rows[1] and len(rows[0]) == 4


def test_late_repeats_are_dropped(spark, tmp_path):
    rows = [(1, dt.datetime(2024, 1, 1, 0, 0), "a", 1.0), (1, dt.datetime(2024, 1, 1, 0, 5), "a", 1.0), (2, dt.datetime(2024, 1, 1, 3, 0), "b", 2.0)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, event_type string, value double").coalesce(1).write.parquet(f"{tmp_path}/in")
    flows.run_available(flows.distinct_events(flows.open_stream(spark, f"{tmp_path}/in")), f"{tmp_path}/out", f"{tmp_path}/state")
    assert sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2]


def test_round_resumes_until_nothing_finishes(spark, tmp_path):
    ids = spark.range(7).select(F.concat(F.lit("i"), F.col("id").cast("string")).alias("identity"))
    path = f"{tmp_path}/receipts"
    spark.createDataFrame([("i0",)], "identity string").write.parquet(path)
    passes = resume.run_round(lambda: ids, lambda: spark.read.parquet(path), lambda todo: todo.where("identity <> 'i3'"), lambda done: done.write.mode("append").parquet(path), batch=3)
    assert sorted(r.identity for r in spark.read.parquet(path).collect()) == ["i0", "i1", "i2", "i4", "i5", "i6"] and passes < 10
