"""The fold as a stream against the fold as a batch."""

from __future__ import annotations

import datetime as dt
import random

from ledgerspark.operators.events import VERSION_DDL, build_events
from ledgerspark.streaming import availability as A
from ledgerspark.streaming.flows import open_stream

from .test_events import DAY, FILING_DDL, TRADE, TRADE_DDL

NAMES = [c.split()[0] for c in VERSION_DDL.split(", ")]


def lake(spark):
    """Trades of three members that repeat, correct and amend each other, many at one instant."""
    r = random.Random(2)
    filed = {str(d): (f"member:{d % 3}", dt.date(2024, 1, 1 + d % 9), DAY[d % 14]) for d in range(30)}
    rows = [
        {"doc_id": d, "row_index": i, "filer_key": who, "available_at": at, "printed_ticker": r.choice(["a", "b", None]), "source_transaction_id": r.choice([None, None, "X", "Y", "Z"]),
         "amount_high": r.choice([15000.0, 50000.0, None]), "transaction_date": r.choice([None, dt.date(2024, 1, 1), dt.date(2024, 1, 2)])}
        for d, (who, _, at) in filed.items() for i in range(4)
    ]
    trades = spark.createDataFrame([tuple({**TRADE, **x}[k] for k in TRADE) for x in rows], TRADE_DDL)
    filings = spark.createDataFrame([("house", d, who, day, None, day - dt.timedelta(int(d) % 4) if int(d) % 2 else None) for d, (who, day, _) in filed.items()], FILING_DDL)
    return trades, filings


def rows(df):
    return sorted(map(str, df.select(*NAMES).collect()))


def test_stream_equals_batch_in_any_cut_and_goes_on_from_its_checkpoint(spark, tmp_path):
    trades, filings = lake(spark)
    want = build_events(trades, filings).cache()
    assert want.where("version > 1").count() > 3 and want.where("contributor_row_ids like '%,%'").count() > 3 and want.where("superseded_at is not null").count() > 2
    arriving = A.arrivals(trades, filings).cache()
    for name, cuts in (("one", [0, 28]), ("many", [0, 2, 3, 5, 9, 10, 28])):
        out, state, folder = (f"{tmp_path}/{name}-{x}" for x in ("out", "state", "in"))
        for a, b in zip(cuts, cuts[1:], strict=False):  # the stream stops and starts again after each part
            arriving.where(f"day(available_at) > {a} and day(available_at) <= {b}").coalesce(1).write.mode("append").parquet(folder)
            A.follow(open_stream(spark, folder), out, state)
        changed = spark.read.parquet(out)
        assert rows(A.current(changed)) == rows(want)
        assert A.late_filers(changed).count() == 0
    A.follow(open_stream(spark, folder), out, state)
    assert spark.read.parquet(out).count() == changed.count()


def test_late_trades_are_told(spark, tmp_path):
    trades, filings = lake(spark)
    arriving = A.arrivals(trades, filings).where("filer_key = 'member:1'")
    folder, out, state = (f"{tmp_path}/{x}" for x in ("in", "out", "state"))
    for part in ("day(available_at) > 5", "day(available_at) <= 5"):
        arriving.where(part).coalesce(1).write.mode("append").parquet(folder)
        A.follow(open_stream(spark, folder), out, state)
    changed = spark.read.parquet(out)
    assert [r.filer_key for r in A.late_filers(changed).collect()] == ["member:1"]


def test_a_filer_of_many_events_goes_to_entries_and_reads_the_same():
    class Entries(dict):
        getValue, updateValue = dict.get, dict.__setitem__  # noqa: N815

    entries = Entries()
    held = A._Held(entries, '"a"', '{"events": {}, "found": {}, "days": {}}')
    held.put("events", "0", {"name": "x"})
    held.put("days", "2024-01-01", ["1"])
    packed = held.packed(A.FEW_EVENTS)
    assert not entries and A._Held(entries, '"a"', packed).get("events", "0") == {"name": "x"}
    assert held.packed(A.FEW_EVENTS + 1) is None and len(entries) == 2
    again = A._Held(entries, '"a"', None)
    again.put("found", "k", [0])
    assert [again.get(*k) for k in (("events", "0"), ("days", "2024-01-01"), ("found", "k"), ("found", "none"))] == [{"name": "x"}, ["1"], [0], None]
