"""The fold of observations into events: golden cases and laws."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from ledgerspark.operators.events import amended_docs, build_events, migrate_comments, rebuild

TRADE = {
    "chamber": "house", "doc_id": "1", "row_index": 0, "source_transaction_id": None, "filer_first": "Ann", "filer_last": "Lee", "owner": "self", "action": "purchase", "partial_sale": False,
    "transaction_date": dt.date(2024, 1, 2), "available_at": dt.datetime(2024, 1, 10), "asset_description": "Acme", "printed_ticker": "acm", "resolved_ticker": None, "comment": None, "asset_type_code": "ST",
    "asset_type_label": None, "amount_low": 1001.0, "amount_high": 15000.0, "filer_key": "member:A", "member_id": "A", "display_name": "Ann Lee", "identity_source": "legislators",
}
TRADE_DDL = (
    "chamber string, doc_id string, row_index int, source_transaction_id string, filer_first string, filer_last string, owner string, action string, partial_sale boolean, transaction_date date, available_at timestamp, "
    "asset_description string, printed_ticker string, resolved_ticker string, comment string, asset_type_code string, asset_type_label string, amount_low double, amount_high double, filer_key string, member_id string, display_name string, identity_source string"
)
FILING_DDL = "chamber string, doc_id string, filer_key string, filing_date date, report_date date, amended_report_date date"
DAY = [dt.datetime(2024, 1, d) for d in range(1, 29)]


def run(spark, trades, filings=()):
    t = spark.createDataFrame([tuple({**TRADE, **x}[k] for k in TRADE) for x in trades], TRADE_DDL)
    f = spark.createDataFrame([tuple(x) for x in filings], FILING_DDL)
    rows = build_events(t, f).collect()
    return sorted(rows, key=lambda r: (r.event_id, r.version)), t, f


def test_repeat_joins_the_event(spark):
    rows, *_ = run(spark, [{}, {"doc_id": "2", "available_at": DAY[14], "owner": "not_indicated", "source_transaction_id": "X1"}, {"doc_id": "3", "available_at": DAY[15], "source_transaction_id": "X1", "printed_ticker": None}])
    assert len(rows) == 1
    assert json.loads(rows[0].contributor_row_ids) == ["1:0", "2:0", "3:0"]
    # Adopting an id is state only; roles and the published row stay.
    assert rows[0].source_transaction_id is None and rows[0].owner == "self" and rows[0].ticker == "ACM"


def test_equal_rows_of_one_document_are_two_events(spark):
    rows, *_ = run(spark, [{}, {"row_index": 1}])
    assert [r.event_id for r in rows] == ["house:1:0", "house:1:1"]


def test_correction_by_source_id_opens_a_version(spark):
    rows, *_ = run(spark, [{"source_transaction_id": "X"}, {"doc_id": "2", "source_transaction_id": "X", "available_at": DAY[19], "action": "sale", "amount_low": 5.0}])
    assert [(r.version, r.action, r.superseded_at, r.contributor_row_ids) for r in rows] == [(1, "purchase", DAY[19], '["1:0"]'), (2, "sale", None, '["2:0"]')]
    assert {r.first_available_at for r in rows} == {TRADE["available_at"]}


def test_correction_of_the_same_instant_replaces(spark):
    rows, *_ = run(spark, [{"source_transaction_id": "X"}, {"doc_id": "2", "source_transaction_id": "X", "action": "sale"}])
    assert [(r.version, r.action) for r in rows] == [(1, "sale")]


@pytest.mark.parametrize(("change", "events"), [({"amount_high": 50000.0}, 1), ({"amount_high": 50000.0, "action": "sale"}, 2), ({"printed_ticker": "ZZZ"}, 2)])
def test_amendment_needs_one_conflict(spark, change, events):
    filings = [("house", "1", "member:A", dt.date(2024, 1, 9), None, None), ("house", "2", "member:A", dt.date(2024, 1, 20), None, dt.date(2024, 1, 9))]
    rows, _, f = run(spark, [{}, {"doc_id": "2", "available_at": DAY[20], **change}], filings)
    assert len({r.event_id for r in rows}) == events
    assert [(r.doc_id, r.amended) for r in amended_docs(f).collect()] == [("2", ["1"])]


def test_unknown_roles_and_chambers(spark):
    house, *_ = run(spark, [{"partial_sale": False}, {"doc_id": "2", "partial_sale": True, "available_at": DAY[20]}])
    senate, *_ = run(spark, [{"chamber": "senate", "partial_sale": False}, {"chamber": "senate", "doc_id": "2", "partial_sale": True, "available_at": DAY[20]}])
    assert len(house) == 1 and len(senate) == 2


def test_only_members_have_events(spark):
    rows, *_ = run(spark, [{"identity_source": "unresolved"}, {"doc_id": "2", "identity_source": "override"}])
    assert [r.source_doc_id for r in rows] == ["2"]


def test_scoped_rebuild_equals_full_and_windows_are_open(spark):
    import random

    r = random.Random(1)
    trades = [
        {"doc_id": str(r.randrange(40)), "row_index": i, "filer_key": f"member:{r.randrange(4)}", "available_at": DAY[r.randrange(28)], "printed_ticker": r.choice(["a", "b", None]), "source_transaction_id": r.choice([None, None, "X", "Y"]),
         "amount_high": r.choice([15000.0, 50000.0]), "transaction_date": dt.date(2024, 1, r.randrange(1, 4))}
        for i in range(120)
    ]
    rows, t, f = run(spark, trades)
    assert all(x.superseded_at is None or x.superseded_at > x.available_at for x in rows)
    before = build_events(t.where("row_index < 100"), f)
    touched = t.where("row_index >= 100").select("filer_key")
    again = sorted(rebuild(before, t, f, touched).collect(), key=lambda x: (x.event_id, x.version))
    assert again == rows
    assert sorted(migrate_comments(build_events(t, f), t).columns) == sorted(build_events(t, f).columns)


def test_large_filers_by_parts_equal_whole_ones_and_payload_is_shuffled_once(spark):
    import random

    r = random.Random(5)
    trades = [
        {"doc_id": str(d), "row_index": i, "filer_key": f"member:{d % 3}" if d % 7 else None, "available_at": DAY[d % 27], "printed_ticker": r.choice(["a", "b", None]), "source_transaction_id": r.choice([None, None, "X", "Y"]),
         "amount_high": r.choice([15000.0, 50000.0]), "transaction_date": dt.date(2024, 1, r.randrange(1, 4))}
        for d in range(40) for i in range(3)
    ]
    filings = [("house", str(d), f"member:{d % 3}" if d % 7 else None, dt.date(2024, 1, 1 + d % 27), None, dt.date(2024, 1, 1 + d % 5) if d % 2 else None) for d in range(40)]
    rows, t, f = run(spark, trades, filings)
    assert any(x.version > 1 for x in rows) and any("," in x.contributor_row_ids for x in rows)
    for whole in (0, 35):  # every filer by parts; some of them
        assert sorted(build_events(t, f, whole).collect(), key=lambda x: (x.event_id, x.version)) == rows
    plan = build_events(t, f)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1 and plan.count("asset_description") and "leftanti" not in plan.lower()
