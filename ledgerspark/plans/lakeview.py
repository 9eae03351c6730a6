"""Lake-shaped views over the star-schema test tables.

Each view is one SQL text that Spark and the oracle read alike; ``{name}`` stands for a
base table. The views only shape input: every operator under test runs on top of them.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, str] = {}

VIEWS["filings"] = """
SELECT cast(o_orderkey AS string) AS doc_id,
  CASE WHEN o_orderkey % 3 = 0 THEN 'senate' ELSE 'house' END AS chamber,
  'First' || cast(o_custkey % 83 AS string) AS filer_first,
  'LAST' || cast(o_custkey % 211 AS string) AS filer_last,
  CASE WHEN o_orderkey % 3 <> 0 THEN substr('CATXNYFLWA', cast(1 + 2 * (o_custkey % 5) AS int), 2) || lpad(cast(o_custkey % 12 AS string), 2, '0') END AS state_district,
  cast(o_orderdate AS date) AS filing_date,
  o_orderdate + interval 28 hours AS available_at,
  CASE WHEN o_orderkey % 4 = 0 THEN cast(o_orderdate AS date) - cast(o_orderkey % 9 AS int) END AS report_date,
  CASE WHEN o_orderkey % 5 = 0 THEN cast(o_orderdate AS date) - cast(o_orderkey % 40 AS int) END AS amended_report_date,
  CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'failed' ELSE 'unsupported' END AS extraction_status,
  CASE o_orderstatus WHEN 'O' THEN 'model error ' || substr(o_orderpriority, 1, 1) END AS failure_reason,
  CASE WHEN o_custkey % 10 >= 2 THEN 'member:M' || cast(o_custkey AS string) || CASE WHEN o_custkey % 97 = 5 AND o_orderkey % 2 = 0 THEN ':alt' ELSE '' END
       ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'senate' ELSE 'house' END || '|last' || cast(o_custkey % 211 AS string) || '|first' || cast(o_custkey % 83 AS string) END AS filer_key,
  CASE WHEN o_custkey % 10 >= 2 THEN 'M' || cast(o_custkey AS string) END AS member_id,
  'First' || cast(o_custkey % 83 AS string) || ' Last' || cast(o_custkey % 211 AS string) AS display_name,
  CASE o_custkey % 10 WHEN 0 THEN 'unresolved' WHEN 1 THEN 'non_member' WHEN 2 THEN 'override' ELSE 'legislators' END AS identity_source
FROM {orders}
"""

VIEWS["trades"] = """
SELECT f.chamber, f.doc_id, cast(l.l_linenumber - 1 AS int) AS row_index,
  CASE WHEN l.l_suppkey % 4 = 0 THEN 'X' || cast(l.l_partkey % 400 AS string) END AS source_transaction_id,
  f.filer_first, f.filer_last,
  CASE l.l_suppkey % 5 WHEN 0 THEN 'self' WHEN 1 THEN 'spouse' WHEN 2 THEN 'joint' WHEN 3 THEN 'dependent_child' ELSE 'not_indicated' END AS owner,
  CASE WHEN l.l_returnflag = 'A' THEN 'purchase' WHEN l.l_returnflag = 'R' THEN 'sale' WHEN l.l_partkey % 20 = 0 THEN 'unmarked' ELSE 'exchange' END AS action,
  l.l_quantity > 40 AS partial_sale,
  CASE WHEN l.l_partkey % 61 = 0 THEN NULL ELSE cast(l.l_shipdate AS date) END AS transaction_date,
  CASE WHEN l.l_partkey % 97 = 0 THEN cast(l.l_shipdate AS date) - 90000 ELSE cast(l.l_shipdate AS date) + cast(l.l_quantity AS int) END AS notification_date,
  f.filing_date, f.available_at,
  'Asset ' || cast(l.l_partkey AS string) AS asset_description,
  CASE WHEN l.l_partkey % 7 = 0 THEN NULL ELSE 't' || cast(l.l_partkey % 50 AS string) END AS printed_ticker,
  CASE WHEN l.l_partkey % 21 = 0 AND l.l_partkey % 5 <> 0 THEN 'R' || cast(l.l_partkey % 9 AS string) END AS resolved_ticker,
  CASE WHEN l.l_partkey % 7 <> 0 THEN 'printed' WHEN l.l_partkey % 3 = 0 THEN 'resolved' WHEN l.l_partkey % 3 = 1 THEN 'not_public_equity' ELSE 'unresolved' END AS resolution_status,
  CASE l.l_partkey % 4 WHEN 0 THEN 'ST' WHEN 1 THEN 'OP' WHEN 2 THEN 'GS' END AS asset_type_code,
  CASE l.l_partkey % 3 WHEN 0 THEN 'Stock' WHEN 1 THEN 'Other' END AS asset_type_label,
  CASE WHEN l.l_partkey % 13 = 0 THEN NULL WHEN l.l_partkey % 103 = 0 THEN -1.0E0 WHEN l.l_extendedprice < 15000 THEN 1001.0E0 WHEN l.l_extendedprice < 50000 THEN 15001.0E0 ELSE 50001.0E0 END AS amount_low,
  CASE WHEN l.l_partkey % 13 = 0 THEN NULL WHEN l.l_partkey % 101 = 0 THEN 500.0E0 WHEN l.l_extendedprice < 15000 THEN 15000.0E0 WHEN l.l_extendedprice < 50000 THEN 50000.0E0 ELSE 100000.0E0 END AS amount_high,
  CASE WHEN l.l_suppkey % 6 = 0 THEN 'note ' || l.l_linestatus END AS comment,
  f.filer_key, f.member_id, f.display_name, f.identity_source,
  l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_extendedprice
FROM {lineitem} l JOIN filings f ON f.doc_id = cast(l.l_orderkey AS string)
"""

VIEWS["events"] = """
SELECT chamber || ':' || doc_id || ':' || cast(row_index AS string) || ':' || cast(l_partkey AS string) AS event_id,
  cast(row_number() OVER (PARTITION BY filer_key, coalesce(upper(printed_ticker), '') ORDER BY available_at, doc_id, row_index, l_partkey, l_suppkey, l_extendedprice) AS int) AS version,
  chamber, filer_first, filer_last, owner, action, partial_sale, transaction_date, upper(coalesce(printed_ticker, resolved_ticker)) AS ticker,
  source_transaction_id, asset_description, CASE WHEN l_suppkey % 12 = 0 THEN NULL ELSE comment END AS comment, amount_low, amount_high, filing_date,
  available_at AS first_available_at, available_at,
  lead(available_at) OVER (PARTITION BY filer_key, coalesce(upper(printed_ticker), '') ORDER BY available_at, doc_id, row_index, l_partkey, l_suppkey, l_extendedprice) AS superseded_at,
  doc_id AS source_doc_id, row_index AS source_row_index,
  CASE WHEN l_partkey % 211 = 0 THEN 'oops' WHEN l_partkey % 223 = 0 THEN '[7]' WHEN l_partkey % 227 = 0 THEN '{"a":1}' WHEN l_partkey % 229 = 0 THEN '["x"]'
       WHEN l_partkey % 233 = 0 THEN '["' || doc_id || ':99"]'
       ELSE '["' || doc_id || ':' || cast(row_index AS string) || '"]' END AS contributor_row_ids,
  filer_key, member_id, display_name, identity_source
FROM trades
"""

#: Filings and trades of which a quarter is filed again: repeated, corrected, at the same instant or 30 days later, amending the first filing or not.
VIEWS["refilings"] = """
SELECT chamber, doc_id, filer_key, filing_date, report_date, amended_report_date, available_at FROM filings
UNION ALL
SELECT chamber, 'R' || doc_id, filer_key, filing_date + 30, cast(NULL AS date), CASE WHEN cast(doc_id AS bigint) % 8 < 4 THEN filing_date END, CASE WHEN cast(doc_id AS bigint) % 16 = 0 THEN available_at ELSE available_at + interval 30 days END
FROM filings WHERE cast(doc_id AS bigint) % 4 = 0
"""
_AGAIN = "filer_first, filer_last, owner, action, partial_sale, transaction_date, {at} AS available_at, asset_description, printed_ticker, resolved_ticker, comment, asset_type_code, asset_type_label, amount_low, {high} AS amount_high, filer_key, member_id, display_name, identity_source"
VIEWS["retraded"] = f"""
SELECT chamber, doc_id, row_index, source_transaction_id, {_AGAIN.format(at="available_at", high="amount_high")} FROM trades
UNION ALL
SELECT chamber, 'R' || doc_id, row_index, CASE WHEN row_index % 2 = 0 THEN source_transaction_id END,
  {_AGAIN.format(at="CASE WHEN cast(doc_id AS bigint) % 16 = 0 THEN available_at ELSE available_at + interval 30 days END", high="CASE WHEN row_index % 3 = 0 THEN 77777.0E0 ELSE amount_high END")}
FROM trades WHERE cast(doc_id AS bigint) % 4 = 0
"""

#: The line index a lake must contain, receipts of a round, and trades as a Spark input of the fold.
VIEWS["indexed"] = """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'senate' ELSE 'house' END AS chamber,
  cast(CASE WHEN o_orderkey % 50 = 0 THEN o_orderkey + 10000000 ELSE o_orderkey END AS string) AS doc_id
FROM {orders}
"""
VIEWS["receipts"] = """
SELECT CASE WHEN o_orderkey % 3 = 0 THEN 'senate' ELSE 'house' END AS chamber, cast(o_orderkey AS string) AS doc_id
FROM {orders} WHERE o_orderkey % 7 <> 0
UNION ALL SELECT 'house', 'lost' || cast(n_nationkey AS string) FROM {nation}
"""
VIEWS["ocr"] = """
SELECT cast(cast(floor(doc_id / 4) AS bigint) AS string) AS filing_id, cast(1 + doc_id % 4 AS int) AS page, text FROM {documents}
"""
#: Signatures are whole texts, with A-Z in lower case and tabs and line ends as spaces.
_WHOLE = "trim(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9) || chr(10) || chr(13), 'abcdefghijklmnopqrstuvwxyz   '))"
VIEWS["reads"] = f"""
SELECT cast(conv_id AS string) AS source_id, cast(turn AS int) AS read_idx, role, text, {_WHOLE} AS signature, conv_id % 11 = 0 AND turn = 1 AS failed
FROM {{conversations}}
"""
#: A first read is repeated as a whole: as second read of every third conversation, as third read of another third.
VIEWS["whole_reads"] = f"""
SELECT cast(conv_id AS string) AS source_id, cast(CASE WHEN conv_id % 3 < 2 AND turn > conv_id % 3 THEN turn + 1 ELSE turn END AS int) AS read_idx, role, text,
  {_WHOLE} AS signature, conv_id % 11 = 0 AND conv_id % 3 > 0 AND turn = 1 AS failed
FROM {{conversations}}
UNION ALL SELECT cast(conv_id AS string), cast(1 + conv_id % 3 AS int), role, text, {_WHOLE}, conv_id % 11 = 0 AND conv_id % 3 = 0
FROM {{conversations}} WHERE conv_id % 3 < 2 AND turn = 0
"""
#: Three reads of every filing's trades. By order number modulo 6: all alike; the second read wrong; the first and the
#: second wrong in different rows; all different in one row; the second failed (and for some the third); no third read.
VIEWS["numbered"] = """
SELECT doc_id AS source_id, l_orderkey % 6 AS kind, l_orderkey % 12 >= 6 AS odd, l_partkey, action, transaction_date, notification_date, amount_low, amount_high, printed_ticker, asset_type_code, owner, partial_sale, source_transaction_id, asset_description,
  cast(row_number() OVER (PARTITION BY doc_id ORDER BY row_index, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS int) AS n, cast(count(*) OVER (PARTITION BY doc_id) AS int) AS of
FROM trades
"""
VIEWS["read_rows"] = " UNION ALL ".join(
    f"""
SELECT source_id, {r} AS read_idx, cast(CASE WHEN kind = 2 AND {r} = 1 THEN of - n ELSE n - 1 END AS int) AS row_idx, n, of, kind, odd,
  kind = 4 AND ({r} = 1 OR {r} = 2 AND odd) AS failed,
  NOT (kind = 2 AND {r} = 1 AND n = 1) AND NOT (kind = 3 AND odd AND {r} > 0 AND n = of) AS listed,
  CASE action WHEN 'purchase' THEN 'P' WHEN 'sale' THEN ' S ' WHEN 'exchange' THEN 'E' ELSE 'unmarked' END AS transaction_type_code,
  cast(transaction_date + cast(CASE WHEN kind = 1 AND {r} = 1 AND n = 1 OR kind = 2 AND {r} = 0 AND n = 1 OR kind = 2 AND {r} = 1 AND n = of OR kind IN (3, 4, 5) AND n = 1 THEN {r} + 1 ELSE 0 END AS int) AS string) AS transaction_date_iso,
  CASE WHEN l_partkey % 5 = 0 THEN '2024-02-30' ELSE cast(notification_date AS string) END AS notification_date_iso,
  amount_low, amount_high, CASE WHEN {r} = 1 THEN ' ' || printed_ticker ELSE printed_ticker END AS ticker,
  CASE WHEN asset_type_code IS NULL AND {r} = 2 THEN ' ' ELSE asset_type_code END AS asset_type_code, owner, partial_sale, source_transaction_id
FROM numbered WHERE {r} < 2 OR kind <> 5"""
    for r in range(3)
)

VIEWS["people"] = """
SELECT 'B' || cast(c_custkey AS string) AS bioguide, translate(cast(c_custkey % 83 AS string), '0123456789', 'Klnopqtuvw') || 'ann' AS first, cast(NULL AS string) AS middle, cast(NULL AS string) AS nickname,
  'Z' || translate(cast(c_custkey % 211 AS string), '0123456789', 'klnopqtuvw') AS last, cast(NULL AS string) AS official_full,
  substr('CATXNYFLWA', cast(1 + 2 * (c_custkey % 5) AS int), 2) AS state, cast(c_custkey % 12 AS int) AS district,
  DATE '1990-01-01' + cast(c_custkey % 900 AS int) AS first_start, DATE '1993-01-01' + cast(c_custkey % 900 AS int) AS first_end,
  DATE '1994-01-01' + cast(c_custkey % 1300 AS int) AS second_start, DATE '1998-01-01' + cast(c_custkey % 900 AS int) AS second_end
FROM {customer}
"""
VIEWS["named"] = """
SELECT cast(o_orderkey AS string) AS doc_id, CASE WHEN o_orderkey % 3 = 0 THEN 'senate' ELSE 'house' END AS chamber,
  upper(translate(cast(o_custkey % 83 AS string), '0123456789', 'Klnopqtuvw')) || CASE WHEN o_orderkey % 4 = 0 THEN 'ANN' ELSE 'OTTO' END AS filer_first,
  'Z' || upper(translate(cast(o_custkey % 211 AS string), '0123456789', 'klnopqtuvw')) AS filer_last,
  CASE WHEN o_orderkey % 3 <> 0 THEN substr('CATXNYFLWA', cast(1 + 2 * (o_custkey % 5) AS int), 2) || lpad(cast(CASE WHEN o_orderkey % 5 = 0 THEN o_custkey % 13 ELSE o_custkey % 12 END AS string), 2, '0') END AS state_district,
  cast(o_orderdate AS date) AS filing_date
FROM {orders}
"""
#: A filing's trades as the lines of a scanned table: two a page, four a window.
VIEWS["read_lines"] = """
SELECT doc_id AS filing_id, filing_date + 200 AS filed_on, cast(row_number() OVER (PARTITION BY doc_id ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS int) AS label,
  l_partkey, l_suppkey, l_linenumber, transaction_date AS transaction, transaction_date + cast(l_quantity AS int) AS notification, asset_description FROM trades
"""
VIEWS["stream"] = "SELECT event_id, ts, user_id, event_type, value, props FROM {events}"

_BASE = re.compile(r"\{(\w+)\}")


def needs(view: str) -> list[str]:
    """Views that a view reads, in order, itself last."""
    out: list[str] = []
    for other in VIEWS:
        if other != view and re.search(rf"\b(?:FROM|JOIN) {other}\b", VIEWS[view]):
            out += [x for x in needs(other) if x not in out]
    return [*out, view]


def oracle_with(*views: str) -> str:
    """The views as a WITH clause over base tables of the same names."""
    order: list[str] = []
    for v in views:
        order += [x for x in needs(v) if x not in order]
    return "WITH " + ",\n".join(f"{v} AS ({_BASE.sub(lambda m: m[1], VIEWS[v])})" for v in order)


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str, given: dict[str, DataFrame] | None = None) -> DataFrame:
    """A view as a DataFrame; views in ``given`` are not derived anew."""
    if given and name in given:
        return given[name]
    text = VIEWS[name]
    frames = {t: base(spark, sf_dir, t) for t in set(_BASE.findall(text))}
    for other in needs(name)[:-1]:
        if re.search(rf"\b(?:FROM|JOIN) {other}\b", text):
            text = re.sub(rf"\b(FROM|JOIN) {other}\b", rf"\1 {{{other}}}", text)
            frames[other] = view(spark, sf_dir, other, given)
    return spark.sql(text.replace('{"a":1}', "{{\"a\":1}}"), **frames)
