"""Queries of normalisation, identity and events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators import events as E
from ledgerspark.operators import identity as ID
from ledgerspark.operators import normalize as N
from ledgerspark.scratch import land, shared_path
from ledgerspark.streaming import availability as A

from .analysis import _REASON, extracted
from .registry import Lake, query

_NOW = "1999-01-01"
_BAD = "(transaction_date < DATE '1789-01-01' OR transaction_date > DATE '1999-01-02' OR transaction_date > filing_date)"
_BADN = "(notification_date < DATE '1789-01-01' OR notification_date > DATE '1999-01-02')"
query(
    "sanitize_trades",
    f"SELECT doc_id, row_index, l_partkey, l_suppkey, cast(transaction_date AS varchar) AS transacted, cast(CASE WHEN {_BADN} THEN NULL ELSE notification_date END AS varchar) AS notified FROM trades WHERE NOT coalesce({_BAD}, false)",
    ("trades",),
)(
    lambda k: N.sanitize(k.trades, N.latest_usable(_NOW)).select("doc_id", "row_index", "l_partkey", "l_suppkey", F.col("transaction_date").cast("string").alias("transacted"), F.col("notification_date").cast("string").alias("notified"))
)
query(
    "sanitize_log",
    f"""
    SELECT doc_id, row_index, doc_id || '#' || row_index || ' notificationDate ' || notification_date || ' nulled' AS message FROM trades WHERE {_BADN}
    UNION ALL SELECT doc_id, row_index, doc_id || '#' || row_index || ' transactionDate ' || transaction_date || ' rejected' FROM trades WHERE {_BAD}
    """,
    ("trades",),
)(lambda k: N.sanitize_log(k.trades, N.latest_usable(_NOW)))


_ORDER = "PARTITION BY doc_id ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity"


def house_input(k: Lake):
    """Index, read results and extracted rows of House filings, shaped from the views; most filings are read without an error."""
    index = k.filings.where("chamber = 'house'").select("doc_id", "filing_date", "extraction_status", "failure_reason")
    results = index.select("doc_id", F.when(F.col("extraction_status") == "failed", F.col("failure_reason")).alias("error"))
    numbered = k.trades.where("chamber = 'house'").withColumn("row_number", F.expr(f"cast(row_number() OVER ({_ORDER}) AS int)"))
    x = F.col("l_partkey")
    rows = numbered.select(
        "doc_id", "row_number", "l_partkey", "l_suppkey",
        F.when(x % 11 == 0, "Q").when(F.col("action") == "purchase", "P").when(F.col("action") == "sale", "S").when(F.col("action") == "unmarked", "unmarked").otherwise("E").alias("transaction_type_code"),
        F.lit(None).cast("string").alias("transaction_date"), F.when(x % 19 != 0, F.col("asset_description")).alias("asset"), F.lit("band").alias("amount_bracket"), F.lit("$1,001 - $15,000").alias("amount_category"),
        F.lit(None).cast("double").alias("amount_exact"), F.col("transaction_date").cast("string").alias("transaction_date_iso"), F.col("notification_date").cast("string").alias("notification_date_iso"),
        "owner", F.upper("printed_ticker").alias("ticker"), "asset_type_code", "source_transaction_id",
    )
    return index.select("doc_id", "filing_date"), results, rows


_HOUSE = f"""
    WITH n AS (SELECT *, row_number() OVER ({_ORDER}) AS rn FROM trades WHERE chamber = 'house'),
    bad AS (SELECT doc_id, 'invalid rows: ' || string_agg('row ' || rn || ' ' || CASE WHEN l_partkey % 11 = 0 THEN 'transaction_type_code Q is not one of P, S, E, unmarked' ELSE 'asset is null' END, '; ' ORDER BY rn) AS failure
            FROM n WHERE l_partkey % 11 = 0 OR l_partkey % 19 = 0 GROUP BY doc_id),
    s AS (SELECT f.doc_id, f.filing_date, coalesce(CASE WHEN f.extraction_status = 'failed' THEN f.failure_reason END, b.failure) AS failure_reason FROM filings f LEFT JOIN bad b ON b.doc_id = f.doc_id WHERE f.chamber = 'house'),
    t AS (SELECT n.* FROM n JOIN s ON s.doc_id = n.doc_id AND s.failure_reason IS NULL WHERE NOT coalesce({_BAD}, false))
"""
_HOUSE = _HOUSE.replace("> filing_date", "> n.filing_date")
query(
    "norm_house",
    _HOUSE + "SELECT 'house' AS chamber, s.doc_id, CASE WHEN s.failure_reason IS NULL THEN 'ok' ELSE 'failed' END AS extraction_status, s.failure_reason, cast(coalesce(c.n, 0) AS int) AS extracted_rows FROM s LEFT JOIN (SELECT doc_id, count(*) AS n FROM t GROUP BY 1) c ON c.doc_id = s.doc_id",
    ("trades",),
)(lambda k: N.house_filings(*house_input(k), _NOW)[0].drop("filing_date"))
query(
    "norm_house_trades",
    _HOUSE + f"SELECT doc_id, cast(rn - 1 AS int) AS row_index, action, upper(printed_ticker) AS printed_ticker, 1001.0E0 AS amount_low, cast(CASE WHEN {_BADN} THEN NULL ELSE notification_date END AS varchar) AS notified FROM t",
    ("trades",),
)(lambda k: N.house_filings(*house_input(k), _NOW)[1].select("doc_id", "row_index", "action", "printed_ticker", "amount_low", F.col("notification_date").cast("string").alias("notified")))
query(
    "norm_failures",
    f"""
    WITH n AS (SELECT *, row_number() OVER ({_ORDER}) AS rn, {_REASON} AS reason FROM trades)
    SELECT doc_id, 'invalid rows: ' || string_agg('row ' || rn || ' ' || reason, '; ' ORDER BY rn) AS failure FROM n WHERE reason IS NOT NULL GROUP BY doc_id
    """,
    ("trades",),
)(lambda k: N.failures(extracted_numbered(k), N.S.row_invalid_reason(), ["doc_id"], "row_number"))


def extracted_numbered(k: Lake):
    """Extraction rows with their number in the document."""
    return extracted(_Only(k.trades.withColumn("row_number", F.expr(f"cast(row_number() OVER ({_ORDER}) AS int)"))))


class _Only:
    """A lake of trades alone."""

    def __init__(self, trades):
        self.trades = trades


def senate_input(k: Lake):
    """Electronic reports and their printed cells, some of them wrong."""
    n = F.col("doc_id").cast("bigint")
    day = F.date_format("filing_date", "MM/dd/yyyy")
    amended = F.when(n % 5 == 0, F.concat(F.lit(" (Amendment "), (n % 3 + 1).cast("string"), F.lit(")"))).when(n % 7 == 0, " (Amendment)").otherwise("")
    reports = k.filings.where("chamber = 'senate'").select("doc_id", "filing_date", F.when(n % 13 == 0, "Annual Report").otherwise(F.concat(F.lit("Periodic Transaction Report for "), day, amended)).alias("report_title"))
    x = F.col("l_partkey")
    rows = k.trades.where("chamber = 'senate'").withColumn("row_number", F.expr(f"cast(row_number() OVER ({_ORDER}) AS int)")).select(
        "doc_id", "row_number",
        F.when(x % 23 == 0, "Gift").when(F.col("action") == "purchase", "Purchase").when(F.col("partial_sale"), "Sale (Partial)").otherwise("Sale (Full)").alias("transaction_type"),
        F.when(x % 29 == 0, "Dog").otherwise("Joint").alias("owner"), F.when(x % 31 == 0, "lots").otherwise("$15,001 - $50,000").alias("amount"),
        F.when(x % 37 == 0, "13/40/2020").otherwise(F.date_format("transaction_date", "M/d/yyyy")).alias("transaction_date"),
        F.upper("printed_ticker").alias("ticker"), F.concat(F.lit("AB"), F.lit(" - "), "asset_description").alias("asset_name"), F.lit("Stock").alias("asset_type"),
    )
    return reports, rows


_SENATE = f"""
    WITH n AS (SELECT *, row_number() OVER ({_ORDER}) AS rn FROM trades WHERE chamber = 'senate'),
    p AS (SELECT doc_id, rn, concat_ws('; ', CASE WHEN l_partkey % 23 = 0 THEN 'row ' || rn || ' has unknown type "Gift"' END, CASE WHEN l_partkey % 29 = 0 THEN 'row ' || rn || ' has unknown owner "Dog"' END,
            CASE WHEN l_partkey % 31 = 0 THEN 'row ' || rn || ' has non-statutory amount "lots"' END, CASE WHEN l_partkey % 37 = 0 THEN 'row ' || rn || ' has no calendar date "13/40/2020"' END) AS m FROM n),
    g AS (SELECT doc_id, string_agg(m, '; ' ORDER BY rn) AS m FROM p WHERE m <> '' GROUP BY doc_id),
    s AS (SELECT f.doc_id, f.filing_date, cast(f.doc_id AS bigint) AS d, nullif(concat_ws('; ', CASE WHEN cast(f.doc_id AS bigint) % 13 = 0 THEN 'report title "Annual Report" is not a known eFD title' END, g.m), '') AS failure_reason
          FROM filings f LEFT JOIN g ON g.doc_id = f.doc_id WHERE f.chamber = 'senate'),
    t AS (SELECT n.* FROM n JOIN s ON s.doc_id = n.doc_id AND s.failure_reason IS NULL WHERE NOT coalesce({_BAD.replace("> filing_date", "> n.filing_date")}, false))
    SELECT s.doc_id, cast(CASE WHEN d % 13 <> 0 THEN filing_date END AS varchar) AS reported, cast(CASE WHEN d % 13 <> 0 AND d % 5 = 0 THEN filing_date END AS varchar) AS amends,
      CASE WHEN failure_reason IS NULL THEN 'ok' ELSE 'failed' END AS extraction_status, failure_reason, cast(coalesce(c.n, 0) AS int) AS extracted_rows
    FROM s LEFT JOIN (SELECT doc_id, count(*) AS n FROM t GROUP BY 1) c ON c.doc_id = s.doc_id
"""
query("norm_senate", _SENATE, ("trades",))(
    lambda k: N.senate_filings(*senate_input(k), _NOW)[0].select("doc_id", F.col("report_date").cast("string").alias("reported"), F.col("amended_report_date").cast("string").alias("amends"), "extraction_status", "failure_reason", "extracted_rows")
)

# Identity. Names are letters only, as digits are no part of a name.
query("legislator_terms", """
    SELECT bioguide, 'rep' AS type, cast(first_start AS varchar) AS s, state, district FROM people
    UNION ALL SELECT bioguide, 'sen', cast(second_start AS varchar), state, NULL FROM people
    """, ("people",))(lambda k: ID.legislator_terms(nested(k)).select("bioguide", "type", F.col("start").cast("string").alias("s"), "state", "district"))


def nested(k: Lake):
    """People with nested terms: one as representative, then one as senator, and one of another kind."""
    term = lambda kind, s, e, d: F.struct(F.lit(kind).alias("type"), F.col(s).cast("string").alias("start"), F.col(e).cast("string").alias("end"), "state", d.alias("district"))
    return k.people.select("*", F.array(term("rep", "first_start", "first_end", F.col("district")), term("sen", "second_start", "second_end", F.col("district")), term("mayor", "first_start", "first_end", F.col("district"))).alias("terms"))


def overrides(k: Lake):
    """Reviewed exceptions for some names."""
    f = k.named.where("cast(doc_id as bigint) % 101 = 0").select("chamber", "doc_id", "filer_first", "filer_last", "state_district", F.when(F.col("doc_id").cast("bigint") % 2 == 0, F.lit("B7")).alias("member_id"))
    return f.groupBy("chamber", "filer_first", "filer_last", "state_district").agg(F.max("member_id").alias("member_id"), F.min("doc_id").alias("doc_id"))


_RESOLVE = """
    WITH o AS (SELECT chamber, filer_first, filer_last, coalesce(state_district, '') AS sd, max(CASE WHEN cast(doc_id AS bigint) % 2 = 0 THEN 'B7' END) AS member_id FROM named WHERE cast(doc_id AS bigint) % 101 = 0 GROUP BY ALL),
    f AS (SELECT *, CASE WHEN chamber = 'senate' THEN 'sen' ELSE 'rep' END AS type, CASE WHEN chamber = 'house' THEN substr(state_district, 1, 2) END AS st, CASE WHEN chamber = 'house' THEN cast(substr(state_district, 3) AS int) END AS di FROM named),
    terms AS (SELECT bioguide, 'rep' AS type, first_start AS s, first_end AS e, state, district FROM people UNION ALL SELECT bioguide, 'sen', second_start, second_end, state, NULL FROM people),
    c AS (SELECT f.chamber, f.doc_id, p.bioguide, max(CASE WHEN f.di IS NULL OR t.district IS NULL OR t.district = f.di THEN least(t.e, f.filing_date) END) AS strict, max(CASE WHEN f.di IS NOT NULL THEN least(t.e, f.filing_date) END) AS loose,
            bool_or(substr(lower(f.filer_first), 1, 3) = substr(lower(p.first), 1, 3)) AS named_
          FROM f JOIN people p ON lower(p.last) = lower(f.filer_last) JOIN terms t ON t.bioguide = p.bioguide AND t.type = f.type AND t.s <= f.filing_date AND (f.st IS NULL OR f.st = t.state) GROUP BY ALL),
    d AS (SELECT *, CASE WHEN max(strict) OVER (PARTITION BY chamber, doc_id) IS NOT NULL THEN strict ELSE loose END AS served FROM c),
    e AS (SELECT *, bool_or(named_) OVER (PARTITION BY chamber, doc_id) AS any_ FROM d WHERE served IS NOT NULL),
    g AS (SELECT *, max(served) OVER (PARTITION BY chamber, doc_id) AS latest FROM e WHERE named_ OR NOT any_),
    h AS (SELECT *, count(*) OVER (PARTITION BY chamber, doc_id) AS n FROM g WHERE served = latest),
    m AS (SELECT f.*, o.chamber IS NOT NULL AS over, CASE WHEN o.chamber IS NOT NULL THEN o.member_id ELSE h.bioguide END AS id FROM f
          LEFT JOIN o ON o.chamber = f.chamber AND o.filer_first = f.filer_first AND o.filer_last = f.filer_last AND o.sd = coalesce(f.state_district, '') LEFT JOIN h ON h.chamber = f.chamber AND h.doc_id = f.doc_id AND h.n = 1)
"""
_IDENTITY = """SELECT m.chamber, m.doc_id, CASE WHEN p.bioguide IS NOT NULL THEN 'member:' || id ELSE m.chamber || '|' || lower(filer_last) || '|' || lower(filer_first) END AS filer_key, p.bioguide AS member_id,
      CASE WHEN p.bioguide IS NOT NULL THEN p.first || ' ' || p.last ELSE upper(substr(filer_first, 1, 1)) || lower(substr(filer_first, 2)) || ' ' || upper(substr(filer_last, 1, 1)) || lower(substr(filer_last, 2)) END AS display_name,
      CASE WHEN over THEN CASE WHEN p.bioguide IS NOT NULL THEN 'override' ELSE 'non_member' END WHEN p.bioguide IS NOT NULL THEN 'legislators' ELSE 'unresolved' END AS identity_source
    FROM m LEFT JOIN people p ON p.bioguide = m.id"""


def resolved(k: Lake):
    return ID.resolve(k.named, k.people, ID.legislator_terms(nested(k)), overrides(k))


query("resolve_members", _RESOLVE + _IDENTITY, ("named", "people"))(resolved)
query(
    "identify_rows",
    _RESOLVE + f", i AS ({_IDENTITY}) SELECT t.doc_id, t.row_index, t.l_partkey, t.l_suppkey, coalesce(i.filer_key, t.chamber || '|last|first') AS filer_key, coalesce(i.identity_source, 'unresolved') AS identity_source FROM trades t LEFT JOIN i ON i.chamber = t.chamber AND i.doc_id = t.doc_id AND cast(t.doc_id AS bigint) % 9 > 0",
    ("named", "people", "trades"),
)(lambda k: ID.identify(k.trades, resolved(k).where("cast(doc_id as bigint) % 9 > 0")).select("doc_id", "row_index", "l_partkey", "l_suppkey", "filer_key", "identity_source"))
query(
    "reidentify_diff",
    _RESOLVE + f", i AS ({_IDENTITY}) SELECT i.chamber, i.doc_id FROM i JOIN filings f ON f.chamber = i.chamber AND f.doc_id = i.doc_id WHERE i.filer_key IS DISTINCT FROM f.filer_key OR i.member_id IS DISTINCT FROM f.member_id OR i.display_name IS DISTINCT FROM f.display_name OR i.identity_source IS DISTINCT FROM f.identity_source",
    ("named", "people", "filings"),
)(lambda k: ID.moved(k.filings, resolved(k)))
query(
    "chk_stale_overrides",
    """
    WITH o AS (SELECT chamber, filer_first, filer_last, state_district, min(doc_id) AS doc_id FROM named WHERE cast(doc_id AS bigint) % 101 = 0 GROUP BY ALL),
    x AS (SELECT chamber, doc_id, chamber || '|' || lower(CASE WHEN cast(doc_id AS bigint) % 4 = 0 THEN filer_last ELSE filer_first END) || '|' || lower(filer_first) || '|' || coalesce(state_district, '') AS a,
          chamber || '|' || lower(filer_last) || '|' || lower(filer_first) || '|' || coalesce(state_district, '') AS b FROM o)
    SELECT chamber || ':' || doc_id || ' ' || a AS example FROM x WHERE a <> b
    """,
    ("named",),
)(lambda k: ID.stale_overrides(overrides(k).withColumn("filer_last", F.when(F.col("doc_id").cast("bigint") % 4 == 0, F.col("filer_last")).otherwise(F.col("filer_first"))), k.named))

# Events.
query(
    "amended_docs",
    """
    WITH d AS (SELECT filer_key, filing_date AS day, doc_id FROM filings UNION SELECT filer_key, report_date, doc_id FROM filings WHERE report_date IS NOT NULL)
    SELECT f.chamber, f.doc_id, string_agg(DISTINCT d.doc_id, ',' ORDER BY d.doc_id) AS amended FROM filings f JOIN d ON d.filer_key = f.filer_key AND d.day = f.amended_report_date GROUP BY 1, 2
    """,
    ("filings",),
)(lambda k: E.amended_docs(k.filings).withColumn("amended", F.array_join("amended", ",")))

# The fold as SQL: every step takes the next trade of each filer, and a filer's open events are a list.
_ROLE_SQL = {
    "owner": "nullif(owner, 'not_indicated')", "action": "nullif(action, 'unmarked')", "partial_sale": "CASE WHEN t.chamber = 'senate' OR partial_sale THEN cast(partial_sale AS varchar) END",
    "transaction_date": "cast(transaction_date AS varchar)", "ticker": "upper(coalesce(printed_ticker, resolved_ticker))", "asset_type_code": "asset_type_code", "asset_type_label": "asset_type_label",
    "amount": "CASE WHEN amount_low IS NOT NULL OR amount_high IS NOT NULL THEN coalesce(cast(amount_low AS varchar), 'null') || '-' || coalesce(cast(amount_high AS varchar), 'null') END",
}
_CONFLICTS = " + ".join(f"coalesce(cast(e.r_{r} <> t.r_{r} AS int), 0)" for r in _ROLE_SQL)
_FREE = "NOT list_contains(e.docs, t.doc_id) AND coalesce(e.src = t.source_transaction_id, true)"
_STATE = ", ".join(f"r_{r} := {{0}}.r_{r}" for r in _ROLE_SQL)
FOLD_SQL = f"""
    days AS (SELECT filer_key, filing_date AS day, doc_id FROM filings UNION SELECT filer_key, report_date, doc_id FROM filings WHERE report_date IS NOT NULL),
    am AS (SELECT f.chamber, f.doc_id, list(d.doc_id) AS amended FROM filings f JOIN days d ON d.filer_key = f.filer_key AND d.day = f.amended_report_date GROUP BY 1, 2),
    t AS (SELECT t.*, coalesce(am.amended, []) AS amended, {", ".join(f"{x} AS r_{r}" for r, x in _ROLE_SQL.items())},
            row_number() OVER (PARTITION BY filer_key ORDER BY available_at, t.chamber, t.doc_id, row_index, source_transaction_id NULLS FIRST, owner, action, partial_sale, transaction_date NULLS FIRST, upper(coalesce(printed_ticker, resolved_ticker)) NULLS FIRST,
              asset_description, comment NULLS FIRST, asset_type_code NULLS FIRST, asset_type_label NULLS FIRST, amount_low NULLS FIRST, amount_high NULLS FIRST) AS k
          FROM trades t LEFT JOIN am ON am.chamber = t.chamber AND am.doc_id = t.doc_id WHERE identity_source IN ('legislators', 'override')),
    fresh AS (SELECT *, struct_pack(name := chamber || ':' || doc_id || ':' || row_index, ver := 1, at := available_at, src := source_transaction_id, docs := [doc_id], every := [doc_id], {_STATE.format("t")}) AS own FROM t),
    steps AS (
      SELECT filer_key, k, [own] AS evs, own.name AS name, 1 AS ver, 'new' AS what, cast(1 AS bigint) AS idx FROM fresh WHERE k = 1
      UNION ALL
      SELECT filer_key, k,
        CASE WHEN again > 0 THEN list_transform(evs, lambda e, i: CASE WHEN i = again THEN struct_pack(name := e.name, ver := e.ver, at := e.at, src := coalesce(e.src, t_src), docs := list_append(e.docs, doc), every := list_append(e.every, doc), {_STATE.format("e")}) ELSE e END)
             WHEN old > 0 THEN list_transform(evs, lambda e, i: CASE WHEN i = old THEN struct_pack(name := e.name, ver := CASE WHEN own.at > e.at THEN e.ver + 1 ELSE e.ver END, at := own.at, src := coalesce(e.src, t_src), docs := [doc], every := list_append(e.every, doc), {_STATE.format("own")}) ELSE e END)
             ELSE list_append(evs, own) END,
        CASE WHEN again > 0 THEN evs[again].name WHEN old > 0 THEN evs[old].name ELSE own.name END,
        CASE WHEN again > 0 THEN evs[again].ver WHEN old > 0 THEN CASE WHEN own.at > evs[old].at THEN evs[old].ver + 1 ELSE evs[old].ver END ELSE 1 END,
        CASE WHEN again > 0 THEN 'again' WHEN old > 0 THEN 'fix' ELSE 'new' END,
        CASE WHEN again > 0 THEN again WHEN old > 0 THEN old ELSE len(evs) + 1 END
      FROM (
        SELECT t.filer_key, t.k, s.evs, t.own, t.doc_id AS doc, t.source_transaction_id AS t_src,
          coalesce(list_position(list_transform(s.evs, lambda e: coalesce({_FREE} AND {_CONFLICTS} = 0 AND (coalesce(e.src = t.source_transaction_id, false) OR coalesce(e.r_ticker = t.r_ticker AND e.r_transaction_date = t.r_transaction_date, false)), false)), true), 0) AS again,
          coalesce(nullif(coalesce(list_position(list_transform(s.evs, lambda e: coalesce({_FREE} AND e.src = t.source_transaction_id, false)), true), 0), 0),
                   list_position(list_transform(s.evs, lambda e: coalesce({_FREE} AND list_has_any(e.every, t.amended) AND e.r_ticker = t.r_ticker AND {_CONFLICTS} = 1, false)), true), 0) AS old
        FROM steps s JOIN fresh t ON t.filer_key = s.filer_key AND t.k = s.k + 1) x),
    shown AS (SELECT s.filer_key, s.k, s.name, s.idx, s.ver, s.what, s.what <> 'again' AS starts, t.* EXCLUDE (filer_key, k, own), sum(CASE WHEN s.what <> 'again' THEN 1 ELSE 0 END) OVER (PARTITION BY s.filer_key, s.idx ORDER BY s.k) AS run FROM steps s JOIN fresh t ON t.filer_key = s.filer_key AND t.k = s.k),
    said AS (SELECT filer_key, idx, run, '["' || string_agg(doc_id || ':' || row_index, '","' ORDER BY k) || '"]' AS contributor_row_ids FROM shown GROUP BY 1, 2, 3),
    begun AS (SELECT *, min(available_at) FILTER (WHERE what = 'new') OVER (PARTITION BY filer_key, idx) AS first_at, row_number() OVER (PARTITION BY filer_key, idx, ver ORDER BY k DESC) AS latest,
              min(k) OVER (PARTITION BY filer_key, idx, ver) AS opened FROM shown WHERE starts),
    ends AS (SELECT filer_key, idx, ver, arg_min(available_at, k) AS at FROM begun GROUP BY 1, 2, 3)
    SELECT b.name AS event_id, cast(b.ver AS int) AS version, chamber, filer_first, filer_last, owner, action, partial_sale, r_ticker AS ticker, source_transaction_id, asset_description, comment, asset_type_code, asset_type_label, amount_low, amount_high,
      b.doc_id AS source_doc_id, row_index AS source_row_index, 'doc/' || b.doc_id AS source_url, s.contributor_row_ids, b.filer_key, member_id, display_name, identity_source,
      cast(transaction_date AS varchar) AS traded, strftime(first_at, '%Y-%m-%d %H:%M:%S') AS first_seen, strftime(available_at, '%Y-%m-%d %H:%M:%S') AS seen, strftime(e.at, '%Y-%m-%d %H:%M:%S') AS until
    FROM begun b JOIN said s ON s.filer_key = b.filer_key AND s.idx = b.idx AND s.run = b.run LEFT JOIN ends e ON e.filer_key = b.filer_key AND e.idx = b.idx AND e.ver = b.ver + 1 WHERE latest = 1
"""


def said(events: DataFrame) -> DataFrame:
    """Event versions with their times as text."""
    text = {"traded": F.col("transaction_date").cast("string"), **{a: F.date_format(b, "yyyy-MM-dd HH:mm:ss") for a, b in (("first_seen", "first_available_at"), ("seen", "available_at"), ("until", "superseded_at"))}}
    return events.withColumns(text).drop("transaction_date", "first_available_at", "available_at", "superseded_at")


_SOURCED = lambda trades: trades.withColumn("source_url", F.concat(F.lit("doc/"), "doc_id"))
query("events_build", f"WITH {FOLD_SQL.strip()}", ("trades",), recursive=True)(lambda k: said(E.build_events(_SOURCED(k.trades), k.filings)))
_REFILED_SQL = f"WITH {FOLD_SQL.strip().replace('FROM filings', 'FROM refilings').replace('FROM trades', 'FROM retraded')}"
query("events_refiled", _REFILED_SQL, ("retraded", "refilings"), recursive=True)(lambda k: said(E.build_events(_SOURCED(k.retraded), k.refilings)))


def _streamed(k: Lake) -> DataFrame:
    """The events of trades that arrive in three parts, as files of a stream: each part is followed when it has landed."""
    spark = k.spark
    year = F.year("available_at")
    arriving = A.arrivals(_SOURCED(k.retraded), k.refilings).withColumn("part", F.when(year < 1994, 0).when(year < 1996, 1).otherwise(2)).where(year.isNotNull())
    waiting, folder, out, state = (shared_path(spark, t) for t in ("waiting", "arrivals", "changes", "changes-state"))
    arriving.write.partitionBy("part").parquet(waiting)
    for part in range(3):
        land(spark, f"{waiting}/part={part}", f"{folder}/part={part}")
        A.follow(spark.readStream.schema(arriving.schema).parquet(folder).drop("part"), out, state)
    return A.current(spark.read.parquet(out)).select(*[c.split()[0] for c in E.VERSION_DDL.split(", ")])


query("events_stream", _REFILED_SQL, ("retraded", "refilings"), recursive=True)(lambda k: said(_streamed(k)))
query(
    "migrate_comment",
    """
    WITH t AS (SELECT chamber, doc_id, row_index, min(comment) AS c FROM trades GROUP BY ALL)
    SELECT e.event_id, e.version, coalesce(e.comment, t.c) AS comment FROM events e LEFT JOIN t ON t.chamber = e.chamber AND t.doc_id = e.source_doc_id AND t.row_index = e.source_row_index
    """,
    ("events",),
)(lambda k: E.migrate_comments(k.events, k.trades).select("event_id", "version", "comment"))
