"""Queries of the integrity checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.operators import integrity as I

from .registry import ORACLES, Lake, query

NOW = "2024-07-01"

query("chk_index_completeness", "SELECT i.chamber || ':' || i.doc_id AS example FROM indexed i WHERE NOT EXISTS (SELECT 1 FROM filings f WHERE f.chamber = i.chamber AND f.doc_id = i.doc_id)", ("indexed", "filings"))(
    lambda k: I.missing_indexed(k.indexed, k.filings)
)
query(
    "chk_publication_parity",
    """
    SELECT 'filings' AS side, 'receipt without row ' || chamber || ':' || doc_id AS example FROM (SELECT chamber, doc_id FROM receipts EXCEPT SELECT chamber, doc_id FROM filings)
    UNION ALL SELECT 'receipts', 'row without receipt ' || chamber || ':' || doc_id FROM (SELECT chamber, doc_id FROM filings EXCEPT SELECT chamber, doc_id FROM receipts)
    """,
    ("receipts", "filings"),
)(lambda k: I.parity_gaps(k.receipts, k.filings))
_ORPHANS = "SELECT t.chamber || ':' || t.doc_id || '#' || t.row_index AS example FROM trades t LEFT JOIN filings f ON f.chamber = t.chamber AND f.doc_id = t.doc_id AND f.extraction_status = 'ok' WHERE f.doc_id IS NULL"
query("chk_orphan_trades", _ORPHANS, ("trades",))(lambda k: I.orphan_trades(k.trades, k.filings))
query(
    "chk_orphan_events",
    "SELECT e.event_id || ' source=' || e.chamber || ':' || e.source_doc_id AS example FROM events e LEFT JOIN filings f ON f.chamber = e.chamber AND f.doc_id = e.source_doc_id AND f.extraction_status = 'ok' WHERE f.doc_id IS NULL",
    ("events",),
)(lambda k: I.orphan_event_sources(k.events, k.filings))
_CONTRIBUTORS = """
    WITH c AS (SELECT event_id, contributor_row_ids AS raw, try_cast(contributor_row_ids AS json) AS j FROM events),
    t AS (SELECT event_id, j, CASE WHEN j IS NULL THEN 'not JSON' WHEN json_type(j) <> 'ARRAY' THEN 'not an array' END AS error FROM c),
    x AS (SELECT event_id, unnest(from_json(j, '["json"]')) AS v FROM t WHERE error IS NULL),
    y AS (SELECT event_id, CAST(v AS varchar) AS v, json_extract_string(v, '$') AS s, json_type(v) = 'VARCHAR' AND regexp_full_match(json_extract_string(v, '$'), '[^:]+:[0-9]+') AS good FROM x),
    bad AS (SELECT event_id, min(v) AS v FROM y WHERE NOT good GROUP BY event_id)
    SELECT event_id || ': ' || error AS example FROM t WHERE error IS NOT NULL
    UNION ALL SELECT event_id || ': invalid ' || v FROM bad
    UNION ALL SELECT event_id || ': missing trade ' || s FROM y WHERE event_id NOT IN (SELECT event_id FROM bad)
      AND NOT EXISTS (SELECT 1 FROM trades WHERE doc_id || ':' || row_index = s)
    """
query("chk_contributors", _CONTRIBUTORS, ("events",))(lambda k: I.invalid_contributors(k.events, k.trades))
query("chk_dated_after_filing", "SELECT doc_id || '#' || row_index || ' ' || transaction_date || ' > ' || filing_date AS example FROM trades WHERE transaction_date > filing_date", ("trades",))(
    lambda k: I.dated_after_filing(k.trades)
)
query(
    "chk_date_range",
    """
    WITH d AS (SELECT doc_id, row_index, unnest([{'f': 'transactionDate', 'd': transaction_date}, {'f': 'notificationDate', 'd': notification_date}, {'f': 'filingDate', 'd': filing_date}]) AS x FROM trades)
    SELECT doc_id || '#' || row_index || ' ' || x.f || '=' || x.d AS example FROM d WHERE x.d < DATE '1789-01-01' OR x.d > DATE '1999-01-02'
    """,
    ("trades",),
)(lambda k: I.dates_out_of_range(k.trades, "1999-01-01"))
query(
    "chk_amount_range",
    "SELECT doc_id || '#' || row_index || ' ' || coalesce(cast(cast(amount_low AS bigint) AS varchar), 'null') || '..' || coalesce(cast(cast(amount_high AS bigint) AS varchar), 'null') AS example FROM trades WHERE amount_low < 0 OR amount_high < 0 OR amount_low > amount_high",
    ("trades",),
)(lambda k: I.invalid_amounts(k.trades))
query("chk_duplicate_trades", "SELECT chamber || ':' || doc_id || ':' || row_index || ' x' || count(*) AS example FROM trades GROUP BY chamber, doc_id, row_index HAVING count(*) > 1", ("trades",))(
    lambda k: I.duplicate_trades(k.trades)
)
query("chk_resolved_ticker", "SELECT doc_id || '#' || row_index AS example FROM trades WHERE resolution_status = 'resolved' AND resolved_ticker IS NULL", ("trades",))(lambda k: I.resolved_without_ticker(k.trades))
query("chk_unresolved_filers", "SELECT trim(chamber || ':' || doc_id || ' ' || coalesce(filer_key, '')) AS example FROM filings WHERE identity_source = 'unresolved'", ("filings",))(lambda k: I.unresolved_filers(k.filings))
query("chk_non_member_events", "SELECT event_id AS example FROM events WHERE identity_source NOT IN ('legislators', 'override')", ("events",))(lambda k: I.non_member_events(k.events))
query(
    "chk_member_split",
    "SELECT member_id || ' ' || string_agg(filer_key, ' | ' ORDER BY filer_key) AS example FROM (SELECT DISTINCT member_id, filer_key FROM filings WHERE member_id IS NOT NULL) GROUP BY member_id HAVING count(*) > 1",
    ("filings",),
)(lambda k: I.split_members(k.filings))
query("failed_share_by_year", "SELECT cast(year(filing_date) AS int) AS year, round(avg(CASE WHEN extraction_status = 'failed' THEN 1.0E0 ELSE 0.0E0 END), 6) AS share FROM filings GROUP BY 1", ("filings",))(
    lambda k: I.failed_share(k.filings).withColumn("share", F.round("share", 6))
)


def _previous(k: Lake):
    """Shares of an earlier pass: those of the filings with an odd document number."""
    return I.failed_share(k.filings.where("cast(doc_id as bigint) % 2 = 1"))


query(
    "chk_extraction_health",
    """
    WITH a AS (SELECT year(filing_date) AS y, avg(CASE WHEN extraction_status = 'failed' THEN 1.0E0 ELSE 0.0E0 END) AS s FROM filings GROUP BY 1),
    b AS (SELECT year(filing_date) AS y, avg(CASE WHEN extraction_status = 'failed' THEN 1.0E0 ELSE 0.0E0 END) AS s FROM filings WHERE cast(doc_id AS bigint) % 2 = 1 GROUP BY 1)
    SELECT printf('%d: %.2f%% failed, was %.2f%%', a.y, a.s * 100, b.s * 100) AS example FROM a JOIN b ON a.y = b.y WHERE a.s > b.s
    """,
    ("filings",),
)(lambda k: I.regressions(I.failed_share(k.filings), _previous(k)))
query(
    "chk_freshness",
    f"SELECT 'newest filingDate is stale' AS message, 'newest filingDate is ' || datediff('day', max(filing_date), DATE '{NOW}') || ' days behind {NOW}' AS example FROM filings HAVING datediff('day', max(filing_date), DATE '{NOW}') >= 4",
    ("filings",),
)(lambda k: I.freshness(k.filings, NOW))


def shards(k: Lake):
    """A manifest of yearly shards: some years empty, some still in one file."""
    years = k.filings.select(F.year("filing_date").alias("year")).distinct()
    plain = F.array(F.format_string("political_filings/%d/part-0.parquet", "year"), F.format_string("political_filings/%d-all.parquet", "year"))
    keys = F.when(F.col("year") % 3 == 0, F.array().cast("array<string>")).when(F.col("year") % 3 == 1, plain).otherwise(F.slice(plain, 1, 1))
    return years.select(F.lit("political_filings").alias("prefix"), "year", keys.alias("keys"))


query(
    "chk_manifest",
    """
    SELECT CASE WHEN y % 3 = 0 THEN 'political_filings/' || y || ': no shard keys' ELSE 'political_filings/' || y || ': reads political_filings/' || y || '-all.parquet' END AS example
    FROM (SELECT DISTINCT year(filing_date) AS y FROM filings) WHERE y % 3 < 2
    """,
    ("filings",),
)(lambda k: I.manifest_health(shards(k)))


def report(k: Lake):
    return I.audit(k.spark, NOW, k.filings, k.trades, k.events, k.indexed, k.receipts)


_CHECKS = [
    ("member_split", "'members whose filings carry more than one filer key'", "fail", "SELECT member_id || ' ' || string_agg(filer_key, ' | ' ORDER BY filer_key) AS example FROM (SELECT DISTINCT member_id, filer_key FROM filings WHERE member_id IS NOT NULL) GROUP BY member_id HAVING count(*) > 1"),
    ("unresolved_filers", "'filings no member of Congress matched; add a reviewed override'", "info", "SELECT trim(chamber || ':' || doc_id || ' ' || coalesce(filer_key, '')) AS example FROM filings WHERE identity_source = 'unresolved'"),
    ("non_member_events", "'events whose filer is not a member'", "fail", "SELECT event_id AS example FROM events WHERE identity_source NOT IN ('legislators', 'override')"),
    ("orphan_trades", "'trade rows whose filing is missing or not ok'", "fail", _ORPHANS),
    ("dated_after_filing", "'transactionDate after filingDate (' || count(*) || ', cap 0)'", "fail", "SELECT doc_id || '#' || row_index || ' ' || transaction_date || ' > ' || filing_date AS example FROM trades WHERE transaction_date > filing_date"),
    ("duplicate_trade_key", "'duplicate (chamber, docId, rowIndex)'", "fail", "SELECT chamber || ':' || doc_id || ':' || row_index || ' x' || count(*) AS example FROM trades GROUP BY chamber, doc_id, row_index HAVING count(*) > 1"),
]
_KEPT = [c for c, *_ in _CHECKS]
query(
    "audit_report",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"check\", '{sev}' AS severity, {m} AS message, count(*) AS count, array_to_string(list_slice(list_sort(list(example)), 1, 20), ';') AS examples FROM ({sql}) HAVING count(*) > 0" for c, m, sev, sql in _CHECKS
    ),
    ("filings", "trades", "events"),
)(lambda k: report(k).where(F.col("check").isin(_KEPT)).withColumn("examples", F.array_join("examples", ";")))


def _found(check: str, of: str, message: str, severity: str = "fail", where: str = "true") -> str:
    """A finding over the violations that another query's SQL gives, on the day of the audit."""
    violations = ORACLES[of].replace("1999-01-02", "2024-07-02")
    return f"SELECT '{check}' AS \"check\", '{severity}' AS severity, {message} AS message, count(*) AS count, array_to_string(list_slice(list_sort(list(example)), 1, 20), ';') AS examples FROM ({violations}) WHERE {where} HAVING count(*) > 0"


_FULL = [
    _found("member_split", "chk_member_split", "'members whose filings carry more than one filer key'"),
    _found("unresolved_filers", "chk_unresolved_filers", "'filings no member of Congress matched; add a reviewed override'", "info"),
    _found("non_member_events", "chk_non_member_events", "'events whose filer is not a member'"),
    _found("orphan_trades", "chk_orphan_trades", "'trade rows whose filing is missing or not ok'"),
    _found("orphan_event_sources", "chk_orphan_events", "'events whose sourceDocId is not an ok filing'"),
    _found("invalid_contributor_row_ids", "chk_contributors", "'contributorRowIds that do not parse or do not exist'"),
    _found("dated_after_filing", "chk_dated_after_filing", "'transactionDate after filingDate (' || count(*) || ', cap 0)'"),
    _found("date_out_of_range", "chk_date_range", f"'dates outside {I.EARLIEST} .. ' || cast(DATE '{NOW}' + 1 AS varchar)"),
    _found("invalid_amount_range", "chk_amount_range", "'amountLow > amountHigh or a negative bound'"),
    _found("duplicate_trade_key", "chk_duplicate_trades", "'duplicate (chamber, docId, rowIndex)'"),
    _found("resolved_without_ticker", "chk_resolved_ticker", "'resolutionStatus=resolved with a null resolvedTicker'"),
    f"SELECT 'freshness', 'fail', message, 1, example FROM ({ORACLES['chk_freshness']})",
    _found("index_completeness", "chk_index_completeness", "'indexed filings have no political_filings row'"),
    _found("publication_parity", "chk_publication_parity", "'receipts ' || (SELECT count(*) FROM receipts) || ' vs published filings ' || (SELECT count(*) FROM filings)", where="side = 'filings'"),
    _found("publication_parity", "chk_publication_parity", "'published rows from earlier rounds (' || count(*) || ')'", "info", "side = 'receipts'"),
    _found("extraction_health", "chk_extraction_health", "'failed share rose for an index year'"),
    _found("manifest_health", "chk_manifest", "'a published year has no manifest or still reads {year}-all.parquet'"),
]
query("audit_full", "\nUNION ALL\n".join(_FULL), ("filings", "receipts"))(
    lambda k: I.audit(k.spark, NOW, k.filings, k.trades, k.events, k.indexed, k.receipts, shards(k), _previous(k)).withColumn("examples", F.array_join("examples", ";"))
)
query(
    "alert_lines",
    """
    WITH v AS (SELECT 'duplicate (chamber, docId, rowIndex)' AS m, chamber || ':' || doc_id || ':' || row_index || ' x' || count(*) AS example FROM trades GROUP BY chamber, doc_id, row_index HAVING count(*) > 1),
    e AS (SELECT example, row_number() OVER (ORDER BY example) AS p FROM v)
    SELECT 'duplicate_trade_key' AS "check", 0 AS position, 'duplicate_trade_key (' || count(*) || '): ' || min(m) AS line FROM v HAVING count(*) > 0
    UNION ALL SELECT 'duplicate_trade_key', cast(p AS int), '  ' || example FROM e WHERE p <= 20
    """,
    ("trades",),
)(lambda k: I.alert_lines(I.finding(I.duplicate_trades(k.trades), "duplicate_trade_key", "duplicate (chamber, docId, rowIndex)")))


def _records(k: Lake):
    """Run records as JSON text; some of them broken."""
    e = F.col("event_id")
    good = F.format_string('{"integrity": {"passed": %s, "failedShareByYear": {"%d": 0.%d}}}', F.when(e % 2 == 0, "true").otherwise("false"), F.lit(2000) + e % 30, e % 90 + 10)
    return k.stream.select(F.col("event_id").alias("run_id"), F.when(e % 7 == 0, "oops").when(e % 7 == 1, "{}").otherwise(good).alias("record"))


query(
    "previous_integrity",
    """
    SELECT event_id AS run_id, event_id % 7 >= 2 AND event_id % 2 = 1 AS failed,
      CASE WHEN event_id % 7 >= 2 THEN cast(2000 + event_id % 30 AS int) END AS year,
      CASE WHEN event_id % 7 >= 2 THEN round((event_id % 90 + 10) / 100.0E0, 6) END AS share
    FROM stream
    """,
    ("stream",),
)(lambda k: I.previous_state(_records(k)).select("run_id", "failed", F.explode_outer("shares").alias("year", "share")).withColumn("share", F.round("share", 6)))
query(
    "recovered",
    "SELECT event_id AS run_id, event_id % 7 >= 2 AND event_id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM trades WHERE transaction_date > filing_date) AS send FROM stream",
    ("stream", "trades"),
)(lambda k: I.recovered(I.finding(I.dated_after_filing(k.trades), "dated_after_filing", "transactionDate after filingDate"), I.previous_state(_records(k))))
