"""Queries of user analytics and of the scalar rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.functions import scalars as S
from ledgerspark.operators import analytics as A

from .registry import query

_NOW = "superseded_at IS NULL"
query("current_events", f"SELECT event_id, version, ticker, action FROM events WHERE {_NOW}", ("events",))(lambda k: A.current(k.events).select("event_id", "version", "ticker", "action"))
query(
    "as_of_events",
    "SELECT event_id, version FROM events WHERE available_at <= TIMESTAMP '1998-06-01' AND (superseded_at IS NULL OR superseded_at > TIMESTAMP '1998-06-01')",
    ("events",),
)(lambda k: A.as_of(k.events, F.lit("1998-06-01").cast("timestamp_ntz")).select("event_id", "version"))
query(
    "recent_trades",
    f"SELECT event_id, version, ticker FROM events WHERE {_NOW} ORDER BY first_available_at DESC, event_id, version LIMIT 20",
    ("events",),
)(lambda k: A.recent(k.events, 20).select("event_id", "version", "ticker"))
query(
    "top_buyers",
    f"SELECT filer_key, count(*) AS purchases FROM events WHERE {_NOW} AND action = 'purchase' AND first_available_at >= TIMESTAMP '1995-01-01' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    ("events",),
)(lambda k: A.top_buyers(k.events, F.lit("1995-01-01").cast("timestamp_ntz"), 10))
query(
    "top_tickers",
    f"SELECT ticker, count(DISTINCT filer_key) AS distinct_members, count(*) AS purchases FROM events WHERE {_NOW} AND action = 'purchase' AND ticker IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 3 DESC, 1 LIMIT 20",
    ("events",),
)(lambda k: A.top_tickers(k.events, 20))
query(
    "disclosure_lag",
    f"SELECT chamber, round(avg((epoch_us(first_available_at) - epoch_us(cast(transaction_date AS timestamp))) / 86400e6), 1) AS days, count(*) AS rows FROM events WHERE {_NOW} AND transaction_date IS NOT NULL GROUP BY 1",
    ("events",),
)(lambda k: A.disclosure_lag(k.events))
query("filing_rows", "SELECT chamber, doc_id, row_index, asset_description, action FROM trades WHERE doc_id = '77' ORDER BY row_index", ("trades",))(
    lambda k: A.filing_rows(k.trades, "77").select("chamber", "doc_id", "row_index", "asset_description", "action")
)
query(
    "status_counts",
    """
    SELECT 'filings' AS name, count(*) AS n FROM filings UNION ALL SELECT 'failed_filings', count(*) FROM filings WHERE extraction_status = 'failed'
    UNION ALL SELECT 'members', count(DISTINCT member_id) FROM filings UNION ALL SELECT 'unresolved_filings', count(*) FROM filings WHERE identity_source = 'unresolved'
    UNION ALL SELECT 'trades', count(*) FROM trades UNION ALL SELECT 'events', count(*) FROM events
    """,
    ("events",),
)(lambda k: A.status_counts(k.filings, k.trades, k.events))

# Scalar rules over columns of the views.
query(
    "parse_slash_date",
    """
    WITH t AS (SELECT doc_id, CASE cast(doc_id AS bigint) % 5 WHEN 0 THEN '  ' WHEN 1 THEN '2/30/' || year(filing_date) WHEN 2 THEN strftime(filing_date, '%m/%d/%y') ELSE ' ' || month(filing_date) || '/' || day(filing_date) || '/' || year(filing_date) END AS printed FROM filings)
    SELECT doc_id, CASE WHEN cast(doc_id AS bigint) % 5 >= 3 THEN cast(try_strptime(trim(printed), '%m/%d/%Y') AS date) END AS parsed FROM t
    """,
    ("filings",),
)(
    lambda k: k.filings.select(
        "doc_id",
        S.parse_slash_date(
            F.when(F.col("doc_id").cast("bigint") % 5 == 0, "  ")
            .when(F.col("doc_id").cast("bigint") % 5 == 1, F.concat(F.lit("2/30/"), F.year("filing_date").cast("string")))
            .when(F.col("doc_id").cast("bigint") % 5 == 2, F.date_format("filing_date", "MM/dd/yy"))
            .otherwise(F.concat(F.lit(" "), F.date_format("filing_date", "M/d/yyyy")))
        ).alias("parsed"),
    )
)
query(
    "available_at",
    "SELECT doc_id, epoch_ms(((cast(filing_date AS timestamp) + INTERVAL 86399999 MILLISECONDS) AT TIME ZONE 'America/New_York')) AS millis FROM filings",
    ("filings",),
)(lambda k: (S.utc(k.spark), k.filings.select("doc_id", F.unix_millis(S.available_at(F.col("filing_date"))).alias("millis")))[1])
_BANDS = " ".join(f"WHEN '{n}' THEN {{}}" for n, _, _ in S.AMOUNT_BANDS)
_LABEL = "(['" + "','".join([n for n, *_ in S.AMOUNT_BANDS] + [S.EXACT_AMOUNT, S.UNMARKED]) + "'])"


def _label(expr):
    return F.get(F.array(*[F.lit(n) for n, *_ in S.AMOUNT_BANDS], F.lit(S.EXACT_AMOUNT), F.lit(S.UNMARKED)), expr)


query(
    "amount_bounds",
    f"""
    WITH t AS (SELECT l_orderkey, l_linenumber, l_quantity, {_LABEL}[cast(1 + l_partkey % 13 AS int)] AS label FROM trades)
    SELECT l_orderkey, l_linenumber, label, CASE WHEN label = 'Exact amount' THEN l_quantity ELSE CASE label {_BANDS.format(*[low for _, low, _ in S.AMOUNT_BANDS])} END END AS low,
      CASE WHEN label = 'Exact amount' THEN l_quantity ELSE CASE label {_BANDS.format(*[high or 'NULL' for _, _, high in S.AMOUNT_BANDS])} END END AS high FROM t
    """,
    ("trades",),
)(
    lambda k: k.trades.select("l_orderkey", "l_linenumber", "l_quantity", _label((F.col("l_partkey") % 13).cast("int")).alias("label"))
    .select("l_orderkey", "l_linenumber", "label", S.amount_bounds(F.col("label"), F.col("l_quantity")).alias("b"))
    .select("l_orderkey", "l_linenumber", "label", "b.low", "b.high")
)
_NAME = "CASE WHEN l_partkey % 5 = 0 THEN 'ABC' || (l_partkey % 7) || ' - Common' WHEN l_partkey % 5 = 1 THEN 'BRK.B-A - Class (Exchanged)' WHEN l_partkey % 5 = 2 THEN 'Bond of 2030' WHEN l_partkey % 5 = 3 THEN 'TOOLONGX - X' ELSE 'X.Y - Z' END"
query(
    "asset_ticker",
    f"""
    WITH t AS (SELECT *, {_NAME} AS name FROM trades)
    SELECT l_orderkey, l_linenumber, name, CASE WHEN asset_type_label IN ('Stock', 'Other', 'Cryptocurrency') AND name NOT LIKE '%(Exchanged)%' THEN nullif(regexp_extract(name, '^([A-Z][A-Z0-9.]{{0,5}}(?:-[A-Z])?) - \\S', 1), '') END AS found FROM t
    """,
    ("trades",),
)(
    lambda k: k.trades.withColumn("name", F.expr(_NAME)).select("l_orderkey", "l_linenumber", "name", S.asset_ticker(F.col("name"), F.col("asset_type_label")).alias("found"))
)
query(
    "ticker_status",
    "SELECT l_orderkey, l_linenumber, cast(NULL AS varchar) AS resolved_ticker, CASE WHEN printed_ticker IS NULL THEN 'unresolved' ELSE 'printed' END AS status, CASE WHEN printed_ticker IS NULL THEN 'no ticker printed' END AS reason FROM trades",
    ("trades",),
)(lambda k: k.trades.select("l_orderkey", "l_linenumber", S.ticker_status(F.col("printed_ticker")).alias("t")).select("l_orderkey", "l_linenumber", "t.*"))
_ISO = "CASE cast(doc_id AS bigint) % 4 WHEN 0 THEN '2023-02-30' WHEN 1 THEN '2024-02-29' WHEN 2 THEN '2024-2-9' ELSE cast(filing_date AS string) || ' ' END"
query("valid_iso_date", "SELECT doc_id, cast(doc_id AS bigint) % 4 = 1 AS valid FROM filings", ("filings",))(lambda k: k.filings.select("doc_id", S.is_iso_date(F.expr(_ISO)).alias("valid")))
query("shard_assign", "SELECT doc_id, cast(cast('0x' || substr(sha256(doc_id), 1, 8) AS bigint) % 7 AS int) AS shard FROM filings", ("filings",))(lambda k: k.filings.select("doc_id", S.shard_index(F.col("doc_id"), 7).alias("shard")))
query(
    "seat_of",
    """
    SELECT doc_id, CASE chamber WHEN 'senate' THEN 'sen' ELSE 'rep' END AS type, CASE WHEN chamber <> 'senate' THEN upper(substr(state_district, 1, 2)) END AS state,
      CASE WHEN chamber <> 'senate' THEN try_cast(substr(state_district, 3) AS int) END AS district FROM filings
    """,
    ("filings",),
)(lambda k: k.filings.select("doc_id", S.seat_of(F.col("chamber"), F.col("state_district")).alias("s")).select("doc_id", "s.*"))
query(
    "display_name",
    "SELECT doc_id, filer_first || ' Last' || (regexp_extract(filer_last, '[0-9]+')) || ' Jr.' AS shown FROM filings",
    ("filings",),
)(lambda k: k.filings.select("doc_id", S.display_name(F.concat(F.lit("  "), F.upper("filer_first"), F.lit(" ")), F.concat("filer_last", F.lit(" ,  JR."))).alias("shown")))
query("blank_to_null", "SELECT event_id, CASE WHEN event_id % 3 > 0 THEN event_type END AS kept FROM stream", ("stream",))(
    lambda k: k.stream.select("event_id", S.blank_to_null(F.when(F.col("event_id") % 3 == 0, F.lit("  \t")).otherwise(F.concat(F.lit("  "), "event_type", F.lit("\n")))).alias("kept"))
)
query("content_address", "SELECT doc_id, sha256(chamber || chr(0) || doc_id || chr(0)) AS hash, 'raw/' || substr(sha256(doc_id), 1, 2) || '/' || sha256(doc_id) || '.pdf' AS path FROM filings", ("filings",))(
    lambda k: k.filings.select("doc_id", S.request_hash(F.col("chamber"), F.col("doc_id")).alias("hash"), S.content_path(F.sha2("doc_id", 256), F.lit(".pdf")).alias("path"))
)
_LETTERS = "klnopqtuvw"  # digits of a document number as letters
query("name_tokens", f"SELECT doc_id, 'munoz ' || translate(doc_id, '0123456789', '{_LETTERS}') || ' x-y' AS tokens FROM filings", ("filings",))(
    lambda k: k.filings.select(
        "doc_id", F.array_join(S.name_tokens(F.concat(F.lit("Hon. MUÑOZ, "), F.translate("doc_id", "0123456789", _LETTERS), F.lit(" (III) X-y"))), " ").alias("tokens")
    )
)
query("page_dpi", "SELECT event_id, cast(round(greatest(800 + event_id % 900, 1100 + event_id % 700) / 11.0) AS int) AS dpi FROM stream", ("stream",))(
    lambda k: k.stream.select("event_id", S.page_dpi(800 + F.col("event_id") % 900, 1100 + F.col("event_id") % 700).alias("dpi"))
)
_ROLES_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN owner <> 'not_indicated' THEN owner END AS owner, CASE WHEN action <> 'unmarked' THEN action END AS action,
      CASE WHEN chamber = 'senate' OR partial_sale THEN partial_sale END AS partial_sale, cast(transaction_date AS varchar) AS transaction_date, upper(coalesce(printed_ticker, resolved_ticker)) AS ticker,
      asset_type_code, asset_type_label, CASE WHEN amount_low IS NOT NULL OR amount_high IS NOT NULL THEN coalesce(cast(amount_low AS varchar), 'null') || '-' || coalesce(cast(amount_high AS varchar), 'null') END AS amount FROM trades"""
query("event_roles", _ROLES_SQL, ("trades",))(lambda k: k.trades.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", S.event_roles().alias("r")).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "r.*"))
_PAIR = "PARTITION BY doc_id ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice"
query(
    "role_conflicts",
    f"""
    WITH r AS ({_ROLES_SQL.replace("SELECT l_orderkey,", "SELECT doc_id, l_extendedprice, l_orderkey,")}),
    p AS (SELECT *, {", ".join(f"lag({c}) OVER ({_PAIR}) AS p_{c}" for c in S.ROLES)}, row_number() OVER ({_PAIR}) AS n FROM r)
    SELECT doc_id, cast(n AS int) AS n, concat_ws(',', {", ".join(f"CASE WHEN {c} <> p_{c} THEN '{c}' END" for c in S.ROLES)}) AS conflicts FROM p WHERE n > 1
    """,
    ("trades",),
)(
    lambda k: k.trades.withColumn("r", S.event_roles())
    .selectExpr("doc_id", "r", f"lag(r) OVER ({_PAIR}) AS p", f"row_number() OVER ({_PAIR}) AS n").where("n > 1")
    .select("doc_id", "n", F.array_join(S.role_conflicts(F.col("p"), F.col("r")), ",").alias("conflicts"))
)


def extracted(k):
    """Extraction rows with some broken ones, shaped from trades."""
    x = F.col("l_partkey")
    pick = lambda n, r, bad, good: F.when(x % n == r, bad).otherwise(good)
    return k.trades.select(
        "doc_id", "l_linenumber", "l_partkey", "l_suppkey", *(["row_number"] if "row_number" in k.trades.columns else []),
        pick(11, 0, F.lit("Q"), F.when(F.col("action") == "purchase", "P").when(F.col("action") == "sale", "S").when(F.col("action") == "unmarked", "unmarked").otherwise("E")).alias("transaction_type_code"),
        pick(17, 0, F.lit(" "), F.col("transaction_date").cast("string")).alias("transaction_date"),
        pick(19, 0, F.lit(None).cast("string"), F.col("asset_description")).alias("asset"),
        pick(23, 0, F.lit("unmarked"), F.lit("band")).alias("amount_bracket"),
        pick(29, 0, F.lit("lots"), F.lit("$1,001 - $15,000")).alias("amount_category"),
        pick(31, 0, F.lit(5.0), F.lit(None).cast("double")).alias("amount_exact"),
        pick(37, 0, F.lit("2024-13-01"), F.col("transaction_date").cast("string")).alias("transaction_date_iso"),
        pick(41, 0, F.lit("me"), F.col("owner")).alias("owner"),
        F.upper("printed_ticker").alias("ticker"), "asset_type_code", "source_transaction_id",
    )


_REASON = """CASE WHEN l_partkey % 11 = 0 THEN 'transaction_type_code Q is not one of P, S, E, unmarked' WHEN l_partkey % 17 = 0 THEN 'transaction_date   is neither a printed date nor null'
      WHEN l_partkey % 19 = 0 THEN 'asset is null' WHEN l_partkey % 29 = 0 THEN 'amount_category lots is not a legal value category' WHEN l_partkey % 23 = 0 THEN 'amount_bracket and amount_category disagree about being unmarked'
      WHEN l_partkey % 31 = 0 THEN 'amount_category does not match amount_exact' WHEN l_partkey % 37 = 0 THEN 'transaction_date_iso 2024-13-01 is not a calendar date' WHEN l_partkey % 41 = 0 THEN 'owner me is not a known owner' END"""
query("row_invalid_reason", f"SELECT doc_id, l_linenumber, l_partkey, l_suppkey, {_REASON} AS reason FROM trades", ("trades",))(
    lambda k: extracted(k).select("doc_id", "l_linenumber", "l_partkey", "l_suppkey", S.row_invalid_reason().alias("reason"))
)
query("row_needs_review", "SELECT doc_id, l_linenumber, l_partkey, l_suppkey FROM trades WHERE action = 'unmarked' AND l_partkey % 11 <> 0", ("trades",))(
    lambda k: extracted(k).where(S.needs_review()).select("doc_id", "l_linenumber", "l_partkey", "l_suppkey")
)
query(
    "date_findings",
    """
    SELECT doc_id, l_linenumber, l_partkey, l_suppkey, unnest(list_filter([CASE WHEN transaction_date > filing_date THEN 'transaction after filing' END,
      CASE WHEN datediff('day', filing_date, notification_date) > 30 THEN 'notification long after filing' END, CASE WHEN datediff('day', notification_date, transaction_date) > 30 THEN 'transaction long after notification' END,
      CASE WHEN datediff('day', transaction_date, notification_date) > 365 THEN 'notification over a year after transaction' END], lambda x: x IS NOT NULL)) AS finding FROM trades
    """,
    ("trades",),
)(lambda k: k.trades.select("doc_id", "l_linenumber", "l_partkey", "l_suppkey", F.explode(S.date_findings(F.col("transaction_date"), F.col("notification_date"), F.col("filing_date"))).alias("finding")))
query(
    "date_sentences",
    """
    SELECT doc_id, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_partkey % 3 = 0 THEN 'the row labeled ' || l_linenumber || ', ' || (l_linenumber + 1) WHEN l_partkey % 3 = 1 THEN 'a row on page ' || l_linenumber || ' (' || asset_description || ')' ELSE 'a row' END AS which,
      unnest(list_filter([CASE WHEN transaction_date > filing_date THEN 'transaction date ' || transaction_date || ' is after the report was filed on ' || filing_date END,
      CASE WHEN datediff('day', filing_date, notification_date) > 30 THEN 'notification date ' || notification_date || ' is more than a month after the report was filed on ' || filing_date END,
      CASE WHEN datediff('day', notification_date, transaction_date) > 30 THEN 'transaction date ' || transaction_date || ' is more than a month after its notification date ' || notification_date END,
      CASE WHEN datediff('day', transaction_date, notification_date) > 365 THEN 'transaction date ' || transaction_date || ' is more than a year before its notification date ' || notification_date END], lambda x: x IS NOT NULL)) AS sentence FROM trades
    """,
    ("trades",),
)(
    lambda k: k.trades.select(
        "doc_id", "l_linenumber", "l_partkey", "l_suppkey",
        S.describe_row(
            F.when(F.col("l_partkey") % 3 == 0, F.array(F.col("l_linenumber").cast("int"), (F.col("l_linenumber") + 1).cast("int"))), F.when(F.col("l_partkey") % 3 == 1, F.col("l_linenumber")),
            F.when(F.col("l_partkey") % 3 == 1, F.concat(F.lit(" "), "asset_description")).otherwise(" "),
        ).alias("which"),
        F.explode(S.date_sentences(F.col("transaction_date"), F.col("notification_date"), F.col("filing_date"))).alias("sentence"),
    )
)
