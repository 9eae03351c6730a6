"""Queries of sources, sinks, resume and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerspark.operators import resume as R
from ledgerspark.operators import store as ST
from ledgerspark.schema import ENUMS
from ledgerspark.scratch import shared_path
from ledgerspark.sources import readers as RD
from ledgerspark.operators.normalize import senate_title
from ledgerspark.streaming import flows as FL

from .building import FOLD_SQL, said
from .registry import Lake, query

_DAY = "strftime(filing_date, '%m/%d/%Y')"


def _index_file(k: Lake) -> str:
    """An index as tab-separated text, columns in another order and case, with blanks around cells."""
    path = shared_path(k.spark, "index")
    f = k.filings
    cells = f.select(
        F.col("doc_id").alias("DocID"), F.lit("Hon.").alias("Prefix"), F.concat(F.lit(" "), "filer_last").alias("LAST"), F.col("filer_first").alias("First"), F.lit(None).cast("string").alias("Suffix"),
        F.when(F.col("doc_id").cast("bigint") % 4 == 0, "p").otherwise("C").alias("FilingType"), F.col("state_district").alias("StateDst"), F.year("filing_date").cast("string").alias("Year"), F.date_format("filing_date", "M/d/yyyy").alias("FilingDate"),
    )
    cells.write.csv(path, sep="\t", header=True, quote="")
    return path


query("src_house_index", "SELECT doc_id, filer_last AS last, 'P' AS filing_type, cast(year(filing_date) AS varchar) AS year FROM filings WHERE cast(doc_id AS bigint) % 4 = 0", ("filings",))(
    lambda k: RD.transaction_reports(RD.read_house_index(k.spark, _index_file(k), 2024)).select("doc_id", "last", "filing_type", "year")
)
query(
    "source_urls",
    "SELECT doc_id, 'https://disclosures-clerk.house.gov/public_disc/financial-pdfs/' || year(filing_date) || 'FD.zip' AS index_url, 'https://disclosures-clerk.house.gov/public_disc/ptr-pdfs/' || year(filing_date) || '/' || doc_id || '.pdf' AS report_url FROM filings WHERE chamber = 'house'",
    ("filings",),
)(lambda k: k.filings.where("chamber = 'house'").select("doc_id", RD.index_zip_url(F.year("filing_date")).alias("index_url"), RD.report_pdf_url(F.year("filing_date"), F.col("doc_id")).alias("report_url")))
_ID = "'0000' || substr(md5(doc_id), 1, 4) || '-' || substr(md5(doc_id), 5, 27)"
query(
    "src_senate_path",
    f"SELECT doc_id, CASE cast(doc_id AS bigint) % 3 WHEN 0 THEN 'electronic' WHEN 1 THEN 'paper' END AS kind, CASE WHEN cast(doc_id AS bigint) % 3 < 2 THEN {_ID} END AS id FROM filings",
    ("filings",),
)(
    lambda k: k.filings.select(
        "doc_id",
        RD.senate_path(F.concat(F.lit("/search/view/"), F.get(F.array(F.lit("PTR"), F.lit("paper"), F.lit("annual")), (F.col("doc_id").cast("bigint") % 3).cast("int")), F.lit("/0000"), F.substring(F.md5("doc_id"), 1, 4), F.lit("-"), F.substring(F.md5("doc_id"), 5, 27), F.lit("/"))).alias("p"),
    ).select("doc_id", "p.kind", "p.id")
)
query(
    "src_senate_title",
    "SELECT doc_id, CASE WHEN cast(doc_id AS bigint) % 4 < 3 THEN cast(filing_date AS varchar) END AS day, CASE cast(doc_id AS bigint) % 4 WHEN 0 THEN 'numbered' WHEN 1 THEN 'unnumbered' WHEN 2 THEN 'none' END AS amendment FROM filings",
    ("filings",),
)(
    lambda k: k.filings.select(
        "doc_id",
        senate_title(
            F.concat(F.when(F.col("doc_id").cast("bigint") % 4 == 3, "Report for ").otherwise("Periodic Transaction Report for "), F.date_format("filing_date", "MM/dd/yyyy"),
                     F.when(F.col("doc_id").cast("bigint") % 4 == 0, " (Amendment 2)").when(F.col("doc_id").cast("bigint") % 4 == 1, " (Amendment)").otherwise(""))
        ).alias("t"),
    ).select("doc_id", F.col("t.report_date").cast("string").alias("day"), "t.amendment")
)


def _report_pages(k: Lake):
    """Report pages in HTML from trades of some documents."""
    th = "".join(f"<th>{h}</th>" for h in RD.TRANSACTION_HEADERS)
    row = F.concat(
        F.lit("<tr><td>"), F.col("l_linenumber").cast("string"), F.lit("</td><td>"), F.coalesce(F.date_format("transaction_date", "MM/dd/yyyy"), F.lit("")), F.lit("</td><td>Self</td><td>"), F.coalesce("printed_ticker", F.lit("--")),
        F.lit("</td><td><b>"), "asset_description", F.lit("</b> &amp;\n Co</td><td>Stock</td><td>Purchase</td><td>$1,001 - $15,000</td><td> "), F.coalesce("comment", F.lit("--")), F.lit("</td></tr>"),
    )
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", row.alias("r"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(order)), lambda x: x["r"]), "")
    head = F.when(F.col("doc_id").cast("bigint") % 10 == 0, "<tr><th>Transaction Date</th><th>Amount</th></tr>").otherwise(f"<tr>{th}</tr>")
    return k.trades.where("chamber = 'senate'").groupBy("doc_id").agg(body.alias("b")).select("doc_id", F.concat(F.lit("<html><table><tr><td>x</td></tr></table><table>"), head, "b", F.lit("</table></html>")).alias("html"))


query(
    "html_extract",
    """
    SELECT doc_id, cast(NULL AS varchar) AS error, cast(l_linenumber AS int) AS row_number, printed_ticker AS ticker, asset_description || ' & Co' AS asset_name, comment FROM trades WHERE chamber = 'senate' AND cast(doc_id AS bigint) % 10 > 0
    UNION ALL SELECT DISTINCT doc_id, 'unknown headers', cast(NULL AS int), NULL, NULL, NULL FROM trades WHERE chamber = 'senate' AND cast(doc_id AS bigint) % 10 = 0
    """,
    ("trades",),
)(lambda k: RD.senate_transactions(_report_pages(k)).select("doc_id", "error", "row_number", "ticker", "asset_name", "comment"))
query("doc_read_path", "SELECT filing_id, page, CASE WHEN length(regexp_replace(coalesce(text, ''), '[^A-Za-z]', '', 'g')) >= 80 THEN 'text_layer' ELSE 'page_image_ocr' END AS path FROM ocr", ("ocr",))(
    lambda k: k.ocr.select("filing_id", "page", RD.read_path(F.col("text")).alias("path"))
)


def _manifest(k: Lake):
    """A manifest document over the years of the filings."""
    y = F.col("year")
    sha = F.sha2(y.cast("string"), 256)
    f = F.struct(F.format_string("data/political_filings/%d/a.parquet", y).alias("path"), (y * 10).cast("long").alias("size"), sha.alias("sha256"), y.cast("long").alias("rows"))
    g = F.struct(F.format_string("data/political_filings/%d/b.parquet", y).alias("path"), (y * 20).cast("long").alias("size"), sha.alias("sha256"), F.lit(1).cast("long").alias("rows"))
    years = k.filings.select(F.year("filing_date").alias("year")).distinct().groupBy().agg(F.array_sort(F.collect_list(F.struct(y.alias("year"), F.array(f, g).alias("files")))).alias("manifests"))
    t = F.struct(F.lit(1).cast("long").alias("rows"), F.transform("manifests", lambda m: m["year"]).alias("years"), F.col("manifests"))
    return years.select(F.to_json(F.struct(F.create_map(F.lit("political_filings"), t, F.lit("political_trades"), t).alias("tables"))).alias("body"))


_FILES = """
    WITH y AS (SELECT DISTINCT cast(year(filing_date) AS int) AS year FROM filings), t AS (SELECT unnest(['political_filings', 'political_trades']) AS "table"),
    f AS (SELECT "table", year, 'data/political_filings/' || year || '/a.parquet' AS path, cast(year * 10 AS bigint) AS size, sha256(cast(year AS varchar)) AS sha256, cast(year AS bigint) AS rows FROM y, t
          UNION ALL SELECT "table", year, 'data/political_filings/' || year || '/b.parquet', year * 20, sha256(cast(year AS varchar)), 1 FROM y, t)
"""
query("manifest_files", _FILES + " SELECT * FROM f", ("filings",))(lambda k: RD.manifest_files(_manifest(k)))
query("manifest_prune", _FILES + " SELECT * FROM f WHERE \"table\" = 'political_trades' AND year = 1996", ("filings",))(lambda k: RD.prune(RD.manifest_files(_manifest(k)), "political_trades", 1996))
query("disk_plan", _FILES + " SELECT count(*) AS files, cast(sum(size) AS bigint) AS bytes, cast(greatest(268435456, sum(size) * 32) AS bigint) AS database_bytes FROM f", ("filings",))(lambda k: ST.disk_plan(RD.manifest_files(_manifest(k))))
query(
    "manifest_verify",
    _FILES + " SELECT path, CASE WHEN year % 4 = 0 THEN 'missing' WHEN path LIKE '%b.parquet' THEN 'size' WHEN year % 4 = 1 THEN 'digest' ELSE 'ok' END AS state FROM f WHERE \"table\" = 'political_filings'",
    ("filings",),
)(
    lambda k: RD.verify(
        # Contents as long as the manifest's year; sizes there are replaced to fit or not.
        RD.prune(RD.manifest_files(_manifest(k)), "political_filings").withColumn("size", F.when(F.col("path").endswith("b.parquet"), 9).otherwise(F.when(F.col("year") % 4 == 1, 5).otherwise(4)).cast("long")),
        RD.prune(RD.manifest_files(_manifest(k)), "political_filings").where("year % 4 > 0").select("path", F.when(F.col("year") % 4 == 1, F.concat(F.col("year").cast("string"), F.lit("x"))).otherwise(F.col("year").cast("string")).cast("binary").alias("content")),
    )
)
query(
    "decode_guard",
    "SELECT doc_id, CASE WHEN cast(doc_id AS bigint) % 5 = 0 THEN 'filer_key is missing' WHEN cast(doc_id AS bigint) % 5 = 1 THEN 'extraction_status is odd' END AS violation FROM filings",
    ("filings",),
)(
    lambda k: RD.decode_guard(
        k.filings.withColumn("filer_key", F.when(F.col("doc_id").cast("bigint") % 5 > 0, F.col("filer_key"))).withColumn("extraction_status", F.when(F.col("doc_id").cast("bigint") % 5 == 1, "odd").otherwise(F.col("extraction_status"))),
        ENUMS, ["filer_key", "identity_source"],
    ).select("doc_id", "violation")
)


def _stored(k: Lake) -> ST.LakeStore:
    store = ST.LakeStore(k.spark, shared_path(k.spark, "lake"))
    store.publish({"political_filings": k.filings, "political_trades": k.trades.select(*_TRADES)})
    return store


_TRADES = [
    "chamber", "doc_id", "row_index", "source_transaction_id", "filer_first", "filer_last", "owner", "action", "partial_sale", "transaction_date", "notification_date", "filing_date", "available_at", "asset_description",
    "printed_ticker", "resolved_ticker", "resolution_status", "asset_type_code", "asset_type_label", "amount_low", "amount_high", "comment", "filer_key", "member_id", "display_name", "identity_source",
]
_COUNTS = "SELECT 'political_filings' AS name, cast(year(available_at) AS int) AS year, count(*) AS n FROM filings GROUP BY 2 UNION ALL SELECT 'political_trades', cast(year(available_at) AS int), count(*) FROM trades GROUP BY 2"


def _by_year(store: ST.LakeStore, years=None):
    parts = [store.read(t, years).groupBy(F.lit(t).alias("name"), F.year("available_at").alias("year")).agg(F.count(F.lit(1)).alias("n")) for t in ("political_filings", "political_trades")]
    return parts[0].unionByName(parts[1])


query("sink_snapshot", _COUNTS, ("trades",))(lambda k: _by_year(_stored(k)))
query("lake_snapshot", f"SELECT * FROM ({_COUNTS}) c WHERE year IN (1995, 1997)", ("trades",))(lambda k: _by_year(_stored(k), [1995, 1997]))
query("manifest_scan", "SELECT doc_id, chamber, extraction_status FROM filings WHERE year(available_at) = 1996 AND chamber = 'house'", ("filings",))(
    lambda k: _stored(k).read("political_filings", [1996]).where("chamber = 'house'").select("doc_id", "chamber", "extraction_status")
)


_PICK = "filer_key = 'member:M7' and cast(doc_id as bigint) % 2 = 0"


def _upserted(k: Lake) -> ST.LakeStore:
    """Documents of one filer re-filed as extracted, their trades all purchases, over events of one in five filers."""
    store = _stored(k)
    for which, status, action in (("cast(substring(member_id, 2, 9) as int) % 5 = 2", F.col("extraction_status"), F.col("action")), (_PICK, F.lit("ok"), F.lit("purchase"))):
        filings, trades = (store.read(t).where(which) for t in ("political_filings", "political_trades"))
        store.upsert(filings.withColumn("extraction_status", status), trades.withColumn("action", action))
    return store


def _upsert(k: Lake):
    store = _upserted(k)
    f = store.read("political_filings").groupBy(F.lit("filings").alias("name"), F.col("extraction_status").alias("what")).agg(F.count(F.lit(1)).alias("n"))
    t = store.read("political_trades").groupBy(F.lit("trades").alias("name"), F.col("action").alias("what")).agg(F.count(F.lit(1)).alias("n"))
    return f.unionByName(t)


query(
    "upsert_filings",
    """
    SELECT 'filings' AS name, CASE WHEN filer_key = 'member:M7' AND cast(doc_id AS bigint) % 2 = 0 THEN 'ok' ELSE extraction_status END AS what, count(*) AS n FROM filings GROUP BY 2
    UNION ALL SELECT 'trades', CASE WHEN filer_key = 'member:M7' AND cast(doc_id AS bigint) % 2 = 0 THEN 'purchase' ELSE action END, count(*) FROM trades GROUP BY 2
    """,
    ("trades",),
)(_upsert)
_CONTENT = ["chamber", "doc_id", "row_index", "action", "filer_key", "asset_description", "amount_low"]
query(
    "upsert_trades",
    f"SELECT chamber, doc_id, row_index, CASE WHEN {_PICK} THEN 'purchase' ELSE action END AS action, filer_key, asset_description, amount_low FROM trades",
    ("trades",),
)(lambda k: _upserted(k).read("political_trades").select(*_CONTENT))
query(
    "upsert_events",
    f"""WITH refiled AS (SELECT * EXCLUDE (action), CASE WHEN {_PICK} THEN 'purchase' ELSE action END AS action FROM trades WHERE cast(substring(member_id, 2, 9) AS int) % 5 = 2),
    {FOLD_SQL.strip().replace("FROM trades", "FROM refiled").replace("'doc/' || b.doc_id", "cast(NULL AS varchar)")}""",
    ("trades",), recursive=True,
)(lambda k: said(_upserted(k).read("political_trade_events")))
query("publish_years", "SELECT DISTINCT cast(year(available_at) AS int) AS year FROM filings WHERE cast(doc_id AS bigint) % 3 = 0 UNION SELECT DISTINCT cast(year(available_at) AS int) FROM filings WHERE cast(doc_id AS bigint) % 5 = 0", ("filings",))(
    lambda k: ST.touched_years(k.filings.where("cast(doc_id as bigint) % 3 = 0"), k.filings.where("cast(doc_id as bigint) % 5 = 0"))
)

query("sync_queue", "SELECT i.chamber, i.doc_id FROM indexed i WHERE NOT EXISTS (SELECT 1 FROM filings f WHERE f.chamber = i.chamber AND f.doc_id = i.doc_id AND extraction_status = 'ok') ORDER BY 1, 2 LIMIT 50", ("indexed", "filings"))(
    lambda k: R.sync_queue(k.indexed, k.filings, 50)
)
_SHARD = "cast(cast('0x' || substr(sha256(identity), 1, 8) AS bigint) % 5 AS int)"
_IDENT = "i AS (SELECT cast(event_id AS varchar) AS identity FROM stream), r AS (SELECT identity FROM i WHERE cast(identity AS bigint) % 3 = 0)"


def _ids(k: Lake):
    return k.stream.select(F.col("event_id").cast("string").alias("identity"))


def _done(k: Lake):
    return _ids(k).where("cast(identity as bigint) % 3 = 0")


query("receipts_pending", f"WITH {_IDENT} SELECT identity FROM i WHERE {_SHARD} = 2 AND identity NOT IN (SELECT identity FROM r)", ("stream",))(lambda k: R.pending(_ids(k), _done(k), 2, 5))
query("receipts_repair", f"WITH {_IDENT} SELECT identity FROM r WHERE length(identity) <> 3", ("stream",))(lambda k: R.repair(_done(k), F.length("identity") == 3))
query("progress_by_shard", f"WITH {_IDENT} SELECT {_SHARD} AS shard, count(*) AS n FROM r GROUP BY 1", ("stream",))(lambda k: R.progress(_done(k), 5))
query(
    "progress_delta",
    f"WITH {_IDENT}, c AS (SELECT count(*) FILTER (WHERE cast(identity AS bigint) % 2 = 0) AS a, count(*) AS b FROM r) SELECT b - a AS added, round((b - a) / 10.0E0, 4) AS per_minute, greatest(100000 - b, 0) AS remaining, round(greatest(100000 - b, 0) / ((b - a) / 10.0E0), 4) AS minutes_left FROM c",
    ("stream",),
)(lambda k: R.progress_delta(R.progress(_done(k).where("cast(identity as bigint) % 2 = 0"), 5), R.progress(_done(k), 5), 10, 100000))


def _windows(k: Lake):
    """The events table as a stream, run until it is drained; windows that the watermark leaves open are not written."""
    k.spark.conf.set("spark.sql.session.timeZone", "UTC")
    out, state = shared_path(k.spark, "windows"), shared_path(k.spark, "windows-state")
    FL.run_available(FL.counts_by_window(FL.open_stream(k.spark, k.sf_dir, "events.parquet")), out, state)
    return k.spark.read.parquet(out).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


query(
    "stream_windows",
    """
    WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS s, event_type, count(*) AS n, round(sum(value), 4) AS total FROM stream GROUP BY 1, 2)
    SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, n, total FROM w WHERE s + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTES FROM stream)
    """,
    ("stream",),
)(_windows)
