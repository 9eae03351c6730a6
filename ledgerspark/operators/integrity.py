"""Integrity checks of the lake: one DataFrame of findings for each.

Every check takes tables and returns one row per violation, ``example string``. A check
says nothing about rows whose tested column is null unless its text says so. finding()
folds violations to a count and the first examples without bringing them together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.schema import MEMBER_SOURCES

# Limits and messages of the audit.
EARLIEST = "1789-01-01"
FRESHNESS_DAYS = 4
EXAMPLES = 20
CONTRIBUTOR = r"\A([^:]+):(\d+)\z"
#: A JSON list of entries that are valid and need no unescaping.
PLAIN_CONTRIBUTORS = r'\A\["[A-Za-z0-9-]+:[0-9]{1,9}"(?:,"[A-Za-z0-9-]+:[0-9]{1,9}")*\]\z'
YEAR_ALL = r"\A(.+)/(\d{4})-all\.parquet\z"

FINDING = "check string, severity string, message string, count long, examples array<string>"


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]).alias("example")


def _key(chamber: str = "chamber", doc: str = "doc_id") -> Column:
    return F.concat_ws(":", chamber, doc)


def _row(*more: Column | str) -> Column:
    return _text(F.col("doc_id"), "#", F.col("row_index"), *more)


def ok_filings(filings: DataFrame) -> DataFrame:
    """Keys of extracted filings."""
    return filings.where("extraction_status = 'ok'").select("chamber", "doc_id").distinct()


def missing_indexed(indexed: DataFrame, filings: DataFrame) -> DataFrame:
    """Index entries without a filing; repeated entries are reported each."""
    return indexed.join(filings.select("chamber", "doc_id"), ["chamber", "doc_id"], "left_anti").select(_text(_key()))


def parity_gaps(receipts: DataFrame, filings: DataFrame) -> DataFrame:
    """``side, example``: receipts without a filing and filings without a receipt, each key once."""
    r, f = (x.select("chamber", "doc_id").distinct() for x in (receipts, filings))
    lost = r.join(f, ["chamber", "doc_id"], "left_anti").select(F.lit("filings").alias("side"), _text("receipt without row ", _key()))
    extra = f.join(r, ["chamber", "doc_id"], "left_anti").select(F.lit("receipts").alias("side"), _text("row without receipt ", _key()))
    return lost.unionByName(extra)


def orphan_trades(trades: DataFrame, filings: DataFrame) -> DataFrame:
    """Trades whose filing is missing or was not extracted."""
    return trades.join(ok_filings(filings), ["chamber", "doc_id"], "left_anti").select(_text(_key(), "#", F.col("row_index")))


def orphan_event_sources(events: DataFrame, filings: DataFrame) -> DataFrame:
    """Events whose source document is no extracted filing."""
    ok = ok_filings(filings).withColumnRenamed("doc_id", "source_doc_id")
    return events.join(ok, ["chamber", "source_doc_id"], "left_anti").select(_text(F.col("event_id"), " source=", _key("chamber", "source_doc_id")))


def contributors(events: DataFrame) -> DataFrame:
    """``event_id, error, ids``: the contributor list as strings, or why it is none.

    The first bad entry decides. Lists of plain entries are cut as text; in all others
    entries are examined as JSON values, so a number in the list is told from its text.
    """
    said = F.coalesce("contributor_row_ids", F.lit(""))
    plain = said.rlike(PLAIN_CONTRIBUTORS)
    entries = F.expr("try_variant_get(_json, '$', 'array<variant>')")
    shown = events.select("event_id", plain.alias("_plain"), said.alias("_said"), F.when(~plain, F.try_parse_json(said)).alias("_json")).withColumn("_list", entries)
    as_text = F.transform("_list", lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))
    raw = F.transform("_list", lambda v: F.to_json(v))
    bad = F.filter(F.arrays_zip(as_text.alias("t"), raw.alias("r")), lambda e: ~F.coalesce(e["t"].rlike(CONTRIBUTOR), F.lit(False)))
    named = shown.select("event_id", "_plain", "_said", "_json", "_list", as_text.alias("ids"), F.get(bad, F.lit(0))["r"].alias("_bad"))
    error = (
        F.when(F.col("_plain"), F.lit(None))
        .when(F.col("_json").isNull(), "not JSON")
        .when(~F.schema_of_variant("_json").startswith("ARRAY"), "not an array")
        .when(F.col("_bad").isNotNull(), F.concat(F.lit("invalid "), F.col("_bad")))
    )
    cut = F.split(F.expr("substring(_said, 3, length(_said) - 4)"), '","')
    return named.select("event_id", error.alias("error"), F.when(F.col("_plain"), cut).when(error.isNull(), F.col("ids")).alias("ids"))


def invalid_contributors(events: DataFrame, trades: DataFrame) -> DataFrame:
    """Contributor lists that do not parse, and entries without a trade. The chamber is not part of an entry."""
    parsed = contributors(events)
    broken = parsed.where("error is not null").select(_text(F.col("event_id"), ": ", F.col("error")))
    entries = parsed.where("error is null").select("event_id", F.explode("ids").alias("entry"))
    parts = entries.select("*", F.regexp_extract("entry", CONTRIBUTOR, 1).alias("doc_id"), F.try_to_number(F.regexp_extract("entry", CONTRIBUTOR, 2), F.lit("999999999")).cast("int").alias("row_index"))
    known = trades.select("doc_id", "row_index").distinct()
    lost = parts.join(known, ["doc_id", "row_index"], "left_anti").select(_text(F.col("event_id"), ": missing trade ", F.col("entry")))
    return broken.unionByName(lost)


def dated_after_filing(trades: DataFrame) -> DataFrame:
    """Transactions dated after their filing."""
    return trades.where("transaction_date > filing_date").select(_row(" ", F.col("transaction_date"), " > ", F.col("filing_date")))


def dates_out_of_range(trades: DataFrame, now: str) -> DataFrame:
    """Dates before EARLIEST or after the day that follows ``now``; one row for each field."""
    latest = F.date_add(F.to_date(F.lit(now)), 1)
    fields = [("transactionDate", "transaction_date"), ("notificationDate", "notification_date"), ("filingDate", "filing_date")]
    each = trades.select("doc_id", "row_index", F.explode(F.array(*[F.struct(F.lit(n).alias("f"), F.col(c).alias("d")) for n, c in fields])).alias("x")).select("doc_id", "row_index", "x.*")
    return each.where((F.col("d") < F.lit(EARLIEST).cast("date")) | (F.col("d") > latest)).select(_row(" ", F.col("f"), "=", F.date_format("d", "yyyy-MM-dd")))


def number_text(x: Column) -> Column:
    """A number without a trailing zero fraction; null as text."""
    return F.coalesce(F.regexp_replace(x.cast("string"), r"\.0\z", ""), F.lit("null"))


def invalid_amounts(trades: DataFrame) -> DataFrame:
    """Negative bounds, or a low above its high."""
    bad = "amount_low < 0 or amount_high < 0 or amount_low > amount_high"
    return trades.where(bad).select(_row(" ", number_text(F.col("amount_low")), "..", number_text(F.col("amount_high"))))


def duplicate_trades(trades: DataFrame) -> DataFrame:
    """Keys of more than one trade."""
    many = trades.groupBy("chamber", "doc_id", "row_index").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return many.select(_text(_key(), ":", F.col("row_index"), " x", F.col("n")))


def resolved_without_ticker(trades: DataFrame) -> DataFrame:
    return trades.where("resolution_status = 'resolved' and resolved_ticker is null").select(_row())


def failed_share(filings: DataFrame) -> DataFrame:
    """``year, share``: failed filings over all filings of a year."""
    failed = F.when(F.col("extraction_status") == "failed", 1.0).otherwise(0.0).cast("double")
    return filings.where("filing_date is not null").groupBy(F.year("filing_date").alias("year")).agg(F.avg(failed).alias("share"))


def regressions(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Years whose failed share rose. Both sides: ``year, share``."""
    j = current.join(previous.withColumnRenamed("share", "prior"), "year").where("share > prior")
    return j.select(F.format_string("%d: %.2f%% failed, was %.2f%%", "year", F.col("share") * 100, F.col("prior") * 100).alias("example"))


def freshness(filings: DataFrame, now: str) -> DataFrame:
    """``message, example`` when the newest filing is FRESHNESS_DAYS or more behind, or there is none."""
    lag = filings.agg(F.max("filing_date").alias("newest")).select(F.datediff(F.to_date(F.lit(now)), "newest").alias("lag"))
    return lag.where(F.col("lag").isNull() | (F.col("lag") >= FRESHNESS_DAYS)).select(
        F.when(F.col("lag").isNull(), "political_filings is empty").otherwise("newest filingDate is stale").alias("message"),
        F.when(F.col("lag").isNull(), "no filings").otherwise(F.concat(F.lit("newest filingDate is "), F.col("lag").cast("string"), F.lit(f" days behind {now}"))).alias("example"),
    )


def split_members(filings: DataFrame) -> DataFrame:
    """Members under more than one filer key."""
    keys = filings.where("member_id is not null and filer_key is not null").groupBy("member_id").agg(F.array_sort(F.collect_set("filer_key")).alias("keys"))
    return keys.where(F.size("keys") > 1).select(_text(F.col("member_id"), " ", F.array_join("keys", " | ")))


def unresolved_filers(filings: DataFrame) -> DataFrame:
    return filings.where("identity_source = 'unresolved'").select(F.trim(_text(_key(), " ", F.coalesce("filer_key", F.lit("")))).alias("example"))


def non_member_events(events: DataFrame) -> DataFrame:
    """Events of filers who are no members; an unknown source is not judged."""
    return events.where(F.col("identity_source").isNotNull() & ~F.col("identity_source").isin(MEMBER_SOURCES)).select(_text(F.col("event_id")))


def manifest_health(shards: DataFrame) -> DataFrame:
    """Years without shard keys, or that still read a whole-year file. ``shards``: ``prefix, year, keys``."""
    each = shards.select("prefix", "year", F.explode_outer(F.when(F.size("keys") > 0, F.col("keys"))).alias("key"))
    none = F.col("key").isNull()
    return each.where(none | F.col("key").rlike(YEAR_ALL)).select(_text(F.col("prefix"), "/", F.col("year"), F.when(none, ": no shard keys").otherwise(F.concat(F.lit(": reads "), F.col("key")))))


def finding(violations: DataFrame, check: str, message: Column | str, severity: str = "fail", above: int = 0) -> DataFrame:
    """One finding where there are more than ``above`` violations, none otherwise.

    The count is an aggregation; examples are the first EXAMPLES in order, which every
    task narrows down before they meet.
    """
    n = violations.agg(F.count(F.lit(1)).alias("count"))
    first = violations.orderBy("example").limit(EXAMPLES).agg(F.array_sort(F.collect_list("example")).alias("examples"))
    said = F.lit(message) if isinstance(message, str) else message
    one = F.lit(0).alias("_one")
    return (
        n.where(F.col("count") > above).withColumn("_one", one).join(first.withColumn("_one", one), "_one")
        .select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), said.alias("message"), "count", "examples")
    )


def audit(
    spark: SparkSession,
    now: str,
    filings: DataFrame,
    trades: DataFrame,
    events: DataFrame,
    indexed: DataFrame | None = None,
    receipts: DataFrame | None = None,
    shards: DataFrame | None = None,
    previous: DataFrame | None = None,
    stale: DataFrame | None = None,
    dated_after_cap: int = 0,
) -> DataFrame:
    """All findings of the lake on day ``now`` (``yyyy-mm-dd``), as FINDING rows. Optional inputs that are absent skip their checks."""
    f = [
        finding(split_members(filings), "member_split", "members whose filings carry more than one filer key"),
        finding(unresolved_filers(filings), "unresolved_filers", "filings no member of Congress matched; add a reviewed override", "info"),
        finding(non_member_events(events), "non_member_events", "events whose filer is not a member"),
        finding(orphan_trades(trades, filings), "orphan_trades", "trade rows whose filing is missing or not ok"),
        finding(orphan_event_sources(events, filings), "orphan_event_sources", "events whose sourceDocId is not an ok filing"),
        finding(invalid_contributors(events, trades), "invalid_contributor_row_ids", "contributorRowIds that do not parse or do not exist"),
        finding(
            dated_after_filing(trades), "dated_after_filing",
            F.concat(F.lit("transactionDate after filingDate ("), F.col("count").cast("string"), F.lit(f", cap {dated_after_cap})")), above=dated_after_cap,
        ),
        finding(dates_out_of_range(trades, now), "date_out_of_range", F.concat(F.lit(f"dates outside {EARLIEST} .. "), F.date_add(F.to_date(F.lit(now)), 1).cast("string"))),
        finding(invalid_amounts(trades), "invalid_amount_range", "amountLow > amountHigh or a negative bound"),
        finding(duplicate_trades(trades), "duplicate_trade_key", "duplicate (chamber, docId, rowIndex)"),
        finding(resolved_without_ticker(trades), "resolved_without_ticker", "resolutionStatus=resolved with a null resolvedTicker"),
        freshness(filings, now).select(F.lit("freshness").alias("check"), F.lit("fail").alias("severity"), "message", F.lit(1).cast("long").alias("count"), F.array("example").alias("examples")),
    ]
    if stale is not None:
        f.append(finding(stale, "stale_overrides", "member overrides their proving filing no longer matches"))
    if indexed is not None:
        f.append(finding(missing_indexed(indexed, filings), "index_completeness", "indexed filings have no political_filings row"))
    if receipts is not None:
        gaps = parity_gaps(receipts, filings)
        sizes = receipts.agg(F.count(F.lit(1)).alias("r")).withColumn("_one", F.lit(0)).join(filings.agg(F.count(F.lit(1)).alias("n")).withColumn("_one", F.lit(0)), "_one")
        lost = finding(gaps.where("side = 'filings'"), "publication_parity", "").withColumn("_one", F.lit(0)).join(sizes, "_one")
        f.append(lost.select("check", "severity", F.format_string("receipts %d vs published filings %d", "r", "n").alias("message"), "count", "examples"))
        said = F.concat(F.lit("published rows from earlier rounds ("), F.col("count").cast("string"), F.lit(")"))
        f.append(finding(gaps.where("side = 'receipts'"), "publication_parity", said, "info"))
    if previous is not None:
        f.append(finding(regressions(failed_share(filings), previous), "extraction_health", "failed share rose for an index year"))
    if shards is not None:
        f.append(finding(manifest_health(shards), "manifest_health", "a published year has no manifest or still reads {year}-all.parquet"))
    return reduce(DataFrame.unionByName, f)


def passed(findings: DataFrame) -> DataFrame:
    """``passed``: whether no finding fails."""
    return findings.agg(F.coalesce(F.bool_and(F.col("severity") != "fail"), F.lit(True)).alias("passed"))


def previous_state(records: DataFrame) -> DataFrame:
    """``run_id, failed, shares`` from the last record's JSON; what does not parse counts as no failure and no shares."""
    doc = F.from_json("record", "struct<integrity: struct<passed: boolean, failedShareByYear: map<string, double>>>")
    shares = F.map_filter(doc["integrity"]["failedShareByYear"], lambda k, v: v.isNotNull() & k.rlike(r"\A\d+\z"))
    return records.select("run_id", F.coalesce(~doc["integrity"]["passed"], F.lit(False)).alias("failed"), F.transform_keys(shares, lambda k, v: k.cast("int")).alias("shares"))


def recovered(findings: DataFrame, previous: DataFrame) -> DataFrame:
    """``run_id, send``: whether a recovery is to be told, after a failed run of `previous_state` and with no failure now."""
    return previous.crossJoin(F.broadcast(passed(findings))).select("run_id", (F.col("failed") & F.col("passed")).alias("send"))


def alert_lines(findings: DataFrame) -> DataFrame:
    """``check, position, line``: the text of an alert, failing findings only."""
    lines = F.concat(F.array(F.format_string("%s (%d): %s", "check", "count", "message")), F.transform("examples", lambda e: F.concat(F.lit("  "), e)))
    return findings.where("severity = 'fail'").select("check", F.posexplode(lines).alias("position", "line"))


def headline(findings: DataFrame) -> DataFrame:
    return findings.agg(F.concat(F.count_if(F.col("severity") == "fail").cast("string"), F.lit(" political lake integrity check(s) failed")).alias("headline"))
