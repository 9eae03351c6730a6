"""From extracted rows to filing and trade rows. A filing with any bad row fails as a whole and has no trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions import scalars as S

# Earliest day, codes and labels of the forms, sources of availability.
EARLIEST = "1789-01-01"
ACTIONS = {"P": "purchase", "S": "sale", "E": "exchange", "unmarked": "unmarked"}
SENATE_ACTIONS = {"Purchase": ("purchase", False), "Sale (Full)": ("sale", False), "Sale (Partial)": ("sale", True), "Exchange": ("exchange", False)}
SENATE_OWNERS = {"Self": "self", "Spouse": "spouse", "Joint": "joint", "Child": "dependent_child"}
HOUSE_AVAILABILITY, SENATE_AVAILABILITY = "house_fd_index_filing_date", "senate_efd_filed_date"


def latest_usable(now: str) -> Column:
    """The day after ``now``: no date of a filing may lie beyond it."""
    return F.date_add(F.to_date(F.lit(now)), 1)


def _outside(day: Column, latest: Column) -> Column:
    return (day < F.lit(EARLIEST).cast("date")) | (day > latest)


def _rejected(latest: Column) -> Column:
    t = F.col("transaction_date")
    return F.coalesce(_outside(t, latest) | (t > F.col("filing_date")), F.lit(False))


def sanitize(trades: DataFrame, latest: Column) -> DataFrame:
    """Trades without impossible transaction dates; impossible notification dates are nulled."""
    n = F.col("notification_date")
    return trades.where(~_rejected(latest)).withColumn("notification_date", F.when(~_outside(n, latest), n))


def sanitize_log(trades: DataFrame, latest: Column) -> DataFrame:
    """``doc_id, row_index, message`` for everything that sanitize() changes or drops."""
    n, t = F.col("notification_date"), F.col("transaction_date")
    row = F.concat(F.col("doc_id"), F.lit("#"), F.col("row_index").cast("string"))
    said = F.array(
        F.when(_outside(n, latest), F.concat(row, F.lit(" notificationDate "), F.date_format(n, "yyyy-MM-dd"), F.lit(" nulled"))),
        F.when(_rejected(latest), F.concat(row, F.lit(" transactionDate "), F.date_format(t, "yyyy-MM-dd"), F.lit(" rejected"))),
    )
    return trades.select("doc_id", "row_index", F.explode(F.filter(said, lambda x: x.isNotNull())).alias("message"))


def failures(rows: DataFrame, reason: Column, key: list[str], order: str) -> DataFrame:
    """``key, failure``: every invalid row of a filing in one text; filings without one are absent."""
    bad = rows.withColumn("_reason", reason).where("_reason is not null")
    each = F.struct(F.col(order), F.format_string("row %d %s", order, "_reason").alias("m"))
    listed = F.transform(F.array_sort(F.collect_list(each)), lambda x: x["m"])
    return bad.groupBy(*key).agg(F.concat(F.lit("invalid rows: "), F.array_join(listed, "; ")).alias("failure"))


def house_trades(rows: DataFrame) -> DataFrame:
    """Extracted rows (``doc_id, row_number`` from 1, contract columns, ``filing_date``) as trade columns."""
    actions = F.create_map(*[F.lit(x) for kv in ACTIONS.items() for x in kv])
    day = lambda c: F.when(S.is_iso_date(F.col(c)), F.try_to_date(F.col(c), "yyyy-MM-dd")).cast("date")
    bounds = S.amount_bounds(F.col("amount_category"), F.col("amount_exact"))
    ticker = S.blank_to_null(F.col("ticker"))
    status = S.ticker_status(ticker)
    return rows.select(
        F.lit("house").alias("chamber"), "doc_id", (F.col("row_number") - 1).cast("int").alias("row_index"), "owner", F.element_at(actions, F.col("transaction_type_code")).alias("action"),
        day("transaction_date_iso").alias("transaction_date"), day("notification_date_iso").alias("notification_date"), "filing_date",
        S.blank_to_null(F.col("asset")).alias("asset_description"), ticker.alias("printed_ticker"), status["resolved_ticker"].alias("resolved_ticker"), status["status"].alias("resolution_status"), status["reason"].alias("resolution_reason"),
        bounds["low"].alias("amount_low"), bounds["high"].alias("amount_high"), S.blank_to_null(F.col("source_transaction_id")).alias("source_transaction_id"),
    )


def house_filings(index: DataFrame, results: DataFrame, rows: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """``(filings, trades)``.

    ``index``: ``doc_id, filing_date``; ``results``: ``doc_id, error`` of each read
    document; ``rows``: extracted rows. A filing fails with the read's error, or with its
    invalid rows; its trades are then left out.
    """
    failed = failures(rows, S.row_invalid_reason(), ["doc_id"], "row_number")
    status = index.join(results, "doc_id").join(failed, "doc_id", "left").select("doc_id", "filing_date", F.coalesce("error", "failure").alias("failure_reason"))
    good = status.where("failure_reason is null").select("doc_id", "filing_date")
    trades = sanitize(house_trades(rows.drop("filing_date").join(good, "doc_id")), latest_usable(now))
    n = trades.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    filings = status.join(n, "doc_id", "left").select(
        F.lit("house").alias("chamber"), "doc_id", "filing_date", F.when(F.col("failure_reason").isNull(), "ok").otherwise("failed").alias("extraction_status"), "failure_reason", F.coalesce("n", F.lit(0)).cast("int").alias("extracted_rows")
    )
    return filings, trades


def senate_title(title: Column) -> Column:
    """``struct<report_date, amendment, number>`` of a report title; null where it is not a known one."""
    pattern = r"(?i)\APeriodic Transaction Report for (\d{1,2}/\d{1,2}/\d{4})(?: \(Amendment(?: (\d+))?\))?\z"
    t = S.trimmed(title)
    number = F.nullif(F.regexp_extract(t, pattern, 2), F.lit(""))
    day = S.parse_slash_date(F.regexp_extract(t, pattern, 1))
    kind = F.when(number.isNotNull(), "numbered").when(t.rlike(r"(?i)\(Amendment"), "unnumbered").otherwise("none")
    return F.when(t.rlike(pattern) & day.isNotNull(), F.struct(day.alias("report_date"), kind.alias("amendment"), number.cast("int").alias("number")))


def senate_problems() -> Column:
    """Everything wrong with an electronic row: ``row_number, transaction_type, owner, amount, transaction_date``."""
    n = F.concat(F.lit("row "), F.col("row_number").cast("string"))
    amounts = [label for label, *_ in S.AMOUNT_BANDS]
    quoted = lambda what, c: F.concat(n, F.lit(f' {what} "'), F.coalesce(F.col(c), F.lit("")), F.lit('"'))
    date = F.col("transaction_date")
    return F.filter(
        F.array(
            F.when(F.col("transaction_type").isNull() | ~F.col("transaction_type").isin(list(SENATE_ACTIONS)), quoted("has unknown type", "transaction_type")),
            F.when(F.col("owner").isNull() | ~F.col("owner").isin(list(SENATE_OWNERS)), quoted("has unknown owner", "owner")),
            F.when(F.col("amount").isNull() | ~F.col("amount").isin(amounts), quoted("has non-statutory amount", "amount")),
            F.when(S.blank_to_null(date).isNotNull() & S.parse_slash_date(date).isNull(), quoted("has no calendar date", "transaction_date")),
        ),
        lambda x: x.isNotNull(),
    )


def senate_filings(reports: DataFrame, rows: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """``(filings, trades)`` of electronic reports.

    ``reports``: ``doc_id, report_title, filing_date``; ``rows``: ``doc_id, row_number``
    and the printed cells. All problems of a report make its failure.
    """
    titled = reports.withColumn("_t", senate_title(F.col("report_title")))
    listed = rows.select("doc_id", "row_number", senate_problems().alias("p")).where(F.size("p") > 0)
    grouped = listed.groupBy("doc_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("row_number", "p"))), lambda x: x["p"])).alias("p"))
    unknown = F.when(F.col("_t").isNull(), F.array(F.concat(F.lit('report title "'), "report_title", F.lit('" is not a known eFD title')))).otherwise(F.array().cast("array<string>"))
    every = F.concat(unknown, F.coalesce("p", F.array().cast("array<string>")))
    status = titled.join(grouped, "doc_id", "left").withColumn("failure_reason", F.when(F.size(every) > 0, F.array_join(every, "; ")))
    good = status.where("failure_reason is null").select("doc_id", "filing_date", "_t")
    action = F.create_map(*[F.lit(x) for k, (a, _) in SENATE_ACTIONS.items() for x in (k, a)])
    partial = F.create_map(*[F.lit(x) for k, (_, p) in SENATE_ACTIONS.items() for x in (k, p)])
    owner = F.create_map(*[F.lit(x) for kv in SENATE_OWNERS.items() for x in kv])
    bounds = S.amount_bounds(F.col("amount"), F.lit(None).cast("double"))
    ticker = F.coalesce("ticker", S.asset_ticker(F.trim("asset_name"), F.col("asset_type")))
    trades = rows.join(good, "doc_id").select(
        F.lit("senate").alias("chamber"), "doc_id", (F.col("row_number") - 1).cast("int").alias("row_index"), F.element_at(owner, F.col("owner")).alias("owner"), F.element_at(action, F.col("transaction_type")).alias("action"),
        F.element_at(partial, F.col("transaction_type")).alias("partial_sale"), S.parse_slash_date(F.col("transaction_date")).alias("transaction_date"), F.lit(None).cast("date").alias("notification_date"), "filing_date",
        F.col("asset_name").alias("asset_description"), ticker.alias("printed_ticker"), F.col("asset_type").alias("asset_type_label"), bounds["low"].alias("amount_low"), bounds["high"].alias("amount_high"),
        F.when(F.col("_t.amendment") != "none", "Amended").alias("filing_status"),
    )
    trades = sanitize(trades, latest_usable(now))
    n = trades.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    filings = status.join(n, "doc_id", "left").select(
        F.lit("senate").alias("chamber"), "doc_id", "filing_date", F.col("_t.report_date").alias("report_date"), F.when(F.col("_t.amendment") == "numbered", F.col("_t.report_date")).alias("amended_report_date"),
        F.when(F.col("failure_reason").isNull(), "ok").otherwise("failed").alias("extraction_status"), "failure_reason", F.coalesce("n", F.lit(0)).cast("int").alias("extracted_rows"),
    )
    return filings, trades
