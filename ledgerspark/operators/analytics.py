"""What users ask of the lake: point-in-time reads, rankings, lags, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def current(events: DataFrame) -> DataFrame:
    """Versions that nothing supersedes."""
    return events.where("superseded_at is null")


def as_of(events: DataFrame, instant: Column) -> DataFrame:
    """Versions that a reader could see at ``instant``: available by then and not superseded yet."""
    return events.where((F.col("available_at") <= instant) & (F.col("superseded_at").isNull() | (F.col("superseded_at") > instant)))


def recent(events: DataFrame, n: int) -> DataFrame:
    """The ``n`` current versions that became available last; ties by event."""
    return current(events).orderBy(F.col("first_available_at").desc(), "event_id", "version").limit(n)


def top_buyers(events: DataFrame, since: Column, n: int) -> DataFrame:
    """Members with most current purchases first seen since a day."""
    rows = current(events).where((F.col("action") == "purchase") & (F.col("first_available_at") >= since))
    return rows.groupBy("filer_key").agg(F.count(F.lit(1)).alias("purchases")).orderBy(F.col("purchases").desc(), "filer_key").limit(n)


def top_tickers(events: DataFrame, n: int) -> DataFrame:
    """Tickers by distinct buying members, then purchases."""
    rows = current(events).where("action = 'purchase' and ticker is not null")
    per = rows.groupBy("ticker").agg(F.count_distinct("filer_key").alias("distinct_members"), F.count(F.lit(1)).alias("purchases"))
    return per.orderBy(F.col("distinct_members").desc(), F.col("purchases").desc(), "ticker").limit(n)


def disclosure_lag(events: DataFrame) -> DataFrame:
    """Mean days, with fractions, from transaction to first availability by chamber."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    days = (micros("first_available_at") - micros("transaction_date")) / F.lit(86400e6)
    rows = current(events).where("transaction_date is not null")
    return rows.groupBy("chamber").agg(F.round(F.avg(days), 1).alias("days"), F.count(F.lit(1)).alias("rows"))


def filing_rows(trades: DataFrame, doc_id: str) -> DataFrame:
    """The printed rows of one document, in order."""
    return trades.where(F.col("doc_id") == doc_id).orderBy("row_index")


def status_counts(filings: DataFrame, trades: DataFrame, events: DataFrame) -> DataFrame:
    """``name, n``: sizes of the lake."""
    f = filings.agg(
        F.count(F.lit(1)).alias("filings"),
        F.count_if(F.col("extraction_status") == "failed").alias("failed_filings"),
        F.count_distinct("member_id").alias("members"),
        F.count_if(F.col("identity_source") == "unresolved").alias("unresolved_filings"),
    )
    sizes = f.select(F.expr("stack(4, 'filings', filings, 'failed_filings', failed_filings, 'members', members, 'unresolved_filings', unresolved_filings) as (name, n)"))
    for name, table in (("trades", trades), ("events", events)):
        sizes = sizes.unionByName(table.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n"))
    return sizes
