"""Scalar rules of the lake as Column functions. Null in gives null out unless said otherwise."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Statutory amount bands (label, low, high), marks and patterns of the forms.
AMOUNT_BANDS = [
    ("$1,001 - $15,000", 1001.0, 15000.0),
    ("$15,001 - $50,000", 15001.0, 50000.0),
    ("$50,001 - $100,000", 50001.0, 100000.0),
    ("$100,001 - $250,000", 100001.0, 250000.0),
    ("$250,001 - $500,000", 250001.0, 500000.0),
    ("$500,001 - $1,000,000", 500001.0, 1000000.0),
    ("$1,000,001 - $5,000,000", 1000001.0, 5000000.0),
    ("$5,000,001 - $25,000,000", 5000001.0, 25000000.0),
    ("$25,000,001 - $50,000,000", 25000001.0, 50000000.0),
    ("Over $50,000,000", 50000001.0, None),
    ("Spouse/DC Over $1,000,000", 1000001.0, None),
]
EXACT_AMOUNT, UNMARKED = "Exact amount", "unmarked"
EXACT_MAX = 999.99
NOISE_WORDS = ["mr", "mrs", "ms", "dr", "hon", "honorable", "the", "jr", "sr", "ii", "iii", "iv", "md", "facs", "phd", "dds", "esq"]
TICKER_TYPES = ["Stock", "Other", "Cryptocurrency"]
ASSET_TICKER = r"\A([A-Z][A-Z0-9.]{0,5}(?:-[A-Z])?) - \S"
MOVED = r"\((?:Exchanged|Received)\)"

_SPACE = r"(?U)\A\s+|\s+\z"


def trimmed(x: Column) -> Column:
    """Without any Unicode white space at both ends."""
    return F.regexp_replace(x, _SPACE, "")


def blank_to_null(x: Column) -> Column:
    """Trimmed; null where nothing is left."""
    return F.nullif(trimmed(x), F.lit(""))


def parse_slash_date(x: Column) -> Column:
    """``M/D/YYYY`` to a date; null where blank or no such day. Years before 100 are none."""
    t = trimmed(x)
    return F.when(t.rlike(r"\A\d{1,2}/\d{1,2}/\d{4}\z"), F.try_to_date(t, "M/d/yyyy")).cast("date")


def is_iso_date(x: Column) -> Column:
    """Whether the text is a real day as YYYY-MM-DD; null text is none."""
    return F.coalesce(x.rlike(r"\A\d{4}-\d{2}-\d{2}\z") & x.try_cast("date").isNotNull(), F.lit(False))


def available_at(day: Column) -> Column:
    """The last millisecond of a day in New York, as an instant (the session must be in UTC)."""
    end = F.make_timestamp(F.year(day), F.month(day), F.dayofmonth(day), F.lit(23), F.lit(59), F.lit(59.999).cast("decimal(8,6)"))
    return F.to_utc_timestamp(end, "America/New_York")


def amount_bounds(label: Column, exact: Column) -> Column:
    """``struct<low, high>`` of an amount label; both null where it is unmarked or unknown."""
    out = F.when(label == EXACT_AMOUNT, F.struct(exact.cast("double").alias("low"), exact.cast("double").alias("high")))
    for name, low, high in AMOUNT_BANDS:
        out = out.when(label == name, F.struct(F.lit(low).alias("low"), F.lit(high).cast("double").alias("high")))
    none = F.lit(None).cast("double")
    return out.otherwise(F.struct(none.alias("low"), none.alias("high")))


def asset_ticker(name: Column, kind: Column) -> Column:
    """Ticker at the head of an asset name, of tradable types that were not exchanged or received."""
    found = F.nullif(F.regexp_extract(name, ASSET_TICKER, 1), F.lit(""))
    return F.when(kind.isin(TICKER_TYPES) & ~name.rlike(MOVED), found)


def ticker_status(printed: Column) -> Column:
    """``struct<resolved_ticker, status, reason>`` before any resolution: a printed ticker stands."""
    has = F.coalesce(F.length(printed) > 0, F.lit(False))
    return F.struct(F.lit(None).cast("string").alias("resolved_ticker"), F.when(has, "printed").otherwise("unresolved").alias("status"), F.when(~has, "no ticker printed").alias("reason"))


def event_ticker(printed: Column, resolved: Column) -> Column:
    return F.upper(F.coalesce(printed, resolved))


def shard_index(identity: Column, shards: int) -> Column:
    """Stable shard: the first four bytes of the SHA-256, as a big-endian number, modulo ``shards``."""
    return F.pmod(F.conv(F.substring(F.sha2(identity, 256), 1, 8), 16, 10).cast("bigint"), F.lit(shards)).cast("int")


def request_hash(*parts: Column) -> Column:
    """SHA-256 of the parts, each followed by a NUL."""
    return F.sha2(F.concat(*[F.concat(p.cast("string"), F.lit("\0")) for p in parts]), 256)


def content_path(sha: Column, extension: Column) -> Column:
    """Place of an archived blob."""
    return F.concat(F.lit("raw/"), F.substring(sha, 1, 2), F.lit("/"), sha, extension)


def seat_of(chamber: Column, state_district: Column) -> Column:
    """``struct<type, state, district>``; null state or district is any."""
    house = (chamber != "senate") & F.coalesce(F.length(state_district) > 0, F.lit(False))
    rest = F.substring(state_district, 3, 1000)
    return F.struct(
        F.when(chamber == "senate", "sen").otherwise("rep").alias("type"),
        F.when(house, F.upper(F.substring(state_district, 1, 2))).alias("state"),
        F.when(house & rest.rlike(r"\A\d+\z"), rest.try_cast("int")).alias("district"),
    )


def display_name(first: Column, last: Column) -> Column:
    """Filed names with each word capitalised and commas as spaces."""
    whole = F.concat(first, F.lit(" "), F.regexp_replace(last, r"\s*,\s*", " "))
    return F.initcap(F.regexp_replace(trimmed(whole), r"\s+", " "))


@F.pandas_udf(T.StringType())
def folded(names: pd.Series) -> pd.Series:
    """Compatibility decomposition without marks; Spark has no built-in for it."""
    return names.map(lambda x: None if x is None else "".join(c for c in unicodedata.normalize("NFKD", x) if unicodedata.category(c)[0] != "M"))


def name_tokens(name: Column) -> Column:
    """Accent-folded lower-case words without titles, suffixes and credentials."""
    words = F.split(F.regexp_replace(F.lower(folded(F.coalesce(name, F.lit("")))), r"[^a-z\- ]", " "), r"\s+")
    return F.filter(words, lambda w: (F.length(w) > 0) & ~w.isin(NOISE_WORDS))


def name_key(chamber: Column, last_tokens: Column, first_tokens: Column) -> Column:
    return F.concat_ws("|", chamber, F.array_join(last_tokens, " "), F.array_join(first_tokens, " "))


def page_dpi(width: Column, height: Column) -> Column:
    """Dots per inch of a letter page of this many pixels."""
    return F.round(F.greatest(width, height) / 11.0).cast("int")


#: The comparable roles of a trade, in the order that findings name them.
ROLES = ["owner", "action", "partial_sale", "transaction_date", "ticker", "asset_type_code", "asset_type_label", "amount"]


def event_roles(prefix: str = "") -> Column:
    """``struct`` of ROLES; null is unknown and conflicts with nothing."""
    c = lambda n: F.col(prefix + n)
    text = lambda n: F.coalesce(c(n).cast("string"), F.lit("null"))
    return F.struct(
        F.when(c("owner") != "not_indicated", c("owner")).alias("owner"),
        F.when(c("action") != "unmarked", c("action")).alias("action"),
        F.when((c("chamber") == "senate") | c("partial_sale"), c("partial_sale")).alias("partial_sale"),
        c("transaction_date").cast("string").alias("transaction_date"),
        event_ticker(c("printed_ticker"), c("resolved_ticker")).alias("ticker"),
        c("asset_type_code").alias("asset_type_code"),
        c("asset_type_label").alias("asset_type_label"),
        F.when(c("amount_low").isNotNull() | c("amount_high").isNotNull(), F.concat(text("amount_low"), F.lit("-"), text("amount_high"))).alias("amount"),
    )


def role_conflicts(a: Column, b: Column) -> Column:
    """Names of the roles that both sides know and that differ."""
    return F.filter(F.array(*[F.when(a[r].isNotNull() & b[r].isNotNull() & (a[r].cast("string") != b[r].cast("string")), F.lit(r)) for r in ROLES]), lambda x: x.isNotNull())


def row_invalid_reason() -> Column:
    """First reason why an extracted row is invalid, or null. Columns as in the extraction contract."""
    c = F.col
    said = lambda n: F.coalesce(F.left(c(n).cast("string"), F.lit(40)), F.lit("null"))
    labels = [n for n, *_ in AMOUNT_BANDS] + [EXACT_AMOUNT, UNMARKED]
    blank = lambda n: c(n).isNull() | (trimmed(c(n)) == "")
    bad = lambda n, pattern: c(n).isNotNull() & ~c(n).rlike(pattern)
    exact = c("amount_exact")
    rules = [
        (c("transaction_type_code").isNull() | ~c("transaction_type_code").isin("P", "S", "E", UNMARKED), F.concat(F.lit("transaction_type_code "), said("transaction_type_code"), F.lit(" is not one of P, S, E, unmarked"))),
        (c("transaction_date").isNotNull() & (trimmed(c("transaction_date")) == ""), F.concat(F.lit("transaction_date "), said("transaction_date"), F.lit(" is neither a printed date nor null"))),
        *[(blank(n), F.concat(F.lit(f"{n} is "), said(n))) for n in ("asset", "amount_bracket")],
        (c("amount_category").isNull() | ~c("amount_category").isin(labels), F.concat(F.lit("amount_category "), said("amount_category"), F.lit(" is not a legal value category"))),
        ((c("amount_bracket") == UNMARKED) != (c("amount_category") == UNMARKED), F.lit("amount_bracket and amount_category disagree about being unmarked")),
        ((c("amount_category") == EXACT_AMOUNT) != exact.isNotNull(), F.lit("amount_category does not match amount_exact")),
        (exact.isNotNull() & ((exact < 0) | (exact > EXACT_MAX)), F.lit(f"amount_exact is outside 0..{EXACT_MAX}")),
        (c("transaction_date_iso").isNotNull() & ~is_iso_date(c("transaction_date_iso")), F.concat(F.lit("transaction_date_iso "), said("transaction_date_iso"), F.lit(" is not a calendar date"))),
        (c("owner").isNotNull() & ~c("owner").isin("self", "spouse", "joint", "dependent_child", "not_indicated"), F.concat(F.lit("owner "), said("owner"), F.lit(" is not a known owner"))),
        (bad("ticker", r"\A[A-Z0-9]+(?:[.-][A-Z0-9]+)*\z"), F.concat(F.lit("ticker "), said("ticker"), F.lit(" has no ticker's form"))),
        (bad("asset_type_code", r"\A[A-Za-z0-9]+\z"), F.concat(F.lit("asset_type_code "), said("asset_type_code"), F.lit(" has no code's form"))),
        (bad("source_transaction_id", r"\A[A-Za-z0-9-]+\z"), F.concat(F.lit("source_transaction_id "), said("source_transaction_id"), F.lit(" has no id's form"))),
    ]
    return F.coalesce(*[F.when(test, reason) for test, reason in rules])


def needs_review() -> Column:
    return F.coalesce((F.col("transaction_type_code") == UNMARKED) | (F.col("amount_category") == UNMARKED), F.lit(False))


# Day counts of the date checks.
NOTICE_DAYS, NOTICE_MOST = 30, 365


def date_findings(transaction: Column, notification: Column, filed: Column) -> Column:
    """Contradictions between a row's three dates, as names."""
    t, n, f = transaction, notification, filed
    return F.filter(
        F.array(
            F.when(t > f, F.lit("transaction after filing")),
            F.when(F.datediff(n, f) > NOTICE_DAYS, F.lit("notification long after filing")),
            F.when(F.datediff(t, n) > NOTICE_DAYS, F.lit("transaction long after notification")),
            F.when(F.datediff(n, t) > NOTICE_MOST, F.lit("notification over a year after transaction")),
        ),
        lambda x: x.isNotNull(),
    )


# The findings in words.
DATE_SENTENCES = {
    "transaction after filing": "transaction date {t} is after the report was filed on {f}",
    "notification long after filing": "notification date {n} is more than a month after the report was filed on {f}",
    "transaction long after notification": "transaction date {t} is more than a month after its notification date {n}",
    "notification over a year after transaction": "transaction date {t} is more than a year before its notification date {n}",
}


def date_sentences(transaction: Column, notification: Column, filed: Column) -> Column:
    """`date_findings` as sentences with their dates."""
    days = {"t": transaction, "n": notification, "f": filed}
    told = F.lit(None).cast("string")
    found = date_findings(transaction, notification, filed)

    def sentence(name: Column) -> Column:
        out = told
        for known, text in DATE_SENTENCES.items():
            parts = [F.date_format(days[x[1]], "yyyy-MM-dd") if x[:1] == "{" else F.lit(x) for x in re.split(r"(\{\w\})", text) if x]
            out = F.when(name == known, F.concat(*parts)).otherwise(out)
        return out

    return F.transform(found, sentence)


def describe_row(labels: Column, page: Column, asset: Column) -> Column:
    """Words for a row of a read: its line labels, else its page and asset."""
    named = F.nullif(trimmed(asset), F.lit(""))
    where = F.when(page.isNotNull(), F.concat(F.lit("a row on page "), page.cast("string"))).otherwise("a row")
    return F.when(F.size(labels) > 0, F.concat(F.lit("the row labeled "), F.array_join(labels.cast("array<string>"), ", "))).otherwise(
        F.concat(where, F.coalesce(F.concat(F.lit(" ("), named, F.lit(")")), F.lit("")))
    )


def utc(spark: SparkSession) -> SparkSession:
    """The session, which must be in UTC for instants to come out right."""
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
