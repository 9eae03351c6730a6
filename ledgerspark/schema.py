"""Published tables: schemas, enumerations, column names.

Columns are camelCase at rest and snake_case inside the engine.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The columns of the published tables, by type and in order.
_FILINGS = """
chamber docId filerFirst filerLast filerSuffix stateDistrict filingDate:date availableAt:timestamp availabilitySource sourceUrl
rawArchiveKey rawSha256 parseMethod extractionStatus failureReason extractedRows:int extractionModel contractVersion ocrArchiveKey
amendedReportDate:date reportDate:date processedAt:timestamp
filerKey memberId displayName identitySource
"""
_TRADES = """
chamber docId rowIndex:int sourceTransactionId filerFirst filerLast owner ownerCodeRaw action partialSale:boolean actionCodeRaw
transactionDate:date notificationDate:date filingDate:date availableAt:timestamp availabilitySource assetDescription printedTicker
resolvedTicker resolutionStatus resolutionReason assetTypeCode assetTypeLabel amountBracket amountLow:double amountHigh:double
capGainsOver200:boolean comment filingStatus sourceUrl rawArchiveKey rawSha256
filerKey memberId displayName identitySource
"""
_EVENTS = """
eventId version:int chamber filerFirst filerLast owner action partialSale:boolean transactionDate:date ticker sourceTransactionId
assetDescription comment assetTypeCode assetTypeLabel amountLow:double amountHigh:double firstAvailableAt:timestamp
availableAt:timestamp supersededAt:timestamp sourceDocId sourceRowIndex:int sourceUrl contributorRowIds
filerKey memberId displayName identitySource
"""

_TYPES = {"date": T.DateType(), "timestamp": T.TimestampType(), "int": T.IntegerType(), "double": T.DoubleType(), "boolean": T.BooleanType()}


def _schema(columns: str) -> T.StructType:
    fields = [c.partition(":")[::2] for c in columns.split()]
    return T.StructType([T.StructField(name, _TYPES.get(kind, T.StringType())) for name, kind in fields])


FILINGS, TRADES, EVENTS = map(_schema, (_FILINGS, _TRADES, _EVENTS))
TABLES = {"political_filings": FILINGS, "political_trades": TRADES, "political_trade_events": EVENTS}
#: Primary keys, in snake case.
KEYS = {"political_filings": ["chamber", "doc_id"], "political_trades": ["chamber", "doc_id", "row_index"], "political_trade_events": ["event_id", "version"]}
#: Row order inside a file.
SORT = ["filer_last", "available_at"]

# Closed sets of the published columns.
ENUMS = {
    "chamber": ["house", "senate"],
    "parse_method": ["text", "scan", "html", "paper"],
    "extraction_status": ["ok", "failed", "unsupported"],
    "action": ["purchase", "sale", "exchange", "unmarked"],
    "owner": ["self", "spouse", "joint", "dependent_child", "not_indicated"],
    "resolution_status": ["printed", "resolved", "not_public_equity", "unresolved"],
    "identity_source": ["legislators", "override", "non_member", "unresolved"],
}
MEMBER_SOURCES = ["legislators", "override"]
IDENTITY = ["filer_key", "member_id", "display_name", "identity_source"]


def snake(name: str) -> str:
    """``availableAt`` to ``available_at``."""
    return re.sub(r"(?<=[a-z0-9])([A-Z])", lambda m: "_" + m[1].lower(), name)


def camel(name: str) -> str:
    """``available_at`` to ``availableAt``."""
    return re.sub(r"_([a-z0-9])", lambda m: m[1].upper(), name)


def to_snake(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake(c) for c in df.columns])


def to_camel(df: DataFrame) -> DataFrame:
    return df.toDF(*[camel(c) for c in df.columns])
