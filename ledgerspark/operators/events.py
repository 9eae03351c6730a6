"""Economic events: repeated and amended observations of one trade folded into versions.

A trade can only meet others of its filer that share its source id, or its ticker and
date, or a document that its filing amends. So trades are dealt by filer, and a filer with
very many by the connected components of those that may meet; the ordered fold streams
Arrow batches sorted by group and time. It takes only the trades that may meet others and
reads only what decides a match; everything else stays in Arrow and is taken by position.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions import scalars as S
from ledgerspark.schema import MEMBER_SOURCES
from ledgerspark.scratch import delete, written

from .linked import components

_COPIED = [
    "chamber", "filer_first", "filer_last", "owner", "action", "partial_sale", "transaction_date", "ticker", "source_transaction_id", "asset_description",
    "comment", "asset_type_code", "asset_type_label", "amount_low", "amount_high", "member_id", "display_name", "identity_source",
]
#: What orders trades of equal keys.
TIE = ["source_transaction_id", "owner", "action", "partial_sale", "transaction_date", "ticker", "asset_description", "comment", "asset_type_code", "asset_type_label", "amount_low", "amount_high"]
VERSION_DDL = (
    "event_id string, version int, chamber string, filer_first string, filer_last string, owner string, action string, partial_sale boolean, transaction_date date, "
    "ticker string, source_transaction_id string, asset_description string, comment string, asset_type_code string, asset_type_label string, amount_low double, "
    "amount_high double, first_available_at timestamp, available_at timestamp, superseded_at timestamp, source_doc_id string, source_row_index int, source_url string, "
    "contributor_row_ids string, filer_key string, member_id string, display_name string, identity_source string"
)


def filing_dates(filings: DataFrame) -> DataFrame:
    """``filer_key, day, doc_id``: documents filed on, or reporting for, a day."""
    days = [filings.select("filer_key", F.col(c).alias("day"), "doc_id") for c in ("filing_date", "report_date")]
    return days[0].union(days[1]).where("day is not null").distinct()


def amended_docs(filings: DataFrame) -> DataFrame:
    """``chamber, doc_id, amended array<string>``: the same filer's documents of the day that a filing amends."""
    day = filings.where("amended_report_date is not null").select("chamber", F.col("doc_id").alias("doc"), "filer_key", F.col("amended_report_date").alias("day"))
    return day.join(filing_dates(filings), ["filer_key", "day"]).groupBy("chamber", F.col("doc").alias("doc_id")).agg(F.array_sort(F.collect_set("doc_id")).alias("amended"))


def held_keys(rows: DataFrame) -> DataFrame:
    """``node, key, amends``: what each trade could share with others of its filer.

    A key is a source id, a ticker with a date, or a document: the trade's own one, and,
    where it has a ticker, those that its filing ``amends``.
    """
    key = lambda kind, *of: F.xxhash64("filer_key", F.lit(kind), *of)
    plain = lambda k, known: F.when(known, F.struct(k.alias("key"), F.lit(False).alias("amends"), F.lit(False).alias("doc")))
    own = F.array_compact(
        F.array(
            plain(key("id", "source_transaction_id"), F.col("source_transaction_id").isNotNull()),
            plain(key("day", "ticker", "transaction_date"), F.col("ticker").isNotNull() & F.col("transaction_date").isNotNull()),
            F.struct(key("doc", "doc_id").alias("key"), F.lit(False).alias("amends"), F.lit(True).alias("doc")),
        )
    )
    docs = F.when(F.col("ticker").isNotNull() & F.col("amended").isNotNull(), F.transform("amended", lambda d: F.struct(key("doc", d).alias("key"), F.lit(True).alias("amends"), F.lit(True).alias("doc"))))
    return rows.select("node", F.explode(F.concat(own, F.coalesce(docs, F.slice(own, 1, 0)))).alias("k")).select("node", "k.*")


def parts(rows: DataFrame) -> DataFrame:
    """``node, part`` of the trades that may meet others; no trade of one part can meet one of another.

    Trades meet where they share a source id or a ticker and date, and an amendment with a
    ticker meets the trades of the documents that it amends, as an event is met through
    any document that it was ever seen in. Parts are connected components over these
    keys, so a filer of many trades falls into as many parts as they have to do with
    each other. Only thin rows of hashes are counted and joined.
    """
    held, held_path = written(held_keys(rows), "held")
    shared = held.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bool_or("amends").alias("amended"), F.bool_or("doc").alias("doc")).where("n > 1 and (amended or not doc)").select("key")
    keys, keys_path = written(held.join(shared, "key").groupBy("node").agg(F.array_sort(F.collect_set("key")).alias("keys")), "keys")  # a trade's own keys
    delete(held_path)
    links = keys.where(F.size("keys") > 1).select(F.col("keys")[0].alias("a"), F.explode(F.slice("keys", 2, F.size("keys"))).alias("b"))
    named = keys.select("node", F.col("keys")[0].alias("key")).join(components(links), "key", "left").select("node", F.coalesce("part", "key").alias("part"))
    out, _ = written(named, "parts")
    delete(keys_path)
    return out


@dataclass
class OpenEvent:
    """An event that later trades may repeat or correct."""

    order: int
    name: str
    first: object
    at: object
    version: int
    source: str | None
    roles: tuple
    docs: set
    every_doc: set
    contributors: list = field(default_factory=list)
    #: What the current version shows: a position, or the row itself.
    shown: object = None
    #: Version, time, contributors and row of the version before.
    before: tuple | None = None


def _differ(a: tuple, b: tuple) -> int:
    return sum(x is not None and y is not None and x != y for x, y in zip(a, b, strict=True))


_TICKER, _DATE = S.ROLES.index("ticker"), S.ROLES.index("transaction_date")
#: What the fold reads of a trade, in order.
_READ = ["chamber", "doc_id", "row_index", "source_transaction_id", "available_at", "amended", *[f"role_{r}" for r in S.ROLES]]


class Fold:
    """The open events of one group of trades, met in order."""

    def __init__(self, n: int = 0) -> None:
        self.found: dict[tuple, dict[int, OpenEvent]] = defaultdict(dict)
        self.n = n

    @staticmethod
    def keys_of(source: str | None, roles: tuple) -> list[tuple]:
        """Under which an event is found, and a trade looks."""
        ticker, day = roles[_TICKER], roles[_DATE]
        keys = [] if source is None else [(source,)]
        return keys + ([] if ticker is None else [(ticker, None)] if day is None else [(ticker, None), (ticker, day)])

    def file(self, e: OpenEvent, remove: bool = False) -> None:
        for key in self.keys_of(e.source, e.roles):
            if remove:
                self.found[key].pop(e.order, None)
            else:
                self.found[key][e.order] = e

    def _earliest(self, keys: list[tuple], fits) -> OpenEvent | None:
        events = {k: e for key in keys for k, e in self.found.get(key, {}).items()}
        return next((events[k] for k in sorted(events) if fits(events[k])), None)

    def meet(self, shown: object, chamber: str, doc: str, row: int, source: str | None, time: object, amended: list | None, roles: tuple) -> tuple[str, OpenEvent]:
        """What a trade is: ``again`` of an event, its ``next`` version, a version ``instead`` of the current one, or ``new``; and its event."""
        me, ticker, day = f"{doc}:{row}", roles[_TICKER], roles[_DATE]

        def free(e: OpenEvent) -> bool:
            return doc not in e.docs and not (e.source and source and e.source != source)

        by_id = [] if source is None else [(source,)]
        by_day = [] if ticker is None or day is None else [(ticker, day)]
        again = self._earliest(by_id + by_day, lambda e: free(e) and not _differ(e.roles, roles))
        if again is not None:
            again.docs.add(doc)
            again.every_doc.add(doc)
            again.contributors.append(me)
            if again.source is None and source is not None:
                again.source = source
                self.file(again)
            return "again", again
        old = self._earliest(by_id, free)
        if old is None and amended and ticker is not None:
            days = set(amended)
            old = self._earliest([(ticker, None)], lambda e: free(e) and not days.isdisjoint(e.every_doc) and _differ(e.roles, roles) == 1)
        if old is None:
            e = OpenEvent(self.n, f"{chamber}:{me}", time, time, 1, source, roles, {doc}, {doc}, [me], shown)
            self.n += 1
            self.file(e)
            return "new", e
        self.file(old, remove=True)
        old.before = (old.version, old.at, old.contributors, old.shown)
        what = "next" if time > old.at else "instead"  # else nobody could have read the version that this one replaces
        old.version += what == "next"
        old.at, old.roles, old.docs, old.contributors, old.shown = time, roles, {doc}, [me], shown
        old.source = source if old.source is None else old.source
        old.every_doc.add(doc)
        self.file(old)
        return what, old


class _Versions:
    """The versions of one group of trades, by position."""

    def __init__(self) -> None:
        self.fold = Fold()
        #: Position of the trade, name, version, position of the event's first trade, of the trade that supersedes, contributors.
        self.rows: dict[tuple[int, int], list] = {}
        self.first: dict[int, int] = {}

    def meet(self, at: int, *trade) -> None:
        what, e = self.fold.meet(at, *trade)
        if what == "again":
            return
        if what == "next":
            self.rows[e.order, e.version - 1][4] = at
        first = self.first.setdefault(e.order, at)
        self.rows[e.order, e.version] = [at, e.name, e.version, first, None, e.contributors]


def _codes(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Numbers that are equal where the values are; -1 for null."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pc.fill_null(whole.dictionary_encode().indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)


def _begins(of: pa.Table | pa.RecordBatch) -> np.ndarray:
    """Whether another group begins at a row, the first one not counted."""
    filer, part = _codes(of.column("filer_key")), _codes(of.column("part"))
    return np.concatenate([[False], (filer[1:] != filer[:-1]) | (part[1:] != part[:-1])])


def _shared(group: np.ndarray, *columns: pa.ChunkedArray) -> np.ndarray:
    """Which trades have their group and these values, none of them null, in common with another."""
    key, known = group.astype(np.int64), np.ones(len(group), bool)
    for codes in map(_codes, columns):
        known &= codes >= 0
        key = key * (int(codes.max(initial=0)) + 1) + codes
    out = np.zeros(len(group), bool)
    if known.any():
        _, at, n = np.unique(key[known], return_inverse=True, return_counts=True)
        out[known] = n[at] > 1
    return out


def _versions_of(table: pa.Table, copied: list[str]) -> pa.RecordBatch:
    """Versions of whole groups of trades, sorted by group and time.

    Rows of ``mark`` say what a document amends. Trades that share no source id and no
    ticker and date, of documents that neither amend nor are amended, meet nobody: they
    leave as they are, their names left out, and only the others are folded.
    """
    group, mark = np.cumsum(_begins(table)), table["mark"].to_numpy()
    amends: dict[tuple, list] = {}
    if mark.any():
        marks = table.filter(pa.array(mark))
        amends = {(g, c, d): a for g, c, d, a in zip(group[mark].tolist(), *(marks[c].to_pylist() for c in ("chamber", "doc_id", "amended")), strict=True)}
        table, group = table.filter(pa.array(~mark)), group[~mark]
    met = _shared(group, table["source_transaction_id"]) | _shared(group, table["ticker"], table["transaction_date"]) | (_codes(table["part"]) >= 0)
    if amends:
        amended = {(g, doc) for (g, _, _), docs in amends.items() for doc in docs}
        maybe = np.flatnonzero(np.isin(group, np.array(list({g for g, *_ in amends}))))
        some = table.take(pa.array(maybe))
        said = zip(group[maybe].tolist(), some["chamber"].to_pylist(), some["doc_id"].to_pylist(), strict=True)
        met[maybe] |= np.fromiter(((g, d) in amended or (g, c, d) in amends for g, c, d in said), bool, len(maybe))

    alone, folded = np.flatnonzero(~met), np.flatnonzero(met)
    rows: list[list] = []
    some = table.select(_READ).take(pa.array(folded))
    some = some.set_column(_READ.index("available_at"), "available_at", some["available_at"].cast(pa.int64()))
    fold, open_ = _Versions(), None
    for at, g, trade in zip(folded.tolist(), group[folded].tolist(), zip(*(c.to_pylist() for c in some.columns), strict=True), strict=True):
        if g != open_:
            rows.extend(fold.rows.values())
            fold, open_ = _Versions(), g
        chamber, doc, row, source, time, docs, *roles = trade
        fold.meet(at, chamber, doc, row, source, time, docs or amends.get((g, chamber, doc)), tuple(roles))
    rows.extend(fold.rows.values())
    at, name, number, first, later, contributors = zip(*rows, strict=True) if rows else [()] * 6
    n, time = len(alone), table["available_at"].combine_chunks()
    own = pa.array([*alone.tolist(), *at], pa.int64())
    said = [None] * n + [json.dumps(c, separators=(",", ":"), ensure_ascii=False) for c in contributors]
    given = table.select(copied).take(own).combine_chunks()
    fixed = [
        pa.array([None] * n + list(name), pa.string()), pa.array([1] * n + list(number), pa.int32()), time.take(pa.array([*alone.tolist(), *first], pa.int64())), time.take(own),
        time.take(pa.array([None] * n + list(later), pa.int64())), pa.array(said, pa.string()),
    ]
    columns = [*fixed, *(c.chunk(0) if c.num_chunks else pa.nulls(0, c.type) for c in given.columns)]
    return pa.RecordBatch.from_arrays(columns, names=["event_id", "version", "first_available_at", "available_at", "superseded_at", "contributor_row_ids", *copied])


def _folded(copied: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Versions of trades sorted by group and time. Groups that a batch completes leave together; only the open group is held."""
        held, last = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = lambda i, of=batch: (of.column("filer_key")[i].as_py(), of.column("part")[i].as_py())
            if held and key(0) != last:
                yield _versions_of(pa.Table.from_batches(held), copied)
                held = []
            last = key(batch.num_rows - 1)
            begins = np.flatnonzero(_begins(batch))
            if len(begins):
                cut = int(begins[-1])
                yield _versions_of(pa.Table.from_batches([*held, batch.slice(0, cut)]), copied)
                held, batch = [], batch.slice(cut)
            held.append(batch)
        if held:
            yield _versions_of(pa.Table.from_batches(held), copied)

    return work


#: Columns of a version that a trade gives it, besides its ticker.
GIVEN = [c for c in _COPIED if c != "ticker"]


def observations(trades: DataFrame) -> DataFrame:
    """Members' trades as the fold takes them: published columns, ``ticker`` and ``_roles``."""
    url = F.col("source_url") if "source_url" in trades.columns else F.lit(None).cast("string")
    return trades.where(F.col("identity_source").isin(MEMBER_SOURCES)).select(
        *GIVEN, "filer_key", "doc_id", "row_index", url.alias("source_url"), F.col("available_at").cast("timestamp").alias("available_at"),
        S.event_ticker(F.col("printed_ticker"), F.col("resolved_ticker")).alias("ticker"), S.event_roles().alias("_roles"),
    )


#: A filer of more trades is folded by parts, others whole.
FILER_TRADES = 100_000


def build_events(trades: DataFrame, filings: DataFrame, whole: int = FILER_TRADES) -> DataFrame:
    """Event versions of all members' trades, as VERSION_DDL.

    Trades are taken by availability, chamber, document and row (equal keys by their
    content). A trade repeats the earliest open event of another document that it
    conflicts with in no role and that shares its source id, or its ticker and date. It
    corrects the earliest one with its source id, or, if its filing amends a day, the
    earliest one with its ticker and exactly one other role that has a document of that
    day. Otherwise it opens an event. See scalars.event_roles() for unknown roles. A
    trade's columns are shuffled once, by filer; a filer of up to ``whole`` trades is held
    until it ends. Of filers with more, trades that no other can meet become events
    without Python, and the others go by component (see parts()).
    """
    names = [c.split()[0] for c in VERSION_DDL.split(", ")]
    shaped = observations(trades).drop("_roles")
    documents, _ = written(shaped.groupBy("filer_key", "chamber", "doc_id").agg(F.count(F.lit(1)).alias("n")), "documents")
    big, _ = written(documents.groupBy("filer_key").agg(F.sum("n").alias("n")).where(F.col("n") > whole).select(F.col("filer_key").alias("_big")), "big")
    is_big = F.col("filer_key").eqNullSafe(F.col("_big"))
    some = not big.isEmpty()
    amending = amended_docs(filings)
    marks = documents.join(amending, ["chamber", "doc_id"]).select("filer_key", "chamber", "doc_id", "amended", F.lit(True).alias("mark"))
    ordinary = shaped.join(big, is_big, "left_anti") if some else shaped
    ordinary = ordinary.withColumn("mark", F.lit(False)).unionByName(marks.join(big, is_big, "left_anti") if some else marks, allowMissingColumns=True).withColumn("part", F.lit(None).cast("long"))
    versions = _fold(ordinary)
    if some:
        nodes = shaped.join(big, is_big, "left_semi").withColumn("node", F.xxhash64("filer_key", "chamber", "doc_id", "row_index", *TIE))
        met = parts(nodes.join(amending, ["chamber", "doc_id"], "left"))
        alone = nodes.join(met, "node", "left_anti").withColumns({"version": F.lit(1), "first_available_at": F.col("available_at"), "superseded_at": F.lit(None).cast("timestamp")})
        alone = alone.withColumns({c: F.lit(None).cast("string") for c in ("event_id", "contributor_row_ids")})
        others = nodes.join(met, "node").join(amending, ["chamber", "doc_id"], "left").withColumn("mark", F.lit(False))
        versions = versions.unionByName(alone.select(*versions.columns)).unionByName(_fold(others.drop("node")))
    row = F.concat_ws(":", "doc_id", "row_index")
    return versions.withColumns({
        "event_id": F.coalesce("event_id", F.concat_ws(":", "chamber", row)), "contributor_row_ids": F.coalesce("contributor_row_ids", F.to_json(F.array(row))),
        "source_doc_id": F.col("doc_id"), "source_row_index": F.col("row_index"),
    }).select(*names)


def _fold(rows: DataFrame) -> DataFrame:
    """Versions of trades with the ``part`` of their filer, what their document has ``amended``, and rows of ``mark`` that say so for a document."""
    dealt = rows.repartition("filer_key", "part").sortWithinPartitions("filer_key", "part", F.desc("mark"), "available_at", "chamber", "doc_id", "row_index", *TIE)
    roles = dealt.withColumns({"printed_ticker": F.col("ticker"), "resolved_ticker": F.col("ticker")}).withColumn("_roles", S.event_roles())
    copied = [*GIVEN, "ticker", "source_url", "filer_key", "doc_id", "row_index"]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    ddl = "event_id string, version int, first_available_at timestamp, available_at timestamp, superseded_at timestamp, contributor_row_ids string, " + ", ".join(f"{c} {kinds[c]}" for c in copied)
    return roles.select(*copied, "available_at", "part", "mark", "amended", *[F.col("_roles")[r].cast("string").alias(f"role_{r}") for r in S.ROLES]).mapInArrow(_folded(copied), ddl)


def rebuild(events: DataFrame, trades: DataFrame, filings: DataFrame, touched: DataFrame) -> DataFrame:
    """Events after a change of the ``touched`` filer keys; all other filers keep theirs."""
    keys = touched.select("filer_key").distinct()
    kept = events.join(keys, "filer_key", "left_anti").select(*events.columns)
    new = build_events(trades.join(keys, "filer_key", "left_semi"), filings.join(keys, "filer_key", "left_semi"))
    return kept.unionByName(new)


def migrate_comments(events: DataFrame, trades: DataFrame) -> DataFrame:
    """Events with a missing comment taken from their source trade."""
    t = trades.groupBy("chamber", F.col("doc_id").alias("source_doc_id"), F.col("row_index").alias("source_row_index")).agg(F.min("comment").alias("_comment"))
    return events.join(t, ["chamber", "source_doc_id", "source_row_index"], "left").withColumn("comment", F.coalesce("comment", "_comment")).drop("_comment")
