"""Events as filings become available: the fold as a stream with keyed state."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerspark.functions import scalars as S
from ledgerspark.operators.events import GIVEN, TIE, VERSION_DDL, Fold, OpenEvent, observations

#: A version with its event's number and its own place among its filer's changes; ``late`` where its trade is older than one that the filer's state has seen.
CHANGES_DDL = f"{VERSION_DDL}, event int, change long, late boolean"
_NAMES = [c.split()[0] for c in CHANGES_DDL.split(", ")]
_ROLES = [f"role_{r}" for r in S.ROLES]
_DAYS = ["filing_date", "report_date", "amended_report_date"]
#: What a version shows of its trade, as text in state.
_SHOWN = [*GIVEN, "ticker", "source_url", "doc_id", "row_index", "filer_key"]
_TIMES = ("first_available_at", "available_at", "superseded_at")
_ORDER = ["available_at", "chamber", "doc_id", "row_index", *TIE]


def arrivals(trades: DataFrame, filings: DataFrame) -> DataFrame:
    """Members' trades with the days of their filing: what the stream takes. Either side may be a stream, the other a table."""
    days = filings.select("chamber", "doc_id", *[F.col(c).cast("string").alias(f"day_{c}") for c in _DAYS])
    seen = observations(trades).withColumns({f"role_{r}": F.col("_roles")[r].cast("string") for r in S.ROLES}).drop("_roles")
    return seen.join(days, ["chamber", "doc_id"]).withColumn("transaction_date", F.col("transaction_date").cast("string"))


def _known(v):
    return None if v is None or v is pd.NaT or (isinstance(v, float) and v != v) else v.item() if hasattr(v, "item") else v


#: Filers are dealt to so many groups, each of which is one call a batch.
GROUPS = 4096
#: A filer of more events keeps them entry by entry.
FEW_EVENTS = 500


class _Held:
    """What is known of one filer: ``events`` by number, the numbers ``found`` under a key, the documents of ``days``.

    Few events lie in one value, which is read and written once a batch; with more, each
    entry lies by itself and a batch touches only those of its own trades.
    """

    def __init__(self, entries, filer: str, held: str | None) -> None:
        self.entries, self.filer = entries, filer
        self.held = None if held is None else json.loads(held)

    def get(self, kind: str, key: str):
        if self.held is not None:
            return self.held[kind].get(key)
        found = self.entries.getValue((self.filer, kind, key))
        return None if found is None else json.loads(found[0])

    def put(self, kind: str, key: str, value) -> None:
        if self.held is not None:
            self.held[kind][key] = value
        else:
            self.entries.updateValue((self.filer, kind, key), (json.dumps(value),))

    def packed(self, events: int) -> str | None:
        """The one value, or null once there are more than FEW_EVENTS."""
        if self.held is not None and events > FEW_EVENTS:
            held, self.held = self.held, None
            for kind, values in held.items():
                for key, value in values.items():
                    self.put(kind, key, value)
        return None if self.held is None else json.dumps(self.held)


class _Filers(StatefulProcessor):
    """The open events of a group of filers, found by source id and ticker.

    State holds for each filer three counters and its _Held entries. A batch loads the
    events of its own trades' keys and stores those that changed, so its cost does not
    grow with what else the filer has filed beyond FEW_EVENTS.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._filers = handle.getMapState("filers", "filer string", "events int, changes long, newest string, held string")
        self._entries = handle.getMapState("entries", "filer string, kind string, key string", "value string")

    @staticmethod
    def _loaded(n: int, d: dict) -> OpenEvent:
        return OpenEvent(n, d["name"], pd.Timestamp(d["first"]), pd.Timestamp(d["at"]), d["version"], d["source"], tuple(d["roles"]), set(d["docs"]), set(d["every"]), d["contributors"], d["shown"])

    @staticmethod
    def _stored(e: OpenEvent) -> dict:
        return {"name": e.name, "first": e.first.isoformat(), "at": e.at.isoformat(), "version": e.version, "source": e.source, "roles": list(e.roles), "docs": sorted(e.docs), "every": sorted(e.every_doc), "contributors": e.contributors, "shown": e.shown}

    @staticmethod
    def _named(key: tuple) -> str:
        return json.dumps(key if len(key) == 1 else [key[0], None])  # a ticker's events hold those of its days

    @staticmethod
    def _row(e: OpenEvent, version: tuple, until=None) -> dict:
        """A version (number, time, contributors, trade) of an event as a row."""
        number, at, contributors, shown = version
        said = json.dumps(contributors, separators=(",", ":"), ensure_ascii=False)
        own = {k: v for k, v in shown.items() if k not in ("doc_id", "row_index")}
        return own | {
            "event_id": e.name, "event": e.order, "version": number, "first_available_at": e.first, "available_at": at, "superseded_at": until, "source_doc_id": shown["doc_id"],
            "source_row_index": shown["row_index"], "contributor_row_ids": said,
        }

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True).astype(object)
        batch = batch.where(batch.notna(), None)
        filers: dict[str | None, list] = {}
        for t in batch.to_dict("records"):
            filers.setdefault(t["filer_key"], []).append(t)
        out: list[dict] = []
        for filer, trades in filers.items():
            self._follow(json.dumps(filer), sorted(trades, key=lambda r: [(r[c] is not None, r[c]) if r[c] is not None else (False, 0) for c in _ORDER]), out)
        frame = pd.DataFrame(out, columns=_NAMES)
        for c in _TIMES:
            frame[c] = pd.to_datetime(frame[c])
        frame["transaction_date"] = [None if d is None else date.fromisoformat(d) for d in frame["transaction_date"]]
        yield frame

    def _follow(self, filer: str, trades: list[dict], out: list[dict]) -> None:
        """Add the changes that trades of one filer make, and keep what they leave open."""
        n, changes, newest, packed = self._filers.getValue((filer,)) or (0, 0, "", '{"events": {}, "found": {}, "days": {}}')
        held = _Held(self._entries, filer, packed)
        days: dict[str, list] = {}
        for t in trades:
            for day in {t["day_filing_date"], t["day_report_date"]} - {None}:
                docs = days.setdefault(day, held.get("days", day) or [])
                if t["doc_id"] not in docs:
                    docs.append(t["doc_id"])
        for day, docs in days.items():
            held.put("days", day, docs)

        fold, loaded, index = Fold(n), {}, {}
        for t in trades:
            for k in Fold.keys_of(t["source_transaction_id"], tuple(t[r] for r in _ROLES)):
                name = self._named(k)
                if name not in index:
                    index[name] = held.get("found", name) or []
                    for i in index[name]:
                        if i not in loaded:
                            loaded[i] = self._loaded(i, held.get("events", str(i)))
                            fold.file(loaded[i])
        touched = {}
        for t in trades:
            time = pd.Timestamp(t["available_at"])
            late = time.isoformat() < newest
            newest = max(newest, time.isoformat())
            amended = t["day_amended_report_date"]
            amended = None if amended is None else days[amended] if amended in days else held.get("days", amended) or []
            shown = {c: _known(t[c]) for c in _SHOWN}
            source, roles = t["source_transaction_id"], tuple(t[r] for r in _ROLES)
            what, e = fold.meet(shown, t["chamber"], t["doc_id"], int(t["row_index"]), source, time, amended, roles)
            touched[e.order] = e
            for row in ([self._row(e, e.before, time)] if what == "next" else []) + [self._row(e, (e.version, e.at, e.contributors, e.shown))]:
                out.append(row | {"change": changes, "late": late})
                changes += 1
        for e in touched.values():
            held.put("events", str(e.order), self._stored(e))
            for k in Fold.keys_of(e.source, e.roles):
                name = self._named(k)
                if name not in index:
                    index[name] = held.get("found", name) or []
                if e.order not in index[name]:
                    index[name].append(e.order)
                    held.put("found", name, index[name])
        self._filers.updateValue((filer,), (fold.n, changes, newest, held.packed(fold.n)))


def changes(arriving: DataFrame) -> DataFrame:
    """Streamed arrivals() as event versions that opened, were repeated or were superseded, as CHANGES_DDL.

    Trades must arrive by availability; how they are cut into batches makes no difference.
    A version is given again when it changes, with a higher ``change``, and current() keeps the last.
    A trade that comes after younger ones of its filer is taken all the same and marked
    ``late``: late_filers() need operators.events.rebuild(). The state store must be
    RocksDB's (see follow()).
    """
    dealt = arriving.withColumn("_group", F.pmod(F.xxhash64("filer_key"), F.lit(GROUPS)))
    return dealt.groupBy("_group").transformWithStateInPandas(statefulProcessor=_Filers(), outputStructType=CHANGES_DDL, outputMode="append", timeMode="none")


def current(changed: DataFrame) -> DataFrame:
    """The versions as VERSION_DDL from a table of changes(). Rows that repeat a document and row number are events of their own under one id."""
    newest = Window.partitionBy("filer_key", "event", "version").orderBy(F.desc("change"))
    return changed.withColumn("_k", F.row_number().over(newest)).where("_k = 1").drop("_k", "event", "change", "late")


def late_filers(changed: DataFrame) -> DataFrame:
    """``filer_key`` of filers with a trade that came out of order."""
    return changed.where("late").select("filer_key").distinct()


_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def follow(arriving: DataFrame, path: str, checkpoint: str) -> None:
    """Append the changes of all that a stream holds now to the table at ``path``, and stop; goes on from ``checkpoint``.

    Keyed state with several variables needs RocksDB as state store, which the session
    is given while the query starts.
    """
    conf = arriving.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKS)
    try:
        query = changes(arriving).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        if before is None:
            conf.unset(_PROVIDER)
        else:
            conf.set(_PROVIDER, before)
