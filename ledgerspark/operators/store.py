"""The lake at rest: yearly Parquet under a manifest that is swapped as the commit point.

``<root>/data/<table>/run=<run>/year=YYYY/`` holds immutable files; ``<root>/manifest-N.json``
names the directories of version N. Readers take the highest version, so a run that dies
leaves the lake as it was. Only the manifest, a few lines for each table and year, is
handled by the driver.

A year is one directory, or a list in order of directories and of key files
(``<root>/gone/``): rows of the directories before a key file that have one of its keys
are gone. So an upsert writes what is new and what is gone, not the years that they lie in;
a year of more than LAYERS steps is written anew.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators.events import build_events
from ledgerspark.schema import IDENTITY, SORT
from ledgerspark.scratch import delete, written

TABLES = ("political_filings", "political_trades", "political_trade_events")
KEY = ["chamber", "doc_id"]
#: Steps of a year, from which an upsert writes it anew, so that reading it stays cheap.
LAYERS = 16
_NO_YEAR = "__HIVE_DEFAULT_PARTITION__"


#: Times that an upsert starts again from a version that another writer committed first.
ATTEMPTS = 8


def _steps(year: str | list[str]) -> list[str]:
    return [year] if isinstance(year, str) else year


class Conflict(RuntimeError):
    """Another writer committed the version first."""


class LakeStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        if not self._fs.exists(self._path(self.root)):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.root))]
        return sorted(int(n[9:-5]) for n in names if n.startswith("manifest-") and n.endswith(".json"))

    def version(self) -> int:
        """The current version, 0 for an empty lake."""
        return (self._versions() or [0])[-1]

    def manifest(self, version: int | None = None) -> dict[str, dict[str, str]]:
        """Directory of each table and year in a version, the current one by default."""
        n = self.version() if version is None else version
        if not n:
            return {t: {} for t in TABLES}
        return json.loads(self.spark.read.text(f"{self.root}/manifest-{n}.json", wholetext=True).first()[0])

    def _commit(self, manifest: dict, base: int) -> None:
        """Publish a manifest as the version after ``base``, which only one writer can: Conflict if another has.

        The file is whole before it gets its name, and gets it only if nobody has it: by a
        hard link on a local disk, elsewhere by a rename, which must refuse an existing
        target, as HDFS's does.
        """
        staged, final = (self._path(f"{self.root}/{n}") for n in (f".staged-{uuid.uuid4().hex}", f"manifest-{base + 1}.json"))
        out = self._fs.create(staged)
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                os.link(*(p.toUri().getPath() for p in (staged, final)))
            elif not self._fs.rename(staged, final):
                raise FileExistsError
        except FileExistsError:
            raise Conflict(f"version {base + 1} was committed by another writer") from None
        finally:
            self._fs.delete(staged, False)

    def _read(self, manifest: dict, table: str, years: list[str] | None = None, only: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame | None:
        """A table, or some of its years, or the rows that ``only`` lets through before gone rows are taken out."""
        groups: dict[tuple, list[str]] = {}  # directories by the key files that come after them
        for year, steps in sorted(manifest[table].items()):
            gone: tuple = ()
            for step in reversed(_steps(steps) if years is None or year in years else []):
                if step.startswith("gone/"):
                    gone = (step, *gone)
                else:
                    groups.setdefault(gone, []).append(step)
        parts = []
        for gone, dirs in groups.items():
            df = self.spark.read.parquet(*[f"{self.root}/{d}" for d in dirs])
            df = df if only is None else only(df)
            if gone:
                keys = self.spark.read.parquet(*[f"{self.root}/{g}" for g in gone])
                df = df.join(keys, keys.columns, "left_anti")
            parts.append(df)
        return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts) if parts else None

    def read(self, table: str, years: list[int] | None = None) -> DataFrame | None:
        """A table, or only some of its years: other years' files are not listed at all."""
        return self._read(self.manifest(), table, years if years is None else [str(y) for y in years])

    def _write(self, run: str, table: str, df: DataFrame) -> dict[str, str]:
        """Directories by year of ``df``: each task writes its rows sorted, one file a year, and nothing is shuffled for it."""
        staging = f"data/{table}/run={run}"
        df.withColumn("year", F.year("available_at")).sortWithinPartitions("year", *SORT).write.partitionBy("year").parquet(f"{self.root}/{staging}")
        found = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/{staging}")) if s.isDirectory()]
        return {n.removeprefix("year="): f"{staging}/{n}" for n in found if n.startswith("year=")}

    def _discard(self, *paths: str) -> None:
        for path in paths:
            self._fs.delete(self._path(f"{self.root}/{path}"), True)

    def publish(self, tables: dict[str, DataFrame], years: dict[str, list[int]] | None = None, base: int | None = None) -> None:
        """Write tables, or only the given years of them, and commit on top of version ``base`` (default: the current one). A year without rows leaves the manifest."""
        base = self.version() if base is None else base
        run, manifest = uuid.uuid4().hex, self.manifest(base)
        for table, df in tables.items():
            only = None if years is None else years.get(table)
            kept = {} if only is None else {y: d for y, d in manifest[table].items() if int(y) not in only}
            manifest[table] = {**kept, **self._write(run, table, df if only is None else df.where(F.year("available_at").isin(only)))}
        try:
            self._commit(manifest, base)
        except Conflict:
            self._discard(*[f"data/{table}/run={run}" for table in tables])
            raise

    def _changed(self, base: int, run: str, filings: DataFrame, trades: DataFrame) -> dict:
        """The manifest of version ``base`` with the given rows in place of their documents' and their filers' events rebuilt; writes the files of ``run`` that it names."""
        manifest = self.manifest(base)
        new = {"political_filings": filings, "political_trades": trades}
        added = {t: self._write(run, t, df) for t, df in new.items()}
        # What was written is read from there, so that what is given is worked out once.
        new = {t: self._read({t: added[t]}, t) if added[t] else df.limit(0) for t, df in new.items()}
        gone = {t: f"gone/run={run}/{'filers' if t == 'political_trade_events' else 'docs'}" for t in TABLES}
        keys = self._kept(new["political_filings"].select(*KEY).distinct(), gone["political_filings"])
        touched, old = new["political_filings"].select("filer_key"), self._read(manifest, "political_filings")
        if old is not None:
            touched = touched.union(old.join(keys, KEY, "left_semi").select("filer_key"))
        touched = self._kept(touched.distinct(), gone["political_trade_events"])
        theirs = lambda df: df.join(touched, "filer_key", "left_semi")
        whole, paths = {}, []
        for t, df in new.items():
            rest = self._read(manifest, t, only=theirs)
            df = theirs(df) if rest is None else rest.join(keys, KEY, "left_anti").unionByName(theirs(df), allowMissingColumns=True)
            whole[t], path = written(df, "theirs")
            paths.append(path)
        added["political_trade_events"] = self._write(run, "political_trade_events", build_events(whole["political_trades"], whole["political_filings"]))
        delete(*paths)
        for t in TABLES:
            lost = self._lost(manifest, t, theirs, keys)
            layered = {y: [*_steps(s), *([gone[t]] if y in lost else [])] for y, s in manifest[t].items()}
            for y, d in added[t].items():
                layered.setdefault(y, []).append(d)
            ended = lost - set(added[t])
            if ended:
                ended -= self._years(self._read({t: layered}, t, sorted(ended)))
            long = [y for y, s in layered.items() if len(s) > LAYERS and y not in ended]
            anew = self._write(f"{run}-anew", t, self._read({t: layered}, t, long)) if long else {}
            manifest[t] = {y: anew.get(y) or (s[0] if len(s) == 1 else s) for y, s in layered.items() if y not in ended and (y in anew or y not in long)}
        return manifest

    def _kept(self, df: DataFrame, path: str) -> DataFrame:
        df.write.parquet(f"{self.root}/{path}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{path}")

    @staticmethod
    def _years(rows: DataFrame) -> set[str]:
        return {r.y for r in rows.select(F.coalesce(F.year("available_at").cast("string"), F.lit(_NO_YEAR)).alias("y")).distinct().collect()}

    def _lost(self, manifest: dict, table: str, theirs: Callable[[DataFrame], DataFrame], keys: DataFrame) -> set[str]:
        """Years with rows that an upsert replaces. Documents meet by hashes, each once a year; a chance match names a year that loses nothing."""
        if not manifest[table]:
            return set()
        if table == "political_trade_events":
            return self._years(self._read(manifest, table, only=theirs))
        hashed = F.xxhash64(*KEY).alias("h")
        return self._years(self._read(manifest, table).select(hashed, F.trunc("available_at", "year").alias("available_at")).distinct().join(keys.select(hashed), "h", "left_semi"))

    def upsert(self, filings: DataFrame, trades: DataFrame) -> None:
        """Replace whole filings and their trades, and rebuild the events of the filers concerned.

        Only new rows are written, with the keys of those that are gone, to the years in
        which a replaced or a new row lies; for events those of the filers' old and new
        versions, as a correction may supersede a version of any year. Other years keep
        their files. If another writer commits meanwhile, the upsert starts again from
        that version, so both survive; after ATTEMPTS it gives up with Conflict. Nothing
        changes before the commit.
        """
        for attempt in range(1, ATTEMPTS + 1):
            base, run = self.version(), uuid.uuid4().hex
            try:
                self._commit(self._changed(base, run, filings, trades), base)
                return
            except BaseException as e:
                self._discard(f"gone/run={run}", *[f"data/{t}/run={r}" for t in TABLES for r in (run, f"{run}-anew")])
                if not isinstance(e, Conflict) or attempt == ATTEMPTS:
                    raise

    def reidentify(self, identities: DataFrame) -> int:
        """Give filings and trades new identities where they differ; returns how many filings moved, and writes nothing for none."""
        filings, trades = self.read("political_filings"), self.read("political_trades")
        if filings is None:
            return 0
        renamed = identities.select(*KEY, *[F.col(c).alias(f"_{c}") for c in IDENTITY])
        same = F.struct(*IDENTITY).eqNullSafe(F.struct(*[F.col(f"_{c}") for c in IDENTITY]))
        moved = filings.join(renamed, KEY).where(~same).select(*KEY, *[f"_{c}" for c in IDENTITY])
        n = moved.count()
        if n:
            def stamp(df: DataFrame) -> DataFrame:
                return df.join(moved, KEY).withColumns({c: F.col(f"_{c}") for c in IDENTITY}).select(*df.columns)

            self.upsert(stamp(filings), stamp(trades) if trades is not None else filings.limit(0))
        return n


def touched_years(before: DataFrame, after: DataFrame) -> DataFrame:
    """``year``: availability years of either side."""
    return before.select(F.year("available_at").alias("year")).union(after.select(F.year("available_at").alias("year"))).distinct()


def upserted(table: DataFrame, updates: DataFrame, replaced: DataFrame) -> DataFrame:
    """``table`` with the ``replaced`` documents' rows exchanged for ``updates``."""
    return table.join(replaced.select(*KEY).distinct(), KEY, "left_anti").unionByName(updates)


# Least size of a database file and its growth over Parquet.
DATABASE_LEAST, DATABASE_GROWTH = 256 * 1024 * 1024, 32


def disk_plan(files: DataFrame) -> DataFrame:
    """``files, bytes, database_bytes``: what a selection of manifest files takes on disk."""
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("bytes")).withColumn(
        "database_bytes", F.greatest(F.lit(DATABASE_LEAST).cast("long"), F.col("bytes") * DATABASE_GROWTH)
    )
