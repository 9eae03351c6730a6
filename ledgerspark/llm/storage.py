"""Cutting lineage with tables written to the folder that all executors share."""

from __future__ import annotations

import atexit
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

#: Used only by a session on one machine that names no folder, as in tests.
DEFAULT_ROOT = "/tmp/checkpoints"

#: Makes Spark delete a query's shuffle files when it ends, and not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_Table = tuple[SparkSession, str]
_lasting: list[_Table] = []
_paths: WeakKeyDictionary[DataFrame, _Table] = WeakKeyDictionary()


class _Scopes(threading.local):
    def __init__(self) -> None:
        self.open: list[list[_Table]] = [_lasting]


_scopes = _Scopes()


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this session: ``spark.checkpoint.dir``. A cluster must name one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = DEFAULT_ROOT
    return root.rstrip("/")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path below the shared folder, removed with the open steps() or when the driver's Python ends."""
    path = f"{shared_root(spark)}/ledgerspark-{tag}-{uuid.uuid4().hex}"
    _scopes.open[-1].append((spark, path))
    return path


@contextmanager
def _shuffle_files_end_with_the_write(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, tag: str, row_group: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Spark's committer makes the write safe against lost executors and repeated tasks,
    and nothing above it is ever computed again. ``row_group`` bounds the bytes that a
    task holds of wide rows before it writes them.
    """
    spark = df.sparkSession
    path = shared_path(spark, tag)
    with _shuffle_files_end_with_the_write(spark):
        (df.write if row_group is None else df.write.option("parquet.block.size", str(row_group))).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = (spark, path)
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables from materialize() whose successors are written."""
    for t in tables:
        delete(*_paths.pop(t))


class _Steps:
    def __init__(self, around: list[_Table]) -> None:
        self._around = around

    def keep(self, df: DataFrame, tag: str) -> DataFrame:
        """materialize() a result that outlives this block."""
        _scopes.open.append(self._around)
        try:
            return materialize(df, tag)
        finally:
            _scopes.open.pop()


@contextmanager
def steps() -> Iterator[_Steps]:
    """Tables written inside the block are deleted at its end, but for those that it keeps."""
    mine: list[_Table] = []
    around = _scopes.open[-1]
    _scopes.open.append(mine)
    try:
        yield _Steps(around)
    finally:
        _scopes.open.pop()
        _delete_all(mine)


def delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _delete_all(tables: list[_Table]) -> None:
    for spark, path in tables:
        if spark.sparkContext._jsc is not None:
            delete(spark, path)
    tables.clear()


@atexit.register
def _clean() -> None:
    try:
        _delete_all(_lasting)
    except Exception:  # noqa: BLE001 - the JVM may be gone already
        return
