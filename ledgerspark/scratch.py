"""Tables in the folder that driver and executors share, deleted when no longer needed."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only by a session on one machine that names no folder.
DEFAULT_ROOT = "/tmp/checkpoints"

_left: dict[str, SparkSession] = {}


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in ``spark.checkpoint.dir``, which a cluster must set; deleted when the driver's Python ends."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = f"{(root or DEFAULT_ROOT).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    _left[path] = spark
    return path


def written(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """``df`` written to a new shared path and read back, and the path: lineage ends there, and a lost executor costs nothing above it."""
    path = shared_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def land(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder, if it is there, to a path whose parents are made."""
    a, b = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    files = a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(b.getParent())
    if files.exists(a) and not files.rename(a, b):
        raise OSError(f"{source} could not be moved to {target}")


def delete(*paths: str) -> None:
    """Delete shared paths whose readers have ended."""
    for path in paths:
        spark = _left.pop(path)
        if spark.sparkContext._jsc is not None:
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _clean() -> None:
    try:
        delete(*_left)
    except Exception:  # noqa: BLE001 - the JVM may be gone already
        return
