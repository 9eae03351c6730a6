"""Session settings that the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def builder(app: str = "ledgerspark") -> SparkSession.Builder:
    """A session builder: UTC, adaptive execution with skew handling, dynamic partition overwrite, Arrow."""
    return (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
