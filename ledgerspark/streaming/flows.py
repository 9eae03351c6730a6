"""Structured Streaming forms: windows with late data, and filings consolidated as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.operators.store import LakeStore


def counts_by_window(stream: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """``window_start, event_type, n, total``: tumbling windows that close once the watermark has passed them."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Write what a stream holds now as Parquet, once, and stop."""
    stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()


def consolidate(filings: DataFrame, trades: DataFrame, store: LakeStore, checkpoint: str) -> None:
    """Upsert streamed filings into the lake, batch by batch, until the source is drained.

    ``filings`` is a stream, ``trades`` a table that holds their trades. A repeated batch
    replaces the same documents, so delivery at least once is enough.
    """

    def write(batch: DataFrame, _: int) -> None:
        batch = batch.persist()
        if batch.limit(1).count():
            store.upsert(batch, trades.join(batch.select("chamber", "doc_id"), ["chamber", "doc_id"], "left_semi"))
        batch.unpersist()

    filings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def distinct_events(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each event id once, with state bounded by the watermark."""
    return stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def open_stream(spark: SparkSession, folder: str, name: str = "*.parquet", files: int = 1) -> DataFrame:
    """Parquet files of a folder, by name, as a stream, some files at a time."""
    schema = spark.read.option("pathGlobFilter", name).parquet(folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", name).option("maxFilesPerTrigger", files).parquet(folder)
