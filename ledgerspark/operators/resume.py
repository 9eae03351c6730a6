"""What is left to do: queues, shards, receipts, progress."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.scalars import shard_index


def sync_queue(indexed: DataFrame, filings: DataFrame, most: int | None = None) -> DataFrame:
    """Indexed documents that are not extracted yet; failed ones are tried again. ``most`` takes the first by key."""
    done = filings.where("extraction_status = 'ok'").select("chamber", "doc_id")
    left = indexed.join(done, ["chamber", "doc_id"], "left_anti")
    return left if most is None else left.orderBy("chamber", "doc_id").limit(most)


def pending(identities: DataFrame, receipts: DataFrame, shard: int, shards: int) -> DataFrame:
    """This shard's identities without a receipt."""
    mine = identities.where(shard_index(F.col("identity"), shards) == shard)
    return mine.join(receipts.select("identity"), "identity", "left_anti")


def repair(receipts: DataFrame, keep) -> DataFrame:
    """Receipts that the predicate rejects, to be dropped."""
    return receipts.where(~F.coalesce(keep, F.lit(False)))


def progress(receipts: DataFrame, shards: int) -> DataFrame:
    """``shard, n`` for every shard, zero included."""
    every = receipts.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    done = receipts.groupBy(shard_index(F.col("identity"), shards).alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    return every.join(done, "shard", "left").select("shard", F.coalesce("n", F.lit(0)).alias("n"))


def progress_delta(before: DataFrame, after: DataFrame, minutes: float, total: int) -> DataFrame:
    """``added, per_minute, remaining, minutes_left`` between two counts (column ``n``) taken ``minutes`` apart."""
    a = before.agg(F.sum("n").alias("a")).withColumn("_one", F.lit(0))
    b = after.agg(F.sum("n").alias("b")).withColumn("_one", F.lit(0))
    added = F.col("b") - F.col("a")
    rate = added / F.lit(float(minutes))
    left = F.greatest(F.lit(total) - F.col("b"), F.lit(0))
    return a.join(b, "_one").select(added.alias("added"), F.round(rate, 4).alias("per_minute"), left.alias("remaining"), F.when(rate > 0, F.round(left / rate, 4)).alias("minutes_left"))


def run_round(identities: Callable[[], DataFrame], receipts: Callable[[], DataFrame], process: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None], batch: int, passes: int = 100) -> int:
    """Process pending identities in batches until a pass finishes nothing; returns the number of passes.

    ``process`` gives the identities it finished; ``write`` stores their receipts. What
    failed stays pending for the next round.
    """
    for n in range(passes):
        todo = identities().join(receipts().select("identity"), "identity", "left_anti").orderBy("identity").limit(batch)
        done = process(todo).select("identity").distinct().cache()
        count = done.count()
        if count:
            write(done)
        done.unpersist()
        if not count:
            return n
    return passes
