"""Reads in passes until they agree, and page ranges halved until their answers fit.

The reader is a function of the caller's: it takes what is to be read as a table and
gives the answers as tables. What a pass gave is written before the next is planned, so a
job that dies goes on with the pass that it was in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.scratch import written

from . import consensus as C
from .ocr import merge_ranges

#: ``(pending, pass)`` to ``reads`` (source_id, error, statement, non, cont) and ``rows`` (source_id, row_idx, sig, labels); passes count from 1.
Reader = Callable[[DataFrame, int], tuple[DataFrame, DataFrame]]
#: Page ranges ``filing_id, chunk, page_start, page_end`` and the round to the same with ``rows array<string>, statement, error, truncated``.
RangeReader = Callable[[DataFrame, int], DataFrame]


def _done(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _kept(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _passes(spark: SparkSession, state: str, n: int) -> tuple[DataFrame, DataFrame]:
    """All reads and rows of the first ``n`` passes."""
    parts = [[spark.read.parquet(f"{state}/pass-{p}/{name}").withColumn("read_idx", F.lit(p - 1)) for p in range(1, n + 1)] for name in ("reads", "rows")]
    out = []
    for first, *others in parts:
        for df in others:
            first = first.unionByName(df)
        out.append(first)
    return out[0], out[1]


def _asked(spark: SparkSession, state: str, n: int) -> DataFrame:
    return spark.read.parquet(f"{state}/pass-{n}/reads").select("source_id").distinct()


def _decisions(spark: SparkSession, windows: DataFrame, state: str, n: int) -> DataFrame:
    """Decisions on the sources that pass ``n`` gave a read of, after it; with fewer than three reads nothing is voted on. Made once and written."""
    at = f"{state}/pass-{n}/decided"
    if not _done(spark, at):
        reads, rows = _passes(spark, state, n)
        reads, rows = (df.join(_asked(spark, state, n), "source_id", "left_semi") for df in (reads, rows))
        _kept(C.decide_rows(reads, rows, windows if n > 2 else None), at)
    return spark.read.parquet(at)


def read_in_passes(sources: DataFrame, windows: DataFrame, read: Reader, state: str, most: int = C.MAX_READS) -> int:
    """Read ``sources`` until their reads decide, ``most`` times at most; returns the number of passes, all below ``state``.

    Everybody is read twice; later passes take only sources that are undecided then and
    were read in the pass before. A pass is over when its pending sources, reads and rows
    are written, in this order, and is not read again. A source that a pass gives no read
    of is not asked again and stays as its reads left it.
    """
    spark = sources.sparkSession
    pending = sources
    for n in range(1, most + 1):
        at = f"{state}/pass-{n}"
        if not _done(spark, f"{at}/rows"):
            if not _done(spark, f"{at}/pending"):
                if n > 2:
                    if _asked(spark, state, n - 1).isEmpty():
                        return n - 1
                    open_ = _decisions(spark, windows, state, n - 1).where("outcome = 'failed'")
                    pending = sources.join(open_.select("source_id"), "source_id", "left_semi")
                _kept(pending, f"{at}/pending")
            todo = spark.read.parquet(f"{at}/pending")
            if todo.isEmpty():
                return n - 1
            reads, rows = read(todo, n)
            _kept(reads.select("source_id", "error", "statement", "non", "cont"), f"{at}/reads")
            _kept(rows.select("source_id", "row_idx", "sig", "labels"), f"{at}/rows")
    return most


def decided(spark: SparkSession, windows: DataFrame, state: str, passes: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Decisions with ``reads`` (how often a source was read), the decided rows by ``position``, and ``outcome, n, later_reads``."""
    reads, rows = _passes(spark, state, passes)
    often = reads.groupBy("source_id").agg(F.count(F.lit(1)).cast("int").alias("reads"))
    made = None
    for n in range(1, passes + 1):  # the last decision on a source counts
        if n == 1 and passes > 1:  # of sources that no second pass gave a read of
            first = [df.join(_asked(spark, state, 2), "source_id", "left_anti") for df in _passes(spark, state, 1)]
            last = C.decide_rows(*first, None)
        else:
            last = _decisions(spark, windows, state, n)
        last = last if n in (1, passes) else last.join(_asked(spark, state, n + 1), "source_id", "left_anti")
        made = last if made is None else made.unionByName(last)
    out, _ = written(made.join(often, "source_id"), "decided")  # read three times below
    whole = rows.join(out.where("read_idx is not null").select("source_id", "read_idx"), ["source_id", "read_idx"]).withColumn("position", F.col("row_idx").cast("int"))
    chosen = out.where("voted").select("source_id")
    voted = C.voted_rows(*[df.join(chosen, "source_id", "left_semi") for df in (reads, rows)]).withColumnRenamed("text", "sig").withColumn("position", F.col("position").cast("int"))
    columns = ["source_id", "position", "read_idx", "row_idx", "sig", "labels"]
    counts = out.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.sum(F.greatest(F.col("reads") - 2, F.lit(0))).alias("later_reads"))
    return out, whole.select(*columns).unionByName(voted.select(*columns)), counts


def _ranges(filings: DataFrame) -> DataFrame:
    """Ranges of ``filing_id, pages, each``: at most ``each`` pages."""
    starts = F.posexplode(F.sequence(F.lit(1), "pages", "each")).alias("chunk", "page_start")
    return filings.where("pages > 0").select("filing_id", "pages", "each", starts).select("filing_id", "chunk", "page_start", F.least(F.col("page_start") + F.col("each") - 1, "pages").alias("page_end"))


def read_by_halves(filings: DataFrame, read: RangeReader, state: str, pages_each: int = 10) -> tuple[DataFrame, DataFrame]:
    """Answers by range and by filing of ``filing_id, pages``.

    A filing goes in ranges of ``pages_each`` pages. One that fails with a range whose
    answer was cut off, and that has two pages or more, is read again as a whole in
    ranges of half that range's pages, rounded up, of the smallest such range; and so on
    until ranges of one page. Other filings keep their answers. Each round is written
    below ``state`` and is not read again. Rounds are as many as halvings of
    ``pages_each``; a range is a request of its own.
    """
    spark = filings.sparkSession
    key = ["filing_id", "page_start", "page_end"]
    todo, kept, n = filings.select("filing_id", "pages", F.lit(pages_each).alias("each")), None, 0
    while True:
        at = f"{state}/round-{n}"
        if not _done(spark, at):
            ranges = _ranges(todo)
            answers = read(ranges, n).select(*key, "rows", "statement", "error", F.coalesce("truncated", F.lit(False)).alias("truncated"))
            missing = F.when(F.col("_read").isNull(), F.lit("no answer")).otherwise(F.col("error"))
            found = ranges.join(answers.withColumn("_read", F.lit(True)), key, "left").withColumn("error", missing).drop("_read")
            _kept(found.withColumns({"rows": F.coalesce("rows", F.array().cast("array<string>")), "truncated": F.coalesce("truncated", F.lit(False))}), at)
        found = spark.read.parquet(at)
        size = F.col("page_end") - F.col("page_start") + 1
        failed = found.groupBy("filing_id").agg(
            F.bool_or(F.col("error").isNotNull()).alias("failed"), F.min(F.when(F.col("truncated") & (size > 1), F.ceil(size / 2).cast("int"))).alias("each")
        )
        again = failed.where("failed and each is not null").select("filing_id", "each")
        settled = found.join(again, "filing_id", "left_anti")
        kept = settled if kept is None else kept.unionByName(settled)
        todo = filings.select("filing_id", "pages").join(again, "filing_id")
        n += 1
        if todo.isEmpty():
            return kept, merge_ranges(kept)
