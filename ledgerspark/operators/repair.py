"""What two reads of filed pages dispute, and which decided reads get a second look.

Tables, all of them thin:

``windows``    source_id, filing_id, filed_on date, first, last (labels; null: the filing has none), page_start, page_end
``spans``      filing_id, page, first_label, last_label: the labels that a page holds
``text_reads`` source_id, error; one read of each window's text
``text_rows``  source_id, row_idx, labels array<int>, sig, transaction, notification (dates), asset
``page_reads`` filing_id, page, error, and ``page_rows`` filing_id, page, row_idx, sig, transaction, notification, asset

A read without an error, and only that, answers. All of it is equi-joins on filing or
source with a range inside, and aggregations: nothing is gathered but a window's own rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions import scalars as S

# How findings name the two reads, and the finding of a report without any transaction.
TEXT_READ, PAGE_READ = "Read A (OCR text alone)", "Read B (the filed pages alone)"
EMPTY_READ = "No read of this report found a transaction or a statement that it has none."


_SAID = ["sig", "transaction", "notification", "asset"]


def window_pages(windows: DataFrame, spans: DataFrame) -> DataFrame:
    """``source_id, filing_id, page``: every page from that of a window's first label to that of its last; all of its pages without labels."""
    w = windows.select("source_id", "filing_id", "first", "last", "page_start", "page_end")
    at = lambda label, name: spans.select(F.col("filing_id").alias("_f"), F.col("page").alias(name), F.col("first_label").alias("_a"), F.col("last_label").alias("_b")).alias(name)
    for label, name in (("first", "_from"), ("last", "_to")):
        s = at(label, name)
        w = w.join(s, (F.col("filing_id") == F.col(f"{name}._f")) & F.col(label).between(F.col(f"{name}._a"), F.col(f"{name}._b")), "left").drop("_f", "_a", "_b")
    pages = F.sequence(F.coalesce("_from", "page_start"), F.coalesce("_to", "page_end"))
    return w.select("source_id", "filing_id", F.explode(pages).alias("page")).distinct()


def placed(windows: DataFrame, spans: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` of windows with their ``filing_id, filed_on`` and the ``page`` of the least label they cite; null where they cite none that a page holds."""
    r = rows.select("source_id", "row_idx", "labels", *_SAID).join(windows.select("source_id", "filing_id", "filed_on"), "source_id").withColumn("_label", F.array_min("labels"))
    s = spans.select(F.col("filing_id").alias("_f"), "page", "first_label", "last_label")
    return r.join(s, (F.col("filing_id") == F.col("_f")) & F.col("_label").between(F.col("first_label"), F.col("last_label")), "left").drop("_f", "_label", "first_label", "last_label")


def disputed_pages(windows: DataFrame, spans: DataFrame, text_reads: DataFrame, text_rows: DataFrame, page_reads: DataFrame, page_rows: DataFrame) -> DataFrame:
    """``filing_id, page`` where the reads disagree.

    A window whose text read failed, is missing, or has a row on no page disputes all its
    pages and says nothing of them. Of the others, the rows that start on a page, over
    all windows, must be those that the page's read lists, repeats counted; a page whose
    read failed or is missing is disputed.
    """
    pages = window_pages(windows, spans)
    good = text_reads.where("error is null").select("source_id").distinct()
    rows = placed(windows, spans, text_rows.join(good, "source_id", "left_semi"))
    unplaced = windows.select("source_id").join(good, "source_id", "left_anti").union(rows.where("page is null").select("source_id")).distinct()
    text = rows.join(unplaced, "source_id", "left_anti").groupBy("filing_id", "page", "sig").agg(F.count(F.lit(1)).alias("n"))
    read = page_reads.where("error is null").select("filing_id", "page").distinct()
    listed = page_rows.join(read, ["filing_id", "page"], "left_semi").groupBy("filing_id", "page", "sig").agg(F.count(F.lit(1)).alias("m"))
    key = ["filing_id", "page"]
    differ = text.join(listed, [*key, "sig"], "full_outer").where(~F.col("n").eqNullSafe(F.col("m"))).select(*key)
    asked = pages.select(*key).distinct()
    bad = differ.union(asked.join(read, key, "left_anti")).distinct()
    return asked.join(bad, key, "left_semi").union(pages.join(unplaced, "source_id", "left_semi").select(*key)).distinct()


def _findings(filed_on: Column) -> Column:
    return S.date_sentences(F.col("transaction"), F.col("notification"), filed_on)


def date_findings_by_page(windows: DataFrame, spans: DataFrame, text_reads: DataFrame, text_rows: DataFrame, page_reads: DataFrame, page_rows: DataFrame) -> DataFrame:
    """``filing_id, page, finding``: what the dates of either read's rows contradict, each said once a page.

    The text's rows count on the page they start on, those of a page's read on each page
    of a window; rows of failed reads and rows on no page say nothing. Findings name their
    read, so each read's are made distinct where its rows lie, by filing or page, and no
    sentence is shuffled.
    """
    key = ["filing_id", "page"]
    text = placed(windows, spans, text_rows.join(text_reads.where("error is null"), "source_id", "left_semi")).where("page is not null")
    none = F.lit(None).cast("int")
    say = lambda who, labels, page: F.concat(F.lit(f"{who}, "), S.describe_row(labels, page, F.col("asset")), F.lit(": "), F.col("f")).alias("finding")
    said = text.withColumn("f", F.explode(_findings(F.col("filed_on")))).select(*key, say(TEXT_READ, F.col("labels"), none)).distinct()
    days = window_pages(windows, spans).join(windows.select("source_id", "filed_on"), "source_id").select(*key, "filed_on").distinct()
    listed = page_rows.join(page_reads.where("error is null"), key, "left_semi").join(days, key).withColumn("f", F.explode(_findings(F.col("filed_on"))))
    return said.union(listed.select(*key, say(PAGE_READ, F.array().cast("array<int>"), F.col("page"))).distinct())


def source_read(windows: DataFrame, spans: DataFrame, page_reads: DataFrame, page_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The page reads as a window sees them: ``source_id, error`` and ``source_id, page, row_idx, ...`` of page_rows.

    ``error`` names, in order, the pages without an answer and those whose read failed; null if there is none.
    """
    key = ["filing_id", "page"]
    pages = window_pages(windows, spans)
    asked = pages.join(page_reads.select(*key, "error", F.lit(True).alias("_read")), key, "left")
    page = F.concat(F.lit("page "), F.col("page").cast("string"), F.lit(": "))
    trouble = F.when(F.col("_read").isNull(), F.concat(page, F.lit("no answer"))).when(F.col("error").isNotNull(), F.concat(page, F.col("error")))
    told = F.array_sort(F.collect_list(F.when(trouble.isNotNull(), F.struct("page", trouble.alias("t")))))  # a window's pages
    errors = asked.groupBy("source_id").agg(F.nullif(F.array_join(F.transform(told, lambda x: x["t"]), "; "), F.lit("")).alias("error"))
    return errors, pages.join(page_rows.select(*key, "row_idx", *_SAID), key).drop("filing_id")


def kept_date_findings(windows: DataFrame, rows: DataFrame, text_reads: DataFrame, text_rows: DataFrame) -> DataFrame:
    """``source_id, row_idx, finding`` of rows whose dates contradict something where the text's row does not.

    A row's text row is, by the order of its own labels, the first row of the text read
    that has the label. It must give a date wherever the row has one, and contradict
    nothing itself.
    """
    filed = windows.select("source_id", "filed_on")
    text = text_rows.join(text_reads.where("error is null"), "source_id", "left_semi").select("source_id", "row_idx", F.explode("labels").alias("label"), "transaction", "notification")
    first = text.groupBy("source_id", "label").agg(F.min(F.struct("row_idx", "transaction", "notification")).alias("text"))
    found = rows.join(filed, "source_id").withColumn("found", _findings(F.col("filed_on"))).where(F.size("found") > 0)
    cited = found.select("source_id", "row_idx", "labels", "asset", "filed_on", "found", "transaction", "notification", F.posexplode("labels").alias("nth", "label"))
    met = cited.join(first, ["source_id", "label"])
    best = Window.partitionBy("source_id", "row_idx").orderBy("nth")
    met = met.withColumn("_k", F.row_number().over(best)).where("_k = 1")  # a row's own labels
    given = lambda c: F.col(c).isNull() | F.col(f"text.{c}").isNotNull()
    sound = F.size(S.date_findings(F.col("text.transaction"), F.col("text.notification"), F.col("filed_on"))) == 0
    told = lambda c: F.coalesce(F.date_format(F.col(f"text.{c}"), "yyyy-MM-dd"), F.lit("none"))
    gives = F.concat(F.lit(f", where {TEXT_READ} gives transaction date "), told("transaction"), F.lit(" and notification date "), told("notification"))
    said = met.where(given("transaction") & given("notification") & sound).withColumn("f", F.explode("found"))
    return said.select("source_id", "row_idx", F.concat(S.describe_row(F.col("labels"), F.lit(None).cast("int"), F.col("asset")), F.lit(": "), F.col("f"), gives).alias("finding"))


def _assetless(rows: DataFrame) -> DataFrame:
    return rows.where(F.coalesce(S.trimmed(F.col("asset")), F.lit("")) == "")


def _empty(reads: DataFrame, rows: DataFrame) -> DataFrame:
    """``source_id`` of reads without a row and without a statement that there is none."""
    return reads.where(F.coalesce("statement", F.lit("")) == "").select("source_id").join(rows.select("source_id").distinct(), "source_id", "left_anti")


def repair_findings(
    windows: DataFrame, decisions: DataFrame, rows: DataFrame, reconciled: DataFrame, reconciled_rows: DataFrame, text_reads: DataFrame, text_rows: DataFrame
) -> DataFrame:
    """``source_id, kind, finding``: why a window's decided read gets a second look at the pages.

    ``decisions``: source_id, outcome (agreed, arbitrated, failed), error, statement, with
    ``rows`` as text_rows; ``reconciled``: source_id, error, statement of the reconciling
    reads. ``asset``: a row names no asset. ``kept_date``: see kept_date_findings(), only
    where reads were reconciled. ``empty_read``: no window of the filing has a row or a
    statement; a failed window counts by its reconciling read. That finding stands alone,
    and failed or undecided windows have no other.
    """
    ok = decisions.where("outcome <> 'failed'").select("source_id", "outcome")
    known = windows.select("source_id")
    asset = _assetless(rows.join(ok, "source_id", "left_semi").join(known, "source_id", "left_semi"))
    asset = asset.select("source_id", F.lit("asset").alias("kind"), F.concat(S.describe_row(F.col("labels"), F.lit(None).cast("int"), F.col("asset")), F.lit(" has no asset name")).alias("finding"))
    kept = kept_date_findings(windows, rows.join(ok.where("outcome = 'arbitrated'"), "source_id", "left_semi"), text_reads, text_rows)
    kept = kept.select("source_id", F.lit("kept_date").alias("kind"), "finding")
    decided = decisions.where("outcome <> 'failed' and error is null")
    silent = _empty(decided, rows).union(_empty(reconciled.join(decisions.where("outcome = 'failed'"), "source_id", "left_semi"), reconciled_rows))
    per = windows.select("filing_id", "source_id").join(silent.distinct().withColumn("_silent", F.lit(1)), "source_id", "left")
    empty = per.groupBy("filing_id").agg(F.min(F.coalesce("_silent", F.lit(0))).alias("all")).where("all = 1").select("filing_id")
    alone = windows.join(empty, "filing_id", "left_semi").select("source_id")
    others = asset.union(kept).join(alone, "source_id", "left_anti")
    return others.union(alone.select("source_id", F.lit("empty_read"), F.lit(EMPTY_READ)))


def settled(windows: DataFrame, findings: DataFrame, repaired: DataFrame, repaired_rows: DataFrame, text_reads: DataFrame, text_rows: DataFrame) -> DataFrame:
    """``source_id, settles`` of every window with findings: whether its repair read clears what sent it. Else the decision stands.

    ``repaired``: source_id, error. A missing or failed repair read settles nothing; an
    asset finding needs an asset in every row, and a kept date no such finding any more.
    """
    kinds = findings.groupBy("source_id").agg(F.bool_or(F.col("kind") == "asset").alias("asset"), F.bool_or(F.col("kind") == "kept_date").alias("kept"))
    mark = lambda df, name: df.select("source_id").distinct().withColumn(name, F.lit(True))
    j = kinds.join(mark(repaired.where("error is null"), "_read"), "source_id", "left").join(mark(_assetless(repaired_rows), "_blank"), "source_id", "left")
    j = j.join(mark(kept_date_findings(windows, repaired_rows, text_reads, text_rows), "_still"), "source_id", "left")
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    return j.select("source_id", (yes("_read") & ~(F.col("asset") & yes("_blank")) & ~(F.col("kept") & yes("_still"))).alias("settles"))
