"""Agreement between repeated reads of one source.

``reads(source_id, read_idx, error)`` and ``rows(source_id, read_idx, row_idx, sig)``;
a row's ``sig`` is the text of all its comparable fields. Decisions on whole reads and by
row also need ``statement, non, cont`` of a read, and a row's ``labels``: arrays of the
line labels that it lists or cites.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.functions.scalars import is_iso_date, trimmed

# Reads of a source at most, and the fields in which rows of reads must agree.
MAX_READS = 5
ROW_FIELDS = (
    "transaction_type_code", "transaction_date_iso", "notification_date_iso", "amount_low", "amount_high",
    "ticker", "asset_type_code", "owner", "partial_sale", "source_transaction_id",
)


def row_signature(labels: Column | None = None) -> Column:
    """A row's comparable fields and cited labels as one text; without labels for reads of a whole page.

    Blank texts and dates off the calendar count as absent, the owner as it is; the order
    of labels does not count, their repeats do.
    """
    whole = lambda n: F.col(n).cast("string")
    told = lambda n: F.nullif(trimmed(whole(n)), F.lit(""))
    dated = lambda n: F.when(is_iso_date(whole(n)), whole(n))
    fields = [dated(n) if n.endswith("_iso") else whole(n) if n in ("amount_low", "amount_high", "owner", "partial_sale") else told(n) for n in ROW_FIELDS]
    cited = [] if labels is None else [F.array_join(F.array_sort(F.coalesce(labels, F.array().cast("array<int>"))), ",")]
    return F.to_json(F.array(*fields, *cited))


def _thin(rows: DataFrame) -> DataFrame:
    """Rows with 128 bits of ``sig`` in its place, dealt by source once for all that goes by source."""
    return rows.withColumn("sig", F.unhex(F.md5("sig"))).repartition("source_id")


def _usable(reads: DataFrame) -> DataFrame:
    """``source_id, _usable``: its reads without an error; MAX_READS at most."""
    return reads.where("error is null").groupBy("source_id").agg(F.collect_set("read_idx").alias("_usable"))


def document_signatures(reads: DataFrame, rows: DataFrame) -> DataFrame:
    """``source_id, read_idx, sig``: rows in order, both lists of labels, and whether an empty read says so; null for a failed read."""
    listed = rows.groupBy("source_id", "read_idx").agg(F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "sig"))), lambda r: r["sig"]).alias("_rows"))
    ints = lambda n: F.array_sort(F.coalesce(n, F.array().cast("array<int>"))).alias(n)
    empty = F.col("_rows").isNull() & (F.coalesce("statement", F.lit("")) != "")
    whole = F.to_json(F.struct(empty.alias("empty"), F.coalesce("_rows", F.array().cast("array<string>")).alias("rows"), ints("non"), ints("cont")))
    return reads.join(listed, ["source_id", "read_idx"], "left").select("source_id", "read_idx", F.when(F.col("error").isNull(), whole).alias("sig"))


def _kept(rows: DataFrame, reads: DataFrame) -> DataFrame:
    """Rows, dealt by source, with ``_kept``: whether the vote keeps them. All sorts and windows of a source share one shuffle."""
    same, within = Window.partitionBy("source_id", "_ok", "sig"), Window.partitionBy("source_id", "_ok", "sig", "read_idx")
    each = rows.join(_usable(reads), "source_id", "left").withColumn("_ok", F.coalesce(F.array_contains("_usable", F.col("read_idx")), F.lit(False))).drop("_usable").select(
        "*", F.row_number().over(same.orderBy("read_idx", "row_idx")).alias("_copy"), F.row_number().over(within.orderBy("row_idx")).alias("_nth"), F.count(F.lit(1)).over(within).alias("_n")
    )
    second = F.try_element_at(F.sort_array(F.collect_list(F.when(F.col("_nth") == 1, F.col("_n"))).over(same), asc=False), F.lit(2))  # one entry a read, MAX_READS at most
    return each.withColumn("_copies", second).withColumn("_kept", F.coalesce(F.col("_ok") & (F.col("_copy") <= F.col("_copies")), F.lit(False))).drop("_copies", "_copy", "_nth", "_n", "_ok")


def voted_rows(reads: DataFrame, rows: DataFrame) -> DataFrame:
    """``source_id, position, read_idx, row_idx, labels, text``: the rows that `vote_window` keeps, by first cited label, and their ``sig`` as text.

    The first reads' copies stay; rows with equal or no labels follow reads and rows,
    those without labels last. The windows run over one source.
    """
    thin = _thin(rows.select("source_id", "read_idx", "row_idx", "sig", "labels", F.col("sig").alias("text")))
    order = Window.partitionBy("source_id").orderBy(F.array_min("labels").asc_nulls_last(), "read_idx", "row_idx")
    return _kept(thin, reads).where("_kept").select("source_id", (F.row_number().over(order) - 1).alias("position"), "read_idx", "row_idx", "labels", "text")


def shared_labels(reads: DataFrame, listed: str) -> DataFrame:
    """``source_id, label`` that at least two usable reads hold in the list of that name."""
    each = reads.where("error is null").select("source_id", "read_idx", F.explode(F.array_distinct(listed)).alias("label"))
    return each.groupBy("source_id", "label").agg(F.count(F.lit(1)).alias("_n")).where("_n >= 2").select("source_id", "label")


def _listed(reads: Column, name: str) -> Column:
    """Labels of the list of that name in all usable reads of a source, sorted."""
    return F.sort_array(F.flatten(F.transform(F.filter(reads, lambda r: r["ok"]), lambda r: F.array_distinct(r[name]))))


def _repeated(sorted_: str) -> Column:
    """What a sorted array, which must be a column, holds more than once."""
    return F.array_distinct(F.filter(sorted_, lambda x, i: F.get(F.col(sorted_), i - 1) == x))


def decide_rows(reads: DataFrame, rows: DataFrame, windows: DataFrame | None) -> DataFrame:
    """``source_id, outcome, read_idx, voted, reason``: as `decide`, then row by row for sources with a window.

    A vote needs a read after the second, two usable reads, and rows and lists that
    account for every label of the window; ``read_idx`` is null then. ``windows``:
    ``source_id, first, last, row_count``. The rules of a window are those of
    ocr.coverage_problems() and ocr.coverage_gaps(). Rows, reads and windows are each dealt
    by source once; all that is asked of a source is asked of its reads and rows together.
    Without windows nothing is voted on.
    """
    none = F.array().cast("array<int>")
    thin = _thin(rows.select("source_id", "read_idx", "row_idx", "sig", "labels"))
    thin = thin.withColumn("_kept", F.lit(False)) if windows is None else _kept(thin, reads)
    kept = lambda x: F.when(F.col("_kept"), x)
    per = thin.groupBy("source_id").agg(
        F.array_sort(F.collect_list(F.struct("read_idx", "row_idx", "sig"))).alias("_all"), F.flatten(F.collect_list(kept(F.array_compact(F.coalesce("labels", none))))).alias("_rows"),
        F.collect_list(kept(F.array_min("labels"))).alias("_starts"), F.bool_or(kept(F.coalesce(F.size("labels"), F.lit(0)) <= 0)).alias("_blank"),
    )
    said = F.coalesce(F.col("statement"), F.lit("")) != ""
    lists = [F.array_sort(F.coalesce(c, none)).alias(c) for c in ("non", "cont")]
    every = reads.select("source_id", F.struct("read_idx", F.col("error").isNull().alias("ok"), said.alias("said"), *lists).alias("r")).repartition("source_id")
    every = every.groupBy("source_id").agg(F.array_sort(F.collect_list("r")).alias("_reads"))  # MAX_READS at most
    j = every.join(per, "source_id", "left")
    if windows is None:
        j = j.withColumn("_windows", F.lit(None).cast("array<struct<first:int,last:int,row_count:int>>"))
    else:
        placed = windows.select("source_id", F.struct("first", "last", "row_count").alias("w")).repartition("source_id")
        j = j.join(placed.groupBy("source_id").agg(F.collect_list("w").alias("_windows")), "source_id", "left")

    def document(r: Column) -> Column:
        mine = F.transform(F.filter(F.col("_all"), lambda x: x["read_idx"] == r["read_idx"]), lambda x: x["sig"])
        listed = F.coalesce(mine, F.array().cast("array<binary>"))
        return F.struct(r["read_idx"].alias("at"), F.when(r["ok"], F.struct(((F.size(listed) == 0) & r["said"]).alias("empty"), listed.alias("rows"), r["non"].alias("non"), r["cont"].alias("cont"))).alias("doc"))

    j = j.withColumns({"_docs": F.transform("_reads", document), "_each_non": _listed(F.col("_reads"), "non"), "_each_cont": _listed(F.col("_reads"), "cont")}).drop("_all")
    again = F.filter(F.col("_docs"), lambda b: F.exists(F.col("_docs"), lambda a: (a["at"] < b["at"]) & (a["doc"] == b["doc"])))
    j = j.select(
        "source_id", F.array_min(F.transform(again, lambda d: d["at"])).alias("_later"), F.array_max(F.transform("_reads", lambda r: r["read_idx"])).alias("_last"), F.size(F.filter("_reads", lambda r: r["ok"])).alias("_usable"),
        "_windows", *[F.coalesce(c, none).alias(c) for c in ("_rows", "_starts")], F.coalesce("_blank", F.lit(False)).alias("_blank"), _repeated("_each_non").alias("_non"), _repeated("_each_cont").alias("_cont"),
    )

    def unaccounted(w: Column) -> Column:
        outside = lambda x: ~x.between(w["first"], w["last"])
        held = F.array_distinct(F.filter(F.concat("_rows", "_non", "_cont"), lambda x: ~outside(x)))
        return (
            F.exists("_rows", lambda x: (x < 1) | (x > w["row_count"])) | F.exists("_starts", outside) | F.exists("_non", outside) | F.exists("_cont", outside)
            | F.arrays_overlap("_non", "_rows") | F.arrays_overlap("_cont", "_non") | (F.size(held) < F.size(F.sequence(w["first"], w["last"]))) | F.col("_blank")
        )

    reason = (
        F.when(F.col("_later").isNotNull(), None).when(F.col("_last") < 2, "no read after the second").when(F.col("_windows").isNull(), "no two reads agree")
        .when(F.col("_usable") < 2, "fewer than two usable reads").when(F.exists("_windows", unaccounted), "voted rows do not account for the window")
    )
    voted = F.col("_later").isNull() & F.col("_reason").isNull()
    outcome = F.when(F.col("_later") == 1, "agreed").when(F.col("_later").isNotNull() | voted, "arbitrated").otherwise("failed")
    return j.withColumn("_reason", reason).select("source_id", outcome.alias("outcome"), F.when(F.col("_later") == 1, 0).otherwise(F.col("_later")).alias("read_idx"), voted.alias("voted"), F.col("_reason").alias("reason"))


def voted_statement(reads: DataFrame, rows: DataFrame) -> DataFrame:
    """``source_id, statement`` of votes without rows: that of the first usable read without rows."""
    usable = reads.where("error is null").join(rows.select("source_id", "read_idx").distinct(), ["source_id", "read_idx"], "left_anti")
    blank = usable.join(voted_rows(reads, rows).select("source_id").distinct(), "source_id", "left_anti")
    return blank.groupBy("source_id").agg(F.min_by("statement", "read_idx").alias("statement"))


def signatures(reads: DataFrame, rows: DataFrame) -> DataFrame:
    """``source_id, read_idx, sig``: a read's rows in order as one text; null for a failed read."""
    listed = rows.groupBy("source_id", "read_idx").agg(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("row_idx", "sig"))), lambda r: r["sig"])).alias("_sig"))
    return reads.join(listed, ["source_id", "read_idx"], "left").select("source_id", "read_idx", F.when(F.col("error").isNull(), F.coalesce("_sig", F.lit("[]"))).alias("sig"))


def third_reads(sigs: DataFrame) -> DataFrame:
    """Sources whose first two reads do not agree."""
    first = F.max(F.when(F.col("read_idx") == 0, F.col("sig")))
    second = F.max(F.when(F.col("read_idx") == 1, F.col("sig")))
    return sigs.groupBy("source_id").agg((first == second).alias("same")).where("not coalesce(same, false)").select("source_id")


def decide(sigs: DataFrame) -> DataFrame:
    """``source_id, outcome, read_idx``: agreed (first two alike), arbitrated (a later read like an earlier one) or failed."""
    alike = sigs.select("source_id", "read_idx", F.md5("sig").alias("sig")).repartition("source_id").groupBy("source_id", "sig").agg(F.array_sort(F.collect_set("read_idx")).alias("_reads"))  # MAX_READS at most
    later = alike.groupBy("source_id").agg(F.min(F.when(F.col("sig").isNotNull(), F.get("_reads", F.lit(1)))).alias("read_idx"))
    return later.select(
        "source_id", F.when(F.col("read_idx") == 1, "agreed").when(F.col("read_idx").isNotNull(), "arbitrated").otherwise("failed").alias("outcome"), F.when(F.col("read_idx") == 1, 0).otherwise(F.col("read_idx")).alias("read_idx")
    )


def vote_window(reads: DataFrame, rows: DataFrame) -> DataFrame:
    """``source_id, sig, copies``: rows that at least two usable reads share, as often as the second most frequent read has them.

    Reads that lack a row count it zero times. Sources of fewer than two usable reads are
    absent.
    """
    usable = reads.where("error is null").select("source_id", "read_idx")
    counts = rows.join(usable, ["source_id", "read_idx"], "left_semi").groupBy("source_id", "sig", "read_idx").agg(F.count(F.lit(1)).alias("n"))
    second = F.try_element_at(F.sort_array(F.collect_list("n"), asc=False), F.lit(2))  # one entry a read, MAX_READS at most
    return counts.groupBy("source_id", "sig").agg(second.cast("int").alias("copies")).where("copies is not null")


def disputed_pages(a: DataFrame, b: DataFrame) -> DataFrame:
    """``filing_id, page`` where two reads hold different rows, counting repeats. Both: ``filing_id, page, sig``."""
    count = lambda df, c: df.groupBy("filing_id", "page", "sig").agg(F.count(F.lit(1)).alias(c))
    j = count(a, "n").join(count(b, "m"), ["filing_id", "page", "sig"], "full_outer")
    return j.where(~F.col("n").eqNullSafe(F.col("m"))).select("filing_id", "page").distinct()


def page_shortfalls(listed: DataFrame, read: DataFrame) -> DataFrame:
    """Pages whose read has clearly fewer rows than the page lists. Both: ``filing_id, page, n``."""
    j = listed.join(read.withColumnRenamed("n", "m"), ["filing_id", "page"], "left").withColumn("m", F.coalesce("m", F.lit(0)))
    return j.where(F.col("n") - F.col("m") > F.greatest(F.lit(2), F.ceil(F.col("n") * F.lit(0.1).cast("double")))).select("filing_id", "page", "n", "m")


def outcome_counts(decisions: DataFrame) -> DataFrame:
    """``outcome, n``."""
    return decisions.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def parse_reads(requested: DataFrame, responses: DataFrame) -> DataFrame:
    """``source_id, rows, error`` of every requested source.

    ``responses``: ``source_id, body``; a body is a JSON object with ``rows`` and
    ``statement``. A source without an answer, with several, with one that does not parse,
    or with neither rows nor a statement has an error.
    """
    parsed = responses.withColumn("p", F.from_json("body", "struct<rows: array<string>, statement: string, finish: string>"))
    per = parsed.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.max("p").alias("p"))
    j = requested.select("source_id").join(per, "source_id", "left")
    rows = F.coalesce("p.rows", F.array().cast("array<string>"))
    error = (
        F.when(F.col("n").isNull(), "no answer").when(F.col("n") > 1, "answered more than once").when(F.col("p.finish").isin("length", "max_tokens"), "cut off")
        .when(F.col("p").isNull() | (F.col("p.rows").isNull() & F.col("p.statement").isNull()), "does not parse").when((F.size(rows) == 0) & F.col("p.statement").isNull(), "empty without a statement")
    )
    return j.select("source_id", error.alias("error"), F.when(error.isNull(), rows).otherwise(F.array().cast("array<string>")).alias("rows"))


def reconcile_queue(disputed: DataFrame, findings: DataFrame) -> DataFrame:
    """Pages to reconcile: disputed ones and those with a date finding."""
    return disputed.select("filing_id", "page").union(findings.select("filing_id", "page")).distinct()
