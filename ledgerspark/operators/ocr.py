"""Row labels of OCR text, windows over them, and proofs that reads account for every row.

Tables: ``lines(filing_id, page, line, label, is_table, text)``, ``windows(source_id,
filing_id, first, last, row_count)`` and ``marks(source_id, tx, label, role)``, one row
for each label that a read mentions: role ``row`` with the transaction's number,
``non`` (no transaction) or ``cont`` (continues an earlier window's).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Patterns and limits of the row and page checks.
BLANKS = r"[\t\n\x0B\f\r \p{Z}\x{FEFF}]*"
SEPARATOR = rf"\A\|{BLANKS}:?-{{3,}}"
DATED = r"\d{1,2}/\d{1,2}/\d{2,4}"
WORD_LETTERS, CONFIDENCE = 3, 80
MIN_REFERENCE_LETTERS, SHORTFALL = 40, 0.5
DECISIVE_LETTERS, DECISIVE_RATIO = 20, 2
WINDOW_LABELS, WINDOW_TABLE_ROWS = 120, 20
CONTEXT_PAGES = 2


def _kept_lines(pages: DataFrame) -> DataFrame:
    each = pages.select("filing_id", "page", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "text"))
    return each.where(~F.col("text").rlike(rf"\A{BLANKS}\z") & ~F.col("text").rlike(SEPARATOR))


def label_counts(pages: DataFrame) -> DataFrame:
    """``filing_id, n``: the last label of number_lines() in each filing that has one, without numbering its lines."""
    return _kept_lines(pages).groupBy("filing_id").agg(F.count(F.lit(1)).cast("int").alias("n"))


def number_lines(pages: DataFrame) -> DataFrame:
    """``filing_id, page, line, label, is_table, text`` of every non-blank line but table rules.

    Only a line of white space is blank, and only one that begins with a bar is of a
    table or a rule, so indented ones are text. Labels run over all pages of a filing.
    ``pages``: ``filing_id, page, text``. The window runs over one filing.
    """
    kept = _kept_lines(pages)
    order = Window.partitionBy("filing_id").orderBy("page", "line")
    return kept.select("filing_id", "page", "line", F.row_number().over(order).alias("label"), F.col("text").startswith("|").alias("is_table"), "text")


def dated_lines(pages: DataFrame) -> DataFrame:
    """``filing_id, page, dated``: lines with a date on each page."""
    return pages.select("filing_id", "page", F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(DATED))).alias("dated"))


def confident_letters(text: Column) -> Column:
    """Letters in words of at least three letters."""
    words = F.transform(F.split(F.coalesce(text, F.lit("")), r"[\s|]+"), lambda w: F.length(F.regexp_replace(w, r"[^\p{L}]", "")))
    return F.aggregate(F.filter(words, lambda n: n >= WORD_LETTERS), F.lit(0), lambda a, n: a + n)


def ocr_shortfall(letters: Column, reference: Column) -> Column:
    """Whether a page's transcription lacks at least half of what another engine saw."""
    return (reference >= MIN_REFERENCE_LETTERS) & (letters < reference * SHORTFALL)


def _tolerance(n: Column) -> Column:
    return F.greatest(F.lit(2), F.ceil(n * F.lit(0.1).cast("double")))


def ocr_disagreement(a: Column, b: Column) -> Column:
    """Whether two transcriptions differ in dated lines by more than chance."""
    return F.abs(a - b) > _tolerance(F.greatest(a, b))


def rotation_vote(scores: DataFrame) -> DataFrame:
    """``page_id, rotation, decisive``: the rotation with most letters, ties to the smaller one. ``scores``: ``page_id, rotation, letters``."""
    w = Window.partitionBy("page_id").orderBy(F.col("letters").desc(), "rotation")
    ranked = scores.select("page_id", "rotation", "letters", F.row_number().over(w).alias("n"), F.lead("letters").over(w).alias("runner_up"))
    decisive = (F.col("letters") >= DECISIVE_LETTERS) & (F.col("letters") >= DECISIVE_RATIO * F.coalesce("runner_up", F.lit(0)))
    return ranked.where("n = 1").select("page_id", "rotation", decisive.alias("decisive"))


def largest_box(boxes: DataFrame) -> DataFrame:
    """``page_id, x0, y0, x1, y1`` of the largest box with an area; ties to the first by coordinates."""
    b = F.struct("x0", "y0", "x1", "y1")
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    valid = boxes.where("x1 > x0 and y1 > y0").withColumn("_area", area)
    best = valid.groupBy("page_id").agg(F.max("_area").alias("_area"))
    return valid.join(best, ["page_id", "_area"]).groupBy("page_id").agg(F.min(b).alias("b")).select("page_id", "b.*")


def row_ranges(labels: DataFrame, by: list[str]) -> DataFrame:
    """Runs of consecutive labels: ``by..., first, last``."""
    w = Window.partitionBy(*by).orderBy("label")
    runs = labels.select(*by, "label").distinct().withColumn("_run", F.col("label") - F.row_number().over(w))
    return runs.groupBy(*by, "_run").agg(F.min("label").alias("first"), F.max("label").alias("last")).drop("_run")


def coverage_gaps(windows: DataFrame, marks: DataFrame) -> DataFrame:
    """``source_id, label`` of labels inside a window that its read does not mention."""
    owed = windows.select("source_id", F.explode(F.sequence("first", "last")).alias("label"))
    return owed.join(marks.select("source_id", "label"), ["source_id", "label"], "left_anti")


def _starts(marks: DataFrame) -> DataFrame:
    return marks.where("role = 'row'").groupBy("source_id", "tx").agg(F.min("label").alias("start"))


def coverage_problems(windows: DataFrame, marks: DataFrame) -> DataFrame:
    """``source_id, problem, label`` of every contradiction inside one window's read.

    All of them are seen on one row a label, which says in what roles it is marked and
    whether a transaction starts there, so marks are read once.
    """
    row = F.col("role") == "row"
    start = F.min(F.when(row, F.col("label"))).over(Window.partitionBy("source_id", "tx"))
    has = lambda test, name: F.coalesce(F.bool_or(test), F.lit(False)).alias(name)
    each = marks.select("source_id", "role", "label", (row & (F.col("label") == start)).alias("_start")).groupBy("source_id", "label").agg(
        has(row, "_row"), has(F.col("role") == "non", "_non"), has(F.col("role") == "cont", "_cont"), has("_start", "_starts")
    )
    outside = ~F.col("label").between(F.col("first"), F.col("last"))
    rules = [
        (F.col("_row") & F.col("row_count").isNotNull() & ((F.col("label") < 1) | (F.col("label") > F.col("row_count"))), "cites a row outside the filing"),
        (F.col("_starts") & outside, "starts outside its window"),
        (F.col("_non") & outside, "no transaction outside its window"),
        (F.col("_cont") & outside, "continuation outside its window"),
        (F.col("_non") & F.col("_row"), "both in a transaction and none"),
        (F.col("_cont") & F.col("_non"), "both a continuation and no transaction"),
    ]
    placed = each.join(windows.select("source_id", "first", "last", "row_count"), "source_id", "left")
    return placed.select("source_id", F.explode(F.array_compact(F.array(*[F.when(test, problem) for test, problem in rules]))).alias("problem"), "label")


def normalize_read(windows: DataFrame, marks: DataFrame) -> DataFrame:
    """Marks reduced to what each window owns.

    Transactions that start before the window leave, and their labels inside become
    continuations; those that start after it leave; other marks outside leave.
    """
    row = F.col("role") == "row"
    m = marks.select("source_id", "tx", "label", "role").withColumn("_start", F.when(F.col("tx").isNotNull(), F.min(F.when(row, F.col("label"))).over(Window.partitionBy("source_id", "tx"))))
    m = m.join(windows.select("source_id", "first", "last"), "source_id")
    inside, earlier = F.col("label").between(F.col("first"), F.col("last")), F.coalesce(row & (F.col("_start") < F.col("first")), F.lit(False))
    kept = m.where(F.when(row & ~earlier, F.col("_start") <= F.col("last")).otherwise(inside))
    return kept.select("source_id", F.when(~earlier, F.col("tx")).alias("tx"), "label", F.when(earlier, "cont").otherwise(F.col("role")).alias("role")).distinct()


def coverage_filing(windows: DataFrame, marks: DataFrame) -> DataFrame:
    """``source_id, problem, label`` of contradictions between a filing's windows; a label in no window has a null source.

    A continuation needs a transaction that holds the label and starts before the
    window; a label listed as no transaction may be in none that starts elsewhere.
    """
    w = windows.select("source_id", "filing_id", "first", "last")
    held = marks.where("role = 'row'").join(_starts(marks), ["source_id", "tx"]).join(w.select("source_id", "filing_id"), "source_id").select("filing_id", "label", F.col("start").alias("_start")).distinct()
    mine = marks.where("role <> 'row'").select("source_id", "role", "label").distinct().join(w, "source_id")
    both = mine.join(held, ["filing_id", "label"], "left")
    earlier, elsewhere = F.col("_start") < F.col("first"), ~F.col("_start").between(F.col("first"), F.col("last"))
    per = both.groupBy("source_id", "role", "label").agg(F.coalesce(F.bool_or(earlier), F.lit(False)).alias("backed"), F.coalesce(F.bool_or(elsewhere), F.lit(False)).alias("read"))
    bad = per.where("(role = 'cont' and not backed) or (role = 'non' and read)").select("source_id", F.when(F.col("role") == "cont", "continuation that nothing backs").otherwise("no transaction here but one elsewhere").alias("problem"), "label")
    every = windows.groupBy("filing_id").agg(F.max("row_count").alias("n")).select("filing_id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("label"))
    covered = windows.select("filing_id", F.explode(F.sequence("first", "last")).alias("label")).distinct()
    none = every.join(covered, ["filing_id", "label"], "left_anti").select(F.lit(None).cast("string").alias("source_id"), F.lit("row in no window").alias("problem"), "label")
    return bad.unionByName(none)


def gap_ranges(windows: DataFrame, marks: DataFrame) -> DataFrame:
    """Ranges to read again, of reads whose only defect is labels without a mark."""
    sound = coverage_gaps(windows, marks).join(coverage_problems(windows, marks).select("source_id").distinct(), "source_id", "left_anti")
    return row_ranges(sound, ["source_id"])


def merge_gaps(marks: DataFrame, windows: DataFrame, fills: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(marks, problems)`` with gap reads merged in.

    ``fills``: ``source_id, gap_first, tx, label, role``; their transactions get numbers
    of their own, beyond those of any read. A fill's continuations extend the one transaction that holds the row
    above the gap, or stay continuations when the gap opens the window; no or several
    such transactions are a problem. Of the marks, only those above a gap are searched for
    owners; all are shuffled once more, to be made distinct.
    """
    first = windows.select("source_id", "first")
    opening = fills.join(first, "source_id").withColumn("_opens", F.col("gap_first") == F.col("first"))
    conts = opening.where("role = 'cont' and not _opens")
    above = marks.where("role = 'row'").select("source_id", F.col("tx").alias("_owner"), (F.col("label") + 1).alias("gap_first"))
    beside = above.join(conts.select("source_id", "gap_first"), ["source_id", "gap_first"], "left_semi")
    owners = beside.groupBy("source_id", "gap_first").agg(F.min("_owner").alias("_owner"), F.max("_owner").alias("_other"))
    owned = conts.join(owners, ["source_id", "gap_first"], "left")
    extended = owned.where("_owner = _other").select("source_id", F.col("_owner").alias("tx"), "label", F.lit("row").alias("role"))
    problems = owned.where("_owner is null or _owner < _other").select("source_id", (F.col("gap_first") - 1).alias("label"), F.when(F.col("_owner").isNull(), "no transaction").otherwise("more than one transaction").alias("holders")).distinct()
    plain = opening.where("role <> 'cont' or _opens").select("source_id", F.when(F.col("role") == "row", F.shiftleft(F.col("gap_first").cast("long"), 32) + F.col("tx")).alias("tx"), "label", "role")
    return marks.select("source_id", "tx", "label", "role").unionByName(extended).unionByName(plain).distinct(), problems


def band_fractions(windows: DataFrame, lines: DataFrame) -> DataFrame:
    """``source_id, page, top, bottom``: where a window's table rows lie among the page's, as fractions."""
    page = Window.partitionBy("filing_id", "page")
    t = lines.where("is_table").select("filing_id", "page", "label", F.row_number().over(page.orderBy("label")).alias("n"), F.count(F.lit(1)).over(page).alias("of"))
    hit = t.join(windows, "filing_id").where(F.col("label").between(F.col("first"), F.col("last")))
    return hit.groupBy("source_id", "page").agg(F.round((F.min("n") - 1) / F.max("of"), 6).alias("top"), F.round(F.max("n") / F.max("of"), 6).alias("bottom"))


def split_ranges(filings: DataFrame, pages_each: int) -> DataFrame:
    """``filing_id, chunk, page_start, page_end`` of ``filing_id, pages``."""
    starts = F.posexplode(F.sequence(F.lit(1), "pages", F.lit(pages_each))).alias("chunk", "page_start")
    return filings.where("pages > 0").select("filing_id", "pages", starts).select("filing_id", "chunk", "page_start", F.least(F.col("page_start") + pages_each - 1, "pages").alias("page_end"))


def merge_ranges(results: DataFrame) -> DataFrame:
    """One result for each filing from its ranges, in chunk order: ``filing_id, rows, statement, error``.

    ``results``: ``filing_id, chunk, rows array<string>, statement, error``. The first
    statement wins and errors are joined.
    """
    parts = F.array_sort(F.collect_list(F.struct("chunk", "rows", "statement", "error")))
    g = results.groupBy("filing_id").agg(parts.alias("p"))
    return g.select(
        "filing_id",
        F.flatten(F.transform("p", lambda x: x["rows"])).alias("rows"),
        F.get(F.filter(F.transform("p", lambda x: x["statement"]), lambda s: s.isNotNull()), F.lit(0)).alias("statement"),
        F.nullif(F.array_join(F.filter(F.transform("p", lambda x: x["error"]), lambda e: e.isNotNull()), "; "), F.lit("")).alias("error"),
    )


def _cut(labels: int, table_rows: int, max_pages: int | None):
    def work(lines: pd.DataFrame) -> pd.DataFrame:
        """Windows of one filing: cut where the next line would pass a limit."""
        lines = lines.sort_values("label")
        out, first, page, n, t = [], None, 0, 0, 0
        for label, is_table, at in zip(lines["label"], lines["is_table"], lines["page"], strict=True):
            wide = max_pages is not None and at - page + 1 + CONTEXT_PAGES > max_pages
            if first is not None and (n >= labels or (is_table and t >= table_rows) or wide):
                out.append((first, label - 1))
                first, n, t = None, 0, 0
            if first is None:
                first, page = label, at
            n, t = n + 1, t + bool(is_table)
        if first is not None:
            out.append((first, int(lines["label"].iloc[-1])))
        filing, count = lines["filing_id"].iloc[0], int(lines["label"].iloc[-1])
        return pd.DataFrame([(f"{filing}:w{i}", filing, a, b, count) for i, (a, b) in enumerate(out, 1)], columns=["source_id", "filing_id", "first", "last", "row_count"])

    return work


def plan_windows(lines: DataFrame, labels: int = WINDOW_LABELS, table_rows: int = WINDOW_TABLE_ROWS, max_pages: int | None = None) -> DataFrame:
    """``source_id, filing_id, first, last, row_count``: windows in order, from ``:w1``.

    With ``max_pages`` a window with its context pages spans no more pages than that,
    where its first line's page allows. Each cut depends on the one before, so a filing is
    planned by one pandas call over its labels.
    """
    if max_pages is not None and max_pages < 1 + CONTEXT_PAGES:
        raise ValueError(f"max_pages must be at least {1 + CONTEXT_PAGES}")
    page = F.lit(1) if max_pages is None else F.col("page")
    return lines.select("filing_id", "label", "is_table", page.alias("page")).groupBy("filing_id").applyInPandas(_cut(labels, table_rows, max_pages), "source_id string, filing_id string, first int, last int, row_count int")


def window_attachments(windows: DataFrame, lines: DataFrame, pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """``source_id, filing_id, first, last, page_start, page_end, total_pages, table_rows`` of what is sent for each filing.

    A window goes with the pages beside its own. A filing of one window at most, whose
    pages fit ``max_pages``, goes whole under its own id; ``first`` and ``last`` are null
    where it has no line. ``windows`` from plan_windows() of ``lines`` from number_lines()
    of ``pages``.
    """
    total = pages.groupBy("filing_id").agg(F.max("page").alias("total_pages"))
    spans = (
        windows.join(lines.select("filing_id", "label", "page", "is_table"), "filing_id").where((F.col("label") >= F.col("first")) & (F.col("label") <= F.col("last")))
        .groupBy("source_id", "filing_id", "first", "last").agg(F.min("page").alias("_a"), F.max("page").alias("_b"), F.count_if("is_table").alias("table_rows"))
    )
    j = total.join(spans, "filing_id", "left").withColumn("_n", F.count("source_id").over(Window.partitionBy("filing_id")))
    whole = (F.col("_n") == 0) | ((F.col("_n") == 1) & (F.col("total_pages") <= F.lit(max_pages if max_pages is not None else (1 << 31) - 1)))
    return j.select(
        F.when(whole, F.col("filing_id")).otherwise(F.col("source_id")).alias("source_id"), "filing_id", "first", "last",
        F.when(whole, F.lit(1)).otherwise(F.greatest(F.lit(1), F.col("_a") - 1)).alias("page_start"), F.when(whole, F.col("total_pages")).otherwise(F.least("total_pages", F.col("_b") + 1)).alias("page_end"),
        "total_pages", F.coalesce("table_rows", F.lit(0).cast("long")).alias("table_rows"),
    )


# Ids of what is read, labels in a text, and the lines that mark a window in its context.
def gap_id(source: Column, first: Column, last: Column) -> Column:
    return F.concat(source, F.lit(":g"), first.cast("string"), F.lit("-"), last.cast("string"))


def page_range_id(filing: Column, start: Column, end: Column) -> Column:
    return F.concat(filing, F.lit(":p"), start.cast("string"), F.lit("-"), end.cast("string"))


def source_read_id(filing: Column, page: Column) -> Column:
    return F.concat(filing, F.lit(":s"), page.cast("string"))


def labelled(label: Column, is_table: Column, text: Column) -> Column:
    """A line with its label: as first cell of a table's row, else in brackets; a line without a label as it is."""
    name = F.concat(F.lit("R"), label.cast("string"))
    return F.when(label.isNull(), text).when(is_table, F.concat(F.lit("| "), name, F.lit(" "), text)).otherwise(F.concat(F.lit("["), name, F.lit("] "), text))


def window_marker(first: Column, last: Column, edge: str) -> Column:
    return F.concat(F.lit("=== ROW WINDOW R"), first.cast("string"), F.lit("-R"), last.cast("string"), F.lit(f" {edge} ==="))


def marked_windows(attachments: DataFrame, pages: DataFrame, lines: DataFrame) -> DataFrame:
    """``source_id, page, text`` of what is sent for each attachment: its pages, lines labelled, its window marked.

    One marker line stands before the window's first labelled line and one after its last.
    A filing that goes whole under its own id has no markers. ``attachments`` from
    window_attachments(); ``lines`` from number_lines() of ``pages``. Lines are put
    together again a page at a time.
    """
    raw = pages.select("filing_id", "page", F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line", "_raw"))
    named = lines.select("filing_id", "page", "line", "label", "is_table")
    each = raw.join(named, ["filing_id", "page", "line"], "left").select("filing_id", "page", (F.col("line") * 2 + 1).alias("_at"), labelled(F.col("label"), F.col("is_table"), F.col("_raw")).alias("_text"))
    sent = attachments.select("source_id", F.col("filing_id").alias("_f"), "first", "last", "page_start", "page_end")
    body = each.join(sent, (F.col("filing_id") == F.col("_f")) & F.col("page").between(F.col("page_start"), F.col("page_end"))).select("source_id", "page", "_at", "_text")
    marked = sent.where("first is not null and source_id <> _f")
    place = named.select(F.col("filing_id").alias("_f"), "page", "line", F.col("label").alias("_label"))
    for edge, label, shift in (("BEGINS", "first", 0), ("ENDS", "last", 2)):
        at = marked.withColumn("_label", F.col(label)).join(place, ["_f", "_label"])
        body = body.unionByName(at.select("source_id", "page", (F.col("line") * 2 + shift).alias("_at"), window_marker(F.col("first"), F.col("last"), edge).alias("_text")))
    listed = F.array_sort(F.collect_list(F.struct("_at", "_text")))  # a page's lines
    return body.groupBy("source_id", "page").agg(F.array_join(F.transform(listed, lambda x: x["_text"]), "\n").alias("text"))
