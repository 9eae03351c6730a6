"""Queries of disputes between reads and of repair decisions."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.operators import repair as R
from ledgerspark.scratch import written

from .registry import Lake, query


class _Reads:
    """Two reads of every filing's lines, and decided reads: some fail or are missing, rows are lost, misread, unplaced or without an asset, dates are misread."""

    def __init__(self, k: Lake):
        page, window = F.expr("cast((label + 1) div 2 AS int)"), F.expr("concat(filing_id, ':w', (label - 1) div 4)")
        self.lines = written(k.read_lines.withColumns({"page": page, "source_id": window}), "lines")[0]

    def _rows(self, day: str = "transaction") -> DataFrame:
        return self.lines.select(
            "source_id", "filing_id", "page", "label", "l_partkey", "l_suppkey", F.col("label").alias("row_idx"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("sig"),
            F.expr("CASE WHEN l_partkey % 29 = 0 THEN cast(array() AS array<int>) ELSE array(label) END").alias("labels"), F.expr(day).alias("transaction"), "notification",
            F.expr("CASE WHEN l_partkey % 23 = 0 THEN ' ' ELSE asset_description END").alias("asset"),
        )

    @cached_property
    def _windows(self) -> DataFrame:
        """Windows with their least part, which decides how they were read; written once, as many steps meet them."""
        per = self.lines.groupBy("source_id", "filing_id", "filed_on")
        return written(per.agg(F.min("label").alias("first"), F.max("label").alias("last"), F.min("page").alias("page_start"), F.max("page").alias("page_end"), F.min("l_partkey").alias("p")), "windows")[0]

    @cached_property
    def _pages(self) -> DataFrame:
        return written(self.lines.groupBy("filing_id", "page").agg(F.min("label").alias("first_label"), F.max("label").alias("last_label"), F.min("l_partkey").alias("p")), "pages")[0]

    @cached_property
    def windows(self) -> DataFrame:
        return self._windows.drop("p")

    @cached_property
    def spans(self) -> DataFrame:
        return self._pages.drop("p")

    @cached_property
    def text_reads(self) -> DataFrame:
        return self._windows.where("p % 17 <> 0").select("source_id", F.expr("CASE WHEN p % 13 = 0 THEN 'cut off' END").alias("error"))

    @cached_property
    def text_rows(self) -> DataFrame:
        return self._rows().where("l_suppkey % 9 <> 0")

    @cached_property
    def page_reads(self) -> DataFrame:
        return self._pages.where("p % 31 <> 0").select("filing_id", "page", F.expr("CASE WHEN p % 19 = 0 THEN 'timeout' END").alias("error"))

    @cached_property
    def page_rows(self) -> DataFrame:
        return self._rows().withColumn("sig", F.expr("CASE WHEN l_suppkey % 8 = 0 THEN concat('q', sig) ELSE sig END"))

    @cached_property
    def decisions(self) -> DataFrame:
        """By the window's least part: failed, agreed or arbitrated; some without rows, of these some with a statement."""
        return self._windows.selectExpr("source_id", "CASE WHEN p % 7 = 0 THEN 'failed' WHEN p % 2 = 0 THEN 'arbitrated' ELSE 'agreed' END AS outcome", "cast(NULL AS string) AS error", "CASE WHEN p % 10 = 4 THEN 'nothing to report' END AS statement", "p")

    def decided_rows(self, day: str) -> DataFrame:
        """Rows of decided reads, none of windows whose least part leaves 1 or 4 in tens; dates misread by ``day``."""
        return self._rows(day).join(self.decisions.where("p % 10 NOT IN (1, 4)").select("source_id"), "source_id", "left_semi")

    @cached_property
    def findings(self) -> DataFrame:
        none = self.decisions.where("p % 14 <> 0").selectExpr("source_id", "error", "statement")
        return R.repair_findings(self.windows, self.decisions, self.decided_rows(_MISREAD), none, self.decided_rows(_MISREAD), self.text_reads, self.text_rows)


_MISREAD = "CASE WHEN l_partkey % 5 = 0 THEN transaction + 400 ELSE transaction END"
_STILL = "CASE WHEN l_partkey % 15 = 0 THEN transaction + 400 ELSE transaction END"

#: The same reads in SQL.
_SQL = """WITH ln AS (SELECT *, cast((label + 1) // 2 AS int) AS page, filing_id || ':w' || ((label - 1) // 4) AS source_id FROM read_lines),
    wn AS (SELECT source_id, filing_id, filed_on, min(page) AS p0, max(page) AS p1, min(l_partkey) AS p FROM ln GROUP BY 1, 2, 3),
    pg AS (SELECT filing_id, page, min(l_partkey) AS p FROM ln GROUP BY 1, 2),
    wp AS (SELECT DISTINCT source_id, filing_id, filed_on, page FROM ln),
    tr AS (SELECT ln.*, l_partkey % 29 = 0 AS nowhere, CASE WHEN l_partkey % 29 = 0 THEN 'a row' || CASE WHEN l_partkey % 23 = 0 THEN '' ELSE ' (' || asset_description || ')' END ELSE 'the row labeled ' || label END AS which
      FROM ln JOIN wn USING (source_id) WHERE p % 17 <> 0 AND p % 13 <> 0 AND l_suppkey % 9 <> 0)"""
_TOLD = """unnest(list_filter([CASE WHEN {t} > filed_on THEN 'transaction date ' || {t} || ' is after the report was filed on ' || filed_on END,
      CASE WHEN notification - filed_on > 30 THEN 'notification date ' || notification || ' is more than a month after the report was filed on ' || filed_on END,
      CASE WHEN {t} - notification > 30 THEN 'transaction date ' || {t} || ' is more than a month after its notification date ' || notification END,
      CASE WHEN notification - {t} > 365 THEN 'transaction date ' || {t} || ' is more than a year before its notification date ' || notification END], lambda x: x IS NOT NULL))"""

query(
    "disputed_pages",
    _SQL + """,
    lost AS (SELECT source_id FROM wn WHERE p % 17 = 0 OR p % 13 = 0 UNION SELECT source_id FROM tr WHERE nowhere),
    a AS (SELECT filing_id, page, list_sort(list(l_partkey)) AS rows FROM tr WHERE source_id NOT IN (SELECT source_id FROM lost) GROUP BY 1, 2),
    b AS (SELECT filing_id, page, list_sort(list(CASE WHEN l_suppkey % 8 = 0 THEN -l_partkey ELSE l_partkey END)) AS rows FROM ln GROUP BY 1, 2)
    SELECT DISTINCT wp.filing_id, wp.page FROM wp JOIN pg USING (filing_id, page) LEFT JOIN a ON a.filing_id = wp.filing_id AND a.page = wp.page LEFT JOIN b ON b.filing_id = wp.filing_id AND b.page = wp.page
    WHERE wp.source_id IN (SELECT source_id FROM lost) OR pg.p % 31 = 0 OR pg.p % 19 = 0 OR coalesce(a.rows, []) <> coalesce(b.rows, [])""",
    ("read_lines",),
)(lambda k: (lambda r: R.disputed_pages(r.windows, r.spans, r.text_reads, r.text_rows, r.page_reads, r.page_rows))(_Reads(k)))
query(
    "page_date_findings",
    _SQL + f""",
    a AS (SELECT filing_id, page, 'Read A (OCR text alone), ' || which AS who, {_TOLD.format(t="transaction")} AS f FROM tr WHERE NOT nowhere),
    b AS (SELECT ln.filing_id, page, 'Read B (the filed pages alone), a row on page ' || page || CASE WHEN l_partkey % 23 = 0 THEN '' ELSE ' (' || asset_description || ')' END AS who, {_TOLD.format(t="transaction")} AS f
      FROM ln JOIN pg USING (filing_id, page) WHERE p % 31 <> 0 AND p % 19 <> 0)
    SELECT filing_id, page, who || ': ' || f AS finding FROM a UNION SELECT filing_id, page, who || ': ' || f FROM b""",
    ("read_lines",),
)(lambda k: (lambda r: R.date_findings_by_page(r.windows, r.spans, r.text_reads, r.text_rows, r.page_reads, r.page_rows))(_Reads(k)))


def _seen(r: _Reads) -> DataFrame:
    errors, rows = R.source_read(r.windows, r.spans, r.page_reads, r.page_rows)
    return errors.join(rows.groupBy("source_id").agg(F.count(F.lit(1)).alias("rows")), "source_id", "left").select("source_id", "error", F.coalesce("rows", F.lit(0)).alias("rows"))


query(
    "source_reads",
    _SQL + """
    SELECT wp.source_id, string_agg(CASE WHEN p % 31 = 0 THEN 'page ' || page || ': no answer' WHEN p % 19 = 0 THEN 'page ' || page || ': timeout' END, '; ' ORDER BY page) AS error, cast(sum(n) AS bigint) AS rows
    FROM wp JOIN pg USING (filing_id, page) JOIN (SELECT filing_id, page, count(*) AS n FROM ln GROUP BY 1, 2) c USING (filing_id, page) GROUP BY 1""",
    ("read_lines",),
)(lambda k: _seen(_Reads(k)))

_KEPT = """,
    dr AS (SELECT ln.*, {day} AS t, CASE WHEN p % 7 = 0 THEN 'failed' WHEN p % 2 = 0 THEN 'arbitrated' ELSE 'agreed' END AS outcome FROM ln JOIN wn USING (source_id) WHERE p % 10 NOT IN (1, 4)),
    kept AS (SELECT d.source_id, d.label AS row_idx, d.outcome, d.filed_on, d.t, d.notification, 'the row labeled ' || d.label AS which,
        ', where Read A (OCR text alone) gives transaction date ' || coalesce(cast(x.transaction AS varchar), 'none') || ' and notification date ' || coalesce(cast(x.notification AS varchar), 'none') AS gives
      FROM dr d JOIN tr x ON x.source_id = d.source_id AND x.label = d.label AND NOT x.nowhere
      WHERE (d.t IS NULL OR x.transaction IS NOT NULL) AND (d.notification IS NULL OR x.notification IS NOT NULL)
        AND NOT coalesce(x.transaction > x.filed_on OR x.notification - x.filed_on > 30 OR x.transaction - x.notification > 30 OR x.notification - x.transaction > 365, false)),
    kf AS (SELECT source_id, row_idx, outcome, which || ': ' || f || gives AS finding FROM (SELECT *, """ + _TOLD.format(t="t") + """ AS f FROM kept) q)"""
_DAY, _STILL_SQL = ("CASE WHEN l_partkey % {} = 0 THEN transaction + 400 ELSE transaction END".format(n) for n in (5, 15))
query("kept_dates", _SQL + _KEPT.format(day=_DAY) + " SELECT source_id, row_idx, finding FROM kf", ("read_lines",))(
    lambda k: (lambda r: R.kept_date_findings(r.windows, r.decided_rows(_MISREAD), r.text_reads, r.text_rows))(_Reads(k))
)
_FOUND = """,
    silent AS (SELECT source_id FROM wn WHERE p % 10 = 1 AND (p % 7 <> 0 OR p % 14 <> 0)),
    quiet AS (SELECT filing_id FROM wn GROUP BY 1 HAVING bool_and(source_id IN (SELECT source_id FROM silent))),
    alone AS (SELECT source_id FROM wn WHERE filing_id IN (SELECT filing_id FROM quiet)),
    fd AS (SELECT source_id, 'asset' AS kind, CASE WHEN l_partkey % 29 = 0 THEN 'a row' ELSE 'the row labeled ' || label END || ' has no asset name' AS finding FROM dr WHERE outcome <> 'failed' AND l_partkey % 23 = 0 AND source_id NOT IN (SELECT source_id FROM alone)
      UNION ALL SELECT source_id, 'kept_date', finding FROM kf WHERE outcome = 'arbitrated' AND source_id NOT IN (SELECT source_id FROM alone)
      UNION ALL SELECT source_id, 'empty_read', 'No read of this report found a transaction or a statement that it has none.' FROM alone)"""
query("repair_queue", _SQL + _KEPT.format(day=_DAY) + _FOUND + " SELECT * FROM fd", ("read_lines",))(lambda k: _Reads(k).findings)


def _settled(r: _Reads) -> DataFrame:
    """Repair reads of all windows but those whose least part divides by 11, in which a third of the misread dates stay."""
    repaired = r.decisions.where("p % 11 <> 0").select("source_id", F.expr("CASE WHEN p % 37 = 0 THEN 'timeout' END").alias("error"))
    rows = r.decided_rows(_STILL).withColumn("asset", F.expr("CASE WHEN l_partkey % 46 = 0 THEN '' ELSE coalesce(nullif(trim(asset), ''), 'A') END"))
    return R.settled(r.windows, r.findings, repaired, rows, r.text_reads, r.text_rows)


query(
    "repair_settles",
    _SQL + _KEPT.format(day=_DAY) + _FOUND + """,
    dr2 AS (SELECT ln.*, """ + _STILL_SQL + """ AS t FROM ln JOIN wn USING (source_id) WHERE p % 10 NOT IN (1, 4)),
    still AS (SELECT DISTINCT d.source_id FROM dr2 d JOIN tr x ON x.source_id = d.source_id AND x.label = d.label AND NOT x.nowhere
      WHERE (d.t IS NULL OR x.transaction IS NOT NULL) AND (d.notification IS NULL OR x.notification IS NOT NULL)
        AND NOT coalesce(x.transaction > x.filed_on OR x.notification - x.filed_on > 30 OR x.transaction - x.notification > 30 OR x.notification - x.transaction > 365, false)
        AND coalesce(d.t > d.filed_on OR d.notification - d.filed_on > 30 OR d.t - d.notification > 30 OR d.notification - d.t > 365, false)),
    blank AS (SELECT DISTINCT source_id FROM dr2 WHERE l_partkey % 46 = 0)
    SELECT source_id, p % 11 <> 0 AND p % 37 <> 0 AND NOT (bool_or(kind = 'asset') AND source_id IN (SELECT source_id FROM blank)) AND NOT (bool_or(kind = 'kept_date') AND source_id IN (SELECT source_id FROM still)) AS settles
    FROM fd JOIN wn USING (source_id) GROUP BY source_id, p""",
    ("read_lines",),
)(lambda k: _settled(_Reads(k)))
