"""Queries of OCR rows, coverage proofs, planners and consensus."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ledgerspark.operators import consensus as C
from ledgerspark.operators import ocr as O
from ledgerspark.operators import packing as P
from ledgerspark.operators import passes as RP
from ledgerspark.scratch import shared_path

from .registry import Lake, query

_RAW = "r AS (SELECT filing_id, page, unnest(string_split(coalesce(text, ''), chr(10))) AS text, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line FROM ocr)"
_LINES = _RAW + r""",
    lines AS (SELECT filing_id, page, cast(line AS int) AS line, cast(row_number() OVER (PARTITION BY filing_id ORDER BY page, line) AS int) AS label, starts_with(text, '|') AS is_table, text FROM r
              WHERE NOT regexp_full_match(text, '[\t\v\f\r \p{Z}\x{FEFF}]*') AND NOT regexp_matches(text, '^\|[\t\v\f\r \p{Z}\x{FEFF}]*:?-{3,}'))"""
# Windows of 20 labels, and marks that follow a fixed rule on the label with planted contradictions.
_WIN = """,
    sizes AS (SELECT filing_id, max(label) AS n FROM lines GROUP BY 1),
    windows AS (SELECT filing_id || ':w' || (s // 20) AS source_id, filing_id, cast(s + 1 AS int) AS first, cast(least(s + 20, n) AS int) AS last, cast(n AS int) AS row_count FROM (SELECT filing_id, n, unnest(generate_series(0, n - 1, 20)) AS s FROM sizes)),
    marks AS (
      SELECT source_id, CASE WHEN label % 10 < 6 THEN label // 3 END AS tx, label, CASE WHEN label % 10 < 6 THEN 'row' WHEN label % 10 < 8 THEN 'non' WHEN label % 10 = 8 THEN 'cont' END AS role
        FROM (SELECT source_id, cast(unnest(generate_series(first, last)) AS int) AS label FROM windows) WHERE label % 10 < 9
      UNION ALL SELECT source_id, NULL, last, 'non' FROM windows WHERE first % 3 = 0
      UNION ALL SELECT source_id, NULL, first, 'cont' FROM windows WHERE first % 7 = 0
      UNION ALL SELECT source_id, cast(9000 AS int), cast(last + 1 AS int), 'row' FROM windows WHERE first % 11 = 0
      UNION ALL SELECT source_id, cast(9001 AS int), cast(first - 1 AS int), 'row' FROM windows WHERE first % 13 = 0
      UNION ALL SELECT source_id, cast(9001 AS int), first, 'row' FROM windows WHERE first % 13 = 0
      UNION ALL SELECT source_id, NULL, cast(first - 1 AS int), 'cont' FROM windows WHERE first % 17 = 0)"""
_OCR = ("ocr",)


def _with(more: str, windows: bool = True) -> str:
    return f"WITH {_LINES}{_WIN if windows else ''}{more}"


def lines(k: Lake):
    return O.number_lines(k.ocr)


def windows(k: Lake):
    n = O.label_counts(k.ocr)
    return n.select("filing_id", "n", F.explode(F.expr("sequence(0, n - 1, 20)")).alias("s")).select(
        F.concat("filing_id", F.lit(":w"), F.expr("s div 20").cast("string")).alias("source_id"), "filing_id", (F.col("s") + 1).alias("first"), F.least(F.col("s") + 20, "n").alias("last"), F.col("n").alias("row_count")
    )


#: Windows that one task makes marks of.
WINDOWS_A_TASK = 10_000


def _windowed(k: Lake):
    """The windows written once, for all that is made of them: the texts are split once."""
    return _written(k, windows(k), "windows")


def marks(w):
    """The marks of windows that are written: derived anew for each use. Windows are dealt by number, as few bytes of them make many marks.

    A window's marks are made together and not as a union of the regular and the planted ones:
    Spark 4.1 may plan with how a union is dealt and then run it dealt otherwise.
    """
    w = w.repartition(1 + w.count() // WINDOWS_A_TASK, "source_id")
    said = lambda tx, label, role: F.struct(tx.cast("int").alias("tx"), label.cast("int").alias("label"), role.alias("role"))
    regular = F.transform(
        F.filter(F.sequence("first", "last"), lambda x: x % 10 < 9),
        lambda x: said(F.when(x % 10 < 6, F.floor(x / 3)), x, F.when(x % 10 < 6, "row").when(x % 10 < 8, "non").otherwise("cont")),
    )
    planted = [
        F.when(F.expr(test), said(F.lit(tx), F.expr(label), F.lit(r)))
        for test, tx, label, r in (
            ("first % 3 = 0", None, "last", "non"), ("first % 7 = 0", None, "first", "cont"), ("first % 11 = 0", 9000, "last + 1", "row"),
            ("first % 13 = 0", 9001, "first - 1", "row"), ("first % 13 = 0", 9001, "first", "row"), ("first % 17 = 0", None, "first - 1", "cont"),
        )
    ]
    return w.select("source_id", F.inline(F.concat(regular, F.array_compact(F.array(*planted)))))


query("number_lines", _with(" SELECT filing_id, page, line, label, is_table, md5(text) AS text FROM lines", False), _OCR)(lambda k: lines(k).withColumn("text", F.md5("text")))
query("dated_lines", "SELECT filing_id, page, cast(coalesce(len(list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '\\d{1,2}/\\d{1,2}/\\d{2,4}'))), 0) AS int) AS dated FROM ocr", _OCR)(lambda k: O.dated_lines(k.ocr))
_LETTERS = r"cast(coalesce(list_sum(list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '[\s|]+'), lambda w: length(regexp_replace(w, '[^\p{L}]', '', 'g'))), lambda n: n >= 3)), 0) AS int)"
query("confident_letters", f"SELECT filing_id, page, {_LETTERS} AS letters FROM ocr", _OCR)(lambda k: k.ocr.select("filing_id", "page", O.confident_letters(F.col("text")).alias("letters")))
query("ocr_shortfall", f"WITH t AS (SELECT filing_id, page, {_LETTERS} AS a, length(text) AS b FROM ocr) SELECT filing_id, page FROM t WHERE b >= 40 AND a < b * 0.5E0", _OCR)(
    lambda k: k.ocr.where(O.ocr_shortfall(O.confident_letters(F.col("text")), F.char_length("text"))).select("filing_id", "page")
)
query("ocr_disagreement", "SELECT event_id, abs(event_id % 37 - event_id % 31) > greatest(2, ceil(greatest(event_id % 37, event_id % 31) * 0.1E0)) AS differ FROM stream", ("stream",))(
    lambda k: k.stream.select("event_id", O.ocr_disagreement(F.col("event_id") % 37, F.col("event_id") % 31).alias("differ"))
)
query(
    "rotation_vote",
    """
    WITH s AS (SELECT event_id AS page_id, cast(unnest([0, 90, 180, 270]) AS int) AS rotation FROM stream),
    t AS (SELECT *, (page_id * (rotation // 90 + 3) + rotation) % 71 AS letters FROM s),
    u AS (SELECT *, row_number() OVER w AS n, lead(letters) OVER w AS nxt FROM t WINDOW w AS (PARTITION BY page_id ORDER BY letters DESC, rotation))
    SELECT page_id, rotation, letters >= 20 AND letters >= 2 * coalesce(nxt, 0) AS decisive FROM u WHERE n = 1
    """,
    ("stream",),
)(
    lambda k: O.rotation_vote(
        k.stream.select(F.col("event_id").alias("page_id"), F.explode(F.array(*map(F.lit, (0, 90, 180, 270)))).alias("rotation")).withColumn("letters", F.expr("(page_id * (rotation div 90 + 3) + rotation) % 71"))
    )
)
query(
    "ocr_geometry",
    """
    WITH b AS (SELECT user_id AS page_id, event_id % 50 AS x0, event_id % 40 AS y0, event_id % 90 AS x1, event_id % 70 AS y1 FROM stream),
    v AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY (x1 - x0) * (y1 - y0) DESC, x0, y0, x1, y1) AS n FROM b WHERE x1 > x0 AND y1 > y0)
    SELECT page_id, x0, y0, x1, y1 FROM v WHERE n = 1
    """,
    ("stream",),
)(lambda k: O.largest_box(k.stream.selectExpr("user_id AS page_id", "event_id % 50 AS x0", "event_id % 40 AS y0", "event_id % 90 AS x1", "event_id % 70 AS y1")))
_ISLANDS = "SELECT source_id, min(label) AS first, max(label) AS last FROM (SELECT source_id, label, label - row_number() OVER (PARTITION BY source_id ORDER BY label) AS g FROM ({}) q) z GROUP BY source_id, g"
query("row_ranges", _with(" " + _ISLANDS.format("SELECT DISTINCT source_id, label FROM marks WHERE role = 'row'")), _OCR)(lambda k: O.row_ranges(marks(_windowed(k)).where("role = 'row'"), ["source_id"]))
_OWED = "SELECT source_id, cast(unnest(generate_series(first, last)) AS int) AS label FROM windows EXCEPT SELECT source_id, label FROM marks"
query("coverage_gaps", _with(" " + _OWED), _OCR)(lambda k: (lambda w: O.coverage_gaps(w, marks(w)))(_windowed(k)))
_STARTS = ", starts AS (SELECT source_id, tx, min(label) AS start FROM marks WHERE role = 'row' GROUP BY 1, 2)"
_PROBLEMS = """
    SELECT DISTINCT m.source_id, 'cites a row outside the filing' AS problem, label FROM marks m JOIN windows USING (source_id) WHERE role = 'row' AND (label < 1 OR label > row_count)
    UNION ALL SELECT DISTINCT s.source_id, 'starts outside its window', start FROM starts s JOIN windows USING (source_id) WHERE start NOT BETWEEN first AND last
    UNION ALL SELECT DISTINCT m.source_id, CASE role WHEN 'non' THEN 'no transaction outside its window' ELSE 'continuation outside its window' END, label FROM marks m JOIN windows USING (source_id) WHERE role <> 'row' AND label NOT BETWEEN first AND last
    UNION ALL SELECT DISTINCT a.source_id, 'both in a transaction and none', a.label FROM marks a JOIN marks b ON a.source_id = b.source_id AND a.label = b.label AND a.role = 'non' AND b.role = 'row'
    UNION ALL SELECT DISTINCT a.source_id, 'both a continuation and no transaction', a.label FROM marks a JOIN marks b ON a.source_id = b.source_id AND a.label = b.label AND a.role = 'cont' AND b.role = 'non'"""
query("coverage_problems", _with(_STARTS + _PROBLEMS), _OCR)(lambda k: (lambda w: O.coverage_problems(w, marks(w)))(_windowed(k)))
query(
    "normalize_read",
    _with(_STARTS + """
    SELECT DISTINCT m.source_id, m.tx, m.label, m.role FROM marks m JOIN windows w USING (source_id) LEFT JOIN starts s ON s.source_id = m.source_id AND s.tx = m.tx WHERE CASE WHEN role = 'row' THEN start BETWEEN first AND last ELSE label BETWEEN first AND last END
    UNION SELECT DISTINCT m.source_id, NULL, m.label, 'cont' FROM marks m JOIN windows w USING (source_id) JOIN starts s ON s.source_id = m.source_id AND s.tx = m.tx WHERE role = 'row' AND start < first AND label BETWEEN first AND last"""),
    _OCR,
)(lambda k: (lambda w: O.normalize_read(w, marks(w)))(_windowed(k)))
query(
    "coverage_filing",
    _with(_STARTS + """,
    held AS (SELECT DISTINCT w.filing_id, m.label, s.start FROM marks m JOIN starts s ON s.source_id = m.source_id AND s.tx = m.tx JOIN windows w ON w.source_id = m.source_id WHERE m.role = 'row'),
    mine AS (SELECT DISTINCT m.source_id, m.role, m.label, w.filing_id, w.first, w.last FROM marks m JOIN windows w USING (source_id) WHERE m.role <> 'row')
    SELECT source_id, CASE role WHEN 'cont' THEN 'continuation that nothing backs' ELSE 'no transaction here but one elsewhere' END AS problem, label FROM mine
    WHERE CASE role WHEN 'cont' THEN NOT EXISTS (SELECT 1 FROM held h WHERE h.filing_id = mine.filing_id AND h.label = mine.label AND h.start < mine.first)
                    ELSE EXISTS (SELECT 1 FROM held h WHERE h.filing_id = mine.filing_id AND h.label = mine.label AND h.start NOT BETWEEN mine.first AND mine.last) END"""),
    _OCR,
)(lambda k: (lambda w: O.coverage_filing(w, marks(w)))(_windowed(k)))
query("gap_ranges", _with(_STARTS + f", bad AS ({_PROBLEMS}), sound AS (SELECT * FROM ({_OWED}) o WHERE source_id NOT IN (SELECT source_id FROM bad)) " + _ISLANDS.format("SELECT source_id, label FROM sound")), _OCR)(
    lambda k: (lambda w: O.gap_ranges(w, marks(w)))(_windowed(k))
)


def fills(w):
    """A gap read for each first gap of a window: one continuation and one row."""
    g = O.coverage_gaps(w, marks(w)).groupBy("source_id").agg(F.min("label").alias("gap_first"))
    part = lambda tx, label, role: F.struct(F.lit(tx).cast("int").alias("tx"), label.alias("label"), F.lit(role).alias("role"))
    return g.select("source_id", "gap_first", F.inline(F.array(part(None, F.col("gap_first"), "cont"), part(1, F.col("gap_first") + 1, "row"))))


query(
    "merge_gaps",
    _with(f""", g AS (SELECT source_id, min(label) AS gap_first FROM ({_OWED}) o GROUP BY 1),
    own AS (SELECT g.source_id, g.gap_first, count(DISTINCT m.tx) AS n, min(m.tx) AS tx FROM g LEFT JOIN marks m ON m.source_id = g.source_id AND m.role = 'row' AND m.label = g.gap_first - 1 GROUP BY 1, 2)
    SELECT source_id, tx, label, role FROM marks UNION SELECT o.source_id, o.tx, o.gap_first, 'row' FROM own o JOIN windows w USING (source_id) WHERE o.n = 1 AND o.gap_first <> w.first
    UNION SELECT o.source_id, NULL, o.gap_first, 'cont' FROM own o JOIN windows w USING (source_id) WHERE o.gap_first = w.first UNION SELECT source_id, cast(gap_first AS bigint) * 4294967296 + 1, cast(gap_first + 1 AS int), 'row' FROM g"""),
    _OCR,
)(lambda k: (lambda w: O.merge_gaps(marks(w), w, _written(k, fills(w), "fills"))[0])(_windowed(k)))
query(
    "band_fractions",
    _with(""", t AS (SELECT filing_id, page, label, row_number() OVER (PARTITION BY filing_id, page ORDER BY label) AS n, count(*) OVER (PARTITION BY filing_id, page) AS total FROM lines WHERE label % 3 = 0)
    SELECT w.source_id, t.page, round((min(n) - 1) / max(total), 6) AS top, round(max(n) / max(total), 6) AS bottom FROM t JOIN windows w ON w.filing_id = t.filing_id AND t.label BETWEEN w.first AND w.last GROUP BY 1, 2"""),
    _OCR,
)(lambda k: O.band_fractions(windows(k), lines(k).withColumn("is_table", F.col("label") % 3 == 0)))
query("split_ranges", "WITH p AS (SELECT user_id AS filing_id, cast(count(*) AS int) AS pages FROM stream GROUP BY 1) SELECT filing_id, cast((s - 1) // 10 AS int) AS chunk, cast(s AS int) AS page_start, cast(least(s + 9, pages) AS int) AS page_end FROM (SELECT filing_id, pages, unnest(generate_series(1, pages, 10)) AS s FROM p)", ("stream",))(
    lambda k: O.split_ranges(k.stream.groupBy(F.col("user_id").alias("filing_id")).agg(F.count(F.lit(1)).cast("int").alias("pages")), 10)
)
query(
    "merge_ranges",
    """
    SELECT user_id AS filing_id, string_agg(event_type, ',' ORDER BY event_id) AS rows, arg_min(CASE WHEN event_id % 5 = 0 THEN 's' || event_id END, CASE WHEN event_id % 5 = 0 THEN event_id END) AS statement,
      string_agg(CASE WHEN event_id % 7 = 0 THEN 'e' || event_id END, '; ' ORDER BY event_id) AS error FROM stream GROUP BY 1
    """,
    ("stream",),
)(
    lambda k: O.merge_ranges(
        k.stream.selectExpr("user_id AS filing_id", "event_id AS chunk", "array(event_type) AS rows", "CASE WHEN event_id % 5 = 0 THEN 's' || event_id END AS statement", "CASE WHEN event_id % 7 = 0 THEN 'e' || event_id END AS error")
    ).withColumn("rows", F.array_join("rows", ","))
)
# Windows as SQL: each step takes the next line of every filing.
_CUT_SQL = _LINES + """,
    st AS (SELECT filing_id, label, 1 AS w, cast(is_table AS int) AS tables, 1 AS labels, page AS began FROM lines WHERE label = 1
      UNION ALL SELECT filing_id, label, CASE WHEN cut THEN w + 1 ELSE w END, CASE WHEN cut THEN 0 ELSE tables END + is_table, CASE WHEN cut THEN 1 ELSE labels + 1 END, CASE WHEN cut THEN page ELSE began END
      FROM (SELECT s.* EXCLUDE (label), l.label, l.page, cast(l.is_table AS int) AS is_table, s.labels >= {labels} OR (l.is_table AND s.tables >= {tables}) OR l.page - s.began + 3 > {pages} AS cut
            FROM st s JOIN lines l ON l.filing_id = s.filing_id AND l.label = s.label + 1) q),
    planned AS (SELECT st.filing_id || ':w' || w AS source_id, st.filing_id, min(st.label) AS first, max(st.label) AS last, min(page) AS a, max(page) AS b, count(*) FILTER (WHERE is_table) AS table_rows FROM st JOIN lines l ON l.filing_id = st.filing_id AND l.label = st.label GROUP BY st.filing_id, w)"""
query(
    "plan_windows",
    f"WITH {_CUT_SQL.replace('{labels}', '120').replace('{tables}', '20').replace('{pages}', '1000000')} SELECT source_id, filing_id, first, last, cast(max(last) OVER (PARTITION BY filing_id) AS int) AS row_count FROM planned",
    _OCR, recursive=True,
)(lambda k: O.plan_windows(lines(k)))


def _attachments(k: Lake):
    numbered = lines(k)
    return O.window_attachments(O.plan_windows(numbered, 15, 6, 3), numbered, k.ocr, 3)


_ATTACHED = f"""WITH {_CUT_SQL.replace('{labels}', '15').replace('{tables}', '6').replace('{pages}', '3')},
    total AS (SELECT filing_id, max(page) AS total_pages FROM ocr GROUP BY 1),
    j AS (SELECT t.*, source_id, first, last, a, b, table_rows, count(source_id) OVER (PARTITION BY t.filing_id) AS n FROM total t LEFT JOIN planned p ON p.filing_id = t.filing_id),
    att AS (SELECT filing_id AS source_id, filing_id, first, last, 1 AS page_start, total_pages AS page_end, total_pages, coalesce(table_rows, 0) AS table_rows FROM j WHERE n = 0 OR (n = 1 AND total_pages <= 3)
    UNION ALL SELECT source_id, filing_id, first, last, greatest(1, a - 1), least(total_pages, b + 1), total_pages, table_rows FROM j WHERE NOT (n = 0 OR (n = 1 AND total_pages <= 3)))"""
query("window_attachments", f"{_ATTACHED} SELECT * FROM att", _OCR, recursive=True)(_attachments)

query(
    "marked_windows",
    _ATTACHED + """,
    named AS (SELECT r.filing_id, r.page, r.line, label, CASE WHEN label IS NULL THEN r.text WHEN is_table THEN '| R' || label || ' ' || r.text ELSE '[R' || label || '] ' || r.text END AS text
      FROM r LEFT JOIN lines l ON l.filing_id = r.filing_id AND l.page = r.page AND l.line = r.line),
    body AS (SELECT a.source_id, n.page, n.line, CASE WHEN a.source_id <> a.filing_id AND n.label = a.first THEN '=== ROW WINDOW R' || a.first || '-R' || a.last || ' BEGINS ===' || chr(10) ELSE '' END || n.text
      || CASE WHEN a.source_id <> a.filing_id AND n.label = a.last THEN chr(10) || '=== ROW WINDOW R' || a.first || '-R' || a.last || ' ENDS ===' ELSE '' END AS text
      FROM att a JOIN named n ON n.filing_id = a.filing_id AND n.page BETWEEN a.page_start AND a.page_end)
    SELECT source_id, page, md5(string_agg(text, chr(10) ORDER BY line)) AS text FROM body GROUP BY 1, 2""",
    _OCR, recursive=True,
)(lambda k: (lambda numbered: O.marked_windows(_attachments(k), k.ocr, numbered))(lines(k)).withColumn("text", F.md5("text")))

# Requests as SQL: where one that begins at an attachment would end, and the chain of those that do begin.
_PACKED = """,
    ord AS (SELECT *, row_number() OVER (ORDER BY {order}) AS k FROM att),
    acc AS (SELECT *, {sums} FROM ord),
    nx AS (SELECT a.k, min(b.k) AS nk FROM acc a JOIN acc b ON b.k > a.k AND b.k <= a.k + {most} AND (b.k = a.k + {most} OR {over}) GROUP BY 1),
    req AS (SELECT cast(1 AS bigint) AS k, cast(0 AS bigint) AS request UNION ALL SELECT nk, request + 1 FROM req JOIN nx ON nx.k = req.k)
    SELECT {columns}, req.request FROM acc ASOF JOIN req ON acc.k >= req.k"""
_ARRIVAL = "cast(filing_id AS bigint), coalesce(first, 0)"


def _packed_sql(weights: dict[str, tuple[str, str]], most: int, columns: str) -> str:
    """``weights``: expression, and condition on ``b`` under which the sum from ``a`` on, ``s``, is too much, by name."""
    sums = ", ".join(f"{x} AS {n}, sum({x}) OVER (ORDER BY k) AS upto_{n}" for n, (x, _) in weights.items())
    over = " OR ".join(test.format(s=f"(b.upto_{n} - a.upto_{n} + a.{n})") for n, (_, test) in weights.items())
    return _ATTACHED + _PACKED.format(order=_ARRIVAL, sums=sums, most=most, over=over, columns=columns)


def _arrival():
    """Order in which filings' attachments arrive."""
    return [F.col("filing_id").cast("bigint"), F.coalesce("first", F.lit(0))]


query("pack_requests", _packed_sql({"rows": ("cast(greatest(1, table_rows) AS bigint)", "{s} > 40")}, 10, "source_id, rows"), _OCR, recursive=True)(
    lambda k: P.text_requests(_attachments(k), _arrival()).select("source_id", "rows", "request")
)
query(
    "page_requests",
    _packed_sql({"pages": ("cast(page_end - page_start + 1 AS bigint)", "{s} > 10"), "rows": ("cast(CASE WHEN cast(filing_id AS bigint) % 3 > 0 THEN ceil(table_rows * 2 * (page_end - page_start + 1) / total_pages) ELSE 0 END AS bigint)", "(b.rows > 0 AND {s} > 40)")}, 5, "source_id, pages, rows"),
    _OCR, recursive=True,
)(lambda k: P.page_requests(_attachments(k).withColumn("estimated_rows", F.expr("CASE WHEN cast(filing_id AS bigint) % 3 > 0 THEN table_rows * 2 END")), _arrival(), most=5).select("source_id", "pages", "rows", "request"))
query(
    "source_read_requests",
    _packed_sql({"rows": ("cast(greatest(1, table_rows) AS bigint)", "{s} > 40"), "images": ("cast(coalesce(first, 0) % 4 AS bigint)", "{s} > 6")}, 8, "source_id, rows, images"),
    _OCR, recursive=True,
)(lambda k: P.source_read_requests(_attachments(k).withColumn("images", F.coalesce("first", F.lit(0)) % 4), _arrival(), images=6, most=8).select("source_id", "rows", F.col("images").cast("long").alias("images"), "request"))

# Consensus: conversations as sources, turns as reads, words as rows.
_READS = "reads"
_SQL_ROWS = """WITH rw AS (SELECT source_id, read_idx, unnest(string_split(signature, ' ')) AS w, generate_subscripts(string_split(signature, ' '), 1) AS i FROM reads),
    sg AS (SELECT source_id, read_idx, CASE WHEN NOT failed THEN signature END AS sig FROM reads)"""


def _reads(k: Lake):
    return k.reads.select("source_id", "read_idx", F.when(F.col("failed"), "failed").alias("error"))


def _rows(k: Lake):
    return k.reads.select("source_id", "read_idx", F.posexplode(F.split("signature", " ")).alias("row_idx", "sig"))


class _WholeReads(Lake):
    """A lake whose reads carry their whole texts."""

    def __getattr__(self, name: str):
        return super().__getattr__("whole_reads" if name == "reads" else name)


def _read_query(name: str, sql: str):
    """Register ``f(lake)`` over ``reads`` as ``name``, and over ``whole_reads`` as ``name``_whole with the same SQL over that view."""

    def register(f):
        query(name, sql, (_READS,))(f)
        query(f"{name}_whole", re.sub(r"\breads\b", "whole_reads", sql), ("whole_reads",))(lambda k: f(_WholeReads(k.spark, k.sf_dir)))
        return f

    return register


_read_query("third_reads", _SQL_ROWS + " SELECT source_id FROM sg GROUP BY 1 HAVING NOT coalesce(max(CASE WHEN read_idx = 0 THEN sig END) = max(CASE WHEN read_idx = 1 THEN sig END), false)")(
    lambda k: C.third_reads(C.signatures(_reads(k), _rows(k)))
)
_DECIDE = _SQL_ROWS + """, l AS (SELECT a.source_id, min(b.read_idx) AS r FROM sg a JOIN sg b ON a.source_id = b.source_id AND a.read_idx < b.read_idx AND a.sig = b.sig GROUP BY 1),
    d AS (SELECT s.source_id, CASE WHEN r = 1 THEN 'agreed' WHEN r IS NOT NULL THEN 'arbitrated' ELSE 'failed' END AS outcome, CASE WHEN r = 1 THEN 0 ELSE r END AS read_idx FROM (SELECT DISTINCT source_id FROM sg) s LEFT JOIN l USING (source_id))"""
_read_query("consensus", _DECIDE + " SELECT * FROM d")(lambda k: C.decide(C.signatures(_reads(k), _rows(k))))
_read_query("consensus_counts", _DECIDE + " SELECT outcome, count(*) AS n FROM d GROUP BY 1")(lambda k: C.outcome_counts(C.decide(C.signatures(_reads(k), _rows(k)))))
_read_query(
    "vote_window",
    _SQL_ROWS + """, c AS (SELECT rw.source_id, w AS sig, rw.read_idx, count(*) AS n FROM rw JOIN reads r ON r.source_id = rw.source_id AND r.read_idx = rw.read_idx AND NOT r.failed GROUP BY 1, 2, 3)
    SELECT source_id, sig, cast(list_sort(list(n), 'DESC')[2] AS int) AS copies FROM c GROUP BY 1, 2 HAVING count(*) > 1""",
)(lambda k: C.vote_window(_reads(k), _rows(k)))


def _page_rows(k: Lake, turn: int):
    return _rows(k).where(F.col("read_idx") == turn).select(F.col("source_id").alias("filing_id"), (F.col("row_idx") % 3).alias("page"), "sig")


query(
    "disputed_pages_whole",
    _SQL_ROWS.replace("FROM reads", "FROM whole_reads") + """, p AS (SELECT source_id AS filing_id, cast((i - 1) % 3 AS int) AS page, w, read_idx, count(*) AS n FROM rw WHERE read_idx < 2 GROUP BY ALL)
    SELECT DISTINCT coalesce(a.filing_id, b.filing_id) AS filing_id, coalesce(a.page, b.page) AS page FROM (SELECT * FROM p WHERE read_idx = 0) a FULL JOIN (SELECT * FROM p WHERE read_idx = 1) b ON a.filing_id = b.filing_id AND a.page = b.page AND a.w = b.w WHERE a.n IS DISTINCT FROM b.n""",
    ("whole_reads",),
)(lambda k: C.disputed_pages(_page_rows(_WholeReads(k.spark, k.sf_dir), 0), _page_rows(_WholeReads(k.spark, k.sf_dir), 1)))
_read_query(
    "page_shortfalls",
    _SQL_ROWS + """, p AS (SELECT source_id AS filing_id, cast((i - 1) % 3 AS int) AS page, read_idx, count(*) AS n FROM rw GROUP BY ALL)
    SELECT a.filing_id, a.page, a.n, coalesce(b.n, 0) AS m FROM p a LEFT JOIN p b ON b.filing_id = a.filing_id AND b.page = a.page AND b.read_idx = 1 WHERE a.read_idx = 0 AND a.n - coalesce(b.n, 0) > greatest(2, ceil(a.n * 0.1E0))""",
)(lambda k: C.page_shortfalls(*[_page_rows(k, t).groupBy("filing_id", "page").agg(F.count(F.lit(1)).alias("n")) for t in (0, 1)]))
def _parsed(k: Lake, span: str, form: str):
    """A response for every event, whose source is user and day or hour; the next day's or hour's is requested too."""
    source = lambda ts: F.concat(F.col("user_id").cast("string"), F.lit(":"), F.date_format(ts, form)).alias("source_id")
    requested = k.stream.select(source(F.col("ts"))).unionByName(k.stream.select(source(F.expr(f"ts + interval 1 {span}")))).distinct()
    e = F.col("event_id")
    body = F.when(e % 5 == 0, '{"rows": ["x"], "finish": "length"}').when(e % 5 == 1, "oops").when(e % 5 == 2, '{"rows": []}').otherwise(F.format_string('{"rows": ["a%d", "b"]}', e))
    return C.parse_reads(requested, k.stream.select(source(F.col("ts")), body.alias("body"))).withColumn("rows", F.array_join("rows", ","))


def _parse_query(name: str, span: str, form: str, sql_form: str):
    query(
        name,
        f"""
    WITH r AS (SELECT cast(user_id AS varchar) || ':' || strftime(ts, '{sql_form}') AS source_id, event_id FROM stream),
    q AS (SELECT source_id FROM r UNION SELECT cast(user_id AS varchar) || ':' || strftime(ts + INTERVAL 1 {span}, '{sql_form}') FROM stream),
    n AS (SELECT source_id, count(*) AS n, max(event_id) AS e FROM r GROUP BY 1)
    SELECT q.source_id, CASE WHEN n IS NULL THEN 'no answer' WHEN n > 1 THEN 'answered more than once' WHEN e % 5 = 0 THEN 'cut off' WHEN e % 5 = 1 THEN 'does not parse' WHEN e % 5 = 2 THEN 'empty without a statement' END AS error,
      CASE WHEN n = 1 AND e % 5 > 2 THEN 'a' || e || ',b' ELSE '' END AS rows FROM q LEFT JOIN n ON n.source_id = q.source_id
    """,
        ("stream",),
    )(lambda k: _parsed(k, span, form))


_parse_query("parse_reads", "hour", "yyyy-MM-dd HH", "%Y-%m-%d %H")
_parse_query("parse_reads_all", "day", "yyyy-MM-dd", "%Y-%m-%d")
query(
    "reconcile_queue",
    _SQL_ROWS + " SELECT DISTINCT source_id AS filing_id, cast(1 AS int) AS page FROM reads WHERE read_idx = 0 UNION SELECT DISTINCT source_id, cast(read_idx AS int) FROM reads WHERE length(text) % 7 = 0",
    (_READS,),
)(lambda k: C.reconcile_queue(k.reads.where("read_idx = 0").select(F.col("source_id").alias("filing_id"), F.lit(1).alias("page")), k.reads.where("char_length(text) % 7 = 0").select(F.col("source_id").alias("filing_id"), F.col("read_idx").alias("page"))))


# Votes by row: three reads of every filing's trades, whose rows cite two labels each and list a third as no transaction.
def _row_reads(k: Lake):
    per = k.read_rows.groupBy("source_id", "read_idx").agg(F.bool_or("failed").alias("failed"), F.array_sort(F.collect_list(F.when(F.col("listed"), F.col("n") * 3))).alias("non"))
    return per.select("source_id", "read_idx", F.when(F.col("failed"), "failed").alias("error"), F.lit(None).cast("string").alias("statement"), "non", F.array().cast("array<int>").alias("cont"))


def _row_rows(k: Lake):
    labels = F.array(F.col("n") * 3 - 1, F.col("n") * 3 - 2)
    return k.read_rows.select("source_id", "read_idx", "row_idx", C.row_signature(labels).alias("sig"), labels.alias("labels"))


def _written(k: Lake, df, tag: str):
    """The table as a reader of reads finds it: written once, not derived anew for each use."""
    path = shared_path(k.spark, tag)
    df.write.parquet(path)
    return k.spark.read.parquet(path)


class _Numbered(Lake):
    """A lake whose numbered trades are written once, for all tables of reads that are made of them."""

    def __init__(self, k: Lake):
        super().__init__(k.spark, k.sf_dir)
        self.given = {"numbered": _written(k, k.numbered, "numbered")}


def _row_windows(k: Lake):
    return k.read_rows.where("kind <> 1 or not odd").groupBy("source_id").agg(F.lit(1).alias("first"), (F.max("of") * 3).alias("last"), (F.max("of") * 3).alias("row_count"))


_SQL_VOTED = """
    WITH rs AS (SELECT *, concat_ws('|', n, trim(transaction_type_code), coalesce(transaction_date_iso, '-'), CASE WHEN notification_date_iso = '2024-02-30' THEN '-' ELSE coalesce(notification_date_iso, '-') END,
        coalesce(cast(amount_low AS varchar), '-'), coalesce(cast(amount_high AS varchar), '-'), coalesce(trim(ticker), '-'), coalesce(nullif(trim(asset_type_code), ''), '-'), owner, partial_sale, coalesce(source_transaction_id, '-')) AS sig FROM read_rows),
    ok AS (SELECT * FROM rs WHERE NOT failed),
    c AS (SELECT source_id, sig, read_idx, count(*) AS m FROM ok GROUP BY 1, 2, 3),
    s AS (SELECT source_id, sig, list_sort(list(m), 'DESC')[2] AS copies FROM c GROUP BY 1, 2 HAVING count(*) > 1),
    kept AS (SELECT o.source_id, o.read_idx, o.row_idx, o.n FROM (SELECT *, row_number() OVER (PARTITION BY source_id, sig ORDER BY read_idx, row_idx) AS i FROM ok) o JOIN s ON s.source_id = o.source_id AND s.sig = o.sig WHERE i <= copies)"""
query("voted_rows", _SQL_VOTED + " SELECT source_id, cast(row_number() OVER (PARTITION BY source_id ORDER BY n, read_idx, row_idx) - 1 AS int) AS position, read_idx, row_idx FROM kept", ("read_rows",))(
    lambda k: (lambda k: C.voted_rows(_row_reads(k), _row_rows(k)))(_Numbered(k)).select("source_id", "position", "read_idx", "row_idx")
)
_LISTED = ", nons AS (SELECT source_id, n FROM ok WHERE listed GROUP BY 1, 2 HAVING count(DISTINCT read_idx) > 1)"
query("shared_labels", _SQL_VOTED + _LISTED + " SELECT source_id, cast(n * 3 AS int) AS label FROM nons", ("read_rows",))(lambda k: C.shared_labels(_row_reads(k), "non"))
query(
    "consensus_rows",
    _SQL_VOTED + _LISTED + """,
    docs AS (SELECT source_id, read_idx, CASE WHEN NOT bool_or(failed) THEN string_agg(sig, ';' ORDER BY row_idx) || '#' || coalesce(string_agg(CASE WHEN listed THEN cast(n AS varchar) END, ',' ORDER BY n), '') END AS doc FROM rs GROUP BY 1, 2),
    l AS (SELECT a.source_id, min(b.read_idx) AS r FROM docs a JOIN docs b ON a.source_id = b.source_id AND a.read_idx < b.read_idx AND a.doc = b.doc GROUP BY 1),
    size AS (SELECT source_id, max(of) * 3 AS owed, max(read_idx) AS last, count(DISTINCT CASE WHEN NOT failed THEN read_idx END) AS usable, bool_or(kind <> 1 OR NOT odd) AS win FROM rs GROUP BY 1),
    got AS (SELECT source_id, count(DISTINCT label) AS got FROM (SELECT source_id, n * 3 - 1 AS label FROM kept UNION SELECT source_id, n * 3 - 2 FROM kept UNION SELECT source_id, n * 3 FROM nons) GROUP BY 1),
    d AS (SELECT z.source_id, r, CASE WHEN r IS NOT NULL THEN NULL WHEN last < 2 THEN 'no read after the second' WHEN NOT win THEN 'no two reads agree' WHEN usable < 2 THEN 'fewer than two usable reads' WHEN coalesce(got, 0) < owed THEN 'voted rows do not account for the window' END AS reason
      FROM size z LEFT JOIN l USING (source_id) LEFT JOIN got USING (source_id))
    SELECT source_id, CASE WHEN r = 1 THEN 'agreed' WHEN r IS NOT NULL OR reason IS NULL THEN 'arbitrated' ELSE 'failed' END AS outcome, cast(CASE WHEN r = 1 THEN 0 ELSE r END AS int) AS read_idx, r IS NULL AND reason IS NULL AS voted, reason FROM d""",
    ("read_rows",),
)(lambda k: (lambda k: C.decide_rows(_written(k, _row_reads(k), "reads"), _row_rows(k), _row_windows(k)))(_Numbered(k)))


def _ready(k: Lake):
    """A reader that looks its answers up: the reads of the view, pass by pass."""
    reads, rows = _written(k, _row_reads(k), "reads"), _row_rows(k)

    def read(pending, n: int):
        mine = lambda df: df.where(F.col("read_idx") == n - 1).drop("read_idx").join(pending.select("source_id"), "source_id", "left_semi")
        return mine(reads), mine(rows)

    return read


def _passed(k: Lake):
    k = _Numbered(k)
    sources, windows_, state = k.read_rows.select("source_id").distinct(), _written(k, _row_windows(k), "windows"), shared_path(k.spark, "passes")
    n = RP.read_in_passes(sources, windows_, _ready(k), state)
    out, rows, _ = RP.decided(k.spark, windows_, state, n)
    size = rows.groupBy("source_id").agg(F.count(F.lit(1)).alias("rows"))
    return out.join(size, "source_id", "left").select("source_id", "outcome", "voted", "reads", F.coalesce("rows", F.lit(0)).alias("rows"))


query(
    "read_passes",
    _SQL_VOTED + _LISTED + """,
    docs AS (SELECT source_id, read_idx, count(*) AS rows, CASE WHEN NOT bool_or(failed) THEN string_agg(sig, ';' ORDER BY row_idx) || '#' || coalesce(string_agg(CASE WHEN listed THEN cast(n AS varchar) END, ',' ORDER BY n), '') END AS doc FROM rs GROUP BY 1, 2),
    l AS (SELECT a.source_id, min(b.read_idx) AS r FROM docs a JOIN docs b ON a.source_id = b.source_id AND a.read_idx < b.read_idx AND a.doc = b.doc GROUP BY 1),
    size AS (SELECT source_id, max(of) * 3 AS owed, max(read_idx) AS last, count(DISTINCT read_idx) AS reads, count(DISTINCT CASE WHEN NOT failed THEN read_idx END) AS usable, bool_or(kind <> 1 OR NOT odd) AS win FROM rs GROUP BY 1),
    got AS (SELECT source_id, count(DISTINCT label) AS got FROM (SELECT source_id, n * 3 - 1 AS label FROM kept UNION SELECT source_id, n * 3 - 2 FROM kept UNION SELECT source_id, n * 3 FROM nons) GROUP BY 1),
    d AS (SELECT z.source_id, r, reads, r IS NULL AND last >= 2 AND win AND usable >= 2 AND coalesce(got, 0) >= owed AS voted FROM size z LEFT JOIN l USING (source_id) LEFT JOIN got USING (source_id))
    SELECT d.source_id, CASE WHEN r = 1 THEN 'agreed' WHEN r IS NOT NULL OR voted THEN 'arbitrated' ELSE 'failed' END AS outcome, voted, cast(CASE WHEN r = 1 THEN 2 ELSE reads END AS int) AS reads,
      coalesce(CASE WHEN voted THEN (SELECT count(*) FROM kept WHERE kept.source_id = d.source_id) END, (SELECT max(rows) FROM docs WHERE docs.source_id = d.source_id AND docs.read_idx = CASE WHEN r = 1 THEN 0 ELSE r END), 0) AS rows FROM d""",
    ("read_rows",),
)(_passed)
