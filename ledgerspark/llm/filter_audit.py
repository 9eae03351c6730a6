"""What filters do to each other, in every order, from one count per mask of failures."""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialize, steps
from .text import SPACED_WORD

#: The filters, in the order of their bits in a mask.
FILTERS = "ABCDE"
#: The bit of the only filter that looks at other rows.
_COPY = 1 << FILTERS.index("E")
_MASKS = 1 << len(FILTERS)
_ALL = _MASKS - 1

#: A: fewer words than this. B: less than this share of words is distinct, in percent. C: more than this share of code points is A-Z, in percent.
LEAST_WORDS, LEAST_DISTINCT, MOST_UPPER = 100, 80, 10
#: D: any of these characters.
SYMBOLS = "#$%&*|"


def own_mask(text: Column) -> Column:
    """Bits of the failed filters that a text decides by itself: A, B, C and D."""
    words = F.regexp_extract_all(text, F.lit(SPACED_WORD), F.lit(0))
    upper = F.regexp_count(text, F.lit("[A-Z]"))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    failed = (
        n < LEAST_WORDS,
        distinct.cast("long") * 100 < n.cast("long") * LEAST_DISTINCT,
        upper.cast("long") * 100 > F.char_length(text).cast("long") * MOST_UPPER,
        text.rlike(f"[{SYMBOLS}]"),
    )
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(failed)), F.lit(0))


#: What is counted: all documents, those labelled good and those labelled toxic.
_COUNTS = ("docs", "good", "toxic")


def mask_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``part, mask, docs, good, toxic``: documents of a part that fail exactly the filters of a mask.

    Texts leave their task as a mask and a SHA-256. One row for each id and text meets
    the labels, and a text's copies are then counted where they are, before they are
    brought together: with the number of rows that hold the text's least id, which are
    those that E lets pass. No text and no group of copies is gathered.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.sha2(text, 256).alias("text"), own_mask(text).alias("mask")
    )
    rows = rows.groupBy("id", "part", "text", "mask").agg(F.count(F.lit(1)).alias("docs"))
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("id"))
    marks = marks.agg(*[F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(m) for c, m in (("quality", "good"), ("toxic", "toxic"))])
    false = F.lit(False)
    marked = rows.join(marks, "id", "left").select("id", "part", "text", "mask", "docs", F.coalesce("good", false).alias("good"), F.coalesce("toxic", false).alias("toxic"))
    known = F.when(F.col("id").isNotNull(), F.struct("id", "docs"))
    kinds = marked.groupBy("text", "mask", "part", "good", "toxic").agg(
        F.sum("docs").alias("docs"), F.coalesce(F.sum(F.when(F.col("id").isNull(), F.col("docs"))), F.lit(0)).alias("nameless"), F.min(known).alias("least")
    )
    kinds = materialize(kinds, "kinds")
    firsts = kinds.groupBy("text").agg(F.min("least.id").alias("first"))
    both = kinds.join(firsts.hint("merge"), "text")
    first = F.col("nameless") + F.when(F.col("least.id") == F.col("first"), F.col("least.docs")).otherwise(F.lit(0))
    sides = F.array(F.struct(F.col("mask").alias("mask"), first.alias("n")), F.struct(F.col("mask").bitwiseOR(F.lit(_COPY)).alias("mask"), (F.col("docs") - first).alias("n")))
    counted = both.select("part", "good", "toxic", F.explode(sides).alias("s")).where("s.n > 0")
    kept = {"docs": F.col("s.n"), **{c: F.when(F.col(c), F.col("s.n")).otherwise(F.lit(0)) for c in _COUNTS[1:]}}
    return counted.groupBy("part", F.col("s.mask").alias("mask")).agg(*[F.sum(v).alias(c) for c, v in kept.items()])


def zeta(df: DataFrame, column: str) -> DataFrame:
    """``df`` where ``column``, an array by mask, holds for every mask the sum over its submasks: one step a bit."""
    for b in range(len(FILTERS)):
        own, bit = F.col(column), 1 << b
        below = lambda m, own=own, bit=bit: F.when(m.bitwiseAND(F.lit(bit)) != 0, F.get(own, m - F.lit(bit))).otherwise(F.lit(0).cast("long"))
        df = df.withColumn(column, F.transform(own, (lambda below: lambda v, m: v + below(m))(below)))
    return df


def survivors(counted: DataFrame) -> DataFrame:
    """One row a part, with an array by mask for each count: exactly that mask failed (``docs_exact``), and survivors of that subset of filters (``docs_left``)."""
    by_mask = counted.groupBy("part").agg(
        *[F.array(*[F.coalesce(F.sum(F.when(F.col("mask") == m, F.col(c))), F.lit(0).cast("long")) for m in range(_MASKS)]).alias(f"{c}_exact") for c in _COUNTS]
    )
    for c in _COUNTS:  # a document survives the filters S when it fails some of the others only
        by_mask = zeta(by_mask.withColumn(f"{c}_below", F.col(f"{c}_exact")), f"{c}_below")
    left = lambda c: F.transform(F.sequence(F.lit(0), F.lit(_ALL)), lambda s: F.get(F.col(f"{c}_below"), F.lit(_ALL) - s)).alias(f"{c}_left")
    return by_mask.select("part", *[f"{c}_exact" for c in _COUNTS], *[left(c) for c in _COUNTS])


def _steps_of_orders() -> list[tuple[str, int, int, int]]:
    """Order, step, mask of the filters before it, bit of its filter."""
    out = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for step, f in enumerate(order, 1):
            out.append((order, step, before, 1 << FILTERS.index(f)))
            before |= out[-1][3]
    return out


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """What each step of each order of the filters keeps and removes, by part.

    Documents are counted once by the exact set of filters that they fail. A subset-zeta
    transform of these 32 counts gives the survivors of every subset of filters, and all
    else is a difference of neighbouring subsets: a step removes what survives the
    filters before it less what survives it too, a filter alone fails what survives none
    less what survives it, and likewise for documents labelled good or toxic. After the
    counts the work depends only on the number of parts.

    One row for each part, order and step: ``part, filter_order, step, kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley``. A null text is empty and a
    null part is the empty string. Rows that repeat an id or a text are counted one by
    one; E passes every row whose id is the least of its text, and every row without an
    id, which is no smaller id to others either. A document is good (toxic) where any of
    its labels has 1 in ``quality`` (``toxic``); labels without an id are not used. An
    empty table gives an empty result. Other columns are not read.
    """
    with steps() as own:
        left = own.keep(survivors(mask_counts(docs, labels, id_col, text_col, part_col)), "survivors")
    plan = F.explode(F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("before"), F.lit(f).alias("bit")) for o, s, b, f in _steps_of_orders()]))
    weight = F.array(*[F.lit(factorial(m.bit_count()) * factorial(max(0, len(FILTERS) - 1 - m.bit_count()))) for m in range(_MASKS)])
    at = lambda c, m: F.get(F.col(f"{c}_left"), m)
    before, bit = F.col("o.before"), F.col("o.bit")
    after = before.bitwiseOR(bit)
    lost = lambda c: at(c, before) - at(c, after)
    shares = F.transform(
        F.sequence(F.lit(0), F.lit(_ALL)),
        lambda m: F.when(m.bitwiseAND(bit) == 0, F.get(weight, m) * (at("docs", m) - at("docs", m.bitwiseOR(bit)))).otherwise(F.lit(0).cast("long")),
    )
    return left.select("*", plan.alias("o")).select(
        "part", "o.filter_order", "o.step", at("docs", after).alias("kept"), lost("docs").alias("removed"),
        (at("docs", F.lit(0)) - at("docs", bit) - lost("docs")).alias("redundant"), F.get(F.col("docs_exact"), bit).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"), F.aggregate(shares, F.lit(0).cast("long"), lambda a, v: a + v).alias("shapley"),
    )
