"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import with_partner
from .ranking import RANK, TOTAL, globally_ranked
from .storage import materialize, steps

#: Weights by the position of a source in code point order, null last, repeating.
WEIGHTS = (5, 2, 1)
#: Words of the mix as a share of all words.
SHARE = 1.5
#: No source is taken more often than this.
MOST = 2.0
#: Documents over this share of their source's target are taken a whole number of times that is chosen for them, the LARGEST of each source at most.
CERTAIN, LARGEST = 0.01, 512


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: ``source, source_size, source_rows, first_rank, target``.

    ``sizes`` has ``source`` and ``size``. Targets share ``share`` of all words by weight
    and stop at ``most`` times a source's words; what is cut off is shared again by
    weight. The fixed point of that is one level: with the sources ordered by cap over
    weight, those whose ratio is below the level take their cap and all others the level
    times their weight. ``first_rank`` is the number of rows of earlier sources. The
    windows here run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    before = by_name.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    s = s.select(
        "*",
        F.get(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights)).alias("_w"),
        F.coalesce(F.sum("source_rows").over(before), F.lit(0).cast("long")).alias("first_rank"),
        (F.sum("source_size").over(everything) * F.lit(share)).alias("_all"),
        (F.col("source_size") * F.lit(float(most))).alias("_cap"),
    ).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    by_ratio = Window.orderBy("_ratio", F.col("source").asc_nulls_last())
    s = s.withColumn(
        "_level",
        (F.col("_all") - F.coalesce(F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        / F.sum("_w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)),
    )
    level = F.min(F.when(F.col("_ratio") >= F.col("_level"), F.struct("_ratio", "_level"))).over(everything)["_level"]
    return s.withColumn("_final", level).select(
        "source",
        "source_size",
        "source_rows",
        "first_rank",
        F.when(F.col("_final").isNull(), F.col("_cap")).otherwise(F.least("_cap", F.col("_w") * F.col("_final"))).alias("target"),
    )


def _crossed(k: Column, rate: Column, offset: Column) -> Column:
    """Integers passed when the prefix sum of ``rate`` goes from document k - 1 to k."""
    n = F.floor(k * rate + offset) - F.floor((k - 1) * rate + offset)
    return F.least(n, F.ceil(rate))


def certain_copies(placed: DataFrame) -> DataFrame:
    """``_source, sure array<long>, sure_size, sure_words``: copies of each source's large documents, largest first.

    They go from the largest to the smallest, each taken its expected copies rounded up or
    down, whichever leaves the words so far nearer to what is expected of them. A source's
    array has LARGEST entries at most. ``placed``: ``_source, target, source_size,
    source_rows, size, k`` with ``k`` the place in the source by size.
    """
    large = placed.where((F.col("size") > 0) & (F.col("size") > F.col("target") * CERTAIN) & (F.col("k") > F.col("source_rows") - LARGEST))
    rate = F.col("target") / F.col("source_size")
    each = large.groupBy("_source").agg(F.reverse(F.array_sort(F.collect_list(F.struct("k", "size")))).alias("docs"), F.max(rate).alias("rate"))
    lower = F.floor("rate")

    def take(acc: Column, d: Column) -> Column:
        due = acc["due"] + d["size"] * F.col("rate")
        n = F.when(F.abs(due - d["size"] * (lower + 1)) < F.abs(due - d["size"] * lower), F.least(lower + 1, F.ceil("rate"))).otherwise(lower)
        return F.struct((due - n * d["size"]).alias("due"), F.concat(acc["sure"], F.array(n.cast("long"))).alias("sure"))

    start = F.struct(F.lit(0.0).alias("due"), F.array().cast("array<long>").alias("sure"))
    each = each.withColumn("sure", F.aggregate("docs", start, take)["sure"])
    add = lambda a, x: a + x
    zero = F.lit(0).cast("long")
    return each.select(
        "_source", "sure", F.aggregate("docs", zero, lambda a, d: a + d["size"]).alias("sure_size"), F.aggregate(F.zip_with("docs", "sure", lambda d, n: d["size"] * n), zero, add).alias("sure_words")
    )


def systematic_mix(
    docs: DataFrame,
    size: Column,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 17,
    ties: tuple[str, ...] = (),
) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies, taken`` for every row.

    Every document of a source expects ``target / source_size`` copies. Documents whose
    size is a large part of the target are given whole copies (see certain_copies()), and
    what the target then lacks is what the others expect, evenly. These are ordered by
    size and id, their expectations are summed along that order from an offset in [0, 1),
    and a document is taken once for every integer its own step crosses. So the order by
    size keeps the taken words within one document of the target that is no large part of
    it, as long as a source has such documents, and a rerun takes the same. The offset
    is one seeded draw for each source.

    The prefix sum needs each row's rank in its source. That is its rank in the whole
    table ordered by source, size and id, which is computed by range partitions, so one
    source may hold most rows; ``ties`` are columns that order equal ids. Columns of ``docs`` named like a result are replaced. A
    null source is a source of its own; a null size counts as 0; rows that repeat an id
    are sampled separately; a source without words takes nothing; an empty table gives
    an empty result.
    """
    rows = docs.withColumn("size", F.coalesce(size, F.lit(0)).cast("long")).drop("source_size", "target", "copies", "taken")
    ranked = globally_ranked(rows, [F.col(source_col).asc_nulls_last(), F.col("size"), F.col(id_col), *map(F.col, ties)], "mix")
    targets = materialize(source_targets(ranked.select(F.col(source_col).alias("source"), "size"), weights, share, most), "targets")
    t = targets.withColumnRenamed("source", "_source")
    named = F.col(source_col).eqNullSafe(F.col("_source"))
    k = F.col(RANK) - F.col("first_rank") + 1
    sure = materialize(certain_copies(ranked.join(t, named).select("_source", "target", "source_size", "source_rows", "size", k.alias("k"))), "certain")
    t = t.join(sure.withColumnRenamed("_source", "_name"), F.col("_source").eqNullSafe(F.col("_name")), "left").drop("_name")
    placed = ranked.join(t, named).withColumn("_k", k)
    rest = F.col("source_size") - F.coalesce("sure_size", F.lit(0))
    rate = F.when(rest > 0, (F.col("target") - F.coalesce("sure_words", F.lit(0))) / rest).otherwise(F.lit(0.0))
    rate = F.least(F.greatest(rate, F.lit(0.0)), F.lit(float(most)))
    # Multiples of 2^-20 stay exact when whole numbers are added.
    offset = F.pmod(F.xxhash64(F.lit(seed), F.coalesce("_source", F.lit("")), F.col("_source").isNull()), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = F.get(F.col("sure"), (F.col("source_rows") - F.col("_k")).cast("int"))
    return (
        placed.withColumn("copies", F.coalesce(chosen, _crossed(F.col("_k").cast("double"), rate, offset).cast("long")))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("_source", "source_rows", "first_rank", "_k", "sure", "sure_size", "sure_words", RANK, TOTAL)
    )


def mixed_documents(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with every row as often as systematic_mix() takes it.

    Only a row's key (id and a hash of text and source), source and size take part in the
    sampling. Whole rows then meet their number of copies in one merge join, whatever the
    size of either side, so a text crosses one shuffle. Rows that share a key are equal
    but for columns that the mix does not know: each is taken as often as their copies
    allow for all, and what is left over goes to one of them. A null id, text or source
    is a value of its own. An empty table gives an empty result.
    """
    text, source = F.col(text_col).cast("string"), F.col(source_col).cast("string")
    mark = F.xxhash64(F.coalesce(text, F.lit("")), text.isNull(), F.coalesce(source, F.lit("")), source.isNull()).alias("mark")
    key = ["row", "no_id", "mark"]
    keys = [F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")).alias("row"), F.col(id_col).isNull().alias("no_id"), mark]
    with steps() as own:
        thin = materialize(docs.select(*keys, source.alias("source"), size.alias("size")), "sizes")
        taken = systematic_mix(thin, F.col("size"), "row", "source", ties=("no_id", "mark"), **how)
        rows = taken.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"), F.sum("copies").alias("copies")).where("copies > 0")
        shares = own.keep(rows.select(*key, F.expr("copies div rows").alias("each"), F.expr("copies % rows").alias("over")), "copies")
    bundled = docs.select(*keys, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    times = lambda n: F.explode(F.sequence(F.lit(1), F.col(n).cast("int")))
    all_ = bundled.join(shares.where("each > 0").hint("merge"), key).select("doc", times("each").alias("copy"))
    over = shares.where("over > 0")
    some = with_partner(bundled, over, key).dropDuplicates(key).join(over.hint("merge"), key).select("doc", times("over").alias("copy"))
    return all_.unionByName(some).select("doc.*")
