"""Benchmark decontamination over a distributed positional inverted index."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import KEY, identified, original_id, with_partner, without_rows
from .storage import materialize, steps
from .tokens import ALNUM, U, as_long, word_hashes, words_of

#: Consecutive words of an item that make a window.
WIDTH = 10
#: Test terms sent to the tasks at once (8 bytes each); a larger test vocabulary takes several passes.
TERMS_AT_ONCE = 2_000_000
#: The rarest terms of a window whose posting lists are intersected.
ANCHORS = 2


def _item_windows(width: int):
    schema = pa.schema([("item", pa.string()), ("window", pa.binary()), ("phrase", pa.binary()), ("terms", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for first, bounds, h, _, _ in word_hashes(texts, ALNUM):
                rows = []
                for k in range(len(bounds) - 1):
                    own = as_long(h[bounds[k] : bounds[k + 1]])
                    n = min(width, len(own))
                    words = words_of(texts[first + k].as_buffer().to_pybytes(), ALNUM) if n else []
                    for i in range(len(own) - n + 1 if n else 0):
                        phrase = b" ".join(words[i : i + n])
                        rows.append((batch.column(0)[first + k].as_py(), hashlib.blake2b(phrase, digest_size=16).digest(), phrase, own[i : i + n]))
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(schema.types)], schema=schema)

    return work


def item_windows(items: DataFrame, width: int = WIDTH, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item, window, phrase, terms``: a 128-bit key, the words and their hashes for every window of every item."""
    out = items.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).mapInArrow(_item_windows(width), "item string, window binary, phrase binary, terms array<long>")
    return out.dropDuplicates(["item", "window"])


def _counts(terms: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches if len(terms) else ():
            for _, _, h, _, _ in word_hashes(batch.column(0), ALNUM):
                at = np.searchsorted(terms, h)
                at[at == len(terms)] = 0
                total += np.bincount(at[terms[at] == h], minlength=len(terms))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(as_long(terms[some])), pa.array(total[some])], names=["term", "n"])

    return work


def _postings(terms: np.ndarray, count_words: bool):
    schema = pa.schema([("row", pa.int64()), ("text_hash", pa.int64()), ("term", pa.int64()), ("pos", pa.int64())])
    probe = np.zeros(1 << 20, bool)
    probe[(terms & U((1 << 20) - 1)).astype(np.int64)] = True

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, hashes = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            for first, bounds, h, _, _ in word_hashes(batch.column(2), ALNUM):
                if count_words:
                    own = slice(first, first + len(bounds) - 1)
                    yield pa.RecordBatch.from_arrays([pa.array(rows[own]), pa.array(hashes[own]), pa.nulls(len(bounds) - 1, pa.int64()), pa.array(np.diff(bounds))], schema=schema)
                if not len(terms):
                    continue
                maybe = np.flatnonzero(probe[(h & U((1 << 20) - 1)).astype(np.int64)])
                at = np.searchsorted(terms, h[maybe])
                at[at == len(terms)] = 0
                hit = maybe[terms[at] == h[maybe]]
                k = np.searchsorted(bounds, hit, "right") - 1
                yield pa.RecordBatch.from_arrays([pa.array(rows[first + k]), pa.array(hashes[first + k]), pa.array(as_long(h[hit])), pa.array(hit - bounds[k])], schema=schema)

    return work


def _in_blocks(terms: DataFrame) -> Iterator[np.ndarray]:
    """The distinct terms as sorted arrays of about TERMS_AT_ONCE at most."""
    n = terms.count()
    parts = max(1, -(-n // TERMS_AT_ONCE))
    for i in range(parts):
        own = terms if parts == 1 else terms.where(F.pmod(F.xxhash64("term"), F.lit(parts)) == i)
        yield np.sort(np.array([r.term for r in own.toLocalIterator()], dtype=np.int64).view(U))


def _merge(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term, n``: occurrences in all ``docs`` (see identified()) of the distinct ``terms``; absent ones are left out."""
    return _merge([materialize(docs.select("text").mapInArrow(_counts(t), "term long, n long").groupBy("term").agg(F.sum("n").alias("n")), "term-counts") for t in _in_blocks(terms)])


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """Positional index of ``terms``: ``row, text_hash, term, pos``; rows with a null term hold each document's word count.

    Every block of terms is one pass that is written before the next block is fetched.
    """
    return _merge([materialize(docs.mapInArrow(_postings(t, i == 0), "row long, text_hash long, term long, pos long"), "postings") for i, t in enumerate(_in_blocks(terms))])


def _ordered_span(words: list[bytes], terms: list[bytes], lo: int, hi: int, most: int) -> tuple[int, int] | None:
    """The first span that starts in lo..hi and has ``terms`` in order within ``most`` words."""
    for begin in range(max(0, lo), min(hi + 1, len(words))):
        if words[begin] != terms[0]:
            continue
        at, stop = begin, min(len(words), begin + most)
        for t in terms[1:]:
            at = next((i for i in range(at + 1, stop) if words[i] == t), -1)
            if at < 0:
                break
        else:
            return begin, at + 1
    return None


def _verified(slop: int):
    """Candidates that match word by word; columns: row, text_hash, text, candidates."""
    schema = pa.schema([("row", pa.int64()), ("text_hash", pa.int64()), ("n_hit", pa.int64()), ("matches", pa.list_(pa.struct([("window", pa.binary()), ("start", pa.int64()), ("stop", pa.int64())])))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, matches = [], []
            for k in range(len(batch)):
                words = words_of(batch.column(2)[k].as_buffer().to_pybytes(), ALNUM)
                covered, found = np.zeros(len(words) + 1, np.int64), set()
                for c in batch.column(3)[k].as_py():
                    start, terms = c["start"], bytes(c["phrase"]).split(b" ")
                    if slop:
                        span = _ordered_span(words, terms, start - slop, start + slop, len(terms) + slop)
                    else:
                        span = (start, start + len(terms)) if start >= 0 and words[start : start + len(terms)] == terms else None
                    if span:
                        found.add((bytes(c["window"]), *span))
                        covered[span[0]] += 1
                        covered[span[1]] -= 1
                hits.append(int((np.cumsum(covered) > 0).sum()))
                matches.append([{"window": w, "start": s, "stop": e} for w, s, e in sorted(found)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(hits, pa.int64()), pa.array(matches, schema.field("matches").type)], schema=schema)

    return work


def matched_windows(docs: DataFrame, wins: DataFrame, slop: int = 0) -> tuple[DataFrame, DataFrame]:
    """``(row, text_hash, n_words)`` of all ``docs`` and ``(row, text_hash, n_hit, matches)`` of those with matches.

    ``docs`` as from identified(), ``wins`` as from item_windows(). Steps: count the test
    terms over all documents; take each window's rarest ANCHORS terms as its anchors;
    store the postings of the anchors with document and position; move the posting lists
    by the anchors' offsets and intersect them, which leaves candidate starts; check
    each candidate on the whole document, comparing the words themselves. With ``slop`` 0
    a match is the exact phrase; otherwise the window's words in order within ``slop``
    more words than it has.
    """
    distinct = materialize(wins.select("window", "phrase", "terms").dropDuplicates(["window"]), "windows")
    offsets = distinct.select("window", F.size("terms").alias("n"), F.posexplode("terms").alias("off", "term"))
    freq = term_counts(docs, offsets.select("term").distinct())
    ranked = (
        offsets.join(freq.withColumnRenamed("n", "freq"), "term")
        .groupBy("window", "n").agg(F.sort_array(F.collect_list(F.struct("freq", "off", "term"))).alias("by_freq"))  # one window's words
        .where(F.size("by_freq") == F.col("n"))  # a term that the corpus lacks rules the window out
    )
    anchors = ranked.select("window", "n", *[F.get("by_freq", F.lit(i)).alias(f"a{i}") for i in range(ANCHORS)])
    anchors = materialize(anchors, "anchors")
    used = anchors.select(F.explode(F.filter(F.array(*[F.col(f"a{i}.term") for i in range(ANCHORS)]), lambda t: t.isNotNull())).alias("term")).distinct()
    index = postings(docs, used)
    words = index.where("term is null").select("row", "text_hash", F.col("pos").alias("n_words"))
    lists = index.where("term is not null")
    where = ["row", "text_hash"]
    starts = lists.join(anchors.withColumn("term", F.col("a0.term")), "term").withColumn("start", (F.col("pos") - F.col("a0.off")))
    near = starts.select(*where, "window", "n", "start", "a1").where(F.col("start") >= -slop)
    second = lists.select(*where, F.col("term").alias("t2"), F.col("pos").alias("p2"))
    delta = F.col("p2") - F.col("a1.off") - F.col("start")
    paired = near.where("a1 is not null")
    if slop:
        paired = paired.join(second, where).where((F.col("t2") == F.col("a1.term")) & (F.abs(delta) <= slop))
    else:
        paired = paired.withColumn("t2", F.col("a1.term")).withColumn("p2", F.col("start") + F.col("a1.off")).join(second, [*where, "t2", "p2"], "left_semi")
    found = paired.select(*where, "window", "n", "start").union(near.where("a1 is null").select(*where, "window", "n", "start")).distinct()
    found = found.join(distinct.select("window", "phrase"), "window")
    per_doc = materialize(found.groupBy(*where).agg(F.collect_list(F.struct("window", "phrase", "start")).alias("candidates")), "candidates")
    checked = (
        with_partner(docs, per_doc, where).dropDuplicates(where).join(per_doc, where)
        .select(*where, "text", "candidates")
        .mapInArrow(_verified(slop), "row long, text_hash long, n_hit long, matches array<struct<window: binary, start: long, stop: long>>")
    )
    return words, checked.where("n_hit > 0")


def contamination(
    docs: DataFrame, items: DataFrame, width: int = WIDTH, slop: int = 0, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items``.

    Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased. A
    window is ``width`` consecutive words of an item, or all words of a shorter one. A
    document word inside a match of a window is hit. ``items`` lists the ids, as sorted
    strings, of the items with matches; the digest is of that list joined by commas
    (of the empty string where there are none). See matched_windows() for ``slop``.

    Null and empty texts have no words on either side. Rows that repeat an id are
    treated one by one; a null id stays null. Items that repeat a text all match; an item
    with a null id counts for ``n_hit`` and is in no list. Empty tables on either side
    give no hits. Other columns are not read.
    """
    out = _found(docs, items, width, slop, id_col, text_col, item_col)
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return out.select(
        original_id().alias("doc_id"),
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.size(items_).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_, ","), 256).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        items_.alias("items"),
    )


def _found(docs: DataFrame, items: DataFrame, width: int, slop: int, id_col: str, text_col: str, item_col: str) -> DataFrame:
    """``row, text_hash, n_words, n_hit, items`` of every row; the last two are null without a match."""
    rows = identified(docs, id_col, text_col)
    with steps() as own:
        wins = materialize(item_windows(items, width, item_col), "item-windows")
        words, matched = matched_windows(rows, wins, slop)
        matched = materialize(matched, "matches")
        hits = (
            matched.select(*KEY, F.explode(F.array_distinct(F.transform("matches", lambda m: m["window"]))).alias("window"))
            .join(wins.select("item", "window"), "window")
            .groupBy(*KEY).agg(F.array_sort(F.collect_set("item")).alias("items"))
        )
        return own.keep(words.join(matched.select(*KEY, "n_hit").join(hits, KEY), KEY, "left"), "contamination")


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, slop: int = 0, item_col: str = "item_id") -> DataFrame:
    """``docs`` without the contaminated rows. Rows are known by id and text, so each that repeats an id is judged by its own text, as is one with a null id."""
    found = _found(docs, items, width, slop, id_col, text_col, item_col).where("n_hit > 0").select(*KEY)
    return without_rows(docs, materialize(found, "contaminated"), id_col, text_col)
