"""Exact similarity join of shingle sets by PartEnum signatures."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .joins import KEY, NO_ID, identified, original_id, with_partner, without
from .names import repeated_positions
from .near_dedup import shingle_texts, shingles
from .storage import materialize, steps
from .tokens import SPACED, U, mix, texts_of, word_hashes

#: Words in a shingle.
WIDTH = 4
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 85
#: Differences that a partition of the domain may hold and still count, and the parts that it is cut into. Signatures are of all parts but as many.
K2, N2 = 1, 3
#: A signature of fewer members is poor: it says little, and sets of any kind share it.
POOR = 3
#: Partitions for each one that a set may leave its poor signatures out of.
SPARE = 16
#: Bits of a parity sketch for each difference that a link allows, and at most.
SKETCH_BITS, MOST_BITS = 8, 1 << 16
#: Members up to which a bucket's pairs are all formed by a join.
SMALL = 4
#: Members of a larger bucket that one task meets at once, on either side.
BLOCK = 1024
#: Rounds in which a set meets only its nearest of each other component, before it meets all that are left.
NEAREST_ROUNDS = 1


def most_differences(sizes: int, percent: int = PERCENT) -> int:
    """Largest symmetric difference of two linked sets whose sizes add up to ``sizes``."""
    return (100 - percent) * sizes // (100 + percent)


@lru_cache(maxsize=1)
def _bands(percent: int, upto: int) -> np.ndarray:
    """Least size of each band, upwards: sets of one band or of neighbouring ones may be linked, others not."""
    lows = [1]
    while lows[-1] <= upto:
        lows.append(lows[-1] * 100 // percent + 1)
    return np.array(lows)


def band_of(size: int, percent: int = PERCENT) -> tuple[int, np.ndarray]:
    """A size's band, and the least sizes of all bands up to the second next."""
    upto = max(1 << 16, 1 << (2 * size).bit_length())
    lows = _bands(percent, upto)
    return int(np.searchsorted(lows, size, "right")) - 1, lows


@lru_cache(maxsize=4096)
def _partitions(most: int, percent: int) -> tuple[int, int]:
    k = most_differences(2 * most, percent)
    if not k:
        return 0, 0
    need = k // (K2 + 1) + 1
    spare = need // SPARE
    return need + 2 * spare, spare


def partitions(band: int, lows: np.ndarray, percent: int = PERCENT) -> tuple[int, int]:
    """Partitions of the domain for sets of a band or the one below, and poor signatures that a set may leave out.

    Linked sets differ in at most ``k`` members, so at most ``k // (K2 + 1)`` partitions
    hold more than K2 differences. All others yield an equal signature each; with twice
    as many of them to spare as a set leaves out, one remains that neither left out.
    No partitions where different sets cannot be linked.
    """
    return _partitions(int(lows[band + 1]) - 1, percent)


def _signed(members: np.ndarray, owner: np.ndarray, bands: np.ndarray, n1: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of many sets, each in one band, members that each is of, and bounds of each set's signatures.

    A member's hash deals it to a partition and to one of its N2 parts. The signature of
    a partition for each choice of N2 - K2 = 2 parts is a sum over their members, which
    is the partition's sum less one part's, mixed with band, partition and choice.
    ``owner`` is the set of each member; ``bands`` and ``n1`` (partitions) are by set.
    """
    first = np.concatenate([[0], np.cumsum(n1 * N2)])
    g = mix(members + ((bands.astype(U) + U(1)) * U(0x9E3779B97F4A7C15))[owner])
    cell = ((g >> U(32)) * n1.astype(U)[owner] >> U(32)).astype(np.int64) * N2 + ((g & U(0xFFFFFFFF)) * U(N2) >> U(32)).astype(np.int64) + first[:-1][owner]
    sums, counts = np.zeros(first[-1], U), np.bincount(cell, minlength=first[-1])
    np.add.at(sums, cell, mix(members ^ U(0xD1B54A32D192ED03)))
    sums, counts = sums.reshape(-1, N2), counts.reshape(-1, N2)
    sizes = n1 * N2
    names = np.arange(first[-1], dtype=np.int64) - np.repeat(first[:-1], sizes) + np.repeat(bands.astype(np.int64) << 40, sizes)
    return mix((sums.sum(axis=1, dtype=U, keepdims=True) - sums).ravel() ^ mix(names.view(U))), (counts.sum(axis=1, keepdims=True) - counts).ravel(), first


def signatures_of(sets: list[np.ndarray], percent: int = PERCENT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each set's signatures, for its band and the next, and which of them it keeps.

    Any two different linked sets have a kept signature in common.
    """
    plan = []
    for i, s in enumerate(sets):
        if len(s):
            band, lows = band_of(len(s), percent)
            plan += [(i, b, *partitions(b, lows, percent)) for b in (band, band + 1)]
    plan = [x for x in plan if x[2]]
    found: list[list] = [[] for _ in sets]
    if plan:
        sizes = np.array([len(sets[x[0]]) for x in plan])
        h, members, first = _signed(
            np.concatenate([sets[x[0]] for x in plan]), np.repeat(np.arange(len(plan)), sizes), np.array([x[1] for x in plan]), np.array([x[2] for x in plan])
        )
        keep = np.ones(len(h), bool)
        poor = np.flatnonzero(members < POOR)
        ends = np.searchsorted(poor, first)
        for k, (_, _, _, spare) in enumerate(plan):
            own = poor[ends[k] : ends[k + 1]]
            if spare and len(own):
                keep[own[np.argsort(members[own], kind="stable")[:spare]]] = False
        for k, x in enumerate(plan):
            found[x[0]].append(slice(first[k], first[k + 1]))
    for at in found:
        if at:
            whole = slice(at[0].start, at[-1].stop)
            yield h[whole], keep[whole]
        else:
            yield np.zeros(0, U), np.zeros(0, bool)


def signatures(s: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """signatures_of() one set."""
    return next(signatures_of([s], percent))


def parity(s: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Odd sketch: each bit tells whether an odd number of members falls on it. Two sketches never differ in more bits than the sets in members."""
    bits = 64
    while bits < min(MOST_BITS, SKETCH_BITS * most_differences(2 * len(s), percent)):
        bits *= 2
    odd = np.bincount((s & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(U)


def folded(sketch: np.ndarray, words: int) -> np.ndarray:
    """Sketches (last axis) as those of fewer bits."""
    while sketch.shape[-1] > words:
        half = sketch.shape[-1] // 2
        sketch = sketch[..., :half] ^ sketch[..., half:]
    return sketch


_THIN_DDL = "row long, text_hash long, n_shingles long, d1 long, d2 long"


def _sets(batch: pa.RecordBatch, column: int, width: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and distinct shingle hashes of the rows from there on, block by block."""
    for first, bounds, h, _, _ in word_hashes(batch.column(column), SPACED):
        yield first, [shingles(h[bounds[k] : bounds[k + 1]], width) for k in range(len(bounds) - 1)]


def _sizes(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests = np.zeros(len(batch), np.int64), np.zeros((len(batch), 2), np.int64)
            for i, s in ((first + k, s) for first, sets in _sets(batch, 2, width) for k, s in enumerate(sets)):
                sizes[i] = len(s)
                digests[i] = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.int64)
            cols = [batch.column(0), batch.column(1), pa.array(sizes), pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(cols, names=["row", "text_hash", "n_shingles", "d1", "d2"])

    return work


def _namer(width: int, percent: int):
    """Kept signatures of every row ``uid, text``, for names.repeated_positions()."""

    def namer(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            uid = batch.column(0).to_pylist()
            for first, sets in _sets(batch, 1, width):
                for k, (h, kept) in enumerate(signatures_of(sets, percent)):
                    at = np.flatnonzero(kept)
                    if len(at):
                        yield uid[first + k], h[at], None, at

    return namer


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.zeros(0, np.int64), *(p.view(np.int64) for p in parts)])))


_CANDIDATE_DDL = "node long, n long, buckets array<long>, sketch array<long>, text string"


def _candidates(width: int, percent: int):
    """Shared signatures and sketch of rows ``node, n, positions, text``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, sketches = [np.zeros(0, U)] * len(batch), [np.zeros(0, U)] * len(batch)
            for first, sets in _sets(batch, 3, width):
                for i, s, (h, _) in zip(range(first, first + len(sets)), sets, signatures_of(sets, percent), strict=True):
                    buckets[i] = h[np.asarray(batch.column(2)[i].values)]
                    sketches[i] = parity(s, percent)
            cols = [batch.column(0), batch.column(1), _lists(buckets), _lists(sketches), batch.column(3)]
            yield pa.RecordBatch.from_arrays(cols, names=["node", "n", "buckets", "sketch", "text"])

    return work


def _differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Bits in which sketches differ, along the last axis."""
    words = min(x.shape[-1], y.shape[-1])
    return np.bitwise_count(folded(x, words) ^ folded(y, words)).sum(axis=-1, dtype=np.int64)


def _possible(percent: int):
    """Pairs ``a, b, n_a, n_b, s_a, s_b`` whose sizes and sketches allow a link."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (np.asarray(batch.column(i)) for i in (2, 3))
            keep = np.minimum(n, m) * 100 >= np.maximum(n, m) * percent
            for i in np.flatnonzero(keep):
                x, y = (np.asarray(batch.column(c)[int(i)].values).view(U) for c in (4, 5))
                keep[i] = _differing(x, y) <= most_differences(int(n[i] + m[i]), percent)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return work


def _compare(width: int, percent: int):
    """Pairs ``a, b, text_a, text_b`` whose shingles, the words themselves, meet the threshold; one text's set is kept for the pairs that follow."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, one = None, set()
        for batch in batches:
            keep = []
            for a, s, t in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a != last:
                    last, one = a, shingle_texts(s.as_buffer().to_pybytes(), width)
                two = shingle_texts(t.as_buffer().to_pybytes(), width)
                both = len(one & two)
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return work


#: Sides of a row in a pair of blocks.
_RIGHT, _LEFT, _BOTH = 0, 1, 2
_MET = ["bucket", "x", "y", "side", "node", "comp", "n", "sketch"]


def _meet(nearest: bool, percent: int):
    """Pairs within two blocks of a bucket, in different components, whose sizes and sketches allow a link; only they leave the task.

    Rows _MET arrive sorted by bucket and blocks, and one pair of blocks is held.
    """

    def pairs(bucket: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
        side, node, comp, n = (np.asarray(table[c]) for c in _MET[3:7])
        sketches = [np.asarray(v.values).view(U) for v in table["sketch"].combine_chunks()]
        words = min(map(len, sketches))
        bits_of = np.stack([folded(k, words) for k in sketches])
        left, right = np.flatnonzero(side != _RIGHT), np.flatnonzero(side != _LEFT)
        right = right[np.argsort(comp[right], kind="stable")]
        ys, yc, yn, yk = node[right], comp[right], n[right], bits_of[right]
        starts = np.flatnonzero(np.append(True, yc[1:] != yc[:-1])) if len(yc) else yc
        a, b = [], []
        for i in left if len(right) else []:
            bits = np.bitwise_count(bits_of[i] ^ yk).sum(axis=1, dtype=np.int64)
            near = (yc != comp[i]) & (bits * (100 + percent) <= (100 - percent) * (n[i] + yn)) & (np.minimum(yn, n[i]) * 100 >= np.maximum(yn, n[i]) * percent)
            if not near.any():
                continue
            if nearest:
                far = np.where(near, bits, np.iinfo(np.int64).max)
                least = np.minimum.reduceat(far, starts)
                first = np.flatnonzero(near & (far == np.repeat(least, np.diff(np.append(starts, len(yc))))))
                near = first[np.unique(yc[first], return_index=True)[1]]
            a.append(np.minimum(node[i], ys[near]))
            b.append(np.maximum(node[i], ys[near]))
        if a:
            a, b = np.concatenate(a), np.concatenate(b)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), bucket)), pa.array(a), pa.array(b)], names=["bucket", "a", "b"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            ids = np.stack([np.asarray(batch.column(i), dtype=np.int64) for i in range(3)])
            cuts = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(batch)], strict=True):
                if lo == hi:
                    continue
                own = tuple(ids[:, lo].tolist())
                if held and own != key:
                    yield from pairs(key[0], pa.Table.from_batches(held))
                    held = []
                key = own
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from pairs(key[0], pa.Table.from_batches(held))

    return work


class _Join:
    """Links of candidates, bucket by bucket. ``candidates``: one row a class, as _CANDIDATE_DDL, written."""

    def __init__(self, candidates: DataFrame, width: int, percent: int):
        self.candidates, self.width, self.percent = candidates, width, percent

    def possible(self, pairs: DataFrame) -> DataFrame:
        one, two = (self.candidates.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}")) for c in "ab")
        both = pairs.join(two.hint("merge"), "b").join(one.hint("merge"), "a").select("a", "b", "n_a", "n_b", "s_a", "s_b")
        return both.mapInArrow(_possible(self.percent), "a long, b long")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        one, two = (self.candidates.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
        rows = pairs.join(two.hint("merge"), "b").join(one.hint("merge"), "a").select("a", "b", "text_a", "text_b")
        return rows.mapInArrow(_compare(self.width, self.percent), "a long, b long")

    def members(self) -> DataFrame:
        """``bucket, node, size`` of buckets with at least two members."""
        rows = self.candidates.select(F.explode("buckets").alias("bucket"), "node")
        shared = materialize(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "buckets")
        return rows.join(shared.hint("merge"), "bucket")

    def hubs(self, large: DataFrame) -> DataFrame:
        """Pairs of every member with its bucket's hub: the member that meets most others in all its buckets."""
        met = large.groupBy("node").agg(F.sum("size").alias("met"))
        best = large.join(met.hint("merge"), "node").groupBy("bucket").agg(F.max(F.struct("met", (-F.col("node")).alias("least"))).alias("best"))
        best = materialize(best.select("bucket", (-F.col("best.least")).alias("hub")), "hubs")
        pairs = large.join(best.hint("merge"), "bucket").where("node <> hub")
        return pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()

    def across(self, large: DataFrame, comp: DataFrame, nearest: bool) -> DataFrame:
        """``bucket, a, b``: pairs of large buckets between components. Members of a bucket's largest component meet only the others.

        A bucket that gives no pair will give none later, as components only merge.
        """
        placed = large.join(comp, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("comp"))
        placed = materialize(placed, "placed")
        per = placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c"))
        blocks = lambda c: F.ceil(c / F.lit(BLOCK)).cast("int")
        open_ = per.groupBy("bucket").agg(F.max(F.struct("c", "comp")).alias("m"), F.sum("c").alias("size")).where("size > m.c")
        open_ = open_.select("bucket", F.col("m.comp").alias("main"), blocks(F.col("size") - F.col("m.c")).alias("xs"), blocks(F.col("size")).alias("ys"))
        open_ = materialize(open_, "open")
        block = lambda c, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(c)).cast("int")
        every = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
        at = lambda x, y, side: F.struct(x.alias("x"), y.alias("y"), F.lit(side).alias("side"))
        rest, one = F.col("comp") != F.col("main"), (F.col("xs") == 1) & (F.col("ys") == 1)
        right = F.transform(every("xs"), lambda x: at(x, block("ys", 2), _RIGHT))
        left = F.transform(every("ys"), lambda y: at(block("xs", 1), y, _LEFT))
        places = F.when(one, F.array(F.when(rest, at(F.lit(0), F.lit(0), _BOTH)).otherwise(at(F.lit(0), F.lit(0), _RIGHT)))).when(rest, F.concat(left, right)).otherwise(right)
        rows = placed.join(open_.hint("merge"), "bucket").select("bucket", "node", "comp", F.explode(places).alias("p"))
        sketches = self.candidates.select("node", "n", "sketch")
        rows = rows.join(sketches.hint("merge"), "node").select("bucket", "p.x", "p.y", "p.side", "node", "comp", "n", "sketch")
        dealt = rows.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")
        return dealt.mapInArrow(_meet(nearest, self.percent), "bucket long, a long, b long")

    def groups(self) -> DataFrame:
        """``node, component`` of every candidate with a link."""
        members = materialize(self.members(), "members")
        small, large = members.where(F.col("size") <= SMALL), members.where(F.col("size") > SMALL)
        mine, other = small.select("bucket", F.col("node").alias("a")), small.select("bucket", F.col("node").alias("b"))
        pairs = mine.join(other, "bucket").where("a < b").select("a", "b").union(self.hubs(large)).distinct()
        tested = materialize(self.possible(pairs), "tested")
        comp = materialize(components(materialize(self.confirmed(tested), "links")), "comp")
        for nearest in [True] * NEAREST_ROUNDS + [False]:
            met = materialize(self.across(large, comp, nearest), "met")
            if met.isEmpty():
                break
            more = materialize(met.select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"), "more")
            links = materialize(self.confirmed(more), "links")
            if not links.isEmpty():
                stars = comp.select(F.col("node").alias("a"), F.col("component").alias("b"))  # the same components
                comp = materialize(components(stars.union(links)), "comp")
            tested = tested.union(more)
            large = materialize(large.join(met.select("bucket").distinct(), "bucket", "left_semi"), "open-members")
        return comp


def _decided(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """``row, text_hash, n_shingles, best`` of every row: ``best`` is the key of its component's least id and text (null: no set)."""
    rows = identified(docs, id_col, text_col)
    uid = F.xxhash64(*KEY).alias("uid")
    with steps() as own:
        thin = materialize(rows.mapInArrow(_sizes(width), _THIN_DDL), "sizes")
        known = F.struct((F.col("row") == NO_ID).alias("no_id"), *KEY)
        digest = ["d1", "d2"]
        classes = thin.where("n_shingles > 0").groupBy(*digest).agg(F.min(known).alias("least"), F.first("n_shingles").alias("n"))
        classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
        least = classes.select(*digest, F.col("least.row").alias("row0"), F.col("least.text_hash").alias("hash0"))
        copies = thin.join(least.hint("merge"), digest).where("row <> row0 or text_hash <> hash0").select(*KEY)
        copies = materialize(copies.union(thin.where("n_shingles = 0").select(*KEY)).distinct(), "copies")
        shared = repeated_positions(without(rows, copies, KEY).select(uid, "text"), _namer(width, percent))
        shared = shared.groupBy("uid").agg(F.array_distinct(F.flatten(F.collect_list("positions"))).alias("positions"))  # one document's signatures
        named = classes.select(F.col("least.row").alias("row"), F.col("least.text_hash").alias("text_hash"), "node", "n").withColumn("uid", uid)
        wanted = materialize(named.join(shared, "uid").drop("uid"), "shared")
        texts = with_partner(rows, wanted, KEY).join(wanted.hint("merge"), KEY).dropDuplicates(KEY).select("node", "n", "positions", "text")
        candidates = materialize(texts.mapInArrow(_candidates(width, percent), _CANDIDATE_DDL), "candidates")
        comp = _Join(candidates, width, percent).groups()
        linked = classes.select(*digest, "node", "least").join(comp, "node")
        best = materialize(linked.groupBy("component").agg(F.min("least").alias("best")), "best")  # written, so that the join's hot groups can be split
        labelled = linked.join(best.hint("merge"), "component").select(*digest, "best")
        alone = classes.join(comp, "node", "left_anti").select(*digest, F.col("least").alias("best"))
        found = materialize(labelled.union(alone), "found")
        return own.keep(thin.join(found.hint("merge"), digest, "left").select(*KEY, "n_shingles", "best"), "joined")


def similar_groups(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, n_shingles, component_id``.

    1. A first pass gives each row's set size and a 128-bit digest of its set. Rows of
       equal sets form a class, and one row of each goes on.
    2. Sizes are cut into bands, so that linked sets are of one band or of neighbours,
       and a set is signed for its own and the next. A band's bound on the symmetric
       difference of linked sets gives the number of partitions of the domain, of which
       at least one then holds at most K2 differences; its signature for one choice of
       N2 - K2 of its N2 parts is equal in both sets. Nothing here rests on chance.
    3. Signatures that occur once are found in packed arrays and go no further.
    4. In buckets of few members all pairs are formed. In larger ones every member meets
       the bucket's hub; then members outside the largest component meet the others,
       block by block in bounded tasks, nearest ones first, and only pairs of different
       components whose sizes and parity sketches, which bound the difference from below,
       allow a link leave a task. So every pair that shares a signature is compared,
       proved apart, or in one component already.
    5. Pairs are confirmed on their full sets, word by word; then components.

    A set has the distinct shingles of ``width`` words (white space separated, A-Z
    lower-cased); fewer words make one shingle. Null, empty and blank texts have no set
    and are linked with nothing. Rows that repeat an id are treated one by one. Rows with
    a null id take part; a component's id is its least id that is not null, if any. Ids
    must be integers. An empty table gives an empty result. Other columns are not read.
    """
    out = _decided(docs, id_col, text_col, width, percent)
    cid: Column = F.when(F.col("best").isNull(), original_id()).otherwise(F.nullif("best.row", F.lit(NO_ID)))
    return out.select(original_id().alias("doc_id"), "n_shingles", cid.alias("component_id"))
