"""Near-duplicate groups: b-bit MinHash candidates, exact similarity on full shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .joins import KEY, NO_ID, bundled, identified, original_id, with_partner, without
from .storage import materialize, steps
from .tokens import SPACED, U, as_long, mix, texts_of, windows, word_hashes

#: Words in a shingle.
WIDTH = 5
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Bands of ROWS minima. A pair at the threshold shares no band with probability (1 - 0.75**4)**32 = 5e-6.
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: Low bits kept of each minimum, packed into 64-bit words.
BITS = 2
LANES = 64 // BITS
PACKED = HASHES // LANES
#: Candidates whose estimate is lower by more than this many standard deviations go without the exact check.
DEVIATIONS = 5.5
#: Members up to which a band's bucket has all its pairs estimated; larger ones go by centres first.
SMALL = 4
#: Reference members of a large bucket from which its centre is found.
REFERENCES = 8
#: Further rounds of centres at most.
CENTRE_ROUNDS = 8
#: Members of a bucket that one task meets at once.
BLOCK = 1024
#: 64-bit words of the parity sketch that the last comparisons in large buckets look at first.
PARITY_WORDS = 16

_SKETCH = pa.schema(
    [("row", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("bands", pa.list_(pa.int64())), ("packed", pa.list_(pa.int64()))]
)
SKETCH_DDL = "row long, text_hash long, n_shingles long, d1 long, d2 long, bands array<long>, packed array<long>"


@lru_cache
def _family() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.Generator(np.random.PCG64(20240229))
    a = r.integers(0, 1 << 63, HASHES, dtype=np.uint64) * U(2) + U(1)
    return a[:, None], r.integers(0, 1 << 63, HASHES, dtype=np.uint64)[:, None]


def shingles(h: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Distinct shingle hashes, sorted; fewer words than ``width`` make one shingle."""
    if not len(h):
        return h
    return np.unique(windows(h, min(width, len(h))))


def minima(s: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a non-empty set."""
    a, b = _family()
    out = (s[None, :4096] * a + b).min(axis=1)
    for i in range(4096, len(s), 4096):
        np.minimum(out, (s[None, i : i + 4096] * a + b).min(axis=1), out=out)
    return out


def pack(m: np.ndarray) -> np.ndarray:
    """Low bits of the minima (rows of HASHES), LANES to a word."""
    low = (mix(m) & U((1 << BITS) - 1)).reshape(len(m), PACKED, LANES)
    return (low << (np.arange(LANES, dtype=U) * U(BITS))).sum(axis=2, dtype=U)


def band_keys(m: np.ndarray) -> np.ndarray:
    """One key for each band of minima."""
    g = m.reshape(len(m), BANDS, ROWS)
    out = np.broadcast_to(np.arange(BANDS, dtype=U), (len(m), BANDS)).copy()
    for r in range(ROWS):
        out = mix(out + g[:, :, r])
    return out


def shingle_texts(text: bytes, width: int = WIDTH) -> set[bytes]:
    """The distinct shingles of a text themselves, words joined by one blank."""
    w = text.lower().split()
    if len(w) < width:
        return {b" ".join(w)} if w else set()
    joined = b" ".join(w)
    starts = [0, *accumulate(len(x) + 1 for x in w)]
    return {joined[i : j - 1] for i, j in zip(starts, starts[width:])}  # noqa: B905 - the last starts begin no shingle


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = texts_of(batch.column(2))
        for first, bounds, h, _, _ in word_hashes(batch.column(2), SPACED):
            n = len(bounds) - 1
            sizes, digests, mins, filled = np.zeros(n, np.int64), np.zeros((n, 2), np.int64), [], []
            for k in range(n):
                s = shingles(h[bounds[k] : bounds[k + 1]])
                if len(s):
                    sizes[k] = len(s)
                    own = b" ".join(data[offsets[first + k] : offsets[first + k + 1]].tobytes().lower().split())
                    digests[k] = np.frombuffer(hashlib.blake2b(own, digest_size=16).digest(), np.int64)
                    mins.append(minima(s))
                    filled.append(k)
            counts = np.zeros(n, np.int32)
            counts[filled] = 1
            m = np.array(mins, dtype=U).reshape(-1, HASHES)

            def lists(x: np.ndarray, counts=counts) -> pa.Array:
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32) * x.shape[1]
                return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(as_long(np.ascontiguousarray(x)).ravel()))

            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, n), batch.column(1).slice(first, n), pa.array(sizes), pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy()), lists(band_keys(m)), lists(pack(m))],
                schema=_SKETCH,
            )


def sketches(rows: DataFrame) -> DataFrame:
    """Set size, 128-bit digest of the word sequence, band keys and packed signature of every row of joins.identified(); empty sets have empty lists."""
    return rows.select("row", "text_hash", "text").mapInArrow(_sketch, SKETCH_DDL)


def estimate(a: list[Column], b: list[Column]) -> Column:
    """Collision-corrected similarity from the packed bits of two signatures."""
    pairs = F.lit(int("01" * LANES, 2))
    unequal = None
    for x, y in zip(a, b, strict=True):
        d = x.bitwiseXOR(y)
        n = F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(pairs))
        unequal = n if unequal is None else unequal + n
    chance = 1.0 / (1 << BITS)
    return ((F.lit(1.0) - unequal / HASHES) - chance) / (1 - chance)


def lowest_estimate() -> float:
    """What an estimate of a linked pair undercuts only with negligible probability."""
    j, chance = PERCENT / 100, 1.0 / (1 << BITS)
    p = j + (1 - j) * chance
    return j - DEVIATIONS * (p * (1 - p) / HASHES) ** 0.5 / (1 - chance)


def _near(x: str, y: str) -> Column:
    """Whether a candidate deserves the exact check: sizes allow a link and the estimate is not too low."""
    n, m = F.col(f"{x}n"), F.col(f"{y}n")
    sizes = F.least(n, m) * 100 >= F.greatest(n, m) * PERCENT
    sig = lambda s: [F.col(f"{s}{i}") for i in range(PACKED)]
    return sizes & (estimate(sig(x), sig(y)) >= lowest_estimate())


def _blocks() -> Column:
    """Blocks that a bucket of ``size`` members is dealt to."""
    return F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")


def _everywhere(df: DataFrame) -> DataFrame:
    """Every row once in each block of its bucket: rows of other sides are in one block each."""
    return df.withColumn("block", F.explode(F.sequence(F.lit(0), _blocks() - 1)))


def _side(df: DataFrame, prefix: str) -> DataFrame:
    return df.select("bucket", "block", *[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in ("bucket", "block", "size", "main")])


def _pairs(left: DataFrame, right: DataFrame, more: Column) -> DataFrame:
    """Distinct pairs of one bucket that may be linked; only they leave the join.

    ``left`` rows are in their block; ``right`` rows go to every block, so no task meets
    more than BLOCK rows of ``left``, whatever the bucket.
    """
    return (
        _side(left, "x").join(_side(_everywhere(right.drop("block")), "y"), ["bucket", "block"]).where(more & _near("x", "y"))
        .select(F.least("xid", "yid").alias("a"), F.greatest("xid", "yid").alias("b")).distinct()
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose shingles, the words themselves, meet the threshold; one text's set is kept for the pairs that follow."""
    last, one = None, set()
    for batch in batches:
        keep = []
        for s, t in zip(batch.column(2), batch.column(3), strict=True):
            s, t = s.as_buffer(), t.as_buffer()
            if last is None or not s.equals(last):
                last, one = pa.py_buffer(s.to_pybytes()), shingle_texts(s.to_pybytes())
            two = shingle_texts(t.to_pybytes())
            both = len(one & two)
            keep.append(100 * both >= PERCENT * (len(one) + len(two) - both))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _confirmed(pairs: DataFrame, texts: DataFrame, tag: str) -> DataFrame:
    """The pairs ``a, b`` whose full sets meet the threshold. ``texts``: one ``id, text`` for each of their nodes."""
    one, two = (texts.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    rows = pairs.join(two.hint("merge"), "b").join(one.hint("merge"), "a").select("a", "b", "text_a", "text_b")
    return materialize(rows.mapInArrow(_compare, "a long, b long"), f"{tag}-links")


def candidate_rows(classes: DataFrame) -> DataFrame:
    """Members of shared band buckets: ``bucket, size, block, id, n, 0.. `` (packed signature)."""
    members = classes.select(
        F.explode("bands").alias("bucket"), F.col("node").alias("id"), F.col("n_shingles").alias("n"), *[F.get("packed", F.lit(i)).alias(str(i)) for i in range(PACKED)]
    )
    shared = classes.select(F.explode("bands").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return members.join(shared.hint("merge"), "bucket").withColumn("block", F.pmod(F.xxhash64("id", F.lit(2)), _blocks()).cast("int"))


def _centres(large: DataFrame) -> DataFrame:
    """``bucket, size, id``: for each large bucket the member most similar to a few references of it.

    References are the least member of each of REFERENCES hash classes, so both steps
    are aggregations that combine before the shuffle. Where a group was copied from one
    original with edits, that original is nearest to all and becomes the centre.
    """
    cls = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(REFERENCES))
    sig = [F.col(str(i)) for i in range(PACKED)]
    least = large.groupBy("bucket", cls.alias("c")).agg(F.min(F.struct("id", *sig)).alias("r"), F.first("size").alias("size"))
    refs = least.groupBy("bucket").agg(F.collect_list(F.array(*[F.col("r")[str(i)] for i in range(PACKED)])).alias("refs"), F.first("size").alias("size"))  # REFERENCES at most
    score = F.aggregate("refs", F.lit(0.0), lambda acc, r: acc + estimate(sig, [F.get(r, F.lit(i)) for i in range(PACKED)]))
    scored = large.join(_everywhere(refs).drop("size"), ["bucket", "block"])
    nearest = F.max(F.struct((F.round(score * 1e6)).cast("long").alias("s"), (-F.col("id")).alias("least")))
    return scored.groupBy("bucket").agg(nearest.alias("best"), F.first("size").alias("size")).select("bucket", "size", (-F.col("best.least")).alias("id"))


def _centre_pairs(among: DataFrame, members: DataFrame, more: Column) -> DataFrame:
    """Pairs of ``members`` with the centre that ``among`` gives their bucket: one pair a member at most."""
    centres = _everywhere(materialize(_centres(among), "centres")).drop("size")
    return _pairs(members, among.join(centres, ["bucket", "block", "id"], "left_semi"), more)


def parity(s: np.ndarray) -> np.ndarray:
    """Odd sketch of a set: each bit tells whether an odd number of members falls on it."""
    odd = np.bincount((s & U(64 * PARITY_WORDS - 1)).astype(np.int64), minlength=64 * PARITY_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, bounds, h, _, _ in word_hashes(batch.column(1), SPACED):
            n = len(bounds) - 1
            p = np.array([parity(shingles(h[bounds[k] : bounds[k + 1]])) for k in range(n)])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), *(pa.array(np.ascontiguousarray(c)) for c in p.T)], names=["id", *(f"p{i}" for i in range(PARITY_WORDS))])


def _few_differences() -> Column:
    """False only where two sets differ in more members than a link allows: sketches never differ in more bits."""
    bits = sum((F.bit_count(F.col(f"xp{i}").bitwiseXOR(F.col(f"yp{i}"))) for i in range(1, PARITY_WORDS)), F.bit_count(F.col("xp0").bitwiseXOR(F.col("yp0"))))
    return bits * (100 + PERCENT) <= (F.col("xn") + F.col("yn")) * (100 - PERCENT)


def _all_pairs(rest: DataFrame, placed: DataFrame, texts: DataFrame, apart: Column) -> DataFrame:
    """Pairs of ``rest`` with every member of ``placed`` in another component that may be linked."""
    open_ = _everywhere(rest.groupBy("bucket").agg(F.first("size").alias("size"))).drop("size")
    met = materialize(placed.join(open_, ["bucket", "block"], "left_semi"), "met")
    ddl = ", ".join(["id long", *(f"p{i} long" for i in range(PARITY_WORDS))])
    odd = materialize(texts.join(met.select("id").distinct(), "id", "left_semi").select("id", "text").mapInArrow(_parities, ddl), "parities")
    return _pairs(rest.join(odd, "id"), met.join(odd, "id"), apart & _few_differences())


def _large_links(large: DataFrame, links: DataFrame, tested: DataFrame, texts: DataFrame) -> DataFrame:
    """Edges with the components of ``links`` and of all further links in large buckets.

    While most comparisons left would be inside groups that only chains of links hold
    together, members outside their bucket's main component choose a centre among
    themselves, which all members of another component meet. When few are left, or a
    round settles little, each of them meets every member of another component; there,
    parity sketches bound the difference of two sets from below, so groups whose members
    resemble each other without a link leave few pairs to confirm. All of this is dealt
    by bucket and block, so one bucket spreads over as many tasks as its rows fill.
    """
    apart = F.col("xcomp") != F.col("ycomp")
    before = None
    rows = large.count()
    edges = links
    for r in range(CENTRE_ROUNDS + 1):
        with steps() as own:
            comp = materialize(components(edges).withColumnRenamed("node", "id"), "comp")
            edges = own.keep(comp.select(F.col("id").alias("a"), F.col("component").alias("b")), "stars")  # the same components
            placed = large.join(comp, "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
            placed = materialize(placed, "placed")
            per = placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("c"), F.first("size").alias("size"))
            main = per.groupBy("bucket").agg(F.max(F.struct("c", "comp"))["comp"].alias("main"), F.first("size").alias("size"))
            rest = materialize(placed.join(_everywhere(main).drop("size"), ["bucket", "block"]).where(F.col("comp") != F.col("main")), "rest")
            cost = rest.agg(F.sum("size")).first()[0] or 0
            if not cost:
                break
            last = cost <= 2 * rows or r == CENTRE_ROUNDS or (before is not None and cost > 0.9 * before)
            before = cost
            more = _all_pairs(rest, placed, texts, apart) if last else _centre_pairs(rest, placed, apart)
            more = own.keep(more.join(tested, ["a", "b"], "left_anti"), "more")
            edges = edges.union(own.keep(_confirmed(more, texts, "more"), "links"))
            if last:
                break
            tested = tested.union(more)
    return edges


def _decided(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row, text_hash, n_shingles, best`` of every row: ``best`` is the key of its group's least id and text (null: no set)."""
    rows = identified(docs, id_col, text_col)
    with steps() as own:
        sk = materialize(sketches(rows), "sketches")
        thin = sk.select(*KEY, "n_shingles", "d1", "d2")
        known = F.struct((F.col("row") == NO_ID).alias("no_id"), *KEY)
        classes = sk.where("n_shingles > 0").groupBy("d1", "d2").agg(F.min(known).alias("least"), *[F.first(c).alias(c) for c in ("n_shingles", "bands", "packed")])
        classes = materialize(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
        members = materialize(candidate_rows(classes), "members")

        small, large = members.where(F.col("size") <= SMALL), members.where(F.col("size") > SMALL)
        pairs = _pairs(small, small, F.col("xid") < F.col("yid")).union(_centre_pairs(large, large, F.col("xid") != F.col("yid"))).distinct()
        tested = materialize(pairs, "tested")
        nodes = tested.select(F.col("a").alias("node")).union(tested.select(F.col("b").alias("node"))).union(large.select(F.col("id").alias("node"))).distinct()
        wanted = materialize(classes.join(nodes, "node").select(F.col("node").alias("id"), "least.row", "least.text_hash"), "wanted")
        texts = materialize(with_partner(rows, wanted, KEY).dropDuplicates(KEY).join(wanted, KEY).select("id", "text"), "texts")
        links = _large_links(large, _confirmed(tested, texts, "first"), tested, texts)

        comp = materialize(components(links), "groups")
        named = classes.select("d1", "d2", "node", "least")
        linked = named.join(comp, "node")
        best = materialize(linked.groupBy("component").agg(F.min("least").alias("best")), "best")  # written, so that the join's hot groups can be split
        labelled = linked.join(best.hint("merge"), "component").select("d1", "d2", "best")
        alone = named.join(comp, "node", "left_anti").select("d1", "d2", F.col("least").alias("best"))
        return own.keep(thin.join(labelled.union(alone), ["d1", "d2"], "left").select(*KEY, "n_shingles", "best"), "near-groups")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, n_shingles, component_id, kept``.

    1. One pass over the texts gives each row's set size, a digest of its words, 128
       minima as 32 band keys, and the low 2 bits of each minimum packed into four
       integers. Rows of the same words form a class, which is one node below.
    2. Classes that share a band key are candidates. Their similarity is estimated from
       the packed bits, corrected for chance agreement, as the condition of the join on
       the key, so pairs that cannot be linked are never emitted. Small buckets have all
       pairs estimated. In a large one every member meets the bucket's centre; once those
       links are known, members outside the bucket's main component go on with centres
       of their own, and in the end meet all the others.
       So every candidate pair is either compared or already in one component, and a
       group of near copies costs pairs in proportion to its members.
    3. Pairs that pass are confirmed on their full sets of shingles, word by word.
    4. Components of the confirmed links, joined to classes and rows.

    A set has the distinct shingles of five words (white space separated, A-Z
    lower-cased); fewer words make one shingle. Null, empty and blank texts have no set,
    are linked with nothing and are kept. Rows that repeat an id are treated one by one.
    Rows with a null id take part in links; a group's ``component_id`` is its least id
    that is not null, and its rows with a null id are kept only where it has no id at
    all. Ids must be integers. An empty table gives an empty result. Other columns are
    not read.
    """
    out = _decided(docs, id_col, text_col)
    cid = F.when(F.col("best").isNull(), original_id()).otherwise(F.nullif("best.row", F.lit(NO_ID)))
    return out.select(original_id().alias("doc_id"), "n_shingles", cid.alias("component_id"), cid.eqNullSafe(original_id()).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group: of least id (null last), then of least text hash.

    Rows without words stay. Of rows that repeat both id and text one stays, whichever
    of them; their other columns are not compared.
    """
    out = _decided(docs, id_col, text_col).where("best is not null")
    first = F.struct(*KEY) == F.struct("best.row", "best.text_hash")
    touched = out.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"), F.first(first).alias("first")).where("n > 1 or not first").select(*KEY, "first")
    touched = materialize(touched, "near-copies")
    rows = bundled(docs, id_col, text_col)
    again = with_partner(rows, touched.where("first"), KEY).join(touched.where("first").select(*KEY), KEY, "left_semi").dropDuplicates(KEY)
    return without(rows, touched, KEY).unionByName(again).select("doc.*")
