"""Quality classification by co-training a text view and a metadata view."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .storage import materialize, steps
from .tokens import SPACED, blocks, texts_of, word_hashes

#: Labelled documents learned from: with the pseudo-labels given, the bound of what one task fits.
LABELLED = 6000
#: Buckets of hashed byte trigrams.
BUCKETS = 2048
#: Rounds of co-training, and pseudo-labels that a view gives the other in a round.
ROUNDS, GIVEN = 4, 150
#: Gradient steps of a first fit, and of one that goes on.
FIRST_STEPS, MORE_STEPS = 250, 60
#: Bytes hashed at once, and bytes of features that a task holds before it writes them: executors keep what a task once took.
HASHED, HELD = 1 << 18, 8 << 20
#: A pseudo-label needs at least this probability.
CONFIDENT = 0.97
#: Documents under this probability of good quality are rejected.
THRESHOLD = 0.5

#: Word repetition features behind the trigram shares of the text view.
_REPETITION = 2
TEXT = BUCKETS + _REPETITION
#: The page's statistics, in the metadata view.
_PAGE = ("log_bytes", "log_lines", "line_bytes", "word_bytes", "letters", "upper", "digits", "punctuation", "symbols", "beyond_ascii", "spaces", "inflation")
#: Hash classes of source and of language; two features more are the record's stated length and whether it has none.
_CLASSES = 16
META = len(_PAGE) + 2 * _CLASSES + 2


def _classes() -> np.ndarray:
    t = np.full(256, 4)
    t[[ord(c) for c in ".,;:'\"-?()"]] = 3
    t[48:58] = 2
    t[65:91] = 1
    t[97:123] = 0
    t[128:] = 5
    t[[9, 10, 11, 12, 13, 32]] = 6
    return t.astype(np.uint8)


_CLASS = _classes()


def _trigrams(data: np.ndarray) -> np.ndarray:
    """Bucket of the trigram at each byte but the last two."""
    b = data.astype(np.uint32)
    h = (b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]) * np.uint32(2654435761)
    return (h >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _repetition(h: np.ndarray) -> tuple[float, float]:
    """Share of words that repeat the one before, and distinct words against what such a length has."""
    return (float((h[1:] == h[:-1]).mean()) if len(h) > 1 else 0.0, len(np.unique(h)) / max(1, len(h)) ** 0.8)


def _meta(data: np.ndarray, h: np.ndarray, source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """The page's statistics and the record's source, language and stated length; nothing of which words there are."""
    out = np.zeros(META)
    n = max(1, len(data))
    lines = int((data == 10).sum()) + 1
    out[: len(_PAGE)] = (
        np.log1p(len(data)), np.log1p(lines), np.log1p(len(data) / lines), np.log1p(len(data) / max(1, len(h))), *(np.bincount(_CLASS[data], minlength=7) / n), len(zlib.compress(data.tobytes(), 1)) / n,
    )
    for k, value in enumerate((source, lang)):
        if value is not None:
            out[len(_PAGE) + k * _CLASSES + zlib.crc32(value.encode()) % _CLASSES] = 1.0
    out[-2:] = (0.0, 1.0) if n_chars is None else (np.log1p(max(0, n_chars)), 0.0)
    return out


#: Columns of _inputs().
_INPUTS = ["row", "source", "lang", "n_chars", "text"]


def _documents(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Row, bytes, word hashes and metadata features of each document; columns begin with _INPUTS."""
    text = batch.column(4)
    data, offsets = texts_of(text)
    source, lang, n_chars = (batch.column(i).to_pylist() for i in (1, 2, 3))
    for first, bounds, h, _, _ in word_hashes(text, SPACED, HASHED):
        for k in range(len(bounds) - 1):
            i = first + k
            raw, own = data[offsets[i] : offsets[i + 1]], h[bounds[k] : bounds[k + 1]]
            yield i, raw, own, _meta(raw, own, source[i], lang[i], n_chars[i])


_FEATURES_DDL = "at long, row long, hash long, label int, size int, slots array<short>, counts array<int>, repetition array<float>, meta array<float>"


def _lists(parts: list[np.ndarray], kind: type) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, kind), *parts]).astype(kind)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of both views, trigram counts only where there are any; columns: _INPUTS, at, hash, label."""
    for batch in batches:
        size, slots, counts, repetition, meta = [np.zeros(len(batch), np.int32), *([np.zeros(0)] * len(batch) for _ in range(4))]
        for i, data, h, own in _documents(batch):
            n = np.bincount(_trigrams(data), minlength=BUCKETS) if len(data) > 2 else np.zeros(BUCKETS, np.int64)
            size[i], slots[i] = len(data), np.flatnonzero(n)
            counts[i], repetition[i], meta[i] = n[slots[i]], np.array(_repetition(h)), own
        at, hash_, label = (batch.column(len(_INPUTS) + i) for i in range(3))
        cols = [at, batch.column(0), hash_, label, pa.array(size), _lists(slots, np.int16), _lists(counts, np.int32), _lists(repetition, np.float32), _lists(meta, np.float32)]
        yield pa.RecordBatch.from_arrays(cols, names=["at", "row", "hash", "label", "size", "slots", "counts", "repetition", "meta"])


def _wide(column: pa.Array, n: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float32).reshape(-1, n)


@dataclass(frozen=True)
class Linear:
    """A linear score: ``bias + weights . features``."""

    weights: np.ndarray
    bias: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias


def fit_linear(x: np.ndarray, y: np.ndarray, start: Linear | None = None, decay: float = 1e-3) -> Linear:
    """Logistic regression on standardised features by Adam over all rows; both classes weigh the same.

    A fit that goes on from an earlier one takes fewer steps. ``x`` is overwritten, as one
    task holds it all: no second matrix of its size is made.
    """
    mean, scale = x.mean(axis=0), np.concatenate([x[:, i : i + 64].std(axis=0) for i in range(0, x.shape[1], 64)]) + 1e-4
    z = x
    z -= mean
    z /= scale
    np.clip(z, -8, 8, out=z)
    cost = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum())).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    if start is not None:
        w, b = (start.weights * scale).astype(np.float32), float(start.bias + start.weights @ mean)
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, (FIRST_STEPS if start is None else MORE_STEPS) + 1):
        p = 1 / (1 + np.exp(-np.clip(z @ w + b, -30, 30)))
        e = (p - y) * cost
        g = np.append(z.T @ e + decay * w, e.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1].astype(np.float32), b - step[-1]
    weights = w / scale
    return Linear(weights, float(b - weights @ mean))


def calibrate(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn a score into log odds, fitted to held-back labels (Platt)."""
    scale = float(score.std()) + 1e-6
    z = np.stack([score / scale, np.ones_like(score)], axis=1)
    t = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - t) + 1e-2 * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hess, grad), -2, 2)
    return float(w[0] / scale), float(w[1])


_MODEL_DDL = "view int, weights array<double>, bias double, slope double, offset double, share double"

Views = list[tuple[Linear, float, float]]


@dataclass(frozen=True)
class Model:
    """Both views with their calibration, and the log odds that both already hold of good quality at large."""

    views: Views
    prior: float


def _fit(before: Views | None, last: bool):
    """Both views' classifiers with their calibration, going on from ``before``.

    Of rows with a ``label`` a tenth calibrates the rounds, from which pseudo-labels are
    chosen, and another tenth the ``last`` fit; the views learn from the others, and each
    from the pseudo-labels that it was given (``y0`` text, ``y1`` metadata). ``share`` is
    the labelled rows' share of good ones. No rows without rows of both classes.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        n = sum(map(len, parts))
        if not n:
            return
        # The matrices are filled batch by batch and each view's rows taken once, as one task holds them all.
        text, meta, keys, first = np.zeros((n, TEXT), np.float32), np.zeros((n, META), np.float32), np.zeros((4, n), np.int64), 0
        while parts:
            part = parts.pop(0)
            rows = slice(first, first + len(part))
            keys[:, rows] = [np.asarray(part[c], dtype=np.int64) for c in ("label", "y0", "y1", "size")]
            slots, counts = part["slots"], part["counts"]
            of = np.repeat(np.arange(len(part)), np.diff(np.asarray(slots.offsets)))
            text[rows][of, np.asarray(slots.flatten())] = np.asarray(counts.flatten()) / np.maximum(1, keys[3, rows] - 2)[of]
            text[rows, BUCKETS:], meta[rows] = _wide(part["repetition"], _REPETITION), _wide(part["meta"], META)
            first += len(part)
        label, y0, y1, size = keys
        order = np.lexsort([meta @ np.arange(META, dtype=np.float32), size, text @ np.arange(TEXT, dtype=np.float32), label])  # rows arrive in any order
        label, given = label[order], (y0[order], y1[order])
        known = np.flatnonzero(label >= 0)
        held = known[5::10] if last else known[::10]
        used = np.setdiff1d(known, np.append(known[::10], known[5::10]))
        if min((label[used] == c).sum() for c in (0, 1)) < 1 or not len(held):
            return
        for view, (x, y) in enumerate(zip((text, meta), given, strict=True)):
            taken = np.flatnonzero((label < 0) & (y >= 0))
            m = fit_linear(x[order[np.append(used, taken)]], np.append(label[used], y[taken]).astype(np.float32), before and before[view][0])
            slope, offset = calibrate(m(x[order[held]]), label[held])
            cols = [pa.array([view], pa.int32()), pa.array([m.weights.astype(float)], pa.list_(pa.float64())), *(pa.array([float(v)]) for v in (m.bias, slope, offset, (label[used] == 1).mean()))]
            yield pa.RecordBatch.from_arrays(cols, names=["view", "weights", "bias", "slope", "offset", "share"])

    return work


def _confidence(model: Views):
    """Each row's probability of good quality by both views."""
    (text, ta, tb), (meta, ma, mb) = model

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, row, h, size, slots, counts, repetition, m = batch.columns
            c = np.append(0.0, np.cumsum(text.weights[np.asarray(slots.flatten())] * np.asarray(counts.flatten())))
            ends = np.append(0, np.cumsum(np.diff(np.asarray(slots.offsets))))
            t = (c[ends[1:]] - c[ends[:-1]]) / np.maximum(1, np.asarray(size) - 2) + _wide(repetition, _REPETITION) @ text.weights[BUCKETS:] + text.bias
            p = [1 / (1 + np.exp(-np.clip(z, -30, 30))) for z in (ta * t + tb, ma * meta(_wide(m, META)) + mb)]
            yield pa.RecordBatch.from_arrays([at, row, h, *map(pa.array, p)], names=["at", "row", "hash", "text", "meta"])

    return work


def exchange(pool: DataFrame, model: Views, share: float, held: tuple[set[int], set[int]], given: int = GIVEN) -> list:
    """Pseudo-labels of one round, over all rows of ``pool``: rows ``taker, label, at, hash``.

    Each view gives its ``given`` most confident texts, in the labelled classes'
    proportion, to the other view; texts in ``held[taker]`` are not given again. Texts
    that repeat are given once, by the row with the least id.
    """
    scored = pool.select("at", "row", "hash", "size", "slots", "counts", "repetition", "meta").mapInArrow(_confidence(model), "at long, row long, hash long, text double, meta double")
    texts = materialize(scored.groupBy("hash").agg(F.min(F.struct("row", "text", "meta", "at")).alias("s")).select("hash", "s.*"), "confidence")
    best = None
    for taker, p in ((1, F.col("text")), (0, F.col("meta"))):
        for label, sure, n in ((1, p, round(given * share)), (0, 1 - p, given - round(given * share))):
            some = texts.where((sure >= CONFIDENT) & ~F.col("hash").isin(sorted(held[taker]))).orderBy(sure.desc(), "row", "hash").limit(n)
            some = some.select(F.lit(taker).alias("taker"), F.lit(label).alias("label"), "at", "hash")
            best = some if best is None else best.unionByName(some)
    return best.collect()


def learn(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, id_col: str = "doc_id", label_col: str = "quality") -> Model | None:
    """Fit both views on at most ``labelled`` labelled documents and the pseudo-labels of all others.

    The labelled ones are those with the least hash of their id; their ids (bounded by
    that parameter) are broadcast. The features of every document are written once. In
    each round both views score all unlabelled documents and give their most confident
    ones, at most GIVEN a view, to the other view's set; each fit is one task over these
    bounded sets. Only weights and the given rows' keys reach the driver. Labels other
    than 0 and 1 and null ids are not used; of labels that repeat an id the least counts.
    """
    with steps():
        spark = docs.sparkSession
        known = (
            labels.select(F.col(id_col).cast("long").alias("row"), F.col(label_col).cast("int").alias("label"))
            .where("row is not null and label in (0, 1)").groupBy("row").agg(F.min("label").alias("label")).orderBy(F.xxhash64("row", F.lit(11))).limit(labelled)
        )
        known = materialize(known, "labelled")
        rows = _inputs(docs, id_col).where("text is not null").join(F.broadcast(known), "row", "left")
        rows = rows.select(*_INPUTS, F.monotonically_increasing_id().alias("at"), F.xxhash64("text").alias("hash"), F.coalesce("label", F.lit(-1)).alias("label"))
        features = materialize(rows.mapInArrow(_features, _FEATURES_DDL), "features", HELD)
        learned = materialize(features.where("label >= 0").withColumns({"y0": F.lit(-1), "y1": F.lit(-1)}), "learned")
        pool, held, model = features.where("label < 0"), (set(), set()), None
        for r in range(ROUNDS + 1):
            found = sorted(learned.coalesce(1).mapInArrow(_fit(model and model.views, r == ROUNDS), _MODEL_DDL).collect(), key=lambda m: m.view)
            if not found:
                return None
            share = found[0].share
            model = Model([(Linear(np.array(m.weights), m.bias), m.slope, m.offset) for m in found], float(np.log(share / (1 - share))))
            if r == ROUNDS:
                break
            given: dict[int, list[int]] = {}
            for g in exchange(pool, model.views, share, held):
                given.setdefault(g.at, [-1, -1])[g.taker] = g.label
                held[g.taker].add(g.hash)
            if given:
                keys = spark.createDataFrame([(at, *y) for at, y in given.items()], "at long, y0 int, y1 int")
                learned = learned.unionByName(materialize(pool.join(F.broadcast(keys), "at"), "given"))  # at most 2 * GIVEN keys
        return model


def _inputs(docs: DataFrame, id_col: str) -> DataFrame:
    kinds = {f.name: f.dataType for f in docs.schema.fields}
    n_chars = F.col("n_chars").cast("long") if isinstance(kinds.get("n_chars"), IntegralType) else F.lit(None).cast("long")
    have = lambda c: (F.col(c).cast("string") if c in kinds else F.lit(None).cast("string")).alias(c)
    return docs.select(F.col(id_col).cast("long").alias("row"), have("source"), have("lang"), n_chars.alias("n_chars"), have("text"))


def _judge(model: Model | None, threshold: float):
    """Scores of a batch with columns _INPUTS: text view, metadata view, both, accepted."""

    def probability(x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    def work(batch: pa.RecordBatch) -> list[np.ndarray]:
        n = len(batch)
        words, t, m = np.zeros(n, np.int64), np.zeros(n), np.zeros((n, META))
        for i, raw, h, own in _documents(batch):
            words[i] = len(h)
            if model is not None and len(h):
                m[i] = own
                t[i] = model.views[0][0].weights[BUCKETS:] @ _repetition(h)
        if model is None:
            out = [np.full(n, 0.5) for _ in range(3)]
        else:
            (text, ta, tb), (meta, ma, mb) = model.views
            weights = text.weights[:BUCKETS]
            t += text.bias
            data, offsets = texts_of(batch.column(4))
            for i, j in blocks(offsets, HASHED):
                part = data[offsets[i] : offsets[j]]
                if len(part) > 2:
                    c = np.concatenate([[0.0], np.cumsum(weights[_trigrams(part)]), [0.0, 0.0]])
                    lo, hi = offsets[i:j] - offsets[i], offsets[i + 1 : j + 1] - offsets[i] - 2
                    some = hi > lo
                    t[i:j][some] += (c[hi[some]] - c[lo[some]]) / (hi - lo)[some]
            a, b = ta * t + tb, ma * meta(m) + mb
            out = [probability(a), probability(b), probability(a + b - model.prior)]
        out = [np.where(words > 0, x, 0.0) for x in out]
        return [*out, (words > 0) & (out[2] >= threshold)]

    return work


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD, id_col: str = "doc_id") -> DataFrame:
    """One row per row: ``doc_id, text_score, meta_score, score, accepted``.

    ``score`` is the probability of good quality from both views' calibrated log odds,
    added up less what both hold of good quality at large. Every row is scored by itself on its whole text, so repeated rows and ids do
    not matter. A null or blank text scores 0 and is rejected. Without a model (no labels
    of both classes) other texts score 0.5 and are accepted. A missing or null source,
    language or length is a feature of its own. An empty table gives an empty result.
    """
    judge = _judge(model, threshold)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(0), *map(pa.array, judge(batch))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "text_score", "meta_score", "score", "accepted"])

    return _inputs(docs, id_col).mapInArrow(work, "doc_id long, text_score double, meta_score double, score double, accepted boolean")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """learn() and score()."""
    return score(docs, learn(docs, labels), threshold)


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rejected rows, in one pass and without a shuffle of texts.

    A null id stays; a null or blank text goes; rows that repeat are judged one by one.
    Columns other than the id, source, lang, n_chars and text are not read. Without labels
    of both classes only null and blank texts go. An empty table gives an empty result.
    """
    judge = _judge(learn(docs, labels, id_col=id_col), threshold)
    names = docs.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = []
            for c, kind in zip([id_col, *_INPUTS[1:]], [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()], strict=True):
                col = batch.column(names.index(c)) if c in names else pa.nulls(len(batch), kind)
                fits = pa.types.is_integer(col.type) or kind == pa.string()
                cols.append(col.cast(kind) if fits else pa.nulls(len(batch), kind))
            yield batch.filter(pa.array(judge(pa.RecordBatch.from_arrays(cols, names=_INPUTS))[3]))

    return docs.mapInArrow(work, docs.schema)
