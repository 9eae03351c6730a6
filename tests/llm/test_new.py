"""PartEnum join, filter audit and whitening against brute force on small tables."""

from __future__ import annotations

import random
import re
from itertools import combinations, permutations

import numpy as np
import pytest

from ledgerspark.llm import filter_audit, ngram_join, queries, whitening
from pyspark.sql import functions as F

from .test_dedup import frame, lower, prose

LABELS = "doc_id long, quality int, toxic int, text string"


def shingle_set(text, width):
    w = [lower(x) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1)))


def brute_groups(rows, width, percent):
    """Smallest reachable id by row, and set sizes."""
    sets = [shingle_set(t, width) for _, t in rows]
    comp = list(range(len(rows)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
            comp[root(j)] = root(i)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[root(i)] = min(k, least.get(root(i), k))
    return sorted(((k, len(sets[i]), least.get(root(i))) for i, (k, _) in enumerate(rows)), key=str)


def edited(r, base, n):
    w = base.split()
    for _ in range(n):
        w[r.randrange(len(w))] = f"e{r.randrange(10**6)}"
    return " ".join(w)


def test_linked_sets_share_a_kept_signature():
    r = np.random.default_rng(1)
    linked = 0
    for _ in range(1500):
        n = int(r.integers(1, 600))
        x = set(r.integers(0, 1 << 63, n, dtype=np.uint64).tolist())
        y = set(x)
        for _ in range(int(r.integers(0, ngram_join.most_differences(2 * n) + 2))):
            if r.random() < 0.5 and y:
                y.pop()
            else:
                y.add(int(r.integers(0, 1 << 63)))
        both = len(x & y)
        if x == y or 100 * both < 85 * (len(x) + len(y) - both):
            continue
        linked += 1
        a, b = (np.array(sorted(s), np.uint64) for s in (x, y))
        (h, keep), (g, kept) = ngram_join.signatures(a), ngram_join.signatures(b)
        assert set(h[keep].tolist()) & set(g[kept].tolist()), (len(x), len(y), both)
        assert ngram_join._differing(ngram_join.parity(a), ngram_join.parity(b)) <= len(x ^ y)
    assert linked > 1000


def test_signatures_of_few_members_may_go_and_bands_cover_all_sizes():
    for size in range(1, 3000):
        band, lows = ngram_join.band_of(size)
        assert lows[band] <= size < lows[band + 1]
        assert size * 100 // 85 < lows[band + 2]  # a linked set is of this band or the next
    s = np.unique(np.random.default_rng(2).integers(0, 1 << 63, 500, dtype=np.uint64))
    h, keep = ngram_join.signatures(s)
    assert len(h) > keep.sum() > 0.9 * len(h)


@pytest.mark.parametrize("small, block", [(ngram_join.SMALL, ngram_join.BLOCK), (2, 7)])
def test_join_against_all_pairs(spark, monkeypatch, small, block):
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    r = random.Random(8)
    bases = [prose(r, 120), prose(r, 40), prose(r, 12)]
    rows = [(i, edited(r, bases[i % 3], r.randrange(0, (9, 3, 2)[i % 3]))) for i in range(150)]
    chain = prose(r, 90)
    for i in range(12):  # each near to its neighbours only
        rows.append((200 + i, chain))
        chain = edited(r, chain, 1)
    rows += [(300 + i, bases[0] + " " + prose(r, 120)) for i in range(12)]  # one passage, no link
    rows += [(400 + i, prose(r, r.randrange(1, 9))) for i in range(60)]
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one two"), (504, "ONE two"), (505, "one two"), (505, "one two"), (None, bases[1]), (None, "alone here it is"), (506, prose(r, 20000))]
    got = ngram_join.similar_groups(frame(spark, rows).withColumnRenamed("lang", "node").withColumnRenamed("source", "bucket")).collect()
    assert sorted(((g.doc_id, g.n_shingles, g.component_id) for g in got), key=str) == brute_groups(rows, 4, 85)


def test_join_of_an_empty_table_and_other_widths(spark):
    assert ngram_join.similar_groups(frame(spark, [])).count() == 0
    r = random.Random(5)
    base = prose(r, 50)
    rows = [(i, edited(r, base, r.randrange(0, 5))) for i in range(40)]
    got = ngram_join.similar_groups(frame(spark, rows), width=2, percent=70).collect()
    assert sorted(((g.doc_id, g.n_shingles, g.component_id) for g in got), key=str) == brute_groups(rows, 2, 70)


def brute_audit(docs, labels):
    parts, first = {}, {}
    for i, t, *_ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    good, toxic = ({x[0] for x in labels if x[k] == 1 and x[0] is not None} for k in (1, 2))
    for i, t, part, *_ in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t), "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and i > first[t],
        }
        parts.setdefault(part or "", []).append(({f for f, x in fails.items() if x}, i in good, i in toxic))
    out = []
    for part, rows in parts.items():
        removed = {}
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                failing = sum(f in x[0] for x in rows)
                out.append([part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(x[0] == {f} for x in rows), sum(x[1] for x in gone), sum(x[2] for x in gone), f])
                removed[f] = removed.get(f, 0) + len(gone)
        for row in out:
            if row[0] == part:
                row[-1] = removed[row[-1]] if isinstance(row[-1], str) else row[-1]
    return sorted(map(tuple, out))


def test_filter_audit_against_running_all_orders(spark):
    r = random.Random(4)
    texts = [prose(r, n) for n in (5, 99, 100, 150)] + [" ".join(f"w{i}" for i in range(120)), "LOUD " * 130, "a # b", "Été $ " * 60, None, "", " \t", "x " * 20000]
    docs = [(i, r.choice(texts), r.choice(["en", "de", None, ""]), "s", 1) for i in range(160)]
    docs += [(7, texts[2], "en", "s", 1), (7, texts[2], "en", "s", 1), (7, texts[2], "de", "s", 1), (None, texts[2], "en", None, None), (None, texts[4], None, "s", 1)]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None]), "x") for i in range(-5, 120)] + [(3, 1, 0, "x"), (3, 0, 1, "x"), (None, 1, 1, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, quality string, mask long")
    got = filter_audit.audit(df, spark.createDataFrame(labels, LABELS)).collect()
    assert sorted(tuple(x) for x in got) == brute_audit(docs, labels)


def test_filter_audit_of_empty_tables(spark):
    none, labels = frame(spark, []), spark.createDataFrame([], LABELS)
    assert filter_audit.audit(none, labels).count() == 0
    out = filter_audit.audit(frame(spark, [(1, None)]), labels).collect()
    assert len(out) == 600 and {(x.part, x.good_lost) for x in out} == {("en", 0)}


VECTORS = "vec_id long, embedding array<float>, label int, y string"


def brute_whitening(vectors):
    x = np.floor(np.array(vectors, np.float64) * 1024) + 100_000
    n, total = len(x), x.sum(axis=0)
    c = x - total / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    return x, n, total, e, (c @ u) / np.sqrt(np.maximum(e, 1e-300))


@pytest.mark.parametrize("falling, full", [(0.6, False), (1.0, True)])
def test_whitening_against_numpy(spark, falling, full):
    """A spectrum that falls fast is found in the sketch; a flat one takes the basis of all dimensions."""
    r = np.random.default_rng(6)
    d = 40
    basis = np.linalg.qr(r.normal(size=(d, d)))[0]
    scale = 3.0 * falling ** np.arange(d) if falling < 1 else np.linspace(1.2, 1.0, d)
    v = (r.normal(size=(900, d)) * scale) @ basis + r.normal(size=d)
    rows = [(i, [float(np.float32(c)) for c in x], i, "a") for i, x in enumerate(v)]
    odd = [(-1, None, 1, "a"), (-2, [None] * d, 1, "a"), (-3, [float("nan")] * d, 1, "a"), (-4, [float("inf")] * d, 1, "a"), (-5, [1.0, 2.0], 1, "a")]
    out, model = whitening.whiten(spark.createDataFrame(rows + rows[:3] + odd, VECTORS))
    got = {g.row.vec_id: g for g in out.collect()}
    assert set(got) == set(range(900)) and out.count() == 903
    x, n, total, e, white = brute_whitening([a[1] for a in rows + rows[:3]])
    k = len(model.eigenvalues)
    assert model.full == full and model.n == 903 and k == 8 and model.identity_error < 1e-9
    assert np.allclose(model.eigenvalues / model.trace, e[:k] / e.sum(), rtol=1e-10)
    w = np.array([got[i].whitened for i in range(900)])
    signs = np.sign((w * white[:900, :k]).sum(axis=0))
    assert np.abs(w * signs - white[:900, :k]).max() < 1e-6
    for i in range(0, 900, 50):
        assert int(got[i].deviation) == sum((n * int(a) - int(t)) ** 2 for a, t in zip(x[i], total, strict=True))


def test_whitening_of_odd_tables(spark):
    empty, model = whitening.whiten(spark.createDataFrame([], VECTORS))
    assert empty.count() == 0 and model is None
    same, model = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], 0, "") for i in range(5)], VECTORS))
    assert [(list(r.whitened), int(r.deviation)) for r in same.collect()] == [([], 0)] * 5 and len(model.eigenvalues) == 0
    line, model = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0], 0, "") for i in range(5)], VECTORS))
    assert len(model.eigenvalues) == 1 and sorted(round(abs(r.whitened[0]), 6) for r in line.collect()) == [0.0, 0.707107, 0.707107, 1.414214, 1.414214]
    huge, model = whitening.whiten(spark.createDataFrame([(1, [1e30, 0.0], 0, ""), (2, [-1e12, 1.0], 0, ""), (3, [], 0, ""), (None, [5.0, 1.0], None, None)], VECTORS))
    assert huge.count() == 3 and len(model.eigenvalues) >= 1
    none, model = whitening.whiten(spark.createDataFrame([(1, [], 0, "")], VECTORS))
    assert none.count() == 0 and model is None


def test_whitening_query_has_a_row_for_each_vector_and_component(spark):
    out = queries.QUERIES["op13_embedding_whitening"](spark, "/root/testdata/sf0.001")
    one = out.groupBy("vec_id").agg(F.sort_array(F.collect_list("component")).alias("c"), F.countDistinct("identity_error", "n").alias("k")).collect()
    assert all(r.c == list(range(1, 9)) and r.k == 1 for r in one)
    assert out.where("abs(identity_error) > 1e-9 or explained <= 0").count() == 0
