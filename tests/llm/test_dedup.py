"""Exact, line, byte-string and near deduplication against brute force on small tables."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from ledgerspark.llm import exact_dedup, joins, line_dedup, near_dedup, runs, suffix_dedup
from ledgerspark.llm.components import components
from ledgerspark.llm.runs import frequent

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(x: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x)


def frame(spark, rows, ddl=DOCS):
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in rows], ddl)


WORDS = [f"w{i}" for i in range(40)] + ["Éa", "ñu", "X"]


def prose(r: random.Random, n: int) -> str:
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Random texts with copies, edited copies, shared lines, blanks, nulls and one long text."""
    r = random.Random(3)
    rows = []
    base = prose(r, 60)
    for i in range(60):
        kind = i % 6
        if kind == 0:
            t = base
        elif kind == 1:
            w = base.split()
            w[r.randrange(60)] = "edit"
            t = " ".join(w)
        elif kind == 2:
            t = "\n".join(["Shared  Line \t", prose(r, 8), "shared  line", ""])
        elif kind == 3:
            t = base.upper()
        else:
            t = prose(r, r.randrange(1, 50))
        rows.append((i, t))
    rows += [(100, None), (101, ""), (102, "  \n\t"), (103, "one two"), (104, "ONE two"), (105, prose(r, 30000))]
    return rows


def test_exact_groups(spark, corpus):
    got = {r.doc_id: r for r in exact_dedup.exact_groups(frame(spark, corpus)).collect()}
    groups = {}
    for i, t in corpus:
        groups.setdefault(lower(t or ""), []).append(i)
    assert len(got) == len(corpus)
    for text, ids in groups.items():
        for i in ids:
            g = got[i]
            assert (g.keep_id, g.group_size, g.kept) == (max(ids), len(ids), i == max(ids))
            assert g.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    kept = {r.doc_id for r in exact_dedup.drop_copies(frame(spark, corpus)).collect()}
    assert kept == {max(ids) for ids in groups.values()}


def test_exact_groups_edges(spark):
    empty = exact_dedup.exact_groups(frame(spark, []))
    assert empty.count() == 0
    rows = frame(spark, [(1, "a"), (1, "a"), (None, "A"), (None, "only"), (2, None)]).withColumnRenamed("lang", "_norm")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(rows).collect()), key=str)
    assert got == sorted([(1, 1, 3, True), (1, 1, 3, True), (None, 1, 3, False), (None, None, 1, True), (2, 2, 1, True)], key=str)
    least = exact_dedup.exact_groups(frame(spark, [(1, "a"), (5, "A")]), keep="smallest").collect()
    assert {(r.doc_id, r.keep_id) for r in least} == {(1, 1), (5, 1)}


def dropped_lines(rows, least):
    docs = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = lower(line.strip(" \t\n\x0b\x0c\r"))
            if k:
                docs.setdefault(k, set()).add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if len(docs.get(lower(x.strip(" \t\n\x0b\x0c\r")), ())) < least]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [2, 10])
def test_line_dedup(spark, corpus, least):
    got = line_dedup.drop_lines(frame(spark, corpus).repartition(3), min_docs=least).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in got), key=str) == dropped_lines(corpus, least)


def test_line_dedup_edges(spark):
    assert line_dedup.drop_lines(frame(spark, []), min_docs=2).count() == 0
    rows = [(1, "a\nb"), (1, "a\nc"), (None, "a"), (None, None), (2, "a\na\na"), (2, "a\na\na")]
    got = line_dedup.drop_lines(frame(spark, rows).withColumnRenamed("lang", "pos"), min_docs=3).collect()
    assert sorted((r.doc_id, r.n_dropped, r.kept_text) for r in got if r.doc_id) == [(1, 1, "b"), (1, 1, "c"), (2, 3, ""), (2, 3, "")]
    assert sorted((r.n_lines, r.n_dropped) for r in got if r.doc_id is None) == [(1, 0), (1, 1)]


@pytest.mark.parametrize(("partitions", "held"), [(1, 200_000), (4, 200_000), (1, 3), (4, 3)])
def test_frequent_runs_over_partitions(spark, partitions, held, monkeypatch):
    """One key with most rows spans partitions; others sit at every edge; few or many rows are held."""
    monkeypatch.setattr(runs, "HELD", held)
    r = random.Random(1)
    rows = [(7 if r.random() < 0.5 else r.randrange(60), r.randrange(30), p) for p in range(900)]
    rows += [(99, 5, 1000 + p) for p in range(300)] + [(99, 6, 1500)]  # one document repeats a line
    df = spark.createDataFrame(rows, "k long, d long, p long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions * 7))
    try:
        for least in (1, 2, 9, 25):
            docs = {}
            for k, d, _ in rows:
                docs.setdefault(k, set()).add(d)
            want = sorted((d, p) for k, d, p in rows if len(docs[k]) >= least)
            got = sorted((x.d, x.p) for x in frequent(df, ["k"], ["d"], "p", least, "t").collect())
            assert got == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def repeats(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = {}
    for _, x in texts:
        for i in range(len(x) - length + 1):
            seen[x[i : i + length]] = seen.get(x[i : i + length], 0) + 1
    out = []
    for i, x in texts:
        m = bytearray(len(x))
        for j in range(len(x) - length + 1):
            if seen[x[j : j + length]] > 1:
                m[j : j + length] = b"\1" * length
        kept = bytes(b for b, f in zip(x, m, strict=True) if not f)
        out.append((i, len(x), sum(m), len(re.findall(b"\1+", bytes(m))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length", [20, 60])
def test_suffix_dedup(spark, corpus, length):
    got = suffix_dedup.remove_repeats(frame(spark, corpus).repartition(3), length=length).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == repeats(corpus, length)


def test_suffix_dedup_edges(spark):
    assert suffix_dedup.remove_repeats(frame(spark, []), length=20).count() == 0
    rows = [(1, "abcdefghijklmnopqrstuvwxyz"), (1, "abcdefghijklmnopqrstuvwxyz"), (2, None), (None, "x" * 50), (3, "x" * 21), (4, "é" * 10 + "abcdefghijklmnopqrst")]
    got = suffix_dedup.remove_repeats(frame(spark, rows).withColumnRenamed("lang", "uid"), length=20).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == repeats(rows, 20)


def test_suffix_dedup_at_its_length(spark):
    """Strings of 400 bytes: a passage that most texts share, a long text, overlaps and cuts of a byte too few."""
    r = random.Random(12)
    passage, other = prose(r, 200), prose(r, 150)
    rows = [(i, prose(r, r.randrange(0, 90)) + passage[r.randrange(40) :] + prose(r, r.randrange(90))) for i in range(60)]
    long = prose(r, 60000)
    rows += [(100, long[:150_000] + other + long[150_000:]), (101, other[:399] + "#"), (102, "#" + other[:400] + "#"), (103, "ab" * 600), (104, long[1000:1399]), (105, long[2000:2400]), (106, None)]
    got = suffix_dedup.remove_repeats(frame(spark, rows).repartition(4)).collect()
    assert sorted(((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got), key=str) == repeats(rows, 400)


@pytest.mark.parametrize("most", [7, 57, 60, 133, 308])
def test_difference_cover(most):
    v, d = suffix_dedup.difference_cover(most)
    assert v <= most
    assert {(int(i) - int(j)) % v for i in d for j in d} == set(range(v))


def shingle_set(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < 5 else frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def near_classes(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted((i, len(sets[i]), root(i), root(i) == i) for i in ids)


def test_near_groups(spark, corpus):
    got = near_dedup.near_groups(frame(spark, corpus).repartition(3)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == near_classes(corpus)


def test_near_groups_large_chain(spark):
    """Copies of copies: far members are linked only through others, in buckets beyond the small size."""
    r = random.Random(5)
    w, rows = prose(r, 150).split(), []
    for i in range(150):
        w = list(w)
        w[r.randrange(150)] = f"n{i}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, prose(r, 120)) for i in range(10)]
    got = near_dedup.near_groups(frame(spark, rows)).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in got) == near_classes(rows)
    kept = {x.doc_id for x in near_dedup.keep_one(frame(spark, rows)).collect()}
    assert kept == {i for i, _, _, k in near_classes(rows) if k}


def test_near_groups_edges(spark):
    assert near_dedup.near_groups(frame(spark, [])).count() == 0
    rows = [(1, "a b"), (2, "A  b"), (3, None), (4, None), (5, ""), (None, "a b"), (6, "a b c"), (7, "x"), (7, "y")]
    got = near_dedup.near_groups(frame(spark, rows).withColumnRenamed("lang", "bucket")).collect()
    want = [(1, 1, True), (2, 1, False), (3, 3, True), (4, 4, True), (5, 5, True), (None, 1, False), (6, 6, True), (7, 7, True), (7, 7, True)]
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in got), key=str) == sorted(want, key=str)
    nameless = near_dedup.near_groups(frame(spark, [(None, "p q"), (None, "P q"), (None, None)])).collect()
    assert [(r.doc_id, r.component_id, r.kept) for r in nameless] == [(None, None, True)] * 3


def test_near_groups_take_rows_that_repeat_an_id_one_by_one(spark):
    r = random.Random(7)
    one, two = prose(r, 40), prose(r, 40)
    rows = frame(spark, [(7, one), (7, two), (8, two + " tail"), (3, one.upper()), (9, None), (9, None), (7, two)])
    got = sorted((x.doc_id, x.component_id, x.kept) for x in near_dedup.near_groups(rows).collect())
    assert got == [(3, 3, True), (7, 3, False), (7, 7, True), (7, 7, True), (8, 7, False), (9, 9, True), (9, 9, True)]
    kept = near_dedup.keep_one(rows.withColumnRenamed("n_chars", "row"))
    assert kept.columns == ["doc_id", "text", "lang", "source", "row"]
    assert sorted((x.doc_id, x.text or "") for x in kept.collect()) == sorted([(3, one.upper()), (7, two), (9, ""), (9, "")])


def thue_morse(n: int) -> tuple[str, str]:
    """Two words of 2**n letters that every polynomial hash modulo 2**64 takes for one from n = 10 on."""
    x = "a"
    for _ in range(n):
        x += x.translate(str.maketrans("ab", "ba"))
    return x, x.translate(str.maketrans("ab", "ba"))


def test_words_that_collide_in_a_polynomial_hash_are_not_linked(spark):
    x, y = thue_morse(10)
    got = near_dedup.near_groups(frame(spark, [(1, x), (2, y), (3, f"a b c d {x}"), (4, f"a b c d {y}"), (5, x)])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 1)]


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 50), (60, 100), (7, 7), (3, 2)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 60: 50, 100: 50}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_without_and_partner(spark):
    wide = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k long, v string")
    lost = spark.createDataFrame([(2,), (9,), (None,)], "k long")
    assert sorted(r.v for r in joins.without(wide, lost, ["k"]).collect()) == ["a", "c"]
    thin = spark.createDataFrame([(2, 5), (9, 6)], "k long, x long")
    assert sorted((r.v, r.x) for r in joins.attached(wide.where("k is not null"), thin, ["k"]).collect()) == [("a", None), ("b", 5)]
    assert {r.v for r in joins.with_partner(wide, lost.where("k is not null"), ["k"]).collect()} >= {"b"}


def test_parity_sketches_never_lose_a_link():
    rng = np.random.default_rng(11)
    for n in (1, 4, 40, 900, 6000):
        for changed in (0, n // 8, n // 5, n // 2, n):
            a = np.unique(near_dedup.mix(rng.integers(0, 1 << 62, n, dtype=np.uint64)))
            b = np.unique(np.concatenate([a[changed:], near_dedup.mix(rng.integers(0, 1 << 62, changed, dtype=np.uint64))]))
            apart = len(np.setxor1d(a, b))
            bits = sum(int(x).bit_count() for x in near_dedup.parity(a).view(np.uint64) ^ near_dedup.parity(b).view(np.uint64))
            assert bits <= apart
            both = len(np.intersect1d(a, b))
            if 100 * both >= near_dedup.PERCENT * (len(a) + len(b) - both):
                assert bits * (100 + near_dedup.PERCENT) <= (len(a) + len(b)) * (100 - near_dedup.PERCENT)
