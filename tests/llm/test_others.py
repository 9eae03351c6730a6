"""Sharding, language, archives, quality, decontamination, mixing and the pipeline on small tables."""

from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerspark.llm import decontam, langid, mixing, quality, queries, sharding, warc
from ledgerspark.llm.tokens import ALNUM, SPACED, word_hashes

from .test_dedup import DOCS, frame, lower, prose, thue_morse

SF = "/root/testdata/sf0.001"


def test_hilbert_curve_is_a_curve(spark):
    """Every cell is met once, and each step moves one dimension by one."""
    for dims, bits in ((2, 3), (3, 2), (4, 1)):
        n = 1 << bits
        df = spark.range(n**dims).select(*[((F.col("id") / n**i).cast("long") % n).cast("int").alias(f"c{i}") for i in range(dims)])
        rows = df.withColumn("h", sharding.hilbert_index([F.col(f"c{i}") for i in range(dims)], bits)).collect()
        rows.sort(key=lambda r: r.h)
        assert [r.h for r in rows] == list(range(n**dims))
        for a, b in zip(rows, rows[1:], strict=False):
            assert sum(abs(a[i] - b[i]) for i in range(dims)) == 1


def test_shards_law(spark):
    r = random.Random(2)
    rows = [(i, prose(r, r.randrange(1, 40)), r.choice(["en", "de", None]), "hot" if i % 3 else r.choice(["a", "b", None]), 0) for i in range(333)] + [(None, None, None, None, None), (5, "x", "en", "a", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    got = queries.sharded(docs, 7).collect()
    assert len(got) == len(rows)
    by = {}
    for g in got:
        by.setdefault(g.shard, []).append(g.slot)
        assert g.law == "rows" and g.grown_shard is None
    sizes = [len(s) for s in by.values()]
    assert set(by) == set(range(7)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    one = next(g for g in got if g.doc_id == 0)
    assert one.size == len(rows[0][1].encode()) + 16 and one.text_crc32 == zlib.crc32(rows[0][1].encode())
    # Neighbours on the curve share metadata: most shards see few of the sources.
    assert sum(len({g.source for g in got if g.shard == s}) for s in by) <= 7 * 4 // 2 + 4
    assert queries.sharded(docs.limit(0), 7).count() == 0
    few = queries.sharded(docs.limit(3), 7).collect()
    assert sorted(g.slot for g in few) == [0, 0, 0]


def targets_by_hand(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while True:
        level = left / sum(w[s] for s in open_) if open_ else 0
        over = {s for s in open_ if w[s] * level > most * sizes[s] + 1e-9}
        if not over:
            return {**out, **{s: w[s] * level for s in open_}}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= over


def mix_rows(n=500):
    r = random.Random(9)
    return [(i, prose(r, r.randrange(0, 30)), "en", r.choice(["hot"] * 6 + ["a", "b", "ç", None]), 0) for i in range(n)]


def test_mixing(spark):
    rows = mix_rows()
    docs = spark.createDataFrame(rows, DOCS)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, *_ in rows}
    total = {}
    for i, _, _, s, _ in rows:
        total[s] = total.get(s, 0) + size[i]
    want = targets_by_hand(total)
    mixed = mixing.systematic_mix(docs, mixing.F.lit(0) + queries.word_count(F.col("text")))
    got = mixed.collect()
    assert sorted(g.doc_id for g in got) == list(range(len(rows)))
    taken = {}
    for g in got:
        assert g.size == size[g.doc_id] and g.source_size == total[g.source]
        assert g.target == pytest.approx(want[g.source])
        assert g.taken == g.copies * g.size <= 2 * g.size
        taken[g.source] = taken.get(g.source, 0) + g.taken
    for s, t in want.items():
        assert abs(taken[s] - t) <= 30
    assert [(g.doc_id, g.copies) for g in sorted(got)] == [(g.doc_id, g.copies) for g in sorted(mixing.systematic_mix(docs.repartition(5), queries.word_count(F.col("text"))).collect())]
    out = mixing.mixed_documents(docs, queries.word_count(F.col("text")))
    assert out.columns == docs.columns
    assert out.count() == sum(g.copies for g in got)
    size_ = queries.word_count(F.col("text"))
    twice = mixing.mixed_documents(docs.union(docs), size_)
    want = sum(g.copies for g in mixing.systematic_mix(docs.union(docs), size_).collect())
    assert twice.columns == docs.columns and twice.count() == want
    odd = spark.createDataFrame([(None, "a b", "en", None, 0), (None, "a b", "en", None, 1), (None, None, None, "a", 2), (1, "a b", "en", "a", 0), (1, "c", "en", "a", 0), (2, "w " * 200_000, "de", "a", 0)], DOCS)
    odd = odd.withColumnRenamed("lang", "copies").withColumnRenamed("n_chars", "doc")
    copies = sum(g.copies for g in mixing.systematic_mix(odd.select("doc_id", "source", "text"), size_).collect())
    out = mixing.mixed_documents(odd, size_)
    assert out.columns == odd.columns and out.count() == copies
    assert mixing.mixed_documents(odd.limit(0), size_).count() == 0


def plain_mix(spark, rows, size, targets, total):
    """Copies by id: large documents one after the other, the others by prefix sums."""
    of = {}
    for i, _, _, s, _ in rows:
        of.setdefault(s, []).append((size[i], i))
    names = spark.createDataFrame([(s,) for s in of], "s string")
    offset = dict(map(tuple, names.selectExpr("s", "pmod(xxhash64(17, coalesce(s, ''), s is null), 1048576) / 1048576D").collect()))
    copies = {}
    for s, docs in of.items():
        docs.sort()
        rate, due = targets[s] / total[s], 0.0
        large = [d for d in docs[-mixing.LARGEST :] if d[0] > 0 and d[0] > mixing.CERTAIN * targets[s]]
        for n, i in reversed(large):
            due += n * rate
            low = math.floor(rate)
            copies[i] = min(low + 1, math.ceil(rate)) if abs(due - n * (low + 1)) < abs(due - n * low) else low
            due -= copies[i] * n
        rest = docs[: len(docs) - len(large)]
        left = sum(n for n, _ in rest)
        rate = min(2.0, max(0.0, (targets[s] - sum(copies[i] * n for n, i in large)) / left)) if left else 0.0
        before = math.floor(offset[s])
        for k, (_, i) in enumerate(rest, 1):
            upto = math.floor(k * rate + offset[s])
            copies[i] = min(upto - before, math.ceil(rate))
            before = upto
    return copies


def test_mixing_against_a_plain_loop(spark):
    rows = mix_rows(800)
    docs = spark.createDataFrame(rows, DOCS)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, *_ in rows}
    total = {}
    for i, _, _, s, _ in rows:
        total[s] = total.get(s, 0) + size[i]
    got = mixing.systematic_mix(docs, queries.word_count(F.col("text"))).collect()
    assert {g.doc_id: g.copies for g in got} == plain_mix(spark, rows, size, targets_by_hand(total), total)


def test_mixing_comes_within_two_percent_of_every_target(spark):
    got = queries.QUERIES["op10_mixing"](spark, "/root/testdata/sf0.01")
    worst = got.groupBy("source").agg((F.abs(F.sum("taken") - F.first("target")) / F.first("target")).alias("miss")).agg(F.max("miss")).first()[0]
    assert worst < 0.02, worst


def test_mixing_edges(spark):
    assert mixing.systematic_mix(spark.createDataFrame([], DOCS), F.lit(1)).count() == 0
    none = spark.createDataFrame([(1, None, None, None, 0), (2, "", None, "a", 0)], DOCS)
    got = mixing.systematic_mix(none.withColumn("target", F.lit("x")), queries.word_count(F.col("text"))).collect()
    assert {(g.doc_id, g.target, g.taken) for g in got} == {(1, 0.0, 0), (2, 0.0, 0)}


def test_words():
    import pyarrow as pa

    texts = ["Ab  cd", None, "", "ab\tCD é", "x" * 10]
    out = []
    for _, bounds, h, starts, ends in word_hashes(pa.array(texts), SPACED):
        for k in range(len(bounds) - 1):
            out.append(h[bounds[k] : bounds[k + 1]].tolist())
    assert [len(x) for x in out] == [2, 0, 0, 3, 1]
    assert out[0] == out[3][:2]
    long = " ".join(["word"] * 2_000_000)
    (_, bounds, h, _, _), = list(word_hashes(pa.array([long]), SPACED))
    assert bounds.tolist() == [0, 2_000_000] and len(np.unique(h)) == 1
    (_, bounds, h, _, _), = list(word_hashes(pa.array(["a-b_c1 Ä"]), ALNUM))
    assert bounds.tolist() == [0, 4]


def test_language(spark):
    docs = queries.table(spark, SF, "documents")
    got = queries.QUERIES["op5_language_id"](spark, SF).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(got) == docs.count()
    tested = [g for g in got if g.held_out]
    assert {g.doc_id for g in tested} == {g.doc_id for g in got if zlib.crc32(str(g.doc_id).encode()) % 4 == 2}
    assert sum(g.lang_pred == g.lang for g in tested) >= 0.9 * len(tested)
    assert all(0 <= g.score <= 1 for g in got)
    model = langid.learn(docs, F.lit(True))
    odd = frame(spark, [(1, None), (2, ""), (3, "123 !?"), (4, "the and of to " * 20), (5, "the and " * 200_000), (None, "der die das und nicht auf")])
    out = {g.doc_id: g for g in langid.identify(odd.withColumnRenamed("lang", "best"), model).collect()}
    assert [out[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and all(out[i].score == 0 and out[i].rejected for i in (1, 2, 3))
    assert out[4].lang_pred == "en" == out[5].lang_pred and out[None].lang_pred == "de"
    assert langid.identify(odd.limit(0), model).count() == 0
    none = langid.learn(docs, F.lit(False))
    assert {g.lang_pred for g in langid.identify(odd, none).collect()} == {"und"}


def test_warc_round_trip(spark):
    r = random.Random(4)
    big = "é" + prose(r, 300_000)
    pages = [(5, "http://a/", "same"), (3, "http://b/\r\nX: y", "same"), (9, None, "same"), (1, "http://c", None), (2, "http://d", ""), (7, "http://e", big), (8, "http://f", "WARC/1.1\r\n\r\nx\r\n\r\n"), (10, "http://g", "ok"), (10, "http://h", "zz"), (10, "http://h", "zz"), (None, "http://i", "z"), (None, "http://i", "z"), (None, "http://j", "same"), (11, "http://k", "\0" * 20_000_000)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, page string")
    got = warc.round_trip(df, chunk=1000).collect()
    first, want = {}, []
    for p, _, h in sorted(pages, key=lambda x: (x[0] is None, x[0])):
        first.setdefault(h or "", p)
    for p, _, h in pages:
        x, least = (h or "").encode(), first[h or ""]
        want.append((p, len(x), base64.b32encode(hashlib.sha1(x).digest()).decode(), *(("response", None) if least == p else ("revisit", least))))
    assert sorted(((g.page_id, g.payload_bytes, g.payload_digest, g.record_type, g.refers_to) for g in got), key=str) == sorted(want, key=str)
    large = {g.page_id: g.record_type for g in warc.round_trip(df, min_revisit=5).collect()}
    assert large[5] == "response" and large[3] == "response"
    assert warc.round_trip(df.limit(0)).count() == 0


def test_quality(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = queries.table(spark, sf, "documents"), queries.table(spark, sf, "labels")
    fold = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4))
    model = quality.learn(docs, labels.where(fold > 0))
    got = quality.score(docs, model).join(labels.where(fold == 0), "doc_id").collect()
    good, bad = [g for g in got if g.quality == 1], [g for g in got if g.quality == 0]
    assert sum(g.accepted for g in good) >= 0.97 * len(good)
    assert sum(not g.accepted for g in bad) >= 0.6 * len(bad)
    odd = frame(spark, [(1, None), (2, " \n"), (3, "a"), (None, "fine words here"), (4, "ok " * 1_000_000)])
    out = {g.doc_id: g for g in quality.score(odd.withColumnRenamed("n_chars", "score"), model).collect()}
    assert not out[1].accepted and not out[2].accepted and out[1].score == 0 and 0 < out[None].score <= 1
    kept = quality.accepted(odd, labels.limit(0))
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["3", "4", "None"]
    assert quality.score(odd.limit(0), model).count() == 0
    assert quality.score(docs.drop("source", "lang"), model).count() == docs.count()


def test_rare_unlabelled_kinds_are_learned(spark):
    r = random.Random(6)
    vocabulary = lambda letters: ["".join(r.choice(letters) for _ in range(6)) for _ in range(30)]
    good, bad, plain, rare_good, rare_bad = map(vocabulary, ("abc", "def", "ghi", "jkl", "mno"))
    say = lambda words: " ".join(r.choice(words) for _ in range(12))
    ids = [i.id for i in spark.range(4600).orderBy(F.xxhash64("id", F.lit(11))).collect()]
    kinds = [(good, "s1"), (bad, "s2")] * 300 + [(plain, None)] * 3800 + [(rare_good, "s1"), (rare_bad, "s2")] * 100  # the rare ones have the greatest hashes
    docs = spark.createDataFrame([(i, say(w), None, s) for i, (w, s) in zip(ids, kinds, strict=True)], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, 1 - k % 2) for k, i in enumerate(ids[:600])], "doc_id long, quality int")
    fresh = spark.createDataFrame([(k, say(rare_bad if k % 2 else rare_good), None, None) for k in range(40)], docs.schema)
    got = quality.score(fresh, quality.learn(docs, labels)).collect()
    assert min(g.text_score for g in got if g.doc_id % 2 == 0) > 0.8 and max(g.text_score for g in got if g.doc_id % 2) < 0.2


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))


def hits_by_hand(docs, items, width):
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(width, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[k : k + n]), set()).add(str(i))
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in wins}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[tuple(w[k : k + n])]
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_decontamination(spark):
    r = random.Random(8)
    items = [(i, prose(r, n)) for i, n in enumerate([15, 12, 3, 1, 0, 30])] + [(10, None), (11, "rare phrase Only-here"), (12, "rare phrase only here")]
    docs = [(i, prose(r, 60)) for i in range(20)]
    docs += [(50, items[0][1].upper() + " tail"), (51, "x, " + items[5][1][20:120]), (52, None), (53, ""), (54, "so rare... PHRASE only  here!"), (55, " ".join([items[1][1]] * 3)), (56, prose(r, 20000)), (None, items[1][1])]
    b = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.contamination(frame(spark, docs).withColumnRenamed("lang", "term"), b, width=4).collect()
    assert sorted(((g.doc_id, g.n_words, g.n_hit, g.n_items, g.items_sha256, g.contaminated) for g in got), key=str) == hits_by_hand(docs, items, 4)
    clean = {g.doc_id for g in decontam.clean(frame(spark, docs), b, width=4).collect()}
    assert clean == {d for d, *_, c in hits_by_hand(docs, items, 4) if not c}
    twice = frame(spark, [(1, items[1][1]), (1, "fine words"), (None, items[1][1]), (None, "also fine"), (1, "fine words")])
    assert sorted(g.text for g in decontam.clean(twice.withColumnRenamed("lang", "row"), b, width=4).collect()) == ["also fine", "fine words", "fine words"]
    assert decontam.contamination(frame(spark, docs), b.limit(0)).where("contaminated").count() == 0
    assert decontam.contamination(frame(spark, []), b).count() == 0


def test_words_that_collide_in_a_polynomial_hash_do_not_hit(spark):
    x, y = thue_morse(10)
    items = spark.createDataFrame([(1, x), (2, f"{x} b")], "item_id long, text string")
    docs = frame(spark, [(1, y), (2, x), (3, f"{y} b {x}")])
    for slop in (0, 1):
        got = {g.doc_id: g.n_hit for g in decontam.contamination(docs, items, slop=slop).collect()}
        assert got == {1: 0, 2: 1, 3: 1}


def test_terms_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontam, "TERMS_AT_ONCE", 7)
    r = random.Random(3)
    items = [(i, prose(r, 12)) for i in range(4)]
    docs = [(i, prose(r, 30) + (items[i % 4][1] if i % 3 else "")) for i in range(12)]
    got = decontam.contamination(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"), width=5).collect()
    assert sorted(((g.doc_id, g.n_words, g.n_hit, g.n_items, g.items_sha256, g.contaminated) for g in got), key=str) == hits_by_hand(docs, items, 5)


def test_proximity(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    docs = frame(spark, [(1, "alpha beta gamma delta"), (2, "alpha x beta gamma y delta"), (3, "alpha x x x beta gamma delta"), (4, "delta gamma beta alpha")])
    got = {g.doc_id: g.n_hit for g in decontam.contamination(docs, items, slop=2).collect()}
    assert got == {1: 4, 2: 6, 3: 0, 4: 0}


def test_pipeline(spark):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES] == ["quality", "near_dedup", "decontamination", "mixing", "sharding"]
    docs = queries.table(spark, SF, "documents")
    before = docs
    for name, stage in p.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == docs.columns, name
        if name != "mixing":
            assert {r.doc_id for r in after.select("doc_id").collect()} <= {r.doc_id for r in before.select("doc_id").collect()}
        before = after
    out = p.run(spark, SF)
    rows = out.collect()
    assert len(rows) > 0 and {r.shard for r in rows} <= set(range(queries.SHARDS))
