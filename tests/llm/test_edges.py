"""Pipeline stages and models on odd input, and models against plain loops over the same parts."""

from __future__ import annotations

import math
import re

import numpy as np
import zstandard

from ledgerspark.llm import langid, mixing, quality, queries
from pyspark.sql import functions as F

from .test_dedup import frame, lower

SF = "/root/testdata/sf0.001"


def odd_documents(spark):
    """Nulls in every column, empty and long texts, and repeated rows, beside 40 documents of the sample."""
    docs = queries.table(spark, SF, "documents").limit(40)
    rows = [(None, None, None, None, None), (1, "", "en", "src0", 0), (900_001, "The fine words of one text. " * 20_000, "en", None, 5), (None, "Some words without an id here.", None, "src1", 9)]
    rows += [(900_002, "A text that repeats as a whole.", "en", "src1", 31)] * 3 + [(900_002, "The same id with another text.", "en", "src2", None)]
    return docs.unionByName(spark.createDataFrame(rows, docs.schema))


def test_pipeline_stages_take_odd_rows_and_empty_tables(spark):
    import corpus_pipeline as p

    docs = odd_documents(spark)
    keys = sorted(str((r.doc_id, r.text)) for r in docs.collect())
    out = {}
    for name, stage in p.STAGES:
        got = stage(spark, docs, SF)
        rows = got.collect()
        if name != "sharding":
            assert got.columns == docs.columns, name
            assert {str((r.doc_id, r.text)) for r in rows} <= set(keys), name
        out[name] = rows
        empty = stage(spark, docs.limit(0), SF)
        assert empty.columns == got.columns and empty.count() == 0, name
    texts = lambda name, i: sorted(r.text or "" for r in out[name] if r.doc_id == i)
    assert not [r for r in out["quality"] if not (r.text or "").strip()]
    assert texts("near_dedup", 900_002) == ["A text that repeats as a whole.", "The same id with another text."]
    assert len([r for r in out["near_dedup"] if r.doc_id is None]) == 2
    assert texts("decontamination", 900_002) == sorted(["A text that repeats as a whole."] * 3 + ["The same id with another text."])
    assert len(out["sharding"]) == len(keys)


def test_language_against_a_plain_loop(spark):
    docs = queries.table(spark, SF, "documents").limit(60)
    model = langid.learn(queries.table(spark, SF, "documents"), F.lit(True))
    want = {}
    for r in docs.collect():
        text = r.text or ""
        if not any(c.isalpha() for c in text):
            want[r.doc_id] = "und"
            continue
        data, sizes = lower(text).encode(), []
        for content in model.contents:
            content = lower(content.decode()).encode()
            how = zstandard.ZstdCompressionParameters.from_level(
                langid.LEVEL, source_size=langid.PIECE, dict_size=len(content), min_match=langid.MIN_MATCH, strategy=langid.STRATEGY, write_content_size=0, write_checksum=0, write_dict_id=0
            )
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            sizes.append(sum(len(zstandard.ZstdCompressor(dict_data=shared, compression_params=how).compress(data[i : i + langid.PIECE])) for i in range(0, len(data), langid.PIECE)))
        want[r.doc_id] = model.languages[sizes.index(min(sizes))]
    assert {r.doc_id: r.lang_pred for r in langid.identify(docs, model).collect()} == want


def test_quality_scores_against_a_plain_loop(spark):
    r = np.random.default_rng(4)
    linear = lambda n: quality.Linear(r.normal(size=n), 0.3)
    model = quality.Model([(linear(quality.TEXT), 0.02, 0.1), (linear(quality.META), 0.05, -0.2)], 0.7)
    rows = [(1, "ab cab  ab ab\nCd e"), (2, "é"), (3, "x y " * 2000), (4, "  "), (5, None)]
    got = {x.doc_id: x for x in quality.score(frame(spark, rows), model).collect()}
    assert got[4].score == got[5].score == 0 and not got[4].accepted
    for i, text in rows[:3]:
        data = text.encode()
        counts = np.zeros(quality.BUCKETS)
        for j in range(len(data) - 2):
            counts[(int.from_bytes(data[j : j + 3], "big") * 2654435761 & 0xFFFFFFFF) >> (32 - quality.BUCKETS.bit_length() + 1)] += 1
        words = [lower(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
        repeated = sum(a == b for a, b in zip(words, words[1:], strict=False)) / (len(words) - 1) if len(words) > 1 else 0.0
        features = np.concatenate([counts / max(1, len(data) - 2), [repeated, len(set(words)) / len(words) ** 0.8]])
        (view, slope, offset), _ = model.views
        want = 1 / (1 + math.exp(-(slope * (features @ view.weights + view.bias) + offset)))
        assert abs(got[i].text_score - want) < 1e-6
        odds = lambda p: math.log(p / (1 - p))
        assert abs(odds(got[i].score) - (odds(got[i].text_score) + odds(got[i].meta_score) - model.prior)) < 1e-6


def test_mixing_and_sharding_of_long_texts_and_null_ids(spark):
    docs = frame(spark, [(None, "a b c"), (None, "a b c"), (7, "w " * 300_000), (8, None)])
    got = mixing.systematic_mix(docs, queries.word_count(F.col("text"))).collect()
    assert sorted(g.size for g in got) == [0, 3, 3, 300_000] and all(g.taken <= 2 * g.size for g in got)
    sharded = queries.sharded(docs.withColumnRenamed("n_chars", "hilbert"), 3).collect()
    assert sorted(g.size for g in sharded) == [16, 21, 21, 600_016] and len({(g.shard, g.slot) for g in sharded}) == 4
