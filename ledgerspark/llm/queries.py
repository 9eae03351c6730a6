"""The numbered queries: each applies its operator to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, exact_dedup, filter_audit, langid, line_dedup, mixing, near_dedup, ngram_join, quality, sharding, suffix_dedup, warc, whitening
from .storage import materialize
from .text import word_count

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Shards of the sharding query and stage.
SHARDS = 40


def _query(name: str):
    def register(f):
        QUERIES[name] = f
        return f

    return register


#: Rows of text in an Arrow batch: Spark's default of 10,000 keeps a worker at several copies of tens of megabytes.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of ``sf_dir``, in a session that hands texts to Python in small batches."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op8_exact_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


ORACLES["op8_exact_dedup"] = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
), g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY norm)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.norm) AS text_sha256
FROM d JOIN g ON d.norm = g.norm
"""


@_query("op10_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    thin = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    return mixing.systematic_mix(thin, F.col("size")).select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shards of documents by source, language and size, with the text's size and checksum."""
    text = F.coalesce(F.col("text"), F.lit(""))
    thin = materialize(
        docs.select("doc_id", "source", "lang", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")),
        "meta",
    )
    return sharding.hilbert_shards(thin, shards, ["source", "lang"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
        "source",
        "lang",
    )


@_query("op3_sharding")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"))


@_query("op4_minhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


@_query("op1_line_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLES["op1_line_dedup"] = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), often AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT k.*, o.key IS NOT NULL AS dropped FROM k LEFT JOIN often o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


@_query("op9_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items")


@_query("op6_warc")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@_query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = F.coalesce(langid.held_out(F.col("doc_id")), F.lit(False))
    model = langid.learn(docs, ~out)
    return langid.identify(docs, model).withColumn("held_out", out)


@_query("op7_quality_classifier")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query("op2_suffix_array_dedup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("starts", "stops")


@_query("op11_ngram_jaccard_join")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, sf_dir, "documents"))


@_query("op12_filter_audit")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op12_filter_audit"] = """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS first FROM d),
f AS (
  SELECT part, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN doc_id > first THEN 'E' ELSE '' END AS fails
  FROM w
), g AS (SELECT part, fails, good, toxic, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE a.x <> b.x AND a.x <> c.x AND a.x <> d.x AND a.x <> e.x AND b.x <> c.x AND b.x <> d.x AND b.x <> e.x AND c.x <> d.x AND c.x <> e.x AND d.x <> e.x
), s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) q),
r AS (
  SELECT g.part, s.filter_order, s.step, s.x,
    sum(n) FILTER (WHERE translate(fails, substr(filter_order, 1, step), '') = fails) AS kept,
    sum(n) FILTER (WHERE contains(fails, x) AND translate(fails, substr(filter_order, 1, step - 1), '') = fails) AS removed,
    sum(n) FILTER (WHERE contains(fails, x) AND translate(fails, substr(filter_order, 1, step - 1), '') <> fails) AS redundant,
    sum(n) FILTER (WHERE fails = x) AS unique_fails,
    sum(n) FILTER (WHERE good AND contains(fails, x) AND translate(fails, substr(filter_order, 1, step - 1), '') = fails) AS good_lost,
    sum(n) FILTER (WHERE toxic AND contains(fails, x) AND translate(fails, substr(filter_order, 1, step - 1), '') = fails) AS toxic_lost
  FROM g, s GROUP BY ALL
)
SELECT part, filter_order, cast(step AS int) AS step, cast(coalesce(kept, 0) AS bigint) AS kept, cast(coalesce(removed, 0) AS bigint) AS removed,
  cast(coalesce(redundant, 0) AS bigint) AS redundant, cast(coalesce(unique_fails, 0) AS bigint) AS unique_fails, cast(coalesce(good_lost, 0) AS bigint) AS good_lost,
  cast(coalesce(toxic_lost, 0) AS bigint) AS toxic_lost, cast(sum(coalesce(removed, 0)) OVER (PARTITION BY part, x) AS bigint) AS shapley
FROM r
"""


@_query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each remaining vector and component."""
    out, model = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    n, error = (None, None) if model is None else (model.n, model.identity_error)
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues]) if model is not None and len(model.eigenvalues) else F.array(F.lit(0.0))
    rows = out.select("row.vec_id", F.expr("try_cast(deviation AS bigint)").alias("deviation"), F.posexplode("whitened").alias("k", "whitened"))
    return rows.select(
        "vec_id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, F.col("k")).alias("explained"), F.lit(error).cast("double").alias("identity_error")
    )


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(_LOWER)

ORACLES["op9_decontamination"] = f"""
WITH b AS (SELECT cast(item_id AS varchar) AS item, {_TERMS} AS w FROM benchmark),
bn AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT item, n, unnest(generate_series(1, len(w) - n + 1)) AS s, w FROM bn),
win AS (SELECT DISTINCT item, n, array_to_string(w[s : s + n - 1], ' ') AS k FROM bw),
d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
dn AS (SELECT d.doc_id, x.n, d.w, unnest(generate_series(1, len(d.w) - x.n + 1)) AS s FROM d JOIN (SELECT DISTINCT n FROM win) x ON len(d.w) >= x.n),
dw AS (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS k FROM dn),
m AS (SELECT dw.doc_id, dw.n, dw.s, win.item FROM dw JOIN win ON win.n = dw.n AND win.k = dw.k),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM m) q GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM m) q GROUP BY doc_id)
SELECT d.doc_id, cast(len(d.w) AS bigint) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON h.doc_id = d.doc_id LEFT JOIN i ON i.doc_id = d.doc_id
"""

_DIGITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + ((cast('0x' || substr(h, {1 + 5 * g}, 5) AS bigint) >> {shift}) & 31) AS int), 1)" for g in range(8) for shift in (15, 10, 5, 0)
)
ORACLES["op6_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT body, min(page_id) AS first FROM p GROUP BY body)
SELECT page_id, cast(strlen(p.body) AS bigint) AS payload_bytes, {_DIGITS} AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, target_uri
FROM p JOIN f ON f.body = p.body
"""


def _hilbert_sql(bits: int = sharding.BITS) -> str:
    """The curve's steps, one select for each bit, over cells c0, c1 and c2."""
    digits, following = sharding.curve_tables(3)
    source, at = "cells", "0"
    steps = []
    for b in reversed(range(bits)):
        corner = " + ".join(f"((c{i} >> {b}) & 1) * {1 << i}" for i in range(3))
        at = "0" if source == "cells" else "state"
        before = "0" if source == "cells" else "hilbert"
        keep = "* EXCLUDE (state, hilbert)" if source != "cells" else "*"
        steps.append(f"h{b} AS (SELECT {keep}, {following}[cast({at} * 8 + {corner} + 1 AS int)] AS state, cast({before} * 8 + {digits}[cast({at} * 8 + {corner} + 1 AS int)] AS bigint) AS hilbert FROM {source})")
        source = f"h{b}"
    return ",\n".join(steps)


def _crc32_sql(text: str) -> str:
    """CRC-32 of a text's bytes, folded over a table of its polynomial."""
    table = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ 0xEDB88320 if n & 1 else n >> 1
        table.append(n)
    octets = f"list_transform(regexp_extract_all(hex(encode(coalesce({text}, ''))), '..'), lambda x: cast('0x' || x AS bigint))"
    start = "list_prepend(cast(4294967295 AS bigint), " + octets + ")"
    return f"xor(list_reduce({start}, lambda a, b: xor(a >> 8, {table}[cast((xor(a, b) & 255) + 1 AS int)])), 4294967295)"


ORACLES["op3_sharding"] = f"""
WITH d AS (SELECT doc_id, source, lang, cast(strlen(coalesce(text, '')) + 16 AS bigint) AS size, cast({_crc32_sql("text")} AS bigint) AS text_crc32 FROM documents),
s AS (SELECT source, cast(floor((row_number() OVER (ORDER BY source NULLS LAST) - 1) * 64 / count(*) OVER ()) AS int) AS c0 FROM (SELECT DISTINCT source FROM d) q),
l AS (SELECT lang, cast(floor((row_number() OVER (ORDER BY lang NULLS LAST) - 1) * 64 / count(*) OVER ()) AS int) AS c1 FROM (SELECT DISTINCT lang FROM d) q),
cells AS (SELECT d.*, c0, c1, cast(least(floor(log2(d.size) * 3), 63) AS int) AS c2 FROM d JOIN s ON s.source IS NOT DISTINCT FROM d.source JOIN l ON l.lang IS NOT DISTINCT FROM d.lang),
{_hilbert_sql()},
r AS (SELECT *, row_number() OVER (ORDER BY hilbert, doc_id) - 1 AS k, count(*) OVER () AS n FROM h0)
SELECT doc_id, size, text_crc32, 'rows' AS law, cast(k * {SHARDS} // n AS int) AS shard, k - (k * {SHARDS} // n * n + {SHARDS - 1}) // {SHARDS} AS slot, cast(NULL AS int) AS grown_shard, hilbert, source, lang FROM r
"""

_WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')".format(_LOWER)


def _groups_sql(width: int, percent: int, columns: str) -> str:
    """Sets of shingles, all pairs that share one, and what links reach."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
s0 AS (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - {width - 1}, 1))) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + {width - 1}], ' ') AS g FROM s0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= {percent} * (x.n + y.n - m)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(v, r) AS (SELECT doc_id, doc_id FROM n UNION SELECT u.b, reach.r FROM reach JOIN u ON u.a = reach.v),
c AS (SELECT v, min(r) AS component_id FROM reach GROUP BY v)
SELECT {columns} FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.v = d.doc_id
"""


_GROUP = "d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id"
ORACLES["op4_minhash_near_dedup"] = _groups_sql(5, 75, f"{_GROUP}, coalesce(c.component_id, d.doc_id) = d.doc_id AS kept")
ORACLES["op11_ngram_jaccard_join"] = _groups_sql(4, 85, _GROUP)
