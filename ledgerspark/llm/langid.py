"""Language identification by compression with one zstandard dictionary for each language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import materialize

#: Sample documents of each language: the bound of what is learned from.
SAMPLE_DOCS = 64
#: Code points taken from each sample document, and the pieces that they are taken in.
SAMPLE_CHARS, SAMPLE_PIECES = 1500, 5
#: Languages whose samples may be brought to the driver.
MAX_LANGUAGES = 512
#: Texts are encoded in independent pieces of this many bytes, so that every part of a long one is judged by the dictionaries.
PIECE = 4096
#: Match search of the encoder. Short matches tell related languages apart best.
LEVEL, MIN_MATCH, STRATEGY = 3, 3, zstandard.STRATEGY_LAZY
#: A-Z are lower-cased before encoding, in samples and texts.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Relative gain over the second language under which a text is rejected.
MIN_MARGIN = 0.01

UNDETERMINED = "und"


@dataclass(frozen=True)
class Dictionaries:
    """Raw-content dictionaries by language, in the order of their codes."""

    languages: tuple[str, ...]
    contents: tuple[bytes, ...]


def learn(
    docs: DataFrame, rows: Column, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Dictionaries:
    """Dictionaries from at most ``sample_docs`` documents of each language among ``rows``.

    The documents are those with the least hash of their id in each of ``sample_docs``
    hash classes, found by an aggregation over ids alone. A second read takes
    SAMPLE_PIECES pieces of these, spread over the whole text by a hash of the id, and
    nothing else; one row for each chosen id reaches the driver, so that gets at most
    languages * sample_docs * sample_chars code points. Rows with a null id, text or
    language are not used; of rows that repeat an id the least sample counts. More than
    MAX_LANGUAGES languages are an error.
    """
    known = docs.where(rows & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull())
    order = F.xxhash64(F.col(id_col).cast("string"), F.lit(7)).alias("o")
    picked = known.select(F.col(lang_col).alias("lang"), order).groupBy("lang", F.pmod("o", F.lit(sample_docs))).agg(F.min("o").alias("o")).select("lang", "o")
    picked = materialize(picked.limit(MAX_LANGUAGES * sample_docs + 1), "sampled")  # what is broadcast has that many rows at most
    piece = sample_chars // SAMPLE_PIECES
    room = F.greatest(F.char_length("t") - piece, F.lit(0)) + 1
    pieces = [F.substring(F.col("t"), F.pmod(F.xxhash64("o", F.lit(j)), room).cast("int") + 1, F.lit(piece)) for j in range(SAMPLE_PIECES)]
    whole = known.select(F.col(lang_col).alias("lang"), order, F.col(text_col).alias("t")).join(F.broadcast(picked), ["lang", "o"])
    sample = whole.select("lang", "o", F.when(F.char_length("t") <= sample_chars, F.col("t")).otherwise(F.concat_ws("\n", *pieces)).alias("t")).groupBy("lang", "o").agg(F.min("t").alias("t")).collect()
    by_lang: dict[str, list[tuple[int, str]]] = {}
    for r in sample:
        by_lang.setdefault(r.lang, []).append((r.o, r.t))
    if len(by_lang) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return Dictionaries(tuple(sorted(by_lang)), tuple("\n".join(t for _, t in sorted(by_lang[k])).encode() for k in sorted(by_lang)))


def _encoder(content: bytes, piece: int) -> zstandard.ZstdCompressor:
    how = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=piece, dict_size=len(content), min_match=MIN_MATCH, strategy=STRATEGY, write_content_size=0, write_checksum=0, write_dict_id=0
    )
    d = zstandard.ZstdCompressionDict(content.translate(_LOWER), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=how)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=how)


def _classifier(model: Dictionaries, piece: int):
    schema = pa.schema([("best", pa.int64()), ("margin", pa.float64()), ("score", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = [_encoder(content, piece) for content in model.contents]
        for batch in batches:
            best, margin, score = [], [], []
            for text in batch.column(batch.num_columns - 1):
                data = text.as_buffer().to_pybytes().translate(_LOWER) if text.is_valid else b""
                if not len(data) or not encoders:
                    best.append(None)
                    margin.append(None)
                    score.append(0.0)
                    continue
                sizes = np.array([sum(len(e.compress(data[i : i + piece])) for i in range(0, len(data), piece)) for e in encoders], dtype=float)
                at = int(sizes.argmin())
                rest = np.delete(sizes, at)
                gain = float((rest.min() - sizes[at]) / rest.min()) if len(rest) else 1.0
                # Code lengths of equal odds: each byte a piece saves on average counts as one bit.
                odds = np.exp2(-(sizes - sizes[at]) / max(1, -(-len(data) // piece)))
                best.append(at)
                margin.append(gain)
                score.append(float(1.0 / odds.sum()))
            cols = [pa.array(best, pa.int64()), pa.array(margin, pa.float64()), pa.array(score, pa.float64())]
            kept = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, *cols], names=[*batch.schema.names[:-1], *schema.names])

    return work


def identify(docs: DataFrame, model: Dictionaries, id_col: str = "doc_id", text_col: str = "text", piece: int = PIECE, min_margin: float = MIN_MARGIN) -> DataFrame:
    """One row per row: ``doc_id, lang_pred, score, margin, rejected``.

    The whole text is encoded in pieces with every dictionary; the language with the
    smallest total is predicted. ``margin`` is what the winner saves of the second's
    bytes, ``rejected`` whether that is under ``min_margin``; a rejected prediction is
    still named. ``score`` is the winner's share of the odds.

    A null text, one without a letter, or an empty model gives ``und``, score 0, a null
    margin and a rejection. Ties go to the smaller code. Every row is predicted by
    itself, so repeated rows and ids do not matter; an empty table gives an empty
    result. Only id and text are read.
    """
    has_letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.when(has_letter, F.col(text_col)).alias("_text"))
    out = rows.mapInArrow(_classifier(model, piece), "doc_id long, best long, margin double, score double")
    names = F.array(*[F.lit(x) for x in model.languages]) if model.languages else F.array().cast("array<string>")
    return out.select(
        "doc_id",
        F.coalesce(F.get(names, F.col("best")), F.lit(UNDETERMINED)).alias("lang_pred"),
        "score",
        "margin",
        F.coalesce(F.col("margin") < min_margin, F.lit(True)).alias("rejected"),
    )


def held_out(id_col: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id, as text, leaves 2 when divided by 4."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2
