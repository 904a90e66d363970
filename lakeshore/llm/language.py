"""Language identification by compression (operator 13): a text is encoded by
zstandard with each language's raw-content dictionary and belongs to the
language whose dictionary makes it smallest.

A dictionary is ordinary text of the language: whole documents drawn by hash
until ``DICTIONARY_BYTES`` are full, each line once. Texts and dictionaries are
compared as lower-case words. A long text is encoded piece by piece, so that
the dictionary stays in play to its end. Where the second smallest size lies
within ``MIN_MARGIN`` of the smallest, the decision is flagged as rejected.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import ship

DICTIONARY_BYTES = 1 << 16
# Labelled text drawn for each language, in expectation (copies are thrown out).
SAMPLE_BYTES = 4 * DICTIONARY_BYTES
# A model holds at most the languages with the most labelled documents.
MOST_LANGUAGES = 200
LEVEL = 9
PIECE_BYTES = 1 << 15
# Sizes that differ by so many bytes differ in likelihood by the factor e.
BYTES_PER_NAT = 4.0
MIN_MARGIN = 0.02
UNKNOWN = "und"
FOLDS, HELD_OUT_FOLD = 4, 2

# ASCII characters that are no letters become spaces.
_WORDS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_LETTER = regex.compile(r"\p{L}")


class Model(NamedTuple):
    """Languages, the one with the most labelled documents first, and the
    dictionary of each."""
    languages: list[str]
    dictionaries: list[bytes]


def normal(text: str) -> bytes:
    """Lower-case words of a text, one space between them."""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_WORDS).split())


def held_out(doc_id):
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS)) == HELD_OUT_FOLD, F.lit(False))


def dictionary(texts: list[str]) -> bytes:
    """Each line of the texts once, up to DICTIONARY_BYTES."""
    seen: set[bytes] = set()
    out, size = [], 0
    for line in (normal(line) for text in texts for line in text.split("\n")):
        if line and line not in seen:
            seen.add(line)
            out.append(line)
            size += len(line) + 1
        if size >= DICTIONARY_BYTES:
            break
    return b" ".join(out)[:DICTIONARY_BYTES]


def learn(docs: DataFrame) -> Model:
    """Dictionaries from documents with a language, outside the held-out fold
    and of at most DICTIONARY_BYTES; the sample is drawn by hash at a rate that
    makes SAMPLE_BYTES of each language, however much there is."""
    size = F.octet_length("text")
    labelled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                           F.col("lang").cast("string").alias("lang")).where(
        "doc_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL").where(
        ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}") & (size <= DICTIONARY_BYTES))
    known = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes")).orderBy(
        F.desc("n"), "lang").limit(MOST_LANGUAGES).collect()
    if not known:
        return Model([], [])
    # At most MOST_LANGUAGES rates.
    rate = F.lit(0.0)
    for r in known:
        rate = F.when(F.col("lang") == r["lang"], F.lit(SAMPLE_BYTES / r["bytes"])).otherwise(rate)
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    # About SAMPLE_BYTES a language reach the driver; copies are merged before.
    sample = labelled.where(drawn < rate).groupBy("lang", "text").agg(
        F.min(F.xxhash64("doc_id", "text")).alias("draw")).collect()
    texts: dict[str, list] = {r["lang"]: [] for r in known}
    for r in sorted(sample, key=lambda r: (r["draw"], r["text"])):
        texts[r["lang"]].append(r["text"])
    found = [(r["lang"], dictionary(texts[r["lang"]])) for r in known]
    found = [(lang, d) for lang, d in found if d]
    return Model([lang for lang, _ in found], [d for _, d in found])


class Sizer:
    """Compressed sizes of a text by each dictionary of a model."""

    def __init__(self, model: Model):
        import zstandard
        options = zstandard.ZstdCompressionParameters.from_level(
            LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.compressors = []
        for content in model.dictionaries:
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(compression_params=options)
            self.compressors.append(zstandard.ZstdCompressor(dict_data=raw, compression_params=options))

    def sizes(self, words: bytes) -> list[int]:
        pieces = [words[i:i + PIECE_BYTES] for i in range(0, max(1, len(words)), PIECE_BYTES)]
        return [sum(len(c.compress(p)) for p in pieces) for c in self.compressors]


def decide(model: Model, sizes: list[int]) -> tuple[str, float, float]:
    """(language, score, margin): ties go to the language with more labelled
    documents. The score is the language's likelihood among all of the model,
    the margin by how much of the smallest size the second one is larger."""
    best = min(range(len(sizes)), key=sizes.__getitem__)
    least = sizes[best]
    score = 1 / sum(math.exp(min(0.0, (least - s) / BYTES_PER_NAT)) for s in sizes)
    others = [s for i, s in enumerate(sizes) if i != best]
    return model.languages[best], score, (min(others) - least) / least if others else 1.0


_SIZERS: dict[str, Sizer] = {}


def _sizer(model: Model) -> Sizer:
    key = hashlib.sha256(b"\0".join(model.dictionaries)).hexdigest()
    if key not in _SIZERS:
        _SIZERS.clear()
        _SIZERS[key] = Sizer(model)
    return _SIZERS[key]


def classify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (0 to 1),
    margin, rejected (margin below MIN_MARGIN, or nothing to decide on).

    Null text, text without a letter, or nothing learned: ``und``, score 0,
    rejected. Null doc_id: predicted, never learned from, not held out.
    Repeated rows: each predicted; among learned ones each text counts once.
    Whole texts of any length are encoded. Empty table: no rows.
    """
    ship(docs.sparkSession)
    if model is None:
        model = learn(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizer = _sizer(model)
        for b in batches:
            out = []
            for text in b.column("text"):
                text = text.as_py()
                if not text or not model.languages or _LETTER.search(text) is None:
                    out.append((UNKNOWN, 0.0, 0.0))
                else:
                    out.append(decide(model, sizer.sizes(normal(text))))
            lang, score, margin = zip(*out, strict=True) if out else ((), (), ())
            margin = np.array(margin, float)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(margin), pa.array(margin < MIN_MARGIN)],
                ["doc_id", "held_out", "lang_pred", "score", "margin", "rejected"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double, margin double, rejected boolean")
