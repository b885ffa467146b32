"""Language of texts by how well each language's dictionary compresses them."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.schema import shared_dir

from .common import crc_fold, edit_rows, map_texts

#: Bytes of a language's dictionary; different texts of a language in the training sample, and
#: the characters that are read of each: the bounds of what the fit reads.
DICTIONARY_BYTES = 112 << 10
SAMPLE_DOCS = 200
#: Further texts that are ordered to find them, so that chance leaves none short.
SPARE = 200
SAMPLE_CHARS = 4_000
LEVEL = 5
#: Bytes that are compressed at a time, so that a long text's own words don't replace the dictionary's.
BLOCK_BYTES = 1024
#: Best and second size must differ by this share of the second, else the text is rejected.
MIN_MARGIN = 0.004
#: Margin at which the score is 1 - 1/e.
SCORE_MARGIN = 0.05
UNKNOWN = "und"

NO_LETTER = re.compile(r"[\W\d_]+")


def plain(text: str) -> bytes:
    """Lower-case words with one space between them; empty if the text has no letter."""
    return NO_LETTER.sub(" ", text.lower()).strip().encode()


@dataclass(frozen=True)
class LanguageModel:
    """Raw-content dictionaries by language."""

    dictionaries: dict[str, bytes]


class Compressors:
    """One compressor a language; ``predict`` gives language, score and margin of a text."""

    def __init__(self, model: LanguageModel) -> None:
        self._by = []
        for name in sorted(model.dictionaries):
            content = model.dictionaries[name]
            own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=LEVEL)
            compressor = zstandard.ZstdCompressor(
                level=LEVEL, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False
            )
            self._by.append((name, compressor.compress))

    def predict(self, text: str | None) -> tuple[str, float, float]:
        content = plain(text) if text else b""
        if not content or not self._by:
            return UNKNOWN, 0.0, 0.0
        blocks = [content[i : i + BLOCK_BYTES] for i in range(0, len(content), BLOCK_BYTES)]
        sizes = sorted((sum(len(compress(b)) for b in blocks), name) for name, compress in self._by)
        if len(sizes) == 1:
            return sizes[0][1], 1.0, 1.0
        margin = (sizes[1][0] - sizes[0][0]) / sizes[1][0]
        return sizes[0][1], float(-np.expm1(-margin / SCORE_MARGIN)), margin


def fit_languages(docs: DataFrame, folds: int = 4, held_out: int = 2) -> LanguageModel:
    """A dictionary for each value of ``lang``, from ``docs(doc_id, text, lang)``.

    Only rows with a language outside the held-out crc32 fold are read. Of each language a
    sample of ``SAMPLE_DOCS`` different texts, in the order of a hash of what is read of them,
    gives up to ``SAMPLE_CHARS`` characters each and ``DICTIONARY_BYTES`` bytes together, which
    mostly is the smaller bound. Copies take one place. The driver gets that much for each
    language. A language with any letter in its sample is learned, however short (its content is
    then repeated); one without a letter is not. No labelled rows give no languages.
    """
    length = F.length("text")
    part = F.substring("text", 1, SAMPLE_CHARS)
    eligible = (
        docs.select("doc_id", "text", "lang")
        .where("lang IS NOT NULL AND text IS NOT NULL")
        .where(F.coalesce(crc_fold("doc_id", folds) != held_out, F.lit(False)))
        # Texts of middling length first, then any.
        .select("lang", (~length.between(200, SAMPLE_CHARS)).cast("int").alias("odd"), F.xxhash64(part).alias("h"), part.alias("part"))
    )
    # Copies are dropped by their hashes, so that no texts are shuffled for it. Hashes spread evenly
    # over all longs, so those below a bound from the count are the first: the window gets about
    # 2 * SAMPLE_DOCS + SPARE of a language and kind, however many tasks and rows there are.
    shared_dir(docs.sparkSession)
    texts = eligible.select("lang", "odd", "h").distinct().checkpoint()
    share = F.lit(float(2 * SAMPLE_DOCS + SPARE)) / F.count("*")
    bounds = texts.groupBy("lang", "odd").agg((share * 2.0**64 - 2.0**63).alias("bound"))
    order = Window.partitionBy("lang").orderBy("odd", "h")
    chosen = (
        texts.join(bounds, ["lang", "odd"])
        .where(F.col("h").cast("double") <= F.col("bound"))
        .select("lang", "odd", "h", F.row_number().over(order).alias("place"))
        .where(F.col("place") <= SAMPLE_DOCS)
    )
    # At most SAMPLE_DOCS numbers for each language.
    rows = (
        eligible.join(F.broadcast(chosen), ["lang", "odd", "h"])
        .groupBy("lang", "place")
        .agg(F.min("part").alias("part"))
        .collect()
    )
    found: dict[str, bytearray] = {}
    for row in sorted(rows, key=lambda r: (r["lang"], r["place"])):
        own = found.setdefault(row["lang"], bytearray())
        if len(own) < DICTIONARY_BYTES:
            own += plain(row["part"]) + b"\n"
    return LanguageModel({k: _dictionary(bytes(v[:DICTIONARY_BYTES])) for k, v in found.items() if v.strip()})


def _dictionary(content: bytes) -> bytes:
    """At least the eight bytes that a dictionary must have: short content is repeated."""
    return content * -(-8 // len(content))


def identify(docs: DataFrame, model: LanguageModel, folds: int = 4, held_out: int = 2) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, rejected`` of every row of ``docs``.

    ``lang_pred`` is the language with the smallest size over the whole text, the first by
    name among equals, and ``und`` if the text is NULL or has no letter. ``score`` grows with
    the margin from 0 to 1; ``rejected`` tells that the margin is too narrow (or ``und``).
    ``held_out`` is false for rows without ``doc_id``. Rows that repeat come back as often; no
    rows give none; other columns are ignored.
    """

    def make():
        compressors = Compressors(model)

        def run(texts):
            found = [compressors.predict(t) for t in texts]
            return [[f[0] for f in found], [f[1] for f in found], [f[2] < MIN_MARGIN for f in found]]

        return run

    named = map_texts(docs.select("doc_id", "text"), make, "lang_pred string, score double, rejected boolean")
    fold = F.coalesce(crc_fold("doc_id", folds) == held_out, F.lit(False)).alias("held_out")
    return named.select("doc_id", fold, "lang_pred", "score", "rejected")


def drop_unidentified(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """Rows of ``docs`` that are not rejected; columns unchanged."""

    def make():
        compressors = Compressors(model)

        def edit(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = [compressors.predict(t)[2] >= MIN_MARGIN for t in batch.column("text").to_pylist()]
            return batch.filter(pa.array(keep, pa.bool_()))

        return edit

    return edit_rows(docs, make)
