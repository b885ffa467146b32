"""Toxic documents by multiple-instance learning over their sentences."""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_fold, edit_rows, map_texts

#: Documents of each label in the training sample: the bound of what the fit reads.
SAMPLE_TOXIC = 8_000
SAMPLE_CLEAN = 12_000
#: Further documents that are ordered to find them, so that chance leaves none short.
SPARE = 1_000
#: Longer sentences that near copies have to share, those of the smallest hashes.
KEY_SENTENCES = 3
#: A feature needs so many toxic documents, and so many times the share that it has in clean ones.
MIN_TOXIC = 5
MIN_RATIO = 20.0
#: Features that are kept, those with the most evidence first.
MAX_FEATURES = 20_000
#: Lengths of the word beginnings that are features beside the whole words.
BEGINNINGS = (4, 5, 6)
BIAS = -2.0
EPOCHS = 300
RATE = 0.1
DECAY = 1e-4
THRESHOLD = 0.5
#: Words whose scores a worker remembers.
STORE_WORDS = 100_000

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"\w+")


def features(word: str) -> list[str]:
    """A word's features: itself, and its beginnings if it is longer than them."""
    return [word] + [f"{word[:n]}*" for n in BEGINNINGS if len(word) > n]


@dataclass(frozen=True)
class ToxicModel:
    """Weights by feature, and the bias of a sentence that has any of them."""

    weights: dict[str, float]
    bias: float = BIAS


class SentenceScorer:
    """Scores of one text: ``score`` of the document, ``sentences`` with their places."""

    def __init__(self, model: ToxicModel) -> None:
        self._model = model
        self._words: dict[str, float | None] = {}

    def _word(self, word: str) -> float | None:
        if len(self._words) > STORE_WORDS:
            self._words.clear()
        own = [w for f in features(word) if (w := self._model.weights.get(f)) is not None]
        self._words[word] = found = sum(own) if own else None
        return found

    def sentences(self, text: str | None) -> list[tuple[float, int, int]]:
        """``(probability, start, end)`` of the sentences with any learned feature.

        A sentence without one carries no evidence and has probability zero.
        """
        known, found = self._words, []
        for m in SENTENCE.finditer(text or ""):
            total, any_word = self._model.bias, False
            for word in WORD.findall(m[0].lower()):
                score = known[word] if word in known else self._word(word)
                if score is not None:
                    total += score
                    any_word = True
            if any_word:
                found.append((1 / (1 + np.exp(-np.clip(total, -30, 30))), m.start(), m.end()))
        return found

    def score(self, text: str | None) -> tuple[float, int, int]:
        """The noisy-or of the sentences, and the place of the worst (-1, -1 if there is none)."""
        found = self.sentences(text)
        if not found:
            return 0.0, -1, -1
        p = np.array([s[0] for s in found])
        worst = found[int(p.argmax())]
        return float(-np.expm1(np.log1p(-p).sum())), worst[1], worst[2]


def _sample(docs: DataFrame, labels: DataFrame, folds: int, held_out: int) -> DataFrame:
    """``(text, y)`` of a bounded sample of labelled documents outside the held-out fold.

    Of documents that look like near copies of each other one stays, else the words of a
    document that is often copied would count as evidence. The others are dropped before the
    sample is bounded, by a number for each text.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .where(crc_fold("doc_id", folds) != held_out)
        .groupBy("doc_id")
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("y"))
    )

    def kernel():
        return lambda texts: [[_copies_key(t or "") for t in texts]]

    open_docs = docs.select("doc_id", "text").where(crc_fold("doc_id", folds) != held_out)
    once = (
        map_texts(open_docs, kernel, "key long")
        .join(known, "doc_id")
        .groupBy("y", "key")
        .agg(F.min("doc_id").alias("chosen_id"))
        .withColumnRenamed("key", "chosen_key")
        .checkpoint()
    )
    # What is ordered is about twice the sample at most, however many tasks there are: numbers
    # spread evenly over all longs, so those below a bound from the count are the first.
    deal = F.xxhash64("chosen_key", F.lit(11))
    found = {row["y"]: row["count"] for row in once.groupBy("y").count().collect()}
    parts = []
    for y, n in ((1, SAMPLE_TOXIC), (0, SAMPLE_CLEAN)):
        bound = min((1 << 63) - 1, ((2 * n + SPARE) << 64) // max(1, found.get(y, 0)) - (1 << 63))
        parts.append(once.where((F.col("y") == y) & (deal <= F.lit(bound))).orderBy(deal, "chosen_key").limit(n))
    # At most SAMPLE_TOXIC + SAMPLE_CLEAN rows of numbers.
    chosen = F.broadcast(parts[0].union(parts[1]))
    sample = open_docs.join(chosen, F.col("doc_id") == F.col("chosen_id")).select("text", "y", "chosen_key")
    # A doc_id may repeat with other texts.
    keyed = map_texts(sample, kernel, "key long", drop=()).where("key = chosen_key")
    return keyed.groupBy("y", "key").agg(F.min("text").alias("text")).select("text", "y")


def _copies_key(text: str) -> int:
    """A hash of the longer sentences with the smallest hashes: near copies mostly agree on it.

    One shared line is not enough; a text of few longer sentences counts as a whole.
    """
    hashes = sorted({zlib.crc32(s.strip().encode()) for s in SENTENCE.findall(text) if len(s) > 20})
    if len(hashes) < KEY_SENTENCES:
        return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big", signed=True)
    own = b"".join(h.to_bytes(4, "big") for h in hashes[:KEY_SENTENCES])
    return int.from_bytes(hashlib.blake2b(own, digest_size=8).digest(), "big", signed=True)


def _vocabulary(sample: DataFrame) -> list[str]:
    """Features that toxic documents of the sample have far more often than clean ones."""

    def kernel():
        def run(texts):
            return [[sorted({f for w in set(WORD.findall((t or "").lower())) for f in features(w)}) for t in texts]]

        return run

    counts = (
        map_texts(sample, kernel, "f array<string>")
        .select("y", F.explode("f").alias("f"))
        .groupBy("f")
        .agg(F.sum("y").alias("toxic"), F.sum(1 - F.col("y")).alias("clean"))
        .where(F.col("toxic") >= MIN_TOXIC)
    )
    totals = sample.groupBy("y").count().collect()
    n = {row["y"]: row["count"] for row in totals}
    if not n.get(1):
        return []
    ratio = (F.col("toxic") / n[1]) / ((F.col("clean") + 0.5) / (n.get(0, 0) + 1))
    rows = counts.where(ratio >= MIN_RATIO).orderBy(F.desc("toxic"), "clean", "f").limit(MAX_FEATURES).collect()
    return [row["f"] for row in rows]


def fit_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> ToxicModel:
    """Learn sentence scores from document labels (``labels.toxic``).

    Documents are bags of sentences; a document is toxic if any sentence is, so its score is
    the noisy-or of theirs, and the gradient of the label's likelihood goes to the sentences in
    proportion to their share. Only rows whose crc32 fold is not ``held_out`` are read, from them
    a sample of at most ``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN`` documents, whole. Labels are matched
    by ``doc_id``; the text alone is an input. Spark extracts what the sample's sentences
    have of the learned features; the driver gets these numbers, bounded by the sample.
    Without toxic labels the model scores everything zero.
    """
    sample = _sample(docs, labels, folds, held_out).checkpoint()
    vocabulary = _vocabulary(sample)
    if not vocabulary:
        return ToxicModel({})
    index = {f: i for i, f in enumerate(vocabulary)}

    def kernel():
        def run(texts):
            bags = []
            for text in texts:
                bag = []
                for sentence in SENTENCE.findall(text or ""):
                    own = [index[f] for w in WORD.findall(sentence.lower()) for f in features(w) if f in index]
                    if own:
                        bag.append(own)
                bags.append(bag)
            return [bags]

        return run

    rows = map_texts(sample, kernel, "bag array<array<int>>").where(F.size("bag") > 0).collect()
    weights = train([(row["bag"], row["y"]) for row in rows], len(vocabulary))
    return ToxicModel({f: float(w) for f, w in zip(vocabulary, weights) if abs(w) > 1e-3})


def train(bags: list[tuple[list[list[int]], int]], n_features: int) -> np.ndarray:
    """Weights that maximise the likelihood of the bags' labels (Adam, full batches)."""
    if not bags:
        return np.zeros(n_features)
    y = np.array([label for _, label in bags], dtype=float)
    doc = np.repeat(np.arange(len(bags)), [len(b) for b, _ in bags])
    sizes = [len(s) for b, _ in bags for s in b]
    sentence = np.repeat(np.arange(len(doc)), sizes)
    feature = np.array([f for b, _ in bags for s in b for f in s], dtype=np.int64)
    w, m, v = (np.zeros(n_features) for _ in range(3))
    for step in range(1, EPOCHS + 1):
        logit = np.clip(BIAS + np.bincount(sentence, w[feature], len(doc)), -30, 30)
        p = 1 / (1 + np.exp(-logit))
        whole = np.maximum(-np.expm1(np.bincount(doc, np.log1p(-p), len(bags))), 1e-9)
        # d loss / d logit of a sentence: (P - y) / P of its document times its own p.
        pull = ((whole - y) / whole)[doc] * p
        grad = np.bincount(feature, pull[sentence], n_features) / len(bags) + DECAY * w
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def score_toxicity(docs: DataFrame, model: ToxicModel, folds: int = 5, held_out: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted, worst_start, worst_end`` of every row of ``docs``.

    Whole texts are scored. The last two are the code points of the most offending sentence
    (-1 if no sentence has evidence). NULL and empty texts have score 0 and prediction 0.
    ``held_out`` is false for rows without ``doc_id``, whose crc32 is unknown. Rows that
    repeat come back as often; no rows give none; other columns are ignored.
    """

    def make():
        scorer = SentenceScorer(model)

        def run(texts):
            found = [scorer.score(t) for t in texts]
            scores = [f[0] for f in found]
            return [scores, [int(s >= THRESHOLD) for s in scores], [f[1] for f in found], [f[2] for f in found]]

        return run

    fields = "score double, predicted int, worst_start long, worst_end long"
    scored = map_texts(docs.select("doc_id", "text"), make, fields)
    fold = F.coalesce(crc_fold("doc_id", folds) == held_out, F.lit(False)).alias("held_out")
    return scored.select("doc_id", fold, "score", "predicted", "worst_start", "worst_end")


def drop_toxic(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """Rows of ``docs`` whose text is not predicted toxic; columns unchanged."""

    def make():
        scorer = SentenceScorer(model)

        def edit(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = [scorer.score(t)[0] < THRESHOLD for t in batch.column("text").to_pylist()]
            return batch.filter(pa.array(keep, pa.bool_()))

        return edit

    return edit_rows(docs, make)
