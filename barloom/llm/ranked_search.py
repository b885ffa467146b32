"""Ranked lexical search by NRA: postings sorted by impact are read from the top, no random access.

The documents' terms are counted once and stored where they lie. Corpus statistics (documents,
terms, documents holding a term) are Spark aggregates over all of them. Then every task sorts the
postings of its documents, in shards of bounded size, by term and impact, and answers every item
by the NRA rule (Fagin, Lotem and Naor, 2003): read each list a stretch further, keep for each
document met the score seen so far (lower bound) and that plus the next unread impact of every list
it was not seen in (upper bound), and read on until the best are known, with ties, and their two
bounds meet. A list stops being read once no document in question can still turn up in it. Shards
share no documents, so the best of all are the best among the shards' best.

Items come in blocks of bounded size; all rows are searched for each block.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import bounded_batches, map_texts, new_path, release_memory, store

#: Bytes of UTF-8 that belong to terms, after lower-casing: all but ASCII's other characters.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
BEST = 10
#: Fixed values of the score: saturation and length share in percent, scale of an impact.
LENGTH_SHARE, SCALE = 75, 1_000_000_000
#: Memory of a task: documents and postings of a shard, at most one batch over.
SHARD_DOCS, SHARD_POSTINGS = 1 << 15, 1 << 20
#: Different terms of the items of a block, at most one item over.
BLOCK_TERMS = 100_000
#: Places read of each list in the first round; each round reads as many again times this.
FIRST, FACTOR = 64, 4
SPREAD = 64


def _count_terms():
    def kernel(texts: list) -> list:
        n, terms, tfs = [], [], []
        for text in texts:
            found = TERM.findall((text or "").encode("utf-8", "replace").lower())
            counts = Counter(found)
            n.append(len(found))
            terms.append(list(counts))
            tfs.append(list(counts.values()))
        return [n, terms, tfs]

    return kernel


def count_terms(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n, terms, tfs``: terms of each row's text, their number and how often each occurs.

    Terms are the longest runs of ASCII digits, ASCII letters (lower-cased) and all characters
    beyond ASCII. NULL has none.
    """
    slim = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    return map_texts(slim, _count_terms, "n long, terms array<binary>, tfs array<long>")


class Block(NamedTuple):
    """Items of one pass: their ids, and for each the places of its terms and their weights."""

    items: list
    terms: list
    weights: list
    vocabulary: pa.Array


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """``item_id, rank, doc_id, score``: for each item its ``best`` documents with a score above 0.

    ``docs`` has ``doc_id, text`` and ``items`` has ``item_id, text``; other columns are not read.
    Scores are integers: for each term of the item, repeats included, its weight
    ``floor(1000 ln((2N + 2) / (2 df + 1)))`` times the document's impact
    ``(10^9 tf) div (1000 tf + 8 m)`` with ``m = 25 + (75 n N) div L``. Equal scores go by id, NULL
    last. Every row of ``docs`` is a document, also where ids repeat. Different texts of one
    ``item_id`` are one item, and rows that agree in both count once. An item without terms that
    occur has no rows, nor have empty tables.
    """
    spark = docs.sparkSession
    index = store(count_terms(docs), "terms")
    whole = index.agg(F.count(F.when(F.col("n") > 0, 1)).alias("N"), F.sum("n").alias("L")).first()
    path = new_path(spark, "found")
    id_type, doc_type = items.schema["item_id"].dataType, docs.schema["doc_id"].dataType
    schema = f"item_id {id_type.simpleString()}, doc_id {doc_type.simpleString()}, score long, spread int"
    spark.createDataFrame([], schema).write.parquet(path)
    for block in _blocks(index, items, whole["N"]) if whole["N"] else ():
        _found(index, block, whole["N"], whole["L"], best, schema).write.mode("append").parquet(path)

    found = spark.read.schema(schema).parquet(path)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for group in (["item_id", "spread"], ["item_id"]):  # the first cuts what one task gets
        found = found.withColumn("rank", F.row_number().over(W.partitionBy(*group).orderBy(*order)))
        found = found.where(F.col("rank") <= best)
    return found.select("item_id", "rank", "doc_id", "score")


def _blocks(index: DataFrame, items: DataFrame, documents: int) -> Iterator[Block]:
    """The items with the weights of their terms, in blocks of bounded size."""
    texts = items.select("item_id", "text").distinct()
    wanted = count_terms(texts, "item_id").select("id", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
    wanted = wanted.groupBy("id", F.col("t.terms").alias("term")).agg(F.sum("t.tfs").alias("times"))
    wanted = store(wanted, "wanted")
    holding = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    holding = holding.join(wanted.select("term").distinct(), "term", "left_semi")
    weight = F.floor(1000 * F.log((2 * F.lit(documents) + 2) / (2 * F.col("df") + 1)))
    weighted = wanted.join(holding, "term").select("id", "term", (F.col("times") * weight).alias("weight"))
    weighted = weighted.where("weight > 0")
    per_item = weighted.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("term", "weight"))).alias("terms"))
    held, size = [], 0
    for row in store(per_item, "items").toLocalIterator():
        held.append(row)
        size += len(row["terms"])
        if size >= BLOCK_TERMS:
            yield _block(held)
            held, size = [], 0
    if held:
        yield _block(held)


def _block(rows: list) -> Block:
    vocabulary = sorted({bytes(t["term"]) for row in rows for t in row["terms"]})
    place = {term: i for i, term in enumerate(vocabulary)}
    return Block(
        [row["id"] for row in rows],
        [np.array([place[bytes(t["term"])] for t in row["terms"]], np.int64) for row in rows],
        [np.array([t["weight"] for t in row["terms"]], np.int64) for row in rows],
        pa.array(vocabulary, pa.binary()),
    )


def _found(index: DataFrame, block: Block, documents: int, total: int, best: int, schema: str) -> DataFrame:
    """The best of every task for every item of the block."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    types, names = list(arrow.types), list(arrow.names)
    bounded_batches(index.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = [[] for _ in block.items]
        held, docs, postings = [], 0, 0
        for batch in batches:
            part = _postings(batch, block.vocabulary, documents, total)
            held.append(part)
            docs, postings = docs + len(part[0]), postings + len(part[1])
            if docs >= SHARD_DOCS or postings >= SHARD_POSTINGS:
                _answer(held, block, tops, best)
                held, docs, postings = [], 0, 0
        if held:
            _answer(held, block, tops, best)
        release_memory()
        rows = [(item, d, s) for item, top in zip(block.items, tops) for s, d in top]
        spread = TaskContext.get().partitionId() % SPREAD
        columns = [[r[j] for r in rows] for j in range(3)] + [[spread] * len(rows)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    return index.mapInArrow(run, schema)


def _postings(batch: pa.RecordBatch, vocabulary: pa.Array, documents: int, total: int):
    """Ids of a batch, and of each posting of a term in question: document, term, impact."""
    terms, tfs = batch.column("terms"), batch.column("tfs")
    lengths = np.diff(np.asarray(terms.offsets))
    doc = np.repeat(np.arange(len(lengths)), lengths)
    term = pc.index_in(terms.flatten(), value_set=vocabulary)
    hit = np.asarray(term.is_valid())
    doc, term = doc[hit], np.asarray(pc.fill_null(term, 0), np.int64)[hit]
    tf = np.asarray(tfs.flatten(), np.int64)[hit]
    n = np.asarray(batch.column("n"), np.int64)
    m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n * documents) // total
    return batch.column("id").to_pylist(), doc, term, (SCALE * tf) // (1000 * tf + 8 * m[doc])


def _answer(held: list, block: Block, tops: list, best: int) -> None:
    """Search one shard for every item; ``tops`` keeps the best (score, id) of the task so far."""
    ids = [i for part in held for i in part[0]]
    starts = np.cumsum([0] + [len(part[0]) for part in held])
    doc = np.concatenate([part[1] + at for part, at in zip(held, starts)])
    term = np.concatenate([part[2] for part in held])
    impact = np.concatenate([part[3] for part in held])
    order = np.lexsort((-impact, term))
    doc, impact = doc[order], impact[order]
    cuts = np.searchsorted(term[order], np.arange(len(block.vocabulary) + 1))
    for k, (terms, weights) in enumerate(zip(block.terms, block.weights)):
        lists = [
            (doc[cuts[t] : cuts[t + 1]], w * impact[cuts[t] : cuts[t + 1]])
            for t, w in zip(terms, weights)
            if cuts[t] < cuts[t + 1]
        ]
        top = tops[k]
        floor = top[-1][0] if len(top) == best else 1
        found, scores = read_lists(lists, len(ids), best, floor)
        if len(found):
            top += [(int(s), ids[d]) for d, s in zip(found, scores)]
            top.sort(key=lambda x: (-x[0], x[1] is None, x[1]))
            del top[best:]


def read_lists(lists: list, size: int, best: int, floor: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """NRA over lists of ``(documents, scores)``, each sorted by score, largest first.

    Returns the documents (numbers under ``size``) that are or tie with one of the ``best``, and
    their exact scores; none under ``floor``. Bounds are integers below 2^53, so exact in doubles.
    """
    lower, met = np.zeros(size), np.zeros(size, bool)
    at, depth = [0] * len(lists), FIRST
    reading = [True] * len(lists)
    chosen = None  # while unread documents may still come in, all that were met
    while True:
        for t, (docs, scores) in enumerate(lists):
            if reading[t] and at[t] < len(docs):
                stop = min(len(docs), depth)
                lower += np.bincount(docs[at[t] : stop], scores[at[t] : stop], size)
                met[docs[at[t] : stop]] = True
                at[t] = stop
        # What an unseen document can still get of a list; nothing once the list is read.
        bounds = [float(scores[a]) if a < len(docs) else 0.0 for a, (docs, scores) in zip(at, lists)]
        left = np.flatnonzero(met) if chosen is None else chosen
        seen = np.zeros(size)
        for a, bound, (docs, _) in zip(at, bounds, lists):
            if bound:
                seen[docs[:a]] += bound
        upper = lower + (sum(bounds) - seen)
        low = lower[left]
        bar = max(floor, np.partition(low, -best)[-best]) if len(low) >= best else floor
        left = left[upper[left] >= bar]
        if chosen is not None or sum(bounds) < bar:
            chosen = left
            if not len(chosen) or (lower[chosen] == upper[chosen]).all():
                return chosen, lower[chosen].astype(np.int64)
            inside = np.zeros(size, bool)
            inside[chosen] = True
            reading = [bool(b) and inside[docs[:a]].sum() < len(chosen) for a, b, (docs, _) in zip(at, bounds, lists)]
        depth *= FACTOR
