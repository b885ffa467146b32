"""SimHash near-duplicates by meeting in the middle of Hamming balls."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, store
from .components import components

#: Words a shingle, and the greatest number of differing bits of a link.
SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Shingle hashes whose bits are counted at a time.
BLOCK = 1 << 16


def fingerprint_of(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of one text, unsigned.

    Words are what ASCII white space separates after A-Z are lower-cased; a text of fewer
    words is one shingle; a text without words (also NULL) has fingerprint zero.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = [0, *(ends[: len(parts) - words] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[words - 1 :].tolist())]
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), BLOCK):
        block = np.array(hashes[i : i + BLOCK], dtype=">u8")
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)`` of every row of ``docs(doc_id, text)``; ``fp`` is the signed long."""

    def kernel():
        def run(texts):
            found = np.array([fingerprint_of(t, words) for t in texts], dtype=np.uint64)
            return [found.view(np.int64).tolist()]

        return run

    return map_texts(docs.select("doc_id", "text"), kernel, "fp long")


def near_links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``(a, b)`` that join all fingerprints at ``max_bits`` or fewer differing bits.

    ``prints(fp, node)`` holds each fingerprint once. Every fingerprint emits all variants at
    half the distance (65 for two bits). Two fingerprints within ``max_bits`` of each other
    share a variant, so a shuffle on variants brings them together, and a variant has at most
    as many fingerprints as its ball has places, whatever the size of the data: its list is
    bounded. Each is linked to the list's smallest node after a check of the distance; where
    the ball's own members are further apart than ``max_bits`` (odd distances), every pair of
    the bounded list is checked.
    """
    half = (max_bits + 1) // 2
    masks = [0]
    for k in range(1, half + 1):
        masks += [sum(1 << i for i in places) for places in combinations(range(64), k)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    # The masks as a literal array: 65 numbers for two bits.
    variants = F.explode(F.transform(F.array(*[F.lit(m).cast("long") for m in signed]), lambda m: F.col("fp").bitwiseXOR(m)))
    met = (
        prints.select("fp", "node", variants.alias("variant"))
        .groupBy("variant")
        .agg(F.sort_array(F.collect_list(F.struct("node", "fp"))).alias("ball"))
        .where(F.size("ball") > 1)
    )
    if 2 * half == max_bits:
        hub = F.col("ball")[0]
        pairs = met.select(hub.alias("x"), F.explode(F.slice("ball", 2, F.size("ball") - 1)).alias("y"))
    else:
        at = met.select("ball", F.posexplode("ball").alias("i", "x"))
        pairs = at.select("x", F.explode(F.slice("ball", F.col("i") + 2, F.size("ball"))).alias("y"))
    near = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp"))) <= max_bits
    return pairs.where(near).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()


def simhash_groups(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fp, fingerprint, component_id)`` for every row of ``docs(doc_id, text)``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` the smallest ``doc_id`` that
    links of at most ``max_bits`` differing bits reach. NULL and empty texts have fingerprint
    zero and are linked like any other. Repeated rows come back as often as they are given;
    rows without ``doc_id`` have a fingerprint but take no part in links, and their component
    is NULL. An empty table gives an empty table. Other columns are ignored.

    Copies share a fingerprint and count once from here on: links are between fingerprints.
    """
    prints = store(fingerprints(docs, words), "simhash")
    once = prints.where("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node"))
    # Each row becomes many variants next: as many tasks as a shuffle has, not fewer.
    tasks = int(once.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = once.repartition(tasks, "fp").checkpoint()
    groups = components(near_links(once, max_bits))
    of = once.join(groups, "node", "left").select(
        F.col("fp").alias("of_fp"), F.coalesce("component", "node").alias("component_id")
    )
    return prints.join(of, F.col("fp") == F.col("of_fp"), "left").select(
        "doc_id",
        "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


#: Reserved name of a column beside those of the documents.
TEXT_HASH = "_simhash_text"


def drop_near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each group of ``docs``: that of the smallest ``doc_id``; columns unchanged.

    Of rows that repeat such a ``doc_id`` one stays for each different text, so no text goes but for
    a near-duplicate under another id. Rows without ``doc_id`` cannot be compared by it and stay.
    """
    kept = simhash_groups(docs, words, max_bits).where("doc_id = component_id").select("doc_id").distinct()
    # The row number is taken on the partitioning and order that the join leaves.
    named = docs.where("doc_id IS NOT NULL").join(kept, "doc_id", "left_semi")
    first = named.withColumn(TEXT_HASH, F.xxhash64("text")).dropDuplicates(["doc_id", TEXT_HASH])
    first = first.select(docs.columns)
    return first.unionByName(docs.where("doc_id IS NULL"))
