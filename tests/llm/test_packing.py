"""Packings: every piece once, no sequence over its size, and how near the bounds they are."""

import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from tokenizers import Tokenizer

from barloom.llm import packing
from barloom.llm.queries import PATTERN, VOCABULARY


def plain_best_fit(lengths, capacity):
    """Best-fit decreasing by looking at every bin."""
    free = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, f in enumerate(free) if f >= length]
        if fits:
            free[min(fits, key=lambda i: free[i])] -= length
        else:
            free.append(capacity - length)
    return len(free)


def fewest(lengths, capacity):
    """The least number of bins, by trying all subsets."""
    best = {0: (0, 0)}  # pieces packed -> (bins, load of the last)
    for mask in range(1 << len(lengths)):
        if mask not in best:
            continue
        bins, load = best[mask]
        for i, n in enumerate(lengths):
            if not mask >> i & 1:
                new = (bins, load + n) if bins and load + n <= capacity else (bins + 1, n)
                if new < best.get(mask | 1 << i, (99, 0)):
                    best[mask | 1 << i] = new
    return best[(1 << len(lengths)) - 1][0]


def check(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("seed", range(8))
def test_best_fit_and_bounds(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 101, 300)
    bins, offsets, loads = packing.best_fit(lengths, 100)
    assert len(loads) == plain_best_fit(lengths.tolist(), 100)
    assert (np.bincount(bins, lengths) == loads).all() and loads.max() <= 100
    assert packing.lower_bound(lengths, 100) <= len(loads)
    few = rng.integers(10, 80, 9)
    assert packing.lower_bound(few, 100) <= fewest(few.tolist(), 100)


def test_bounds_see_large_pieces():
    assert packing.lower_bound(np.full(7, 51), 100) == 7
    assert packing.lower_bound(np.array([34] * 9), 100) == 5
    assert packing.lower_bound(np.array([], dtype=np.int64), 100) == 0


def test_partitions_with_gaps_exchange(spark):
    rng = np.random.default_rng(1)
    lengths = [int(n) for n in rng.choice([26, 34, 41, 51, 60, 74], 600)]
    rows = [(i, 0, 0, n, 0) for i, n in enumerate(lengths)]
    pieces = spark.createDataFrame(rows, packing.PIECE_FIELDS)
    small = packing.pack(pieces, 100, partition_pieces=20, rounds=4).collect()
    alone = packing.pack(pieces, 100, partition_pieces=20, rounds=1).collect()
    assert sorted(r.doc_id for r in small) == list(range(600))
    n_small, n_alone = (check([r.asDict() for r in x], 100) for x in (small, alone))
    assert packing.lower_bound(np.array(lengths), 100) <= n_small <= n_alone


def test_columns_with_names_of_its_own(spark):
    names = ["deal", "Part", "settled", "settled_", "sequence_id", "offset", "certified", "n"]
    pieces = spark.range(60).selectExpr("1 + id % 7 AS length", *[f"id AS {c}" for c in names])
    packed = packing.pack(pieces, 10, partition_pieces=20, rounds=3)
    assert packed.columns == ["length", "deal", "Part", "settled", "settled_", "n", *packing.ADDED]
    rows = packed.collect()
    assert sorted(r.n for r in rows) == list(range(60))
    assert all(r.deal == r.Part == r.settled == r.settled_ == r.n and r.length == 1 + r.n % 7 for r in rows)
    loads = {}
    for r in rows:
        loads[r.sequence_id] = loads.get(r.sequence_id, 0) + r.length
    assert max(loads.values()) <= 10


def test_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    ids = {
        r.doc_id: np.array([*tokenizer.encode(r.text, add_special_tokens=False).ids, 0], dtype="<u4")
        for r in docs.collect()
    }
    rows = packing.pack_documents(docs, VOCABULARY, PATTERN).collect()
    found = defaultdict(list)
    for r in rows:
        own = ids[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(own.tobytes()) and len(own) == r.length
        found[r.doc_id].append(r)
    assert found.keys() == ids.keys()
    for doc, pieces in found.items():
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces)))
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:i]) for i in range(len(pieces))]
        assert sum(r.length for r in pieces) == len(ids[doc])
        assert all(r.length == 2048 for r in pieces[1:])
    n = check([r.asDict() for r in rows], 2048)
    assert n <= packing.lower_bound(np.array([r.length for r in rows])) + 1


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "word " * 9_000), (4, "b"), (4, "b"), (None, "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS length", "2 AS part")
    found = packing.pack_documents(frame, VOCABULARY, PATTERN).collect()
    sizes = defaultdict(int)
    for r in found:
        sizes[r.doc_id] += r.length
    assert sizes == {1: 1, 2: 1, 3: 9_002, 4: 4, None: 2}
    check([r.asDict() for r in found], 2048)
    assert packing.pack_documents(frame.limit(0), VOCABULARY, PATTERN).count() == 0


def test_all_subsets_helper():
    assert fewest([60, 60, 40, 40], 100) == 2
    assert all(fewest(list(c), 100) == 1 for c in combinations([10, 20, 30], 2))
