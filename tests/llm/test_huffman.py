"""Token files: optimal codes, exact round trips, the table against the library."""

import heapq
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from barloom.llm import huffman
from barloom.llm.queries import PATTERN, VOCABULARY


def huffman_cost(counts):
    """Bits of an optimal code without a length limit."""
    heap, cost = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@pytest.mark.parametrize("seed", range(6))
def test_codes_are_optimal_and_complete(seed):
    rng = np.random.default_rng(seed)
    counts = rng.zipf(1.5, 300) * rng.integers(0, 2, 300)
    lengths = huffman.code_lengths(counts, 32)
    assert ((lengths > 0) == (counts > 0)).all()
    assert int((lengths * counts).sum()) == huffman_cost(counts)
    short = huffman.code_lengths(counts, 9)
    used = short[short > 0].astype(float)
    assert short.max() <= 9 and (2.0**-used).sum() == 1.0


def test_limit_is_optimal():
    # Fibonacci counts want a code of every length; with at most 3 bits, 5 symbols cost this.
    counts = np.array([1, 1, 2, 3, 5])
    best = min(
        sum(c * n for c, n in zip(counts, lens))
        for lens in np.ndindex(4, 4, 4, 4, 4)
        if all(lens) and sum(2.0**-n for n in lens) <= 1
    )
    assert (huffman.code_lengths(counts, 3) * counts).sum() == best


def test_too_many_symbols():
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(9, dtype=np.int64), 3)


def test_codes_are_prefix_free_and_in_order():
    lengths = huffman.code_lengths(np.array([5, 0, 1, 1, 9, 3]), 8)
    codes = huffman.canonical_codes(lengths)
    words = [f"{c:0{n}b}" for c, n in zip(codes, lengths) if n]
    assert not any(a != b and b.startswith(a) for a in words for b in words)
    order = sorted((n, i) for i, n in enumerate(lengths) if n)
    assert [codes[i] << (8 - n) for n, i in order] == sorted(codes[i] << (8 - n) for n, i in order)


@pytest.mark.parametrize("n", [0, 1, 2, huffman.CHECKPOINT, huffman.CHECKPOINT + 1, 20_000])
def test_blocks_round_trip(n):
    rng = np.random.default_rng(n)
    blocks, want = [], []
    counts = np.bincount(np.concatenate([np.minimum(rng.zipf(1.3, 50_000), 4_000), np.arange(4_001)]))
    lengths = huffman.code_lengths(counts)
    codes = huffman.canonical_codes(lengths)
    for size in (n, 3, n // 2):
        ids = np.minimum(rng.zipf(1.3, size), 4_000).astype(np.uint32)
        bits, checkpoints = huffman.encode_block(ids, lengths, codes)
        assert len(bits) * 8 < int(lengths[ids].sum()) + 128
        blocks.append((bits, checkpoints, size))
        want.append(ids)
    table = huffman.decode_table(lengths)
    assert huffman.decode_blocks(blocks, table).tolist() == np.concatenate(want).tolist()
    # A block alone, and from a checkpoint in its middle.
    assert huffman.decode_blocks(blocks[:1], table).tolist() == want[0].tolist()


def test_one_symbol():
    lengths = huffman.code_lengths(np.array([0, 0, 7]))
    bits, checkpoints = huffman.encode_block(np.full(7, 2), lengths, huffman.canonical_codes(lengths))
    assert huffman.decode_blocks([(bits, checkpoints, 7)], huffman.decode_table(lengths)).tolist() == [2] * 7


def expected(rows):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    ids = [(d, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")) for d, t in rows]
    ids.sort(key=lambda x: (x[0] is not None, x[0] or 0))
    out, start = [], 0
    for d, own in ids:
        out.append((d, start, len(own), own.tobytes()))
        start += len(own)
    return out


def test_the_table_in_several_shards(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    files = huffman.write_token_files(docs, VOCABULARY, PATTERN, shard_docs=30)
    assert spark.read.parquet(files.shards).count() > 3
    got = sorted((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in huffman.read_token_files(spark, files).collect())
    assert got == want
    sums = sorted(tuple(r) for r in huffman.read_token_files(spark, files, digests=True).collect())
    assert sums == [(d, s, n, zlib.crc32(b)) for d, s, n, b in want]
    # Documents of a block ascend, and so do blocks.
    blocks = spark.read.parquet(files.blocks).orderBy("shard", "block").collect()
    numbers = [d for b in blocks for d in b.doc_ids]
    assert numbers == sorted(numbers)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (9, "word " * 80_000), (4, "b"), (4, "b"), (None, "z"), (3, "ü\n\n x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS shard", "2 AS ids")
    files = huffman.write_token_files(frame, VOCABULARY, PATTERN, shard_docs=2)
    got = [(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in huffman.read_token_files(spark, files).collect()]
    assert sorted(got, key=lambda x: x[1]) == expected(rows)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    files = huffman.write_token_files(empty, VOCABULARY, PATTERN)
    assert huffman.read_token_files(spark, files).count() == 0
