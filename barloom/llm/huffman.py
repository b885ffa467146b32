"""Token files: canonical length-limited Huffman codes in independent blocks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded_batches, new_path, release_memory, store
from .tokens import library_encoder

END_ID = 0
#: Longest code in bits, ids between two checkpoints, ids of a block (a longer document is one block).
MAX_BITS = 20
CHECKPOINT = 512
BLOCK_IDS = 1 << 16
#: Documents of a shard, about: a shard is a span of document numbers.
SHARD_DOCS = 8_192
#: Ids that are decoded side by side.
DECODE_IDS = 1 << 21

BLOCK_FIELDS = (
    "shard long, block long, first long, n_ids long, doc_ids array<{doc}>, counts array<long>, "
    "checkpoints binary, bits binary"
)


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Bits of an optimal prefix code of at most ``max_bits``; 0 for ids that don't occur.

    Package-merge: at every level pairs of the level below are packaged and merged with the
    symbols; the first 2n - 2 items of the top level tell how often each symbol is taken.
    """
    lengths = np.zeros(len(counts), dtype=np.uint8)
    used = np.flatnonzero(counts)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids do not fit codes of {max_bits} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    levels, items = [], leaves
    for _ in range(max_bits - 1):
        levels.append(np.zeros(0, dtype=bool))
        even = len(items) // 2 * 2
        packages = items[0:even:2] + items[1:even:2]
        both = np.concatenate([leaves, packages])
        place = np.argsort(both, kind="stable")
        items = both[place]
        levels[-1] = place < len(leaves)
    take = 2 * len(leaves) - 2
    depth = np.zeros(len(leaves), dtype=np.int64)
    for is_leaf in reversed(levels):
        own = int(is_leaf[:take].sum())
        depth[:own] += 1
        take = 2 * (take - own)
    depth[:take] += 1
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), dtype=np.uint32)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    if len(order):
        bits = lengths[order].astype(np.int64)
        # Each code takes 2^(longest - length) places of the longest length's numbers.
        width = np.int64(1) << (bits.max() - bits)
        codes[order] = (np.cumsum(width) - width) >> (bits.max() - bits)
    return codes


def encode_block(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, bytes]:
    """Bits of ``ids`` (highest first, in whole 32-bit words) and the bit offset of every
    ``CHECKPOINT``-th id as little-endian unsigned 64-bit numbers."""
    own = lengths[ids].astype(np.int64)
    ends = np.cumsum(own)
    starts = ends - own
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros(total // 32 + 3, dtype=np.uint64)
    # A code of at most 32 bits touches two words; shifted into 64 bits, its halves are added
    # to them. Different codes have different bits, so a sum is a union.
    shifted = codes[ids].astype(np.uint64) << (64 - own - (starts & 31)).astype(np.uint64)
    place = starts >> 5
    if len(ids):
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        words[place[first]] += np.add.reduceat(shifted >> np.uint64(32), first)
        words[place[first] + 1] += np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), first)
    return words.astype(">u4").tobytes(), starts[::CHECKPOINT].astype("<u8").tobytes()


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Id and code length for every value of the next ``bits`` bits."""
    used = np.flatnonzero(lengths)
    if not len(used):
        return np.zeros(1, np.uint32), np.zeros(1, np.uint8), 0
    order = used[np.lexsort((used, lengths[used]))]
    bits = int(lengths.max())
    width = np.int64(1) << (bits - lengths[order].astype(np.int64))
    ids, sizes = np.zeros(1 << bits, np.uint32), np.zeros(1 << bits, np.uint8)
    total = int(width.sum())
    ids[:total] = np.repeat(order, width)
    sizes[:total] = np.repeat(lengths[order], width)
    return ids, sizes, bits


def decode_blocks(blocks: list[tuple[bytes, bytes, int]], table: tuple) -> np.ndarray:
    """Ids of blocks ``(bits, checkpoints, n_ids)``: from all checkpoints at the same time,
    one id a step."""
    ids, sizes, bits = table
    words, places, counts, outs = [], [], [], []
    base = out = 0
    for payload, checkpoints, n in blocks:
        starts = np.frombuffer(checkpoints, dtype="<u8").astype(np.int64)
        words.append(np.frombuffer(payload, dtype=">u4").astype(np.uint64))
        places.append(starts + base * 32)
        lanes = np.arange(len(starts)) * CHECKPOINT
        counts.append(np.minimum(CHECKPOINT, n - lanes))
        outs.append(out + lanes)
        base += len(words[-1])
        out += n
    result = np.zeros(out, dtype=np.uint32)
    if not out:
        return result
    word, at, count, to = map(np.concatenate, (words, places, counts, outs))
    order = np.argsort(-count, kind="stable")
    at, count, to = at[order], count[order], to[order]
    mask = np.uint64((1 << bits) - 1)
    for step in range(int(count[0])):
        live = int(np.searchsorted(-count, -step, side="left"))
        at, to = at[:live], to[:live]
        w = at >> 5
        window = word[w] << np.uint64(32) | word[w + 1]
        shift = (64 - bits - (at & 31)).astype(np.uint64)
        value = ((window >> shift) & mask).astype(np.int64)
        result[to + step] = ids[value]
        at = at + sizes[value]
    return result


@dataclass(frozen=True)
class TokenFiles:
    """Folders of one set of token files: blocks, code lengths by id, ids of each shard."""

    blocks: str
    codebook: str
    shards: str


class IdPacker:
    """Ids as compressed bytes, and back: the width of a number, then the numbers."""

    def __init__(self) -> None:
        self._compress = zstandard.ZstdCompressor(level=1).compress
        self._decompress = zstandard.ZstdDecompressor().decompress

    def pack(self, ids: np.ndarray) -> bytes:
        width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
        return bytes([width]) + self._compress(ids.astype(f"<u{width}").tobytes())

    def unpack(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(self._decompress(packed[1:]), dtype=f"<u{packed[0]}").astype(np.uint32)


def id_counts(packed: DataFrame) -> np.ndarray:
    """How often each id occurs in all rows of ``packed(ids)``; as long as the greatest id.

    Each task counts its rows and Spark adds the counts up, so the driver gets one number for
    each id of the vocabulary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, unpack = np.zeros(0, dtype=np.int64), IdPacker().unpack
        for batch in batches:
            if batch.num_rows:
                own = np.bincount(np.concatenate([unpack(b) for b in batch.column("ids").to_pylist()]))
                if len(own) > len(total):
                    own, total = total, own.astype(np.int64)
                total[: len(own)] += own
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    rows = packed.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    found = rows.toPandas()
    counts = np.zeros(int(found["id"].max()) + 1 if len(found) else 0, dtype=np.int64)
    counts[found["id"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return counts


def _tokenized(docs: DataFrame, vocabulary: str, pattern: str, cuts: np.ndarray) -> DataFrame:
    """``doc_id, n, ids, shard`` of each document; the end id is the last of its ids."""
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pack = library_encoder(vocabulary, pattern), IdPacker().pack
        for batch in batches:
            ids, counts = encoder.encode(batch.column("text"))
            own = [pack(np.append(part, END_ID)) for part in np.split(ids, np.cumsum(counts)[:-1])]
            number = batch.column("doc_id").cast(pa.int64()).fill_null(np.iinfo(np.int64).min)
            shard = np.searchsorted(cuts, number.to_numpy(zero_copy_only=False), side="right")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts + 1, pa.int64()),
                    pa.array(own[: len(counts)], pa.binary()),
                    pa.array(shard, pa.int64()),
                ],
                names=["doc_id", "n", "ids", "shard"],
            )
        release_memory()

    fields = f"doc_id {doc_type}, n long, ids binary, shard long"
    return docs.select("doc_id", "text").mapInArrow(run, fields)


def _blocks(ordered: DataFrame, lengths: np.ndarray) -> DataFrame:
    """Blocks of documents that come in the order of (shard, doc_id)."""
    codes = canonical_codes(lengths)
    doc_type = ordered.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "block", "first", "n_ids", "doc_ids", "counts", "checkpoints", "bits"]
        held: list = []
        unpack = IdPacker().unpack
        size, number, first, shard = 0, 0, 0, None

        def block(doc_type: pa.DataType) -> pa.RecordBatch:
            flat = np.concatenate([h[2] for h in held])
            bits, checkpoints = encode_block(flat, lengths, codes)
            row = [shard, number, first, size, [h[0] for h in held], [h[1] for h in held], checkpoints, bits]
            types = [pa.int64()] * 4 + [pa.list_(doc_type), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

        for batch in batches:
            of = batch.schema.field("doc_id").type
            columns = [batch.column(c).to_pylist() for c in ("shard", "doc_id", "n", "ids")]
            for own, doc, n, packed in zip(*columns):
                if held and (own != shard or size + n > BLOCK_IDS):
                    yield block(of)
                    held, first, number, size = [], first + size, number + 1, 0
                if own != shard:
                    shard, number, first = own, 0, 0
                held.append((doc, n, unpack(packed)))
                size += n
        if held:
            yield block(of)
        release_memory()

    return ordered.mapInArrow(run, BLOCK_FIELDS.replace("{doc}", doc_type))


def write_token_files(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    path: str | None = None,
    shard_docs: int = SHARD_DOCS,
) -> TokenFiles:
    """Encode ``docs(doc_id, text)``, with the end id after each text, into token files.

    The tokenizer runs once and its ids are written down; counts over all of them make the
    code; then ids are shuffled into shards, spans of document numbers of about ``shard_docs``
    documents, and written in ascending order of ``doc_id``. A block holds whole documents,
    and is decoded on its own, from any of its checkpoints. NULL text counts as empty; rows
    without ``doc_id`` come first; rows that repeat stay, side by side, ordered by their ids.
    No rows give empty files. Other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    path = path or new_path(spark, "tokens")
    numbers = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    shards = max(1, -(-numbers.count() // shard_docs))
    cuts: list = []
    if shards > 1:
        parts = [i / shards for i in range(1, shards)]
        (found,) = numbers.agg(F.percentile_approx("doc_id", parts, 20 * shards)).first()
        cuts = sorted(set(found or []))
    ids = store(_tokenized(docs, vocabulary, pattern, np.array(cuts, dtype=np.int64)), "ids", "none")

    lengths = code_lengths(id_counts(ids))
    book = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(book, "id int, bits int").coalesce(1).write.parquet(f"{path}/codebook")
    ids.groupBy("shard").agg(F.sum("n").alias("n_ids")).write.parquet(f"{path}/shards")
    # A shard is a partition: hashes of their numbers would put several into one.
    placed = ids.repartitionById(shards, F.col("shard").cast("int"))
    ordered = placed.sortWithinPartitions("shard", "doc_id", "ids")
    _blocks(ordered, lengths).write.option("compression", "none").parquet(f"{path}/blocks")
    return TokenFiles(f"{path}/blocks", f"{path}/codebook", f"{path}/shards")


def read_token_files(spark: SparkSession, files: TokenFiles, digests: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids binary)`` from token files, decoded block by block.

    ``start`` is the number of ids of all documents before this one; ``ids`` are little-endian
    unsigned 32-bit integers with the end id. With ``digests`` their unsigned crc32
    (``ids_crc32 long``) comes in their place. The code book has at most one row for each id
    of the vocabulary; shards before a shard are summed over one row a shard.
    """
    bounded_batches(spark)
    book = spark.read.parquet(files.codebook).toPandas()
    lengths = np.zeros(int(book["id"].max()) + 1 if len(book) else 0, dtype=np.uint8)
    lengths[book["id"].to_numpy(np.int64)] = book["bits"].to_numpy(np.uint8)
    blocks = spark.read.parquet(files.blocks)
    doc_type = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    content = "ids_crc32 long" if digests else "ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decode_table(lengths)
        for batch in batches:
            n_ids = batch.column("n_ids").to_numpy()
            at = 0
            while at < len(n_ids):
                end = at + max(1, int(np.searchsorted(np.cumsum(n_ids[at:]), DECODE_IDS)))
                part = batch.slice(at, end - at)
                yield _documents(part, table, digests)
                at = end
        release_memory()

    names = ["shard", "first", "n_ids", "doc_ids", "counts", "checkpoints", "bits"]
    fields = f"shard long, doc_id {doc_type}, within long, n_tokens long, {content}"
    found = blocks.select(*names).mapInArrow(run, fields)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = spark.read.parquet(files.shards).select(
        "shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("shard_start")
    )
    return found.join(offsets, "shard").select(
        "doc_id",
        (F.col("shard_start") + F.col("within")).alias("start"),
        "n_tokens",
        content.split()[0],
    )


def _documents(part: pa.RecordBatch, table: tuple, digests: bool) -> pa.RecordBatch:
    columns = {c: part.column(c).to_pylist() for c in ("bits", "checkpoints", "n_ids", "shard", "first", "counts")}
    ids = decode_blocks(list(zip(columns["bits"], columns["checkpoints"], columns["n_ids"])), table)
    doc_ids = part.column("doc_ids").flatten()
    shards, starts, sizes, contents = [], [], [], []
    at = 0
    for shard, first, counts in zip(columns["shard"], columns["first"], columns["counts"]):
        for n in counts:
            own = ids[at : at + n].astype("<u4").tobytes()
            at += n
            shards.append(shard)
            starts.append(first)
            sizes.append(n)
            contents.append(zlib.crc32(own) if digests else own)
            first += n
    arrays = [pa.array(v, pa.int64()) for v in (shards, starts, sizes)]
    last = pa.array(contents, pa.int64() if digests else pa.binary())
    names = ["shard", "doc_id", "within", "n_tokens", "ids_crc32" if digests else "ids"]
    return pa.RecordBatch.from_arrays([arrays[0], doc_ids, *arrays[1:], last], names=names)
