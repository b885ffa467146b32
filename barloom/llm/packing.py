"""Best-fit packing of documents into sequences, certified by lower bounds."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, release_memory, store
from .tokens import library_encoder

CAPACITY = 2048
END_ID = 0
#: Pieces that one task packs, about; and how often partitions with gaps exchange pieces.
PARTITION_PIECES = 16_384
ROUNDS = 4
#: Stretches k of the dual-feasible functions that are tried.
STRETCHES = range(1, 25)

#: Columns that packing adds.
ADDED = ("sequence_id", "offset", "certified")

PIECE_FIELDS = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, vocabulary: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of ``docs(doc_id, text)``: ids of the whole text, then the end id.

    Only documents of more than ``capacity`` ids are cut, into pieces of ``capacity``; what is
    left over comes first. NULL counts as the empty text, whose piece is the end id alone.
    """
    bounded_batches(docs.sparkSession)
    doc_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(vocabulary, pattern)
        for batch in batches:
            ids, counts = encoder.encode(batch.column("text"))
            rows, pieces, starts, lengths, sums = [], [], [], [], []
            at = 0
            for row, n in enumerate(counts.tolist()):
                own = np.append(ids[at : at + n], END_ID).astype("<u4")
                at += n
                start, piece = 0, 0
                while start < n + 1:
                    length = (n + 1 - start - 1) % capacity + 1 if piece == 0 else capacity
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(own[start : start + length].tobytes()))
                    start, piece = start + length, piece + 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(run, PIECE_FIELDS.replace("doc_id long", f"doc_id {doc_type}"))


def lower_bound(lengths: np.ndarray, capacity: int = CAPACITY) -> int:
    """No packing of ``lengths`` into bins of ``capacity`` has fewer bins.

    The greatest bound of three families of dual-feasible functions: the sum of sizes; sizes
    over 1 - e counted as whole bins and those under e as nothing, for every e; and sizes
    stretched by k + 1 and rounded down, for each k of ``STRETCHES``.
    """
    if not len(lengths):
        return 0
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    mass = count * size
    best = ceil(Fraction(int(mass.sum()), capacity))
    below, up_to = np.concatenate([[0], np.cumsum(mass)]), np.concatenate([[0], np.cumsum(count)])
    e = np.arange(0, capacity // 2 + 1)
    large = up_to[-1] - up_to[capacity - e + 1]
    rest = below[capacity - e + 1] - below[e]
    best = max(best, int((large + -(-rest // capacity)).max()))
    for k in STRETCHES:
        whole = (k + 1) * size % capacity == 0
        kept = int(mass[whole].sum())
        steps = int((count[~whole] * ((k + 1) * size[~whole] // capacity)).sum())
        best = max(best, ceil(Fraction(kept, capacity) + Fraction(steps, k)))
    return best


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each piece, and the load of each bin.

    Bins are listed by what is free in them; the bits of one whole number tell for which
    amounts there is a bin, so the fullest bin that fits is found without a search.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    with_free: list[list[int]] = [[] for _ in range(capacity + 1)]
    there, loads = 0, []
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        fits = there >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            own = with_free[free].pop()
            if not with_free[free]:
                there ^= 1 << free
        else:
            free, own = capacity, len(loads)
            loads.append(0)
        bins[i], offsets[i] = own, loads[own]
        loads[own] += length
        free -= length
        if free:
            if not with_free[free]:
                there |= 1 << free
            with_free[free].append(own)
    return bins, offsets, np.array(loads, dtype=np.int64)


def _packer(turn: int, last: bool, capacity: int, dealt: str, settled: str) -> Callable[[pa.Table], pa.Table]:
    def one(pieces: pa.Table) -> pa.Table:
        lengths = pieces.column("length").to_numpy()
        bins, offsets, loads = best_fit(lengths, capacity)
        good = len(loads) == lower_bound(lengths, capacity)
        part = pieces.column(dealt)[0].as_py()
        added = {
            "sequence_id": (turn << 56) + (part << 24) + bins,
            "offset": offsets,
            "certified": np.full(len(bins), good),
            settled: (loads[bins] == capacity) | good | last,
        }
        out = pieces.drop_columns([dealt])
        for name, values in added.items():
            out = out.append_column(name, pa.array(values))
        return out

    return one


def _unused(name: str, columns: list[str]) -> str:
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    partition_pieces: int = PARTITION_PIECES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``pieces(..., length)`` with ``sequence_id``, ``offset``, ``certified``.

    Pieces are dealt over partitions of about ``partition_pieces`` by a random number that is
    written down with them. Each partition is packed best-fit decreasing and compared with its
    lower bound; one that meets it is certified and done. In the others the full bins stay, and
    the pieces of all bins with room are pooled, dealt over new partitions and packed again.
    Packing ends when no partition has a gap, or after ``rounds``; bins of the last round stay
    with ``certified`` false. No piece is longer than ``capacity`` or shorter than one. Columns
    of ``pieces`` that are named like the three added ones are replaced; all others stay.
    """
    spark = pieces.sparkSession
    columns = [c for c in pieces.columns if c.lower() not in ADDED]
    deal, part, settled_name = (_unused(name, columns) for name in ("deal", "part", "settled"))
    now = store(pieces.select(*columns, F.rand(7).alias(deal)), "pieces")
    done = None
    kept = now.schema.fields
    added = T.StructType.fromDDL("sequence_id long, offset long, certified boolean").fields
    schema = T.StructType([*kept, *added, T.StructField(settled_name, T.BooleanType())])
    for turn in range(rounds):
        n = now.count()
        if done is not None and n == 0:
            break
        parts = max(1, -(-n // partition_pieces))
        last = turn == rounds - 1

        dealt = now.withColumn(part, F.floor(F.col(deal) * parts).cast("long"))
        packed = store(dealt.groupBy(part).applyInArrow(_packer(turn, last, capacity, part, settled_name), schema), "packed")
        settled = packed.where(F.col(settled_name)).drop(settled_name, deal)
        done = settled if done is None else done.unionByName(settled)
        # A new deal, so that pieces meet others than before.
        again = packed.where(~F.col(settled_name)).select(*columns, F.rand(8 + turn).alias(deal))
        now = store(again, "pieces") if not last else spark.createDataFrame([], again.schema)
    return done


def pack_documents(docs: DataFrame, vocabulary: str, pattern: str, capacity: int = CAPACITY) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    ``start`` counts the document's ids before the piece; ``ids_crc32`` is unsigned, over
    little-endian unsigned 32-bit ids; ``sequence_id`` is any number; pieces of a sequence lie
    one after the other from offset 0. NULL and empty texts are one piece, the end id. Rows
    that repeat, or lack ``doc_id``, are documents of their own. No rows give none. Other
    columns are ignored. ``certified`` tells whether the piece's partition met its lower bound.
    """
    return pack(cut(docs, vocabulary, pattern, capacity), capacity)
