"""Rows packed into blocks, so that a model meets a symbol's rows once a block and not once a row.

A block is one row of a table: symbol, block number, and a list of about ``BLOCK_ROWS`` rows,
dealt by a hash. A symbol of any size is as many blocks, which lie in any task; a model (one row
per symbol) is joined to blocks, and tasks work through them batch by batch. So memory is bounded
by a batch of blocks, and nothing is grouped by symbol alone.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.chunks import join_symbols

# The functions below travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 512


def pack(
    rows: DataFrame, columns: list[Column], spread: list[str], key: str, size: int = BLOCK_ROWS
) -> DataFrame:
    """``key, _block, _rows``: the ``columns`` of each row as a struct in its block's list.

    ``rows`` is read twice, so give it a stored table. Blocks are small in bytes but long in
    compute: a number of tasks that follows theirs keeps AQE from merging them into a few.
    """
    counts = rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / size).alias("_blocks"))
    total = counts.agg(F.sum("_blocks")).first()[0] or 1
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(total, max(2 * cores, total // 64)))
    dealt = join_symbols(rows, counts, [key], spread)
    block = F.pmod(F.xxhash64(F.lit("block"), *spread), F.col("_blocks")).alias("_block")
    placed = dealt.select(key, block, F.struct(*columns).alias("_row")).repartition(tasks, key, "_block")
    return placed.groupBy(key, "_block").agg(F.collect_list("_row").alias("_rows"))


def meet(blocks: DataFrame, models: DataFrame, key: str) -> DataFrame:
    """Every block with its symbol's row of ``models``; blocks of symbols without one are left out."""
    return join_symbols(blocks, models, [key], ["_block"])


def lists(column: pa.Array) -> Iterator[pa.Array]:
    """The items of each row of a list column; NULL has none."""
    for i in range(len(column)):
        yield column.slice(i, 1).flatten()


def numbers(values: pa.Array, width: int, what: str) -> np.ndarray:
    """A list column as a matrix of doubles; NULL, NaN or a missing item is an error."""
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(flat) != len(values) * width or np.isnan(flat).any():
        raise ValueError(f"{what} has NULL or NaN")
    return flat.reshape(-1, width)
