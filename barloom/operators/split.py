"""Train/test splits, sampling, set difference."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import hash_unit
from ..schema import KEY, TIME
from .chunks import CHUNK_DAYS, attach, chunk_index, join_symbols, open_chunks, row_number


def train_rows(total, train: float):
    """``floor(train * total)`` in double arithmetic: 0.7 of 90 rows is 62."""
    return F.floor(F.lit(float(train)) * total)


def time_split(
    df: DataFrame,
    train: float = 0.7,
    key: str = KEY,
    time: str = TIME,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """Flag the oldest ``train`` share of each symbol's bars; adds ``rn`` and ``is_train``."""
    index = chunk_index(df, key=key, time=time, chunk_days=chunk_days)
    rows = attach(open_chunks(df, 0, time, chunk_days), index, key=key)
    rows = rows.withColumn("rn", row_number())
    rows = rows.withColumn(
        "is_train", F.col("rn") <= train_rows(F.col("_rows_total"), train)
    )
    return rows.select(*df.columns, "rn", "is_train")


def time_split_by_date(
    df: DataFrame,
    train: float = 0.7,
    key: str = KEY,
    time: str = TIME,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """The flag of ``time_split`` without row numbers, and without ordering the rows.

    The last train date of a symbol lies in the one chunk where the running count passes
    the train share, so only the dates of that chunk are ranked. The table itself is
    compared with one date per symbol, which Spark broadcasts while it is small.
    """
    index = chunk_index(df, key=key, time=time, chunk_days=chunk_days)
    n_train = train_rows(F.col("_rows_total"), train)
    ends_here = (F.col("_rows_before") < n_train) & (
        n_train <= F.col("_rows_before") + F.col("_rows_here")
    )
    dates = open_chunks(df.select(key, time), 0, time, chunk_days)
    ranked = attach(dates, index.filter(ends_here), key=key)
    last = ranked.filter(row_number() == n_train).select(key, F.col(time).alias("_last_train"))
    rows = join_symbols(df, last, [key], [key, time], "left")
    is_train = F.coalesce(F.col(time) <= F.col("_last_train"), F.lit(False))
    return rows.withColumn("is_train", is_train).select(*df.columns, "is_train")


def hash_split(
    df: DataFrame, weights: list[float], seed: int = 42, key: str = KEY, time: str = TIME
) -> DataFrame:
    """Random split by weights as a column ``split`` = 0, 1, ...; needs no shuffle."""
    total = sum(weights)
    edges = [edge / total for edge in accumulate(weights)][:-1]
    unit = hash_unit(seed, key, time)
    split = F.lit(0)
    for edge in edges:
        split = split + (unit >= F.lit(edge)).cast("int")
    return df.withColumn("split", split)


def hash_sample(
    df: DataFrame, fraction: float, seed: int = 42, key: str = KEY, time: str = TIME
) -> DataFrame:
    """Bernoulli sample of rows. Derive lagged columns before sampling, not after."""
    return df.filter(hash_unit(seed, key, time) < F.lit(float(fraction)))


def except_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b`` (set semantics, so not a splitter)."""
    return a.subtract(b)
