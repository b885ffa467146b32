"""Row cleaning, symbol filters and the roll-up of raw priced rows to bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import KEY, TIME, TOP_SYMBOLS


def newest_per_key(df: DataFrame, key: str, time: str, order_by: list[str]) -> DataFrame:
    """One row per ``(key, time)``: the greatest by ``order_by``, then by all other columns.

    An aggregate rather than a ranked window, so copies collapse before the shuffle.
    """
    rest = [c for c in df.columns if c not in (key, time, *order_by)]
    best = F.max(F.struct(*order_by, *rest)).alias("_best")
    kept = df.groupBy(key, time).agg(best)
    return kept.select(key, time, "_best.*").select(*df.columns)


def clean(
    df: DataFrame,
    subset: list[str] | None = None,
    dedupe: str = "rows",
    order_by: list[str] | None = None,
    key: str = KEY,
    time: str = TIME,
) -> DataFrame:
    """Drop rows with a NULL or NaN, then duplicates of the row or of ``(key, time)``."""
    df = df.na.drop(how="any", subset=subset)
    if dedupe == "rows":
        return df.dropDuplicates()
    if dedupe == "key":
        return newest_per_key(df, key, time, order_by or [])
    raise ValueError(f"dedupe must be 'rows' or 'key', not {dedupe!r}")


def only_symbols(df: DataFrame, symbols: list[str] | None = None, key: str = KEY) -> DataFrame:
    return df.filter(F.col(key).isin(symbols if symbols is not None else TOP_SYMBOLS))


def to_bars(
    df: DataFrame, symbol: str, ts: str, price: str, order_key: str | list[str] | Column
) -> DataFrame:
    """Raw priced rows to bars; Open and Close are the ends by the unique ``order_key``.

    A list is compared left to right, for which Spark sorts the raw rows before it
    aggregates them; a single number, such as several ids packed in a decimal, is
    aggregated by hash.
    """
    order = F.struct(*order_key) if isinstance(order_key, list) else order_key
    return df.groupBy(F.col(symbol).alias(KEY), F.col(ts).alias(TIME)).agg(
        F.min_by(price, order).alias("Open"),
        F.max(price).alias("High"),
        F.min(price).alias("Low"),
        F.max_by(price, order).alias("Close"),
        F.count(F.lit(1)).cast("double").alias("Volume"),
    )
