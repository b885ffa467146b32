"""The two feature tables, each planned so that the bars are shuffled once."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import date_parts, spreads, typical_price
from ..operators.chunks import (
    CHUNK_DAYS,
    attach,
    chunk_index,
    home_rows,
    open_chunks,
    previous,
    row_number,
)
from ..operators.split import time_split, train_rows
from ..operators.trailing import mean_deviation, trailing_avg
from ..schema import KEY, TIME

# The model inputs, in order.
PRICE_FEATURES = [
    "Open", "High", "Low", "Volume", "Day", "Month", "Year", "SMA", "TP", "DTP14", "MD14",
]
DIRECTION_FEATURES = [
    "Open", "High", "Low", "Volume", "diffOpenClose", "diffHighLow", "Year", "Month", "Day",
]
FRAME_DAYS = 14


def price_features(
    bars: DataFrame,
    mode: str = "same_day",
    train: float = 0.7,
    days: int = FRAME_DAYS,
    units: int | None = None,
    train_only_volume: bool = False,
    key: str = KEY,
    time: str = TIME,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """``Stock, Date, <PRICE_FEATURES>, label, rn, is_train`` for cleaned bars.

    ``same_day``: features of the day whose close is the label (High, Low and TP
    together give that close away, so errors are not forecast errors).
    ``next_day``: only what was known the day before. Prices, TP and volume are the
    previous bar's and frames end a day earlier; bars without a full set are left out.
    The train flag counts all bars in both modes. Volume is relative to the symbol's mean,
    over all its bars or, with ``train_only_volume``, over those it trains on.
    ``units`` as in ``trailing_avg``: give it for intraday bars, whose frames are long.
    """
    if mode not in ("same_day", "next_day"):
        raise ValueError(f"mode must be 'same_day' or 'next_day', not {mode!r}")
    until = 0 if mode == "same_day" else 1
    lagged = ["Open", "High", "Low", "Volume", "TP"]
    at = {"key": key, "time": time, "chunk_days": chunk_days}

    rows = date_parts(typical_price(bars), time)
    counted, volume = rows, F.col("Volume")
    if train_only_volume:
        counted, volume = time_split(rows, train, **at), F.when(F.col("is_train"), volume)
    index = chunk_index(
        counted, last=lagged if until else None, totals={"volume": volume}, **at
    )
    # MD14 averages deviations that are themselves trailing: two frames of lookback.
    rows = open_chunks(rows, 2 * days, time, chunk_days)
    thirds = 3 * units if units else None  # TP is a third of a sum of prices
    rows = trailing_avg(rows, "Close", days, until, out="SMA", units=units, **at)
    rows = trailing_avg(rows, "TP", days, until, out="DTP14", units=thirds, **at)
    running = units is not None
    rows = mean_deviation(rows, "TP", "DTP14", days, until, out="MD14", running=running, **at)

    rows = attach(home_rows(rows), index, lagged if until else None, key)
    rows = rows.withColumn("rn", row_number())
    if until:
        rows = rows.withColumns({c: previous(c) for c in lagged})
    mean_volume = F.col("_sum_volume") / F.nullif(F.col("_count_volume"), F.lit(0))
    rows = rows.withColumns(
        {
            "Volume": F.col("Volume") / F.nullif(mean_volume, F.lit(0.0)),
            "label": F.col("Close"),
            "is_train": F.col("rn") <= train_rows(F.col("_rows_total"), train),
        }
    )
    rows = rows.select(key, time, *PRICE_FEATURES, "label", "rn", "is_train")
    return rows.na.drop(subset=["SMA", "TP"] if not until else PRICE_FEATURES)


def direction_features(
    bars: DataFrame,
    train: float = 0.7,
    key: str = KEY,
    time: str = TIME,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """``Stock, Date, <DIRECTION_FEATURES>, Close, target, rn, is_train`` for cleaned bars."""
    rows = date_parts(spreads(bars), time)
    index = chunk_index(rows, last=["Close"], key=key, time=time, chunk_days=chunk_days)
    rows = attach(open_chunks(rows, 0, time, chunk_days), index, ["Close"], key)
    rows = rows.withColumns(
        {
            "target": F.when(previous("Close") < F.col("Close"), 1).otherwise(0),
            "rn": row_number(),
        }
    )
    rows = rows.withColumn("is_train", F.col("rn") <= train_rows(F.col("_rows_total"), train))
    return rows.select(
        key, time, *DIRECTION_FEATURES, "Close", "target", "rn", "is_train"
    )


def assemble(df: DataFrame, features: list[str], out: str = "features") -> DataFrame:
    """Vector column for Spark ML; a NULL or NaN input is an error."""
    return VectorAssembler(inputCols=features, outputCol=out, handleInvalid="error").transform(df)
