"""Trailing calendar-window features and the direction target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schema import DAY, KEY, TIME
from .chunks import (
    CHUNK,
    CHUNK_DAYS,
    attach,
    by_time,
    chunk_index,
    close_chunks,
    is_open,
    open_chunks,
    previous,
)


def _trailing(df, lookback_days, time, chunk_days, columns):
    """Evaluate window columns inside chunks, opening them only if the caller has not."""
    if is_open(df):
        return df.withColumns(columns)
    opened = open_chunks(df, lookback_days, time, chunk_days)
    return close_chunks(opened.withColumns(columns))


def _running(value, rows, days, until, one=1):
    """Mean over ``[t - days, t - until]`` as a difference of two running sums.

    One pass over the rows, where a sliding frame is added up anew for each row. Only for
    exact ``value`` types: with doubles the difference would lose digits.
    """
    upto = rows.rangeBetween(W.unboundedPreceding, -until * DAY)
    older = rows.rangeBetween(W.unboundedPreceding, -days * DAY - 1)
    total = F.sum(value).over(upto) - F.coalesce(F.sum(value).over(older), F.lit(0))
    count = F.count(value).over(upto) - F.count(value).over(older)
    return total.cast("double") / (F.nullif(count, F.lit(0)) * one)


#: Bits of the whole numbers that a double is cut into for exact sums: one number of whole
#: units and two of the bits below. Doubles from 2 ** -27 to 2 ** 40 fit without a rest.
LIMB_BITS = 40


def _exact_running(value, rows, days, until):
    """Mean of doubles over ``[t - days, t - until]`` from exact running sums.

    A double is cut into three whole numbers of at most ``LIMB_BITS`` bits, each summed as a
    running long; the difference of two running sums is exact, and only the frame's sum is
    rounded, once, as if all digits had been added up.
    """
    step = F.lit(float(1 << LIMB_BITS))
    whole = F.floor(value)
    rest = (value - whole.cast("double")) * step
    high = F.floor(rest)
    rest = (rest - high.cast("double")) * step
    low = F.floor(rest)
    fits = (F.abs(value) < step) & (rest == low.cast("double"))
    message = F.concat(F.lit("a value has no exact sum: "), value.cast("string"))
    whole = F.when(value.isNull() | fits, whole).otherwise(F.raise_error(message).cast("long"))

    upto = rows.rangeBetween(W.unboundedPreceding, -until * DAY)
    older = rows.rangeBetween(W.unboundedPreceding, -days * DAY - 1)

    def between(limb):
        sums = (F.coalesce(F.sum(limb).over(frame), F.lit(0).cast("long")) for frame in (upto, older))
        return next(sums) - next(sums)

    # Carried upwards, so that both lower numbers are below 2 ** LIMB_BITS again.
    mask = F.lit((1 << LIMB_BITS) - 1)
    lows, highs, wholes = between(low), between(high), between(whole)
    highs = highs + F.shiftright(lows, LIMB_BITS)
    wholes = wholes + F.shiftright(highs, LIMB_BITS)
    lows, highs = lows.bitwiseAND(mask), highs.bitwiseAND(mask)
    # All bits in one decimal where they fit; beyond, the lowest only tell that there is a rest.
    wide = "decimal(38,0)"
    power = lambda n: F.lit(1 << n).cast("decimal(20,0)")
    at = lambda c, n: (c.cast("decimal(20,0)") * power(n)).cast(wide)
    upper = at(wholes, LIMB_BITS) + highs.cast("decimal(20,0)")
    small = (upper.cast("decimal(24,0)") * F.lit(1 << LIMB_BITS).cast("decimal(14,0)")).cast(wide)
    small = small + lows.cast("decimal(20,0)")
    large = (upper * F.lit(4).cast("decimal(1,0)")).cast(wide) + F.when(lows > 0, 1).otherwise(0).cast("decimal(1,0)")
    total = F.when(
        F.abs(wholes) < (1 << 15), small.cast("double") * F.lit(2.0 ** (-2 * LIMB_BITS))
    ).otherwise(large.cast("double") * F.lit(2.0 ** (-LIMB_BITS - 2)))
    count = F.count(value).over(upto) - F.count(value).over(older)
    return total / F.nullif(count, F.lit(0)).cast("double")


def _steps(col, units):
    """A price in whole steps of ``1 / units``; doubles are off by their last digits only."""
    exact = F.col(col) * units
    whole = F.round(exact)
    off = F.abs(exact - whole) > F.greatest(F.abs(whole), F.lit(1.0)) * 1e-9
    message = F.concat(F.lit(f"{col} is not in steps of 1/{units}: "), F.col(col).cast("string"))
    return F.when(off, F.raise_error(message).cast("long")).otherwise(whole.cast("long"))


def trailing_avg(
    df: DataFrame,
    col: str,
    days: int = 14,
    until: int = 0,
    out: str | None = None,
    units: int | None = None,
    exact: bool = False,
    key: str = KEY,
    time: str = TIME,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """Mean of ``col`` over ``[t - days, t - until]``, calendar days, both ends included.

    NULL where the frame is empty (possible only with ``until > 0``).

    ``units`` is for frames of many bars (intraday bars, long frames) with prices quoted
    in steps of ``1 / units`` (100 for cents): whole steps are summed, which is exact in
    any order, and a frame costs the same however many bars it holds. A price that is not a
    whole number of steps is an error.

    ``exact`` does the same for any doubles: the mean is the exact sum, rounded once, over the
    number of values, at a cost independent of the frame. Values of 2 ** 40 or more, values
    with bits below 2 ** -80, NaN and infinity are an error; a chunk may hold 2 ** 23 bars.
    """
    out = out or f"{col}_avg{days}"
    rows = by_time(key)
    if exact:
        value = _exact_running(F.col(col).cast("double"), rows, days, until)
    elif units is None:
        value = F.avg(col).over(rows.rangeBetween(-days * DAY, -until * DAY))
    else:
        value = _running(_steps(col, units), rows, days, until, units)
    return _trailing(df, days, time, max(chunk_days, 2 * days), {out: value})


def mean_deviation(
    df: DataFrame,
    col: str = "TP",
    mean: str = "DTP14",
    days: int = 14,
    until: int = 0,
    out: str = "MD14",
    running: bool = False,
    exact: bool = False,
    key: str = KEY,
    time: str = TIME,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """Trailing mean of ``|col - mean|``, each row measured against its own mean.

    ``running`` is for frames of many bars: deviations are summed as decimals of twelve
    places, at a cost that does not grow with the frame. ``exact`` as in ``trailing_avg``.
    """
    rows = by_time(key)
    deviation = F.abs(F.col(col) - F.col(mean))
    if exact:
        value = _exact_running(deviation.cast("double"), rows, days, until)
    elif running:
        value = _running(deviation.cast("decimal(28,12)"), rows, days, until)
    else:
        value = F.avg(deviation).over(rows.rangeBetween(-days * DAY, -until * DAY))
    return _trailing(df, days, time, max(chunk_days, 2 * days), {out: value})


def direction_target(
    df: DataFrame,
    out: str = "target",
    key: str = KEY,
    time: str = TIME,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """1 where Close rose against the previous bar, else 0 (first bar and ties: 0)."""
    index = chunk_index(df, last=["Close"], key=key, time=time, chunk_days=chunk_days)
    rows = attach(open_chunks(df, 0, time, chunk_days), index, ["Close"], key)
    rose = previous("Close") < F.col("Close")
    return rows.withColumn(out, F.when(rose, 1).otherwise(0)).select(*df.columns, out)


def relative_volume(
    df: DataFrame,
    train_only: bool = False,
    out: str = "Volume",
    key: str = KEY,
    time: str = TIME,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """Volume over the symbol's mean Volume (of its train rows only, on request)."""
    volume = F.when(F.col("is_train"), F.col("Volume")) if train_only else F.col("Volume")
    index = chunk_index(
        df, totals={"volume": volume}, key=key, time=time, chunk_days=chunk_days
    )
    rows = open_chunks(df, 0, time, chunk_days).join(index, [key, CHUNK])
    mean = F.col("_sum_volume") / F.nullif(F.col("_count_volume"), F.lit(0))
    rows = rows.withColumn(out, F.col("Volume") / F.nullif(mean, F.lit(0.0)))
    return rows.select(*df.columns, *([] if out in df.columns else [out]))
