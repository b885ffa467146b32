"""Calendar chunks: how one symbol's history is spread over many tasks.

A window over ``partitionBy('Stock')`` puts a symbol's whole history in one
task, so one dominant symbol sets the run time. Here the unit of work is
``(Stock, chunk)``, a fixed span of calendar time. A trailing frame may reach
back past the start of its chunk, so every row is also copied to the later
chunks that can still see it (its *lookback* copies); the copies are dropped once
the windows are computed. Frames hold the same rows in the same order as without
chunks, so results are identical.

What has no bounded lookback (the previous bar, the row number, a whole-history
mean) comes from ``chunk_index``: one aggregated row per ``(Stock, chunk)``,
combined along the few chunks of a symbol and joined back on both columns.

Bars must have a non-null ``Date``, unique per ``(Stock, Date)`` and not finer
than a second, so a chunk holds at most its width in seconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schema import DAY, KEY, TIME, epoch_seconds

CHUNK_DAYS = 1024
CHUNK, HOME, SEC, POS = "_chunk", "_home", "_sec", "_pos"
# Join keys that the rows of one symbol are spread over.
SALT, SALTS = "_salt", 32


def chunk_of(seconds: Column, chunk_days: int) -> Column:
    return F.floor(seconds / F.lit(chunk_days * DAY)).cast("long")


def open_chunks(
    df: DataFrame, lookback_days: int = 0, time: str = TIME, chunk_days: int = CHUNK_DAYS
) -> DataFrame:
    """Add ``_sec``, ``_home`` and ``_chunk``, with the lookback copies of each row."""
    sec = epoch_seconds(time)
    df = df.withColumns({SEC: sec, HOME: chunk_of(sec, chunk_days)})
    if lookback_days == 0:
        return df.withColumn(CHUNK, F.col(HOME))
    last_seen = chunk_of(F.col(SEC) + lookback_days * DAY, chunk_days)
    return df.withColumn(CHUNK, F.explode(F.sequence(F.col(HOME), last_seen)))


def is_open(df: DataFrame) -> bool:
    return CHUNK in df.columns


def home_rows(df: DataFrame) -> DataFrame:
    """Drop the lookback copies; the chunk columns stay."""
    return df.filter(F.col(HOME) == F.col(CHUNK))


def close_chunks(df: DataFrame) -> DataFrame:
    return home_rows(df).drop(CHUNK, HOME, SEC)


def by_time(key: str = KEY) -> W:
    """Rows of one chunk in time order."""
    return W.partitionBy(key, CHUNK).orderBy(SEC)


def chunk_index(
    df: DataFrame,
    last: list[str] | None = None,
    totals: dict[str, Column] | None = None,
    key: str = KEY,
    time: str = TIME,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """One row per ``(key, _chunk)``, built from partial aggregates.

    ``_rows_here`` / ``_rows_before`` / ``_rows_total``: rows of the symbol in this chunk, in
    earlier ones, in all.
    ``_prev_<col>``: each ``last`` column at the nearest earlier bar outside the chunk.
    ``_last_sec``: the time of the symbol's last bar.
    ``_sum_<name>`` / ``_count_<name>``: over the symbol's whole history, per ``totals`` entry.

    A NULL symbol is an error: its rows would match no index row and be lost.
    """
    last, totals = last or [], totals or {}
    sec = epoch_seconds(time)
    aggs = [F.count(F.lit(1)).alias("_rows"), F.max(sec).alias("_end")]
    # One max_by per column: a struct buffer would turn the hash aggregate into a sort.
    aggs += [F.max_by(c, sec).alias(f"_l_{c}") for c in last]
    for name, value in totals.items():
        aggs += [F.sum(value).alias(f"_s_{name}"), F.count(value).alias(f"_c_{name}")]
    per_chunk = df.groupBy(key, chunk_of(sec, chunk_days).alias(CHUNK)).agg(*aggs)

    whole = W.partitionBy(key)
    ordered = whole.orderBy(CHUNK)
    before = ordered.rowsBetween(W.unboundedPreceding, -1)
    missing = F.raise_error(F.lit(f"a row has no {key}")).cast(df.schema[key].dataType)
    out = [
        F.coalesce(F.col(key), missing).alias(key),
        CHUNK,
        F.max("_end").over(whole).alias("_last_sec"),
        F.col("_rows").alias("_rows_here"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
        F.sum("_rows").over(whole).alias("_rows_total"),
    ]
    out += [F.lag(f"_l_{c}").over(ordered).alias(f"_prev_{c}") for c in last]
    for name in totals:
        out.append(F.sum(f"_s_{name}").over(whole).alias(f"_sum_{name}"))
        out.append(F.sum(f"_c_{name}").over(whole).alias(f"_count_{name}"))
    return per_chunk.select(*out)


def join_symbols(
    rows: DataFrame, per_symbol: DataFrame, on: list[str], spread: list[str], how: str = "inner"
) -> DataFrame:
    """Join a table with one row per symbol (``on``) to raw rows.

    The rows of a symbol are spread over ``SALTS`` keys by a hash of the ``spread`` columns and
    the symbol's one row is repeated for each, so beyond the broadcast threshold no shuffle
    gathers a symbol in one task. Rows without a symbol are a group of their own: NULL meets NULL.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = rows.withColumn(SALT, F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"))
    theirs = [f"_of_{c}" for c in [*on, SALT]]
    one_row = per_symbol.withColumn(SALT, salts).withColumnsRenamed(dict(zip([*on, SALT], theirs)))
    same = [F.col(c).eqNullSafe(F.col(t)) for c, t in zip([*on, SALT], theirs)]
    joined = salted.join(one_row, same, how).drop(SALT, *theirs)
    rest = [c for c in joined.columns if c not in on]
    return joined.select(*on, *rest)


def attach(
    df: DataFrame, index: DataFrame, lagged: list[str] | None = None, key: str = KEY
) -> DataFrame:
    """Join the index to home rows; the last step, so call it after the chunk's windows.

    Positions inside the chunk (``_pos``) and the ``lagged`` columns are taken before the
    join, while the rows still lie in time order. No broadcast hint: Spark broadcasts the
    index when its size is under the session's threshold and otherwise merges on
    ``(key, _chunk)``, for which the rows are already partitioned and sorted.
    """
    rows = by_time(key)
    columns = {POS: F.row_number().over(rows)}
    columns |= {f"_lag_{c}": F.lag(c).over(rows) for c in lagged or []}
    return df.withColumns(columns).join(index, [key, CHUNK])


def previous(col: str) -> Column:
    """The value of the preceding bar, for a ``lagged`` column that is in the index too."""
    return F.when(F.col(POS) == 1, F.col(f"_prev_{col}")).otherwise(F.col(f"_lag_{col}"))


def row_number() -> Column:
    """Position in the symbol's whole history, for rows with an attached index."""
    return F.col(POS) + F.col("_rows_before")
