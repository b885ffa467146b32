"""Bars as records keyed by ``(Stock, Date)``: put and get."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clean import newest_per_key
from ..schema import KEY, TIME, staged

#: Symbols of one put that are named to the reader; beyond that they are found by a join.
LISTED = 1_000


def upsert_bars(
    base: DataFrame, delta: DataFrame, batch: str = "batch", key: str = KEY, time: str = TIME
) -> DataFrame:
    """``base`` with every row of ``delta`` put by key; within ``delta`` the last ``batch`` wins.

    ``base`` is unique per key and only filtered against the keys of ``delta``: while
    those are under the session's broadcast threshold it is not shuffled at all.
    """
    newest = newest_per_key(delta, key, time, [batch]).select(*base.columns)
    kept = base.join(newest.select(key, time), [key, time], "left_anti")
    return kept.select(*base.columns).unionByName(newest)


def put_bars(
    delta: DataFrame, path: str, batch: str = "batch", key: str = KEY, time: str = TIME
) -> None:
    """Put ``delta`` by key into the table that ``write_bars`` left at ``path``, in place.

    Only the folders of symbols that ``delta`` holds are read and written anew (dynamic partition
    overwrite); all other files stay as they are. Within ``delta`` the last ``batch`` wins, and it
    is computed once. A table that is not there yet is created. Rows without a symbol or date are
    an error. Readers see whole folders change, so let one put run at a time.
    """
    spark = delta.sparkSession
    missing = F.raise_error(F.lit(f"a row has no {key} or {time}")).cast("boolean")
    whole = F.when(F.col(key).isNull() | F.col(time).isNull(), missing).otherwise(F.lit(True))
    newest = staged(newest_per_key(delta.filter(whole), key, time, [batch]).drop(batch))
    touched = [r[key] for r in newest.select(key).distinct().limit(LISTED + 1).collect()]
    try:
        base = spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        base = spark.createDataFrame([], newest.schema)
    if len(touched) <= LISTED:
        old = base.filter(F.col(key).cast("string").isin(touched))  # other folders are not listed
    else:
        old = base.join(newest.select(key).distinct(), key, "left_semi")
    old = old.withColumn(key, F.col(key).cast(newest.schema[key].dataType)).select(*newest.columns)
    merged = old.join(newest.select(key, time), [key, time], "left_anti").unionByName(newest)
    placed = merged.repartitionByRange(key, time).sortWithinPartitions(key, time)
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(key).parquet(path)


def lookup(
    df: DataFrame, stock: str, start=None, end=None, key: str = KEY, time: str = TIME
) -> DataFrame:
    """Rows of one symbol, dates from ``start`` to ``end`` inclusive.

    Plain comparisons, so on a table partitioned by symbol only its folder is
    listed and the dates reach the file reader.
    """
    df = df.filter(F.col(key) == stock)
    if start is not None:
        df = df.filter(F.col(time) >= F.lit(start).cast(df.schema[time].dataType))
    if end is not None:
        df = df.filter(F.col(time) <= F.lit(end).cast(df.schema[time].dataType))
    return df
