"""Fixed-length row sequences, the input form of recurrent models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schema import KEY, TIME
from .chunks import CHUNK_DAYS, attach, chunk_index, open_chunks, row_number

BLOCK_ROWS = 4096


def sequence_features(
    df: DataFrame,
    cols: list[str],
    k: int = 1,
    out: str = "sequence",
    key: str = KEY,
    time: str = TIME,
    chunk_days: int = CHUNK_DAYS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The last ``k`` rows of ``cols``, oldest first; shorter at the start of a symbol.

    The frame counts rows, so the unit of work is a block of consecutive row
    numbers, with the ``k - 1`` rows before it copied in.
    """
    if k == 1:
        return df.withColumn(out, F.array(F.struct(*cols)))
    index = chunk_index(df, key=key, time=time, chunk_days=chunk_days)
    rows = attach(open_chunks(df, 0, time, chunk_days), index, key=key)
    rows = rows.select(*df.columns, (row_number() - 1).alias("_at"))

    width = max(block_rows, 2 * k)
    last_seen = F.floor((F.col("_at") + (k - 1)) / width)
    rows = rows.withColumn("_own", F.floor(F.col("_at") / width))
    rows = rows.withColumn("_block", F.explode(F.sequence("_own", last_seen)))
    frame = W.partitionBy(key, "_block").orderBy("_at").rowsBetween(-(k - 1), 0)
    rows = rows.withColumn(out, F.collect_list(F.struct(*cols)).over(frame))
    return rows.filter(F.col("_own") == F.col("_block")).select(*df.columns, out)
