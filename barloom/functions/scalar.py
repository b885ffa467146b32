"""Row-wise columns. Everything is a built-in expression, so it stays in codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CSV_DATE_FORMAT, KEY, TIME, epoch_seconds


def parse_date(text: str, date_format: str = CSV_DATE_FORMAT) -> Column:
    """Text to timestamp; NULL, not an error, when it does not match."""
    return F.try_to_timestamp(F.col(text), F.lit(date_format))


def with_sec(df: DataFrame, time: str = TIME, out: str = "sec") -> DataFrame:
    return df.withColumn(out, epoch_seconds(time))


def date_parts(df: DataFrame, time: str = TIME) -> DataFrame:
    return df.withColumns(
        {"Year": F.year(time), "Month": F.month(time), "Day": F.dayofmonth(time)}
    )


def typical_price(df: DataFrame, out: str = "TP") -> DataFrame:
    return df.withColumn(out, (F.col("High") + F.col("Low") + F.col("Close")) / 3)


def spreads(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "diffOpenClose": F.col("Open") - F.col("Close"),
            "diffHighLow": F.col("High") - F.col("Low"),
        }
    )


def hash_unit(seed: int, key: str = KEY, time: str = TIME) -> Column:
    """A number in [0, 1) fixed by ``(key, time, seed)``.

    It depends on the row alone, never on the partition a row sits in, so a
    retried or re-planned task draws the same rows again.
    """
    text = F.concat_ws("|", F.col(key), epoch_seconds(time).cast("string"), F.lit(str(seed)))
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    return head / F.lit(float(2**32))
