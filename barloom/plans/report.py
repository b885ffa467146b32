"""Prediction tables, model comparison and symbol suggestions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.chunks import CHUNK_DAYS, attach, chunk_index, join_symbols, open_chunks, previous
from ..schema import DAY, KEY, TIME

HIGHER_IS_BETTER = ["auc", "accuracy"]


def predictions(
    df: DataFrame,
    model: str,
    actual: str = "label",
    predicted: str = "prediction",
    key: str = KEY,
    time: str = TIME,
) -> DataFrame:
    """``model, Stock, Date, actual, predicted``: the date travels with its row."""
    return df.select(
        F.lit(model).alias("model"),
        key,
        time,
        F.col(actual).cast("double").alias("actual"),
        F.col(predicted).cast("double").alias("predicted"),
    )


def naive_predictions(
    features: DataFrame, columns: list[str] | None = None, key: str = KEY, time: str = TIME
) -> DataFrame:
    """Test rows predicted by their own features: the yardstick for a fitted model.

    One model per column, all from one pass over the features.
    """
    cells = [
        F.struct(F.lit(f"naive_{c}").alias("model"), F.col(c).alias("prediction"))
        for c in columns or ["SMA"]
    ]
    rows = features.filter(~F.col("is_train"))
    rows = rows.select(key, time, "label", F.explode(F.array(*cells)).alias("_cell"))
    return rows.select(
        "_cell.model",
        key,
        time,
        F.col("label").alias("actual"),
        F.col("_cell.prediction").alias("predicted"),
    )


def describe(preds: DataFrame, dim: DataFrame, key: str = KEY) -> DataFrame:
    """Add the symbol's ``description``; symbols without one keep a NULL.

    No broadcast hint: Spark broadcasts the dimension only under its size threshold.
    """
    names = dim.groupBy(key).agg(F.max("description").alias("description"))
    return join_symbols(preds, names, [key], preds.columns, "left")


def metric_report(metrics: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Tab-separated metrics with a header; one file, since it is one row per symbol."""
    ordered = metrics.orderBy("model", "metric", KEY).coalesce(1)
    ordered.write.mode(mode).csv(path, sep="\t", header=True)


def leaderboard(metrics: DataFrame, key: str = KEY) -> DataFrame:
    """Rank of each model per symbol and metric, best first; equal values share a rank."""
    better_first = F.when(F.col("metric").isin(HIGHER_IS_BETTER), -F.col("value")).otherwise(
        F.col("value")
    )
    order = W.partitionBy(key, "metric").orderBy(better_first.asc_nulls_last())
    return metrics.withColumn("rank", F.rank().over(order))


def suggest(
    preds: DataFrame,
    n_days: int = 30,
    k: int = 10,
    key: str = KEY,
    time: str = TIME,
    chunk_days: int = CHUNK_DAYS,
) -> DataFrame:
    """The ``k`` symbols with the highest mean predicted return, per model.

    Over each symbol's last ``n_days`` calendar days, a row's predicted return is
    ``predicted / previous actual - 1``; the previous actual may lie before the span. Rows are
    ordered within chunks of time, as everywhere, never by symbol alone.
    """
    pair = "_pair"
    rows = preds.withColumn(pair, F.struct("model", key))
    index = chunk_index(rows, last=["actual"], key=pair, time=time, chunk_days=chunk_days)
    rows = attach(open_chunks(rows, 0, time, chunk_days), index, ["actual"], pair)
    gain = F.col("predicted") / F.nullif(previous("actual"), F.lit(0.0)) - 1
    recent = F.col("_sec") > F.col("_last_sec") - n_days * DAY
    means = (
        rows.select("model", key, gain.alias("_return"), recent.alias("_recent"))
        .filter("_recent")
        .groupBy("model", key)
        .agg(F.avg("_return").alias("mean_return"), F.count("_return").alias("n_rows"))
        .filter(F.col("mean_return").isNotNull())
    )
    best = F.row_number().over(W.partitionBy("model").orderBy(F.desc("mean_return"), key))
    return means.withColumn("rank", best).filter(F.col("rank") <= k)
