"""Prediction errors per ``(model, symbol)``: tables ``(model, Stock, metric, value)``.

Predictions have columns ``model, Stock, Date, actual, predicted``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schema import KEY
from .chunks import join_symbols

GROUP = ["model", KEY]


def _metric(preds: DataFrame, name: str, value: Column) -> DataFrame:
    return (
        preds.groupBy(*GROUP)
        .agg(value.alias("value"))
        .select(*GROUP, F.lit(name).alias("metric"), "value")
    )


def _squared_error() -> Column:
    gap = F.col("predicted") - F.col("actual")
    return F.avg(gap * gap)


def mse(preds: DataFrame) -> DataFrame:
    return _metric(preds, "mse", _squared_error())


def rmse(preds: DataFrame) -> DataFrame:
    return _metric(preds, "rmse", F.sqrt(_squared_error()))


def accuracy(preds: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Share of rows where prediction and actual lie on the same side of ``threshold``."""
    same = (F.col("predicted") > threshold) == (F.col("actual") > threshold)
    return _metric(preds, "accuracy", F.avg(same.cast("int")))


def auc(preds: DataFrame, slices: int = 64) -> DataFrame:
    """Exact area under the ROC curve for 0/1 actuals; NULL when a class is absent.

    The rank-sum statistic needs, for each score, the negatives scored lower. Equal
    scores collapse to one row first; the distinct scores of a group are then cut into
    slices at approximate quantiles, counted inside each slice, and the slices of a
    group combined. The cut points only balance the work: any give the same result.
    """
    scores = preds.groupBy(*GROUP, F.col("predicted").alias("score")).agg(
        F.count(F.when(F.col("actual") == 1, 1)).alias("pos"),
        F.count(F.when(F.col("actual") == 0, 1)).alias("neg"),
        F.count(F.when(~F.col("actual").isin(0, 1), 1)).alias("other"),
    )
    quantiles = [i / slices for i in range(1, slices)]
    # The totals come along because both readers of ``scores`` then need the same
    # columns, and Spark computes and shuffles it once.
    groups = scores.groupBy(*GROUP).agg(
        F.percentile_approx("score", quantiles, 1000).alias("cuts"),
        F.sum("pos").alias("all_pos"),
        F.sum("neg").alias("all_neg"),
        F.sum("other").alias("all_other"),
    )
    score, wide = F.col("score"), "decimal(38,0)"
    sliced = join_symbols(scores, groups, GROUP, ["score"]).withColumn(
        "slice", F.size(F.filter("cuts", lambda cut: cut < score))
    )
    inside = W.partitionBy(*GROUP, "slice").orderBy("score")
    lower = F.coalesce(
        F.sum("neg").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    ).cast("decimal(18,0)")
    # Twice the pairs won, so that a tie's halves stay whole numbers.
    pairs = F.col("pos").cast("decimal(18,0)") * (2 * lower + F.col("neg"))
    sliced = sliced.withColumn("pairs", pairs.cast(wide))
    per_slice = sliced.groupBy(*GROUP, "slice").agg(
        F.sum("pairs").cast(wide).alias("pairs"),
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        *[F.max(c).alias(c) for c in ("all_pos", "all_neg", "all_other")],
    )
    earlier = W.partitionBy(*GROUP).orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("neg").over(earlier), F.lit(0)).cast("decimal(18,0)")
    across = (F.col("pos").cast("decimal(18,0)") * before * 2).cast(wide)
    won = per_slice.withColumn("pairs", F.col("pairs") + across).groupBy(*GROUP).agg(
        F.sum("pairs").cast("double").alias("pairs"),
        *[F.max(c).cast("double").alias(c) for c in ("all_pos", "all_neg", "all_other")],
    )
    # A label other than 0 or 1 makes the score meaningless, so there is none.
    both = F.nullif(2 * F.col("all_pos") * F.col("all_neg"), F.lit(0.0))
    area = F.when(F.col("all_other") == 0, F.col("pairs") / both)
    return won.select(*GROUP, F.lit("auc").alias("metric"), area.alias("value"))
