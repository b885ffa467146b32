"""One Spark ML model per symbol, several symbols fitted at once.

Each fit is itself a set of distributed Spark jobs over that symbol's rows, so a
dominant symbol is not confined to one task; a thread pool keeps the cluster busy
with several symbols. Give it a table from ``staged(df, 'Stock')``: a fit then
reads only its symbol's files instead of replaying the feature plan.
"""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import NamedTuple
from urllib.parse import quote

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.regression import FMRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.report import predictions
from ..schema import KEY, TIME

# Forests draw their samples per partition: a fixed number, dealt by hash, keeps the trees the
# same on any layout and at any size.
PARTITIONS = 4
SCALED_LABEL, SCALED_PREDICTION = "label_z", "prediction_z"


class Fitted(NamedTuple):
    models: dict[str, PipelineModel]
    skipped: dict[str, str]  # symbol -> reason


def forest(
    features: list[str], label: str = "label", trees: int = 100, depth: int = 5, seed: int = 42
) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="features", handleInvalid="error"),
            RandomForestRegressor(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed),
        ]
    )


def factorization(features: list[str], step_size: float = 0.001, seed: int = 42) -> Pipeline:
    """Factorization machine on standardised features; fit it with ``scale_label=True``.

    Raw prices and years are too unlike for one gradient step, so inputs and label are
    brought to unit scale by the train rows and the prediction is scaled back. The
    default step suits prices in the tens; on unit scale ten to thirty times it fits better.
    """
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="raw", handleInvalid="error"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
            FMRegressor(
                labelCol=SCALED_LABEL,
                predictionCol=SCALED_PREDICTION,
                stepSize=step_size,
                seed=seed,
            ),
        ]
    )


def fit_per_symbol(
    df: DataFrame,
    estimator: Estimator,
    label: str = "label",
    symbols: list[str] | None = None,
    parallelism: int = 8,
    scale_label: bool = False,
    min_rows: int = 2,
    partitions: int = PARTITIONS,
    key: str = KEY,
    time: str = TIME,
) -> Fitted:
    """Fit ``estimator`` on the ``is_train`` rows of each symbol (of all, by default).

    Rows of a symbol are dealt over ``partitions`` tasks by a hash of their time: give more
    for symbols of very many rows. The models do not depend on files or on the other symbols.
    """
    sizes = df.groupBy(key).agg(
        F.count(F.when(F.col("is_train"), 1)).alias("n"),
        F.avg(F.when(F.col("is_train"), F.col(label))).alias("mean"),
        F.stddev_pop(F.when(F.col("is_train"), F.col(label))).alias("sd"),
    )
    stats = {row[key]: row for row in sizes.collect()}  # one row per symbol
    wanted = list(stats) if symbols is None else symbols
    skipped = {}
    for symbol in wanted:
        n = stats[symbol]["n"] if symbol in stats else 0
        if n < min_rows:
            skipped[symbol] = f"{n} train rows, {min_rows} needed"

    def fit(symbol: str):
        row = stats[symbol]
        train = df.filter((F.col(key) == symbol) & F.col("is_train"))
        train = train.repartition(partitions, F.xxhash64(time)).sortWithinPartitions(time)
        mean, sd = float(row["mean"]), float(row["sd"]) or 1.0
        if scale_label:
            train = train.withColumn(SCALED_LABEL, (F.col(label) - mean) / sd)
        model = estimator.fit(train)
        if scale_label:
            back = SQLTransformer(
                statement=f"SELECT *, {SCALED_PREDICTION} * {sd!r}D + {mean!r}D AS prediction "
                "FROM __THIS__"
            )
            model = PipelineModel([*model.stages, back])
        return symbol, model

    todo = sorted(s for s in wanted if s not in skipped)
    if not todo:
        return Fitted({}, skipped)
    return Fitted(dict(_in_threads(df.sparkSession, fit, todo, parallelism)), skipped)


def _in_threads(spark: SparkSession, task, items: list, parallelism: int) -> list:
    """Submit Spark jobs for several symbols at once."""
    pool = ThreadPool(min(parallelism, len(items)))
    try:
        return pool.map(inheritable_thread_target(spark)(task), items, chunksize=1)
    finally:
        pool.close()


def score_per_symbol(
    models: dict[str, PipelineModel],
    df: DataFrame,
    name: str,
    label: str = "label",
    key: str = KEY,
    time: str = TIME,
) -> DataFrame:
    """Prediction table of the test rows (``is_train`` false) of every fitted symbol.

    One plan branch per symbol, so for a short list; ``write_scores`` has no such limit.
    """
    parts = [
        _score(model, df, name, label, symbol, key, time)
        for symbol, model in sorted(models.items())
    ]
    if not parts:
        return _no_scores(df, key, time)
    return reduce(DataFrame.unionByName, parts)


def _no_scores(df: DataFrame, key: str, time: str) -> DataFrame:
    """An empty prediction table."""
    empty = df.limit(0).withColumns({"_a": F.lit(0.0), "_p": F.lit(0.0)})
    return predictions(empty, "none", "_a", "_p", key=key, time=time)


def _score(model, df, name, label, symbol, key, time) -> DataFrame:
    test = df.filter((F.col(key) == symbol) & ~F.col("is_train"))
    return predictions(model.transform(test), name, label, key=key, time=time)


def write_scores(
    models: dict[str, PipelineModel],
    df: DataFrame,
    name: str,
    path: str,
    label: str = "label",
    parallelism: int = 8,
    key: str = KEY,
    time: str = TIME,
) -> DataFrame:
    """The same table, written below ``path`` as one folder per symbol, and read back.

    A run replaces the folders of its own symbols and reads no others.
    """
    spark = df.sparkSession
    if not models:
        return _no_scores(df, key, time)

    def write(symbol: str) -> str:
        scored = _score(models[symbol], df, name, label, symbol, key, time).drop(key)
        folder = f"{path}/{key}={quote(symbol, safe='')}"
        scored.write.mode("overwrite").parquet(folder)
        return folder

    folders = _in_threads(spark, write, sorted(models), parallelism)
    schema = _score(next(iter(models.values())), df, name, label, "", key, time).schema
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*folders).select(*schema.names)


def _folder(path: str, symbol: str) -> str:
    return f"{path}/models/{quote(symbol, safe='')}"


def save_models(
    models: dict[str, PipelineModel], spark: SparkSession, path: str, parallelism: int = 8
) -> None:
    """Write every model below ``path``, replacing earlier ones, and the list of symbols."""

    def save(symbol: str) -> None:
        models[symbol].write().overwrite().save(_folder(path, symbol))

    if models:
        _in_threads(spark, save, sorted(models), parallelism)
    names = spark.createDataFrame([(s,) for s in sorted(models)], f"{KEY} string")
    names.coalesce(1).write.mode("overwrite").parquet(f"{path}/symbols")


def load_models(
    spark: SparkSession, path: str, parallelism: int = 8
) -> dict[str, PipelineModel]:
    names = sorted(row[KEY] for row in spark.read.parquet(f"{path}/symbols").collect())
    if not names:
        return {}
    return dict(
        _in_threads(spark, lambda s: (s, PipelineModel.load(_folder(path, s))), names, parallelism)
    )
