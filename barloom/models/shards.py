"""Gradient-trained models, one per symbol, all symbols in the same Spark job.

Every symbol's train rows are dealt by hash over the same number of shards, whatever its
size, and every symbol has the same schedule, so a model depends on its own rows only.

A net trains in rounds of ``sync_epochs``: each shard trains from the symbol's common state
and the states are averaged, weighted by rows, between rounds (local SGD; McMahan et al.,
2017). Every round deals the rows anew, by a hash that holds the round, so that no row stays
with the same others. Spark sorts a task's rows by symbol, shard and hash, a shard's state first;
the task works through them in blocks of at most ``BLOCK_ROWS`` rows, ``sync_epochs`` epochs each,
and carries the state from block to block. So its memory is a block, however many rows a symbol has,
and the only table between rounds is that of the states.

A factorization machine trains on all rows at once. Its squared error is a quadratic form in
the products of its inputs, so the sums of these products over the rows, added up by Spark in
one pass, hold all that training needs: the model is the same for any number of tasks, and
a step costs the same however many rows there are.

The optimiser is Adam (Kingma & Ba, 2015) on the squared error.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.chunks import join_symbols
from ..operators.sequence import sequence_features
from ..schema import KEY, TIME, cut_lineage, epoch_seconds, staged
from .blocks import lists, meet, numbers, pack
from .kernels import ADAM_DECAY, ADAM_EPS, FactorPairs, GatedCells, RecurrentCells, products, train_on_moments, views

# The functions below travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARDS = 4
SYNC_EPOCHS = 50
#: Rows that a task trains on at a time: its memory. A shard of fewer is one block.
BLOCK_ROWS = 8192
#: Rows that meet a symbol's parameters or scales at a time.
SCORE_ROWS = 2048
# Names under which the parameter table keeps means and deviations, the label's last.
SCALES = ("scale.mean", "scale.sd")


class ShardFit(NamedTuple):
    predictions: DataFrame  # Stock, Date, actual, predicted
    history: DataFrame  # Stock, epoch, loss, rmse, accuracy
    parameters: DataFrame  # Stock, name, shape, values


def train_shard(kernel, x, y, state, step, lr, batch, epochs, draw, cut):
    """Adam over shuffled batches (all rows at once if ``batch`` is None).

    ``state`` holds the parameters and the two moments. Returns the new state, the step
    count and, per epoch, the sum of squared errors and the number of outputs on the same
    side of ``cut`` as their target.
    """
    x, y, state = (np.array(a, kernel.dtype) for a in (x, y, state))
    rng = np.random.default_rng(draw)
    shapes = kernel.shapes(x.shape[1])
    theta, m, v = np.split(state, 3)
    grad = np.empty_like(theta)
    params, grads = views(theta, shapes), views(grad, shapes)
    b1, b2 = ADAM_DECAY
    above = y > cut
    squared, hits, outputs = [], [], np.empty_like(y)
    size = batch or len(y)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for first in range(0, len(y), size):
            rows = order[first : first + size]
            out, cache = kernel.forward(params, x[rows])
            outputs[rows] = out
            kernel.backward(params, cache, 2 * (out - y[rows]) / len(rows), grads)
            step += 1
            m *= b1
            m += (1 - b1) * grad
            grad *= grad
            grad *= 1 - b2
            v *= b2
            v += grad
            np.sqrt(v, out=grad)
            grad *= 1 / math.sqrt(1 - b2**step)
            grad += ADAM_EPS
            np.divide(m, grad, out=grad)
            grad *= lr / (1 - b1**step)
            theta -= grad
        squared.append(float(np.sum((outputs - y) ** 2, dtype="float64")))
        hits.append(int(np.sum((outputs > cut) == above)))
    return state, step, squared, hits


def fit_in_shards(
    df: DataFrame,
    features: list[str],
    label: str,
    kernel,
    lr: float,
    batch: int | None,
    epochs: int,
    seed: int = 42,
    threshold: float = 0.5,
    scale_label: bool = True,
    shards: int = SHARDS,
    sync_epochs: int = SYNC_EPOCHS,
    key: str = KEY,
    time: str = TIME,
) -> ShardFit:
    """Fit ``kernel`` per symbol on its ``is_train`` rows and predict the others.

    Features (and the label, with ``scale_label``) are standardised by the symbol's
    train rows; a symbol without any is left out. A kernel with ``steps`` sees each row with the
    rows before it (``sequence_features``), test rows too. ``history`` is per row, not per
    batch; its accuracy compares both sides of ``threshold`` in label units. A NULL or NaN
    feature is an error; train rows without a label are left out.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    scales = _scales(df, features, label, scale_label, key)
    symbols = max(1, scales.count())
    # Shards are small in bytes but long in compute: a fixed number of partitions keeps AQE
    # from merging them into few tasks. Several per core against collisions, but no more than
    # can be filled.
    tasks = max(1, min(4 * symbols * shards, max(4 * cores, symbols * shards // 64)))
    inputs = staged(_inputs(df, features, kernel, label, key, time))
    train = inputs.filter(F.col("is_train") & F.col("_y").isNotNull())
    n_inputs = _width(features, kernel)
    kinds = f"{key} string, _n long, _step long, _state array<double>, _loss array<double>, _hits array<long>"
    state, logs = scales.withColumns({"_state": F.lit(None).cast("array<double>"), "_step": F.lit(0)}), []
    for first in range(0, epochs, sync_epochs):
        n_epochs = min(sync_epochs, epochs - first)
        none = F.lit(None)
        rows = train.select(
            key,
            F.pmod(F.xxhash64(F.lit(first), key, "_sec"), F.lit(shards)).cast("int").alias("_shard"),
            F.lit(1).alias("_row"),
            F.xxhash64(F.lit(~first), key, "_sec").alias("_draw"),
            F.concat("_x", F.array("_y")).alias("_values"),
            none.cast("array<double>").alias("_scale"),
            none.cast("long").alias("_step"),
        )
        heads = _for_shards(state, shards).select(
            key,
            "_shard",
            F.lit(0).alias("_row"),
            none.cast("long").alias("_draw"),
            F.col("_state").alias("_values"),
            F.concat("_means", "_sds").alias("_scale"),
            F.col("_step").cast("long"),
        )
        stream = rows.unionByName(heads).repartition(tasks, key, "_shard")
        stream = stream.sortWithinPartitions(key, "_shard", "_row", "_draw")
        run = _train_stream(kernel, n_inputs, threshold, lr, batch, n_epochs, seed, first, key)
        trained = cut_lineage(stream.mapInArrow(run, kinds))
        logs.append(_log(trained, first, key))
        state = join_symbols(_averaged(trained, key), scales, [key], [key])

    history = logs[0]
    for log in logs[1:]:
        history = history.unionByName(log)
    parameters = cut_lineage(_parameters(state, kernel.shapes(n_inputs), key))
    test = inputs.filter(~F.col("is_train"))
    return ShardFit(_scored(parameters, test, len(features), n_inputs, kernel, key, time), history, parameters)


def _width(features: list[str], kernel) -> int:
    steps = getattr(kernel, "steps", None)
    return steps * (len(features) + 1) if steps else len(features)


def _inputs(df: DataFrame, features: list[str], kernel, label: str | None, key: str, time: str) -> DataFrame:
    """``key, time, is_train, _sec, _x, _y``: what the kernel sees of a row, not standardised.

    For a kernel with ``steps``: features and flag of each step, oldest first, missing steps zero.
    """
    steps = getattr(kernel, "steps", None)
    if steps is None:
        x = F.array(*[F.col(c).cast("double") for c in features])
    else:
        df = sequence_features(df, features, steps, "_sequence", key, time)
        one = lambda s: F.array(*[s[c].cast("double") for c in features], F.lit(1.0))
        absent = (F.lit(steps) - F.size("_sequence")) * (len(features) + 1)
        x = F.concat(F.array_repeat(F.lit(0.0), absent), F.flatten(F.transform("_sequence", one)))
    y = F.col(label).cast("double") if label else F.lit(None).cast("double")
    return df.select(
        key,
        F.col(time).cast("timestamp").alias(time),
        (F.col("is_train") if "is_train" in df.columns else F.lit(False)).alias("is_train"),
        epoch_seconds(time).alias("_sec"),
        x.alias("_x"),
        y.alias("_y"),
    )


def _standard(x: np.ndarray, mean: np.ndarray, sd: np.ndarray, kernel) -> np.ndarray:
    """Inputs on unit scale; flags of steps stay."""
    steps = getattr(kernel, "steps", None)
    if steps is None:
        return (x - mean) / sd
    return (x - np.tile(np.append(mean, 0.0), steps)) / np.tile(np.append(sd, 1.0), steps)


class _Shard:
    """One shard of one symbol while its rows stream by."""

    def __init__(self, symbol, number: int, values, scale: np.ndarray, step: int, kernel, n_inputs: int, seed: int):
        self.symbol, self.number, self.step = symbol, number, step
        half = len(scale) // 2
        self.mean, self.sd = scale[:half], scale[half:]
        if values is None:
            theta = kernel.start(n_inputs, seed)
            values = np.concatenate([theta, np.zeros(2 * len(theta))])
        self.state, self.held, self.n_held = values, [], 0
        self.n, self.blocks, self.squared, self.hits = 0, 0, 0.0, 0


def _train_stream(kernel, n_inputs, threshold, lr, batch, epochs, seed, first, key):
    """Rows of whole shards, sorted, each shard's state before its rows; a row out for each shard."""

    def train(shard: _Shard) -> None:
        rows = np.concatenate(shard.held)
        x = _standard(rows[:, :-1], shard.mean[:-1], shard.sd[:-1], kernel)
        y = (rows[:, -1] - shard.mean[-1]) / shard.sd[-1]
        cut = (threshold - shard.mean[-1]) / shard.sd[-1]
        draw = [seed, first, shard.number, shard.blocks]
        shard.state, shard.step, squared, hits = train_shard(
            kernel, x, y, shard.state, shard.step, lr, batch, epochs, draw, cut
        )
        shard.squared = shard.squared + np.array(squared) * shard.sd[-1] ** 2
        shard.hits = shard.hits + np.array(hits)
        shard.n, shard.blocks, shard.held, shard.n_held = shard.n + len(rows), shard.blocks + 1, [], 0

    def done(shard: _Shard | None) -> Iterator[pa.RecordBatch]:
        if shard is not None and shard.n_held:
            train(shard)
        if shard is not None and shard.n:  # a shard no row fell into has nothing to train
            columns = [
                pa.array([shard.symbol], pa.string()),
                pa.array([shard.n]),
                pa.array([shard.step]),
                pa.array([shard.state.astype("float64")], pa.list_(pa.float64())),
                pa.array([shard.squared.tolist()], pa.list_(pa.float64())),
                pa.array([shard.hits.tolist()], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "_n", "_step", "_state", "_loss", "_hits"])

    def feed(shard: _Shard | None, rows: pa.RecordBatch, start: int, stop: int) -> None:
        for at in {start, stop - 1} if start < stop else ():
            if shard is None or (rows.column(key)[at].as_py(), rows.column("_shard")[at].as_py()) != (shard.symbol, shard.number):
                raise ValueError("rows without the state of their shard")
        while start < stop:
            end = min(stop, start + BLOCK_ROWS - shard.n_held)
            shard.held.append(numbers(rows.column("_values").slice(start, end - start), n_inputs + 1, "a train row"))
            shard.n_held += end - start
            start = end
            if shard.n_held == BLOCK_ROWS:
                train(shard)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for rows in batches:
            values = rows.column("_values")
            heads = np.flatnonzero(rows.column("_row").to_numpy() == 0).tolist()
            if not heads or heads[0]:
                feed(shard, rows, 0, heads[0] if heads else rows.num_rows)
            for head, stop in zip(heads, [*heads[1:], rows.num_rows]):
                yield from done(shard)
                own = values.slice(head, 1)
                shard = _Shard(
                    rows.column(key)[head].as_py(),
                    rows.column("_shard")[head].as_py(),
                    own.flatten().to_numpy() if own.is_valid()[0].as_py() else None,
                    np.array(rows.column("_scale")[head].as_py()),
                    rows.column("_step")[head].as_py(),
                    kernel,
                    n_inputs,
                    seed,
                )
                feed(shard, rows, head + 1, stop)
        yield from done(shard)

    return run


def fit_gated_net(
    df: DataFrame,
    features: list[str],
    label: str = "label",
    cells: int = 2,
    hidden: int = 64,
    lr: float = 1e-3,
    batch: int | None = 64,
    epochs: int = 200,
    **options,
) -> ShardFit:
    """A small gated recurrent net per symbol; ``options`` as in ``fit_in_shards``.

    It sees one row at a time; ``fit_recurrent_net`` sees the rows before it too.
    """
    return fit_in_shards(
        df, features, label, GatedCells(cells, hidden), lr, batch, epochs, **options
    )


def fit_recurrent_net(
    df: DataFrame,
    features: list[str],
    label: str = "label",
    steps: int = 5,
    cells: int = 2,
    hidden: int = 64,
    lr: float = 1e-3,
    batch: int | None = 64,
    epochs: int = 200,
    **options,
) -> ShardFit:
    """A recurrent net per symbol over each row and the ``steps - 1`` rows before it.

    ``options`` as in ``fit_in_shards``; with one step it is the net of ``fit_gated_net``.
    """
    return fit_in_shards(
        df, features, label, RecurrentCells(cells, hidden, steps), lr, batch, epochs, **options
    )


def fit_factorization(
    df: DataFrame,
    features: list[str],
    label: str = "label",
    factors: int = 8,
    lr: float = 0.03,
    epochs: int = 100,
    seed: int = 42,
    scale_label: bool = True,
    shards: int = SHARDS,
    key: str = KEY,
    time: str = TIME,
) -> ShardFit:
    """A factorization machine per symbol by full-batch steps, without a job per step.

    For universes of thousands of symbols, where one Spark ML fit per symbol would keep
    the driver busy with hundreds of small jobs each. ``shards`` changes nothing: rows are summed
    where they lie. The accuracy of the history is NULL: sums do not tell single outputs.
    """
    kernel = FactorPairs(factors)
    scales = _scales(df, features, label, scale_label, key)
    inputs = staged(_inputs(df, features, kernel, label, key, time))
    n_inputs = len(features)
    scale = scales.select(key, F.concat("_means", "_sds").alias("_scale"))
    rows = pack(inputs.filter(F.col("is_train") & F.col("_y").isNotNull()), [F.concat("_x", F.array("_y")).alias("v")], [key, "_sec"], key, SCORE_ROWS)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict = {}
            own = zip(batch.column(key).to_pylist(), lists(batch.column("_rows")), lists(batch.column("_scale")))
            for symbol, block, scale in own:
                z, scale = numbers(block.field("v"), n_inputs + 1, "a train row"), scale.to_numpy()
                z = (z - scale[: n_inputs + 1]) / scale[n_inputs + 1 :]
                z = np.column_stack([products(z[:, :-1]), z[:, -1]])
                n, _, total = held.get(symbol, (0, 0.0, 0.0))
                held[symbol] = n + len(z), scale[-1], total + (z.T @ z).ravel()
            columns = [pa.array([h[i] for h in held.values()]) for i in (0, 1)]
            columns.append(pa.array([h[2] for h in held.values()], pa.list_(pa.float64())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), *columns], names=[key, "_n", "_sd", "_moments"]
            )

    part = meet(rows, scale, key).select(key, "_rows", "_scale").mapInArrow(
        sums, f"{key} string, _n long, _sd double, _moments array<double>"
    )
    whole = part.groupBy(key).agg(
        F.sum("_n").alias("_n"),
        F.max("_sd").alias("_sd"),
        Summarizer.sum(array_to_vector("_moments")).alias("_moments"),
    ).withColumn("_moments", vector_to_array("_moments"))

    def train(pdf: pd.DataFrame) -> pd.DataFrame:
        n, sd = int(pdf["_n"].iloc[0]), float(pdf["_sd"].iloc[0])
        theta, losses = train_on_moments(
            kernel, np.asarray(pdf["_moments"].iloc[0]), n, n_inputs, lr, epochs, seed
        )
        return pd.DataFrame(
            {key: [pdf[key].iloc[0]], "_state": [theta], "_loss": [[x * sd * sd for x in losses]]}
        )

    state = cut_lineage(
        whole.groupBy(key).applyInPandas(
            train, f"{key} string, _state array<double>, _loss array<double>"
        )
    )
    epoch = state.select(key, F.posexplode("_loss").alias("_i", "loss"))
    history = epoch.select(
        key,
        (F.col("_i") + 1).alias("epoch"),
        "loss",
        F.sqrt("loss").alias("rmse"),
        F.lit(None).cast("double").alias("accuracy"),
    )
    parameters = cut_lineage(_parameters(join_symbols(state, scales, [key], [key]), kernel.shapes(n_inputs), key))
    test = inputs.filter(~F.col("is_train"))
    return ShardFit(_scored(parameters, test, n_inputs, n_inputs, kernel, key, time), history, parameters)


def score_net(
    parameters: DataFrame,
    df: DataFrame,
    features: list[str],
    kernel,
    label: str | None = None,
    only: str | None = None,
    key: str = KEY,
    time: str = TIME,
) -> DataFrame:
    """``Stock, Date, actual, predicted`` of any rows by a parameter table, stored or new.

    ``parameters`` is that of ``ShardFit`` (``Stock, name, shape, values``) and holds the scale of
    features and label; ``features`` and ``kernel`` are those of the fit; ``actual`` is NULL
    without ``label``. ``only`` is a condition (SQL) on the rows to score: the others still come
    before them in sequences. Rows travel in blocks of any tasks, each with its symbol's parameters.
    Symbols without parameters are left out.
    """
    rows = df
    if only is not None:
        rows = df.withColumn("is_train", ~F.coalesce(F.expr(only), F.lit(False)))
    rows = staged(_inputs(rows, features, kernel, label, key, time))
    if only is not None:
        rows = rows.filter(~F.col("is_train"))
    return _scored(parameters, rows, len(features), _width(features, kernel), kernel, key, time)


def _scored(parameters, inputs, n_features: int, n_inputs: int, kernel, key: str, time: str) -> DataFrame:
    """Predictions for a stored table of inputs."""
    packed = pack(inputs, [F.col(time).alias("time"), F.col("_x").alias("x"), F.col("_y").alias("y")], [key, "_sec"], key, SCORE_ROWS)
    by_symbol = parameters.groupBy(key).agg(F.collect_list(F.struct("name", "values")).alias("_named"))
    shapes = kernel.shapes(n_inputs)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = zip(batch.column(key).to_pylist(), lists(batch.column("_rows")), lists(batch.column("_named")))
            for symbol, rows, named in own:
                by_name = dict(zip(named.field("name").to_pylist(), lists(named.field("values"))))
                mean, sd = (by_name[name].to_numpy() for name in SCALES)
                params = [by_name[name].to_numpy().reshape(shape) for name, shape in shapes]
                x = _standard(numbers(rows.field("x"), n_inputs, "a feature"), mean[:-1], sd[:-1], kernel)
                out, _ = kernel.forward(params, x)
                columns = [pa.array([symbol] * len(x), pa.string()), rows.field("time"), rows.field("y")]
                columns.append(pa.array(out * sd[-1] + mean[-1]))
                yield pa.RecordBatch.from_arrays(columns, names=[key, time, "actual", "predicted"])

    schema = f"{key} string, {time} timestamp, actual double, predicted double"
    return meet(packed, by_symbol, key).select(key, "_rows", "_named").mapInArrow(score, schema)


def _scales(df: DataFrame, features: list[str], label: str, scale_label: bool, key: str) -> DataFrame:
    """``key, _means, _sds`` of the features and the label, last, over a symbol's train rows."""
    aggs = []
    for i, c in enumerate([*features, label]):
        value = F.col(c).cast("double")
        aggs += [F.avg(value).alias(f"_m{i}"), F.stddev_pop(value).alias(f"_s{i}")]
    n = len(features)
    stats = df.filter("is_train").groupBy(key).agg(*aggs)
    sd = [F.when(F.col(f"_s{i}") > 0, F.col(f"_s{i}")).otherwise(1.0) for i in range(n + 1)]
    mean = [F.coalesce(F.col(f"_m{i}"), F.lit(0.0)) for i in range(n + 1)]
    if not scale_label:
        mean[n], sd[n] = F.lit(0.0), F.lit(1.0)
    return cut_lineage(stats.select(key, F.array(*mean).alias("_means"), F.array(*sd).alias("_sds")))


def _for_shards(state: DataFrame, count: int) -> DataFrame:
    """The common state of a symbol, once per shard."""
    return state.withColumn("_shard", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))


def _averaged(trained: DataFrame, key: str) -> DataFrame:
    """Row-weighted mean state per symbol, as one vector aggregate with partials."""
    weight = F.col("_n").cast("double")
    means = trained.groupBy(key).agg(
        Summarizer.mean(array_to_vector("_state"), weight).alias("_state"),
        F.max("_step").alias("_step"),
    )
    return means.withColumn("_state", vector_to_array("_state"))


def _log(trained: DataFrame, first: int, key: str) -> DataFrame:
    per_epoch = trained.select(
        key, "_n", F.posexplode(F.arrays_zip("_loss", "_hits")).alias("_i", "_e")
    )
    mean = F.sum("_e._loss") / F.sum("_n")
    return per_epoch.groupBy(key, (F.col("_i") + first + 1).alias("epoch")).agg(
        mean.alias("loss"),
        F.sqrt(mean).alias("rmse"),
        (F.sum("_e._hits") / F.sum("_n")).alias("accuracy"),
    )


def _parameters(state: DataFrame, shapes, key: str) -> DataFrame:
    """``Stock, name, shape, values``: the net's parameters, and the scale of its inputs."""
    cells, start = [], 1
    for name, shape in shapes:
        length = math.prod(shape)
        cells.append(
            F.struct(
                F.lit(name).alias("name"),
                F.array(*[F.lit(d) for d in shape]).alias("shape"),
                F.slice("_state", start, length).alias("values"),
            )
        )
        start += length
    for name, column in zip(SCALES, ("_means", "_sds")):
        cells.append(
            F.struct(F.lit(name).alias("name"), F.array(F.size(column)).alias("shape"), F.col(column).alias("values"))
        )
    return state.select(key, F.explode(F.array(*cells)).alias("_p")).select(key, "_p.*")
