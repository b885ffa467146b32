"""Forests of all symbols, grown level by level in the same jobs, and kept as one table.

A level is one pass over blocks of rows: each task walks its rows down the trees so far and counts,
for every node of the level and the features drawn for it, weights and label sums by bin; the
counts of a tree are added up and the best cut of each of its nodes is chosen. Labels are counted
in whole steps and bootstrap weights come from a hash of the row, so sums are exact and the trees
are the same for any layout of the table, and for any other symbols in it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.chunks import join_symbols
from ..schema import KEY, TIME, epoch_seconds, staged
from .blocks import lists, meet, numbers, pack

# The functions below travel with the task, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of a symbol, about, whose quantiles are the candidate cuts (chosen by hash; all if fewer).
CUT_ROWS = 10_000
#: Steps that a symbol's range of labels is counted in.
STEPS = 1 << 24
#: Symbols whose counts a task holds at once.
HELD = 8
#: Trees whose counts meet in one group.
TOGETHER = 10
#: Chances that a row is drawn at most 0, 1, 2, ... times: a bootstrap of many rows (Poisson).
DRAWN = np.cumsum([np.exp(-1) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320)])

FOREST = "tree int, node int, feature string, cut double, left int, right int, value double"


def bootstrap(rows: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """How often each row (a 64-bit hash) is drawn for each tree."""
    tree = (np.arange(trees, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    z = rows.astype(np.int64).view(np.uint64)[:, None] ^ tree[None, :]
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # SplitMix64
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    unit = (z ^ (z >> np.uint64(31))) >> np.uint64(11)
    return np.searchsorted(DRAWN, unit.astype(np.float64) / 2**53, side="right")


def drawn_features(inputs: int, share: float, trees: int, nodes: int, seed: int) -> np.ndarray:
    """Features that may split each node: ``(tree, node, some)``, in order."""
    some = max(1, int(np.ceil(inputs * share)))
    keys = np.random.default_rng([seed, 1]).random((trees, nodes, inputs))
    return np.sort(np.argsort(keys, axis=2)[:, :, :some], axis=2)


def walk(bins: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node (in heap order) of each row in each tree after ``levels`` levels.

    ``feature`` and ``cut`` are ``(tree, node)``; a feature of -1 ends the walk at that node.
    """
    rows, trees = np.arange(len(bins))[:, None], np.arange(len(feature))[None, :]
    node = np.zeros((len(bins), len(feature)), np.int64)
    for _ in range(levels):
        chosen = feature[trees, node]
        further = 2 * node + 1 + (bins[rows, chosen] > cut[trees, node])
        node = np.where(chosen < 0, node, further)
    return node


def _arrays(column, trees: int, nodes: int):
    """``feature`` and ``cut`` of every node of a symbol's trees, from its levels so far."""
    feature, cut = np.full((trees, nodes), -1), np.zeros((trees, nodes))
    for level in column.to_pylist():
        first = 2 ** level["level"] - 1
        at = slice(first, first + len(level["feature"]))
        feature[level["tree"], at], cut[level["tree"], at] = level["feature"], level["bin"]
    return feature, cut


def _counted(inputs: int, level: int, trees: int, depth: int, width: int, drawn: np.ndarray, seed: int, key: str):
    """Weights and label sums by (tree, node of the level, drawn feature, bin), added up in a task."""
    first, n_nodes = 2**level - 1, 2**level
    some = drawn.shape[2]
    shape = (trees, n_nodes, some, width)

    def flush(held: dict) -> pa.RecordBatch:
        cells = n_nodes * some * width
        flat = [np.concatenate([h[i].reshape(-1) for h in held.values()]) for i in (0, 1)]
        columns = [pa.array(np.repeat(np.array(list(held), dtype=object), trees), pa.string())]
        columns.append(pa.array(np.tile(np.arange(trees, dtype=np.int32), len(held))))
        offsets = pa.array(np.arange(0, len(flat[0]) + 1, cells, dtype=np.int32))
        columns += [pa.ListArray.from_arrays(offsets, pa.array(f)) for f in flat]
        return pa.RecordBatch.from_arrays(columns, names=[key, "tree", "w", "s"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            symbols = batch.column(key).to_pylist()
            parts = [lists(batch.column(c)) for c in ("_rows", "cuts", "levels")]
            for symbol, rows, cuts, levels in zip(symbols, *parts):
                x = numbers(rows.field("x"), inputs, "a feature")
                label = rows.field("q").to_numpy(zero_copy_only=False).astype(np.float64)
                bins = np.column_stack([np.searchsorted(c.as_py(), x[:, i]) for i, c in enumerate(cuts)])
                weight = bootstrap(rows.field("h").to_numpy(), trees, seed)
                feature, cut = _arrays(levels, trees, 2 ** (depth + 1) - 1)
                node = walk(bins, feature, cut, level)
                row, tree = np.nonzero((node >= first) & (weight > 0))
                node, weight = node[row, tree], weight[row, tree]
                own = (tree * n_nodes + node - first) * some
                if symbol not in held:
                    if len(held) == HELD:
                        yield flush(held)
                        held = {}
                    held[symbol] = [np.zeros(shape, np.int64) for _ in range(2)]
                cell = (own[:, None] + np.arange(some)) * width + bins[row[:, None], drawn[tree, node]]
                for total, values in zip(held[symbol], (weight, weight * label[row])):
                    sums = np.bincount(cell.ravel(), np.repeat(values, some), total.size)
                    total += sums.astype(np.int64).reshape(shape)
        if held:
            yield flush(held)

    return run


def best_cuts(w: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place among the drawn features and bin of the best cut of each node; -1 where none gains.

    ``w`` and ``s`` are ``(node, feature, bin)``. The gain is the drop of the sum of squares, which
    for 0/1 labels is half that of the Gini impurity, so both choose the same cuts.
    """
    left_w, left_s = w.cumsum(axis=2)[:, :, :-1], s.cumsum(axis=2)[:, :, :-1]
    right_w, right_s = w.sum(axis=2)[:, :, None] - left_w, s.sum(axis=2)[:, :, None] - left_s
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = left_s / left_w - right_s / right_w
        gain = left_w * (right_w / (left_w + right_w)) * apart * apart
    gain = np.where((left_w > 0) & (right_w > 0), gain, 0.0).reshape(len(w), -1)
    best = gain.argmax(axis=1)
    some = gain[np.arange(len(w)), best] > 1e-6
    place, cut = np.divmod(best, max(1, w.shape[2] - 1))
    return np.where(some, place, -1), cut


def _chosen(level: int, some: int, width: int, drawn: np.ndarray):
    """The cuts of some trees' nodes of the level, and weights and sums of the nodes below."""
    first, n_nodes = 2**level - 1, 2**level

    def one(key: tuple, parts: pa.Table) -> pa.Table:
        of_tree = parts.column("tree").to_numpy()
        order = np.argsort(of_tree, kind="stable")
        trees, starts = np.unique(of_tree[order], return_index=True)
        w, s = (
            np.add.reduceat(
                np.asarray(parts.column(c).combine_chunks().flatten()).reshape(len(order), -1)[order], starts
            ).reshape(-1, some, width)
            for c in ("w", "s")
        )
        place, cut = best_cuts(w, s)
        node, at = np.tile(np.arange(n_nodes), len(trees)), np.arange(len(w))
        of_node = drawn[np.repeat(trees, n_nodes), first + node, np.maximum(place, 0)]
        feature = np.where(place < 0, -1, of_node)
        whole = [c[:, 0].sum(axis=1) for c in (w, s)]
        left = [np.where(place < 0, 0, c.cumsum(axis=2)[at, np.maximum(place, 0), cut]) for c in (w, s)]
        below = [np.column_stack([a, np.where(place < 0, 0, b - a)]) for a, b in zip(left, whole)]
        found = [np.asarray(c).reshape(len(trees), -1).tolist() for c in (feature, cut, *whole, *below)]
        columns = [pa.array([key[0].as_py()] * len(trees), pa.string()), pa.array(trees, pa.int32())]
        columns.append(pa.array([level] * len(trees), pa.int32()))
        columns += [pa.array(c, pa.list_(pa.int64())) for c in found]
        return pa.table(columns, names=[parts.column_names[0], "tree", "level", "feature", "bin", "w", "s", "below_w", "below_s"])

    return one


def fit_forests(
    df: DataFrame,
    features: list[str],
    label: str = "label",
    trees: int = 100,
    depth: int = 5,
    seed: int = 42,
    share: float = 1 / 3,
    bins: int = 32,
    impurity: str = "variance",
    key: str = KEY,
    time: str = TIME,
) -> DataFrame:
    """A forest per symbol on its ``is_train`` rows, as a table ``Stock, tree, node, feature, cut,
    left, right, value``; a row goes left if its feature is at most ``cut``.

    Nodes are numbered as in a heap, from 0; leaves have no feature and no children; ``value`` is
    the mean label of a node's drawn rows. Each node may use a ``share`` of the features, drawn for
    it, and a feature is cut at the quantiles of a hashed sample of the symbol's rows. ``impurity``
    is ``variance`` or, for 0/1 labels, ``gini``. A tree that drew no row is left out, so symbols
    without a train row have none. A NULL or NaN feature is an error. One job a level, whatever
    the number of symbols.
    """
    if impurity not in ("variance", "gini"):
        raise ValueError(f"unknown impurity {impurity!r}")
    x = F.array(*[F.col(c).cast("double") for c in features]).alias("x")
    y = F.col(label).cast("double").alias("y")
    if impurity == "gini":
        y = F.when(y.isin(0.0, 1.0), y).otherwise(F.raise_error(F.lit("gini needs labels 0 and 1"))).alias("y")
    h = F.xxhash64(key, epoch_seconds(time), F.lit(seed)).alias("h")
    train = staged(df.filter("is_train").filter(y.isNotNull()).select(key, h, x, y))

    stats = staged(
        train.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("y").alias("lo"), F.max("y").alias("hi"))
    )
    in_sample = F.pmod("h", F.lit(1 << 30)) / (1 << 30) < F.lit(CUT_ROWS) / F.col("n")
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    cuts = [
        F.array_sort(F.array_distinct(F.percentile(F.col("x")[i], shares))) for i in range(len(features))
    ]
    sampled = join_symbols(train, stats, [key], ["h"]).filter(in_sample)
    cuts = staged(sampled.groupBy(key).agg(F.array(*cuts).alias("cuts")))
    gap = F.col("hi") - F.col("lo")
    q = F.when(gap > 0, F.round((F.col("y") - F.col("lo")) / gap * STEPS)).otherwise(0).cast("long")
    stepped = join_symbols(train, stats, [key], ["h"])
    table = staged(pack(stepped, [F.col("h"), q.alias("q"), F.col("x")], ["h"], key))

    n_nodes = 2 ** (depth + 1) - 1
    drawn = drawn_features(len(features), share, trees, n_nodes, seed)
    kind = "array<bigint>"
    level_schema = f"{key} string, tree int, level int, " + ", ".join(
        f"{c} {kind}" for c in ("feature", "bin", "w", "s", "below_w", "below_s")
    )
    grown: list[DataFrame] = []
    for level in range(depth):
        model = cuts
        if grown:
            so_far = F.collect_list(F.struct("tree", "level", "feature", "bin")).alias("levels")
            model = cuts.join(_union(grown).groupBy(key).agg(so_far), key)
        else:
            none = "cast(array() as array<struct<tree:int,level:int,feature:array<bigint>,bin:array<bigint>>>)"
            model = cuts.withColumn("levels", F.expr(none))
        counted = meet(table, model, key).select(key, "_rows", "cuts", "levels")
        run = _counted(len(features), level, trees, depth, bins, drawn, seed, key)
        parts = counted.mapInArrow(run, f"{key} string, tree int, w {kind}, s {kind}")
        some_trees = (F.col("tree") % F.lit(-(-trees // TOGETHER))).alias("_some")
        chosen = parts.groupBy(key, some_trees).applyInArrow(_chosen(level, drawn.shape[2], bins, drawn), level_schema)
        grown.append(staged(chosen))

    whole = cuts.join(stats, key)
    names = F.array(*[F.lit(c) for c in features])
    value = lambda s, w: F.col("lo") + s / w / STEPS * gap
    levels = join_symbols(_union(grown), whole, [key], ["tree"])
    own = levels.select(
        "*", F.posexplode(F.arrays_zip("feature", "bin", "w", "s")).alias("_i", "_n")
    ).filter("_n.w > 0").select(
        key,
        "tree",
        (F.pow(F.lit(2), "level") - 1 + F.col("_i")).cast("int").alias("node"),
        F.col("_n.feature").cast("int").alias("_f"),
        F.col("_n.bin").cast("int").alias("_b"),
        "cuts",
        value(F.col("_n.s"), F.col("_n.w")).alias("value"),
    )
    split = F.col("_f") >= 0
    when = lambda c: F.when(split, c)
    inner = own.select(
        key,
        "tree",
        "node",
        when(F.get(names, F.col("_f"))).alias("feature"),
        when(F.get(F.get("cuts", F.col("_f")), F.col("_b"))).alias("cut"),
        when(2 * F.col("node") + 1).alias("left"),
        when(2 * F.col("node") + 2).alias("right"),
        "value",
    )
    last = levels.filter(F.col("level") == depth - 1).select(
        "*", F.posexplode(F.arrays_zip("below_w", "below_s")).alias("_i", "_n")
    )
    leaves = last.filter("_n.below_w > 0").select(
        key,
        "tree",
        (F.lit(2**depth - 1) + F.col("_i")).cast("int").alias("node"),
        F.lit(None).cast("string").alias("feature"),
        F.lit(None).cast("double").alias("cut"),
        F.lit(None).cast("int").alias("left"),
        F.lit(None).cast("int").alias("right"),
        value(F.col("_n.below_s"), F.col("_n.below_w")).alias("value"),
    )
    return staged(inner.unionByName(leaves))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def save_forests(forests: DataFrame, path: str, key: str = KEY) -> None:
    """One write for all symbols, in order, so that a reader of some skips the other files."""
    forests.repartitionByRange(key, "tree").sortWithinPartitions(key, "tree", "node").write.mode("overwrite").parquet(path)


def load_forests(spark: SparkSession, path: str, key: str = KEY) -> DataFrame:
    """The table that ``save_forests`` wrote: one scan, whatever the number of symbols."""
    return spark.read.schema(f"{key} string, {FOREST}").parquet(path)


def score_forests(
    forests: DataFrame,
    df: DataFrame,
    features: list[str],
    label: str | None = None,
    key: str = KEY,
    time: str = TIME,
) -> DataFrame:
    """``Stock, Date, actual, predicted`` of any rows by a table of forests, stored or new.

    ``predicted`` is the mean over the trees; ``actual`` is NULL without ``label``. Rows of
    symbols without a forest are left out. All symbols are one plan.
    """
    actual = F.col(label).cast("double") if label else F.lit(None).cast("double")
    rows = staged(
        df.select(
            key,
            F.col(time).cast("timestamp").alias(time),
            actual.alias("actual"),
            F.array(*[F.col(c).cast("double") for c in features]).alias("x"),
        )
    )
    packed = pack(rows, [F.col(time).alias("time"), F.col("actual"), F.col("x")], [key, time], key)
    nodes = forests.groupBy(key).agg(
        F.collect_list(F.struct("tree", "node", "feature", "cut", "value")).alias("nodes")
    )
    number = {name: i for i, name in enumerate(features)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = batch.column(key).to_pylist()
            parts = [lists(batch.column(c)) for c in ("_rows", "nodes")]
            last, arrays = object(), None
            for symbol, rows, nodes in zip(symbols, *parts):
                if symbol != last:
                    last, arrays = symbol, _node_arrays(nodes, number)
                feature, cut, value, levels = arrays
                x = numbers(rows.field("x"), len(features), "a feature")
                node = walk(x, feature, cut, levels)
                predicted = value[np.arange(len(feature))[None, :], node].mean(axis=1)
                columns = [pa.array([symbol] * len(x), pa.string()), rows.field("time"), rows.field("actual"), pa.array(predicted)]
                yield pa.RecordBatch.from_arrays(columns, names=[key, time, "actual", "predicted"])

    schema = f"{key} string, {time} timestamp, actual double, predicted double"
    return meet(packed, nodes, key).select(key, "_rows", "nodes").mapInArrow(run, schema)


def _node_arrays(nodes: pa.Array, number: dict[str, int]):
    """Feature, cut and value of every node, ``(tree, node)``, and the number of levels."""
    tree, node = (nodes.field(c).to_numpy() for c in ("tree", "node"))
    tree = np.unique(tree, return_inverse=True)[1]
    shape = (int(tree.max()) + 1, int(node.max()) + 1)
    feature, cut, value = np.full(shape, -1), np.zeros(shape), np.zeros(shape)
    feature[tree, node] = [-1 if f is None else number[f] for f in nodes.field("feature").to_pylist()]
    cut[tree, node] = nodes.field("cut").to_numpy(zero_copy_only=False)
    value[tree, node] = nodes.field("value").to_numpy(zero_copy_only=False)
    return feature, cut, value, int(node.max() + 1).bit_length() - 1
