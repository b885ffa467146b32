"""Near-duplicate vectors by a forest of random-projection trees with spill overlap."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, inf, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, store
from .components import components
from .vectors import common_dimension, matrix, unit, usable

MIN_COSINE = 0.98
TREES = 5
SEED = 5
#: Vectors of a leaf, about; the documented sample that split points are fitted on (every
#: vector is indexed); the fewest sample vectors of a node that is split.
LEAF = 1_024
SAMPLE = 32_768
SAMPLE_LEAF = 8
#: Half the width of the overlap, in standard deviations of the difference that a projection
#: shows of two vectors at the least cosine.
OVERLAP = 1.0
#: A node is not split if more of its sample than this lies within the overlap of the cut, which
#: is the cheapest one of so many between these shares of the sample.
INSIDE = 0.25
CUTS = 37
SHARES = (0.05, 0.95)
#: Levels of a tree: so many times those of even halves without overlap, and some more for nodes
#: that a level doesn't divide; at most as many as leaf numbers have bits for.
LEVELS = 1.3
SPARE_LEVELS = 8
MOST_LEVELS = 38
#: Vectors of a leaf that are compared in one task; larger leaves are cut into blocks, and
#: every pair of blocks is compared.
BLOCK = 1_500
#: Vectors of a task from which comparing them costs more than telling where they met before.
MANY = 512


@dataclass(frozen=True)
class Forest:
    """Splits of all trees: node i of a tree has the children 2i + 1 and 2i + 2.

    ``cuts`` are by node. Where a node's sample is too small to be divided again, all nodes of
    a level below it share one cut: ``tails``, by (that node, level).
    """

    directions: np.ndarray  # tree, level, component
    cuts: list[dict[int, float]]
    tails: list[dict[tuple[int, int], float]]
    margin: float

    def leaves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, tree, leaf)`` of every leaf that a row of unit vectors falls into."""
        out = []
        for tree, (cuts, tails) in enumerate(zip(self.cuts, self.tails)):
            shown = rows @ self.directions[tree].T
            row, node = np.arange(len(rows)), np.zeros(len(rows), dtype=np.int64)
            top = np.full(len(rows), -1, dtype=np.int64)  # where the tail began
            ended = []
            for level in range(shown.shape[1]):
                nodes, place = np.unique(node, return_inverse=True)
                cut = np.array([cuts.get(n, np.nan) for n in nodes.tolist()])[place]
                top = np.where((top < 0) & np.isnan(cut), node, top)
                if tails and (top >= 0).any():
                    tops, place = np.unique(top, return_inverse=True)
                    below = np.array([tails.get((n, level), np.nan) for n in tops.tolist()])[place]
                    cut = np.where(top >= 0, below, cut)
                ends = np.isnan(cut)
                ended.append((row[ends], node[ends]))
                value = shown[row, level]
                left, right = value <= cut + self.margin, value >= cut - self.margin
                row, node, top = (
                    np.concatenate([row[left], row[right]]),
                    np.concatenate([2 * node[left] + 1, 2 * node[right] + 2]),
                    np.concatenate([top[left], top[right]]),
                )
            row = np.concatenate([row, *(r for r, _ in ended)])
            node = np.concatenate([node, *(n for _, n in ended)])
            out.append((row, np.full(len(row), tree), node))
        return tuple(np.concatenate(c) for c in zip(*out))

    def cells(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, cell)``: leaves as numbers that differ between trees and order by tree."""
        row, tree, leaf = self.leaves(rows)
        return row, (tree.astype(np.int64) << 40) | leaf


def _cheapest(value: np.ndarray, margin: float) -> tuple[float, float, float]:
    """The cut after which the fewest pairs are left to compare, and both sides' shares with overlap.

    A cluster narrower than the margin is thus passed at its side. Where the overlap would hold
    too much of the node, the cut is infinite: all stays on the left.
    """
    value = np.sort(value)
    cuts = np.quantile(value, np.linspace(*SHARES, CUTS))
    left = np.searchsorted(value, cuts + margin, side="right") / len(value)
    right = 1 - np.searchsorted(value, cuts - margin) / len(value)
    best = int(np.argmin(left**2 + right**2 + 1e-9 * np.abs(left - right)))
    if left[best] + right[best] - 1 > INSIDE:
        return inf, 1.0, 0.0
    return float(cuts[best]), float(left[best]), float(right[best])


def grow(sample: np.ndarray, depth: int, min_cosine: float, trees: int, seed: int) -> Forest:
    """Trees whose leaves hold about one in ``2 ** depth`` rows, one random direction a level.

    Two vectors at the least cosine differ by d = sqrt(2 - 2 c); a projection on a random
    direction shows a difference of about d / sqrt(dimension) of it. Vectors nearer to a cut
    than the margin go to both sides, so a pair is parted only if the cut lies between them
    and the difference shown is over twice the margin. A node without a good cut on one level's
    direction goes to the next level whole. Directions of different levels are independent, so
    below a node with few sample vectors the same ones tell the cuts of all further levels:
    depth follows the table, not the sample. Leaves are as small as asked with their overlap.
    """
    rng = np.random.default_rng(seed)
    dimension = sample.shape[1]
    margin = OVERLAP * sqrt(max(0.0, 2 - 2 * min_cosine)) / sqrt(dimension)
    levels = min(ceil(LEVELS * depth) + SPARE_LEVELS, MOST_LEVELS) if depth else 1
    directions = rng.standard_normal((trees, levels, dimension))
    directions /= np.linalg.norm(directions, axis=2, keepdims=True)
    cuts: list[dict[int, float]] = []
    tails: list[dict[tuple[int, int], float]] = []
    for tree in range(trees):
        own: dict[int, float] = {}
        tail: dict[tuple[int, int], float] = {}
        nodes = {0: (np.arange(len(sample)), 1.0)}
        for level in range(levels):
            following = {}
            for node, (members, share) in nodes.items():
                if share <= 0.5**depth or not len(members):
                    continue
                if len(members) < 2 * SAMPLE_LEAF:
                    for below in range(level, levels):
                        if share <= 0.5**depth:
                            break
                        tail[node, below], *sides = _cheapest(sample[members] @ directions[tree, below], margin)
                        share *= max(sides)
                    continue
                value = sample[members] @ directions[tree, level]
                own[node], left, right = _cheapest(value, margin)
                following[2 * node + 1] = members[value <= own[node]], share * left
                following[2 * node + 2] = members[value > own[node]], share * right
            nodes = following
        cuts.append(own)
        tails.append(tail)
    return Forest(directions, cuts, tails, margin)


def _routed(vectors: DataFrame, forest: Forest, dimension: int) -> DataFrame:
    """A row for each leaf of each vector."""
    bounded_batches(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, cell = forest.cells(unit(matrix(batch.column("embedding"), dimension)))
            out = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(cell)], names=[*out.schema.names, "cell"])

    schema = T.StructType(vectors.schema.fields + T.StructType.fromDDL("cell long").fields)
    return vectors.mapInArrow(run, schema)


def _compare(min_cosine: float, dimension: int, forest: Forest):
    """Links of one leaf, or of two blocks of a large one.

    A pair that meets in several leaves counts in the first of them only, so partial numbers
    of links may be added up; vectors that all met in an earlier leaf aren't compared again. For the union each vector is linked to the smallest one of its
    group here; no more rows come out than vectors went in.
    """

    def one(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        first, second = key[2].as_py(), key[3].as_py()
        ids = rows.column("node").to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        x = unit(matrix(rows.column("embedding"), dimension))[order]
        n = len(ids)

        def earlier(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            row, cell = forest.cells(rows) if len(rows) else (np.zeros(0, np.int64),) * 2
            return row[cell < key[1].as_py()], cell[cell < key[1].as_py()]

        # Pairs that share an earlier leaf were compared there, so in a large leaf the vectors
        # of the most frequent earlier one are compared with the others only.
        met = np.zeros(n, dtype=bool)
        if n > MANY:
            who, which = earlier(x)
            if len(which):
                cells, size = np.unique(which, return_counts=True)
                met[who[which == cells[size.argmax()]]] = True
        link = np.zeros((n, n), dtype=bool)
        link[~met] = x[~met] @ x.T >= min_cosine
        link[:, ~met] = link[~met].T
        np.fill_diagonal(link, False)
        if first != second:
            block = rows.column("block").to_numpy()[order]
            link &= block[:, None] != block[None, :]
        some = link.any(axis=1)
        ids, link = ids[some], link[np.ix_(some, some)]
        n = len(ids)
        fresh = link
        who, which = earlier(x[some])
        if len(who):
            which = np.unique(which, return_inverse=True)[1]
            shared = np.zeros((n, int(which.max()) + 1), dtype=np.float32)
            shared[who, which] = 1
            fresh = link & ~(shared @ shared.T > 0)
        copies = rows.column("copies").to_numpy()[order][some]
        links = fresh @ copies.astype(np.int64) if n else np.zeros(0, np.int64)
        # Smallest member of each group: labels spread along links until they rest.
        label = np.arange(n)
        while n:
            least = np.minimum(label, np.where(link, label[None, :], n).min(axis=1))
            least = least[least]
            if (least == label).all():
                break
            label = least
        return pa.table(
            {
                "node": pa.array(ids, pa.int64()),
                "hub": pa.array(ids[label] if n else ids, pa.int64()),
                "links": pa.array(links, pa.int64()),
            }
        )

    return one


def near_vectors(
    vectors: DataFrame,
    min_cosine: float = MIN_COSINE,
    trees: int = TREES,
    leaf: int = LEAF,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors(vec_id, embedding, label)``.

    Vectors are linked when their labels are equal and not NULL and their cosine, in double
    precision, is at least ``min_cosine``. Vectors that are NULL, zero, or hold NULL or
    non-finite components have no links, nor have rows without ``vec_id`` (whose component is
    NULL and which are not kept). ``n_links`` counts other rows linked directly, copies
    included; ``component_id`` is the smallest ``vec_id`` reachable; ``kept`` tells whether the
    row is that one. A repeated ``vec_id`` counts as often as it is given. An empty table gives
    none. All vectors must have the same length.

    Copies (equal label and components) go through the forest once, with their number.
    """
    vectors = vectors.select("vec_id", "embedding", "label")
    fit = usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    good = vectors.where(fit)
    nodes = store(
        good.groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")),
        "vectors",
    )
    dimension = common_dimension(nodes)
    n = nodes.count()
    if n == 0:
        return vectors.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept")
        )
    depth = max(0, ceil(log2(n / leaf))) if n > leaf else 0
    drawn = F.xxhash64("node", F.lit(seed))
    # About twice the sample passes, so that ordering them is no task's burden.
    few = nodes.where(F.pmod(drawn, F.lit(1 << 30)) < F.lit(min(1 << 30, (2 * SAMPLE << 30) // n)))
    taken = few.orderBy(drawn).limit(SAMPLE).select("embedding").toArrow()
    forest = grow(unit(matrix(taken.column("embedding"), dimension)), depth, min_cosine, trees, seed)
    routed = store(_routed(nodes, forest, dimension), "routed")

    # Leaves over the block size: a row goes to each pair of blocks that its own is in.
    sizes = routed.groupBy("label", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = (
        routed.join(sizes, ["label", "cell"])
        .withColumn("block", own)
        .select("label", "cell", "node", "copies", "embedding", "block", other)
        .withColumn("first", F.least("block", "other"))
        .withColumn("second", F.greatest("block", "other"))
        .drop("other")
    )
    compared = pairs.groupBy("label", "cell", "first", "second").applyInArrow(
        _compare(min_cosine, dimension, forest), "node long, hub long, links long"
    )
    compared = store(compared, "links")
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    groups = components(compared.where("node != hub"), "node", "hub")
    of = (
        nodes.join(links, "node", "left")
        .join(groups, "node", "left")
        .select(
            F.col("label").alias("of_label"),
            F.col("embedding").alias("of_embedding"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    same = (F.col("label") == F.col("of_label")) & (F.col("embedding") == F.col("of_embedding"))
    linked = good.join(of, same).select("vec_id", "n_links", "component_id")
    alone = vectors.where(~fit).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    return linked.unionByName(alone).select("*", kept)
