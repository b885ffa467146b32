"""Approximate nearest neighbours by cross-polytope hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, store
from .vectors import common_dimension, cosine_rows, matrix, unit, usable

NEIGHBOURS = 5
#: Hash tables; pseudo-rotations whose nearest axes together are a table's key; buckets that a
#: query looks into over all tables; sign changes and Hadamard transforms of a rotation.
TABLES = 16
HASHES = 1
PROBES = 128
TURNS = 3
SEED = 9
#: Axes of each rotation that probes are combined from where a key has several.
AXES = 12
#: Vectors and queries of a bucket that are compared in one task, about.
BLOCK = 1_000
#: Scores this near to the last of the nearest are computed again, in a fixed order.
SLACK = 1e-9


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; lengths are kept."""
    n, d = rows.shape
    step = 1
    while step < d:
        halves = rows.reshape(n, d // (2 * step), 2, step)
        rows = np.stack([halves[:, :, 0] + halves[:, :, 1], halves[:, :, 0] - halves[:, :, 1]], axis=2)
        rows = rows.reshape(n, d)
        step *= 2
    return rows / np.sqrt(d)


class Polytopes:
    """Pseudo-rotations of all tables, and the signed axes nearest to rotated vectors."""

    def __init__(self, dimension: int, tables: int = TABLES, hashes: int = HASHES, seed: int = SEED) -> None:
        self.width = 1 << max(0, (dimension - 1).bit_length())
        self.tables, self.hashes = tables, hashes
        rng = np.random.default_rng(seed)
        self._signs = rng.choice([-1.0, 1.0], size=(tables, hashes, TURNS, self.width))

    def rotated(self, rows: np.ndarray, table: int, number: int) -> np.ndarray:
        x = np.zeros((len(rows), self.width))
        x[:, : rows.shape[1]] = rows
        for signs in self._signs[table, number]:
            x = hadamard(x * signs)
        return x

    def keys(self, rows: np.ndarray, table: int) -> np.ndarray:
        """The bucket of each row in a table: axis and sign for each rotation."""
        key = np.zeros(len(rows), dtype=np.int64)
        for number in range(self.hashes):
            x = self.rotated(rows, table, number)
            axis = np.abs(x).argmax(axis=1)
            negative = x[np.arange(len(x)), axis] < 0
            key = key * (2 * self.width) + 2 * axis + negative
        return key

    def probes(self, rows: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(row, table, bucket)`` of the ``count`` buckets nearest to each row.

        Buckets of all tables compete: the further a rotated vector reaches along an axis, the
        likelier its neighbours are in that axis' bucket.
        """
        reach, bucket, table_of = [], [], []
        for table in range(self.tables):
            score, key = None, None
            for number in range(self.hashes):
                x = self.rotated(rows, table, number)
                both = np.stack([x, -x], axis=2).reshape(len(rows), -1)
                axes = np.broadcast_to(np.arange(both.shape[1]), both.shape)
                if self.hashes > 1:
                    best = np.argsort(-both, axis=1)[:, :AXES]
                    both, axes = np.take_along_axis(both, best, 1), best
                if score is None:
                    score, key = both, axes.astype(np.int64)
                else:
                    n = len(rows)
                    score = (score[:, :, None] + both[:, None, :]).reshape(n, -1)
                    key = (key[:, :, None] * (2 * self.width) + axes[:, None, :]).reshape(n, -1)
            reach.append(score)
            bucket.append(key)
            table_of.append(np.full(key.shape, table))
        reach, bucket, table_of = (np.concatenate(c, axis=1) for c in (reach, bucket, table_of))
        count = min(count, reach.shape[1])
        best = np.argpartition(-reach, count - 1, axis=1)[:, :count]
        row = np.repeat(np.arange(len(rows)), count)
        return row, np.take_along_axis(table_of, best, 1).ravel(), np.take_along_axis(bucket, best, 1).ravel()


def _placed(vectors: DataFrame, polytopes: Polytopes, dimension: int, probes: int) -> DataFrame:
    """``(table, bucket, id, embedding)``: each vector in each table, or where a query looks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(matrix(batch.column("embedding"), dimension))
            if probes:
                row, table, bucket = polytopes.probes(x, probes)
            else:
                row = np.tile(np.arange(len(x)), polytopes.tables)
                table = np.repeat(np.arange(polytopes.tables), len(x))
                bucket = np.concatenate([polytopes.keys(x, t) for t in range(polytopes.tables)])
            out = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(table, pa.int32()), pa.array(bucket, pa.int64()), *out.columns],
                names=["table", "bucket", *out.schema.names],
            )

    kind = vectors.schema["embedding"].dataType.simpleString()
    return vectors.select("id", "embedding").mapInArrow(run, f"table int, bucket long, id long, embedding {kind}")


def _search(neighbours: int, dimension: int):
    """The nearest candidates of each query among those of one block of a bucket."""

    def one(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[list] = [[], [], []]
        if left.num_rows and right.num_rows:
            ids, asked = left.column("id").to_numpy(), right.column("id").to_numpy()
            x, q = matrix(left.column("embedding"), dimension), matrix(right.column("embedding"), dimension)
            ux, uq = unit(x), unit(q)
            for at in range(0, len(asked), BLOCK):
                near = uq[at : at + BLOCK] @ ux.T
                near[asked[at : at + BLOCK, None] == ids[None, :]] = -np.inf
                k = min(neighbours, len(ids))
                least = np.partition(near, len(ids) - k, axis=1)[:, len(ids) - k]
                rows, columns = np.nonzero((near >= least[:, None] - SLACK) & np.isfinite(near))
                # The same sums for the same two vectors, wherever they meet.
                score = cosine_rows(q[at + rows], x[columns])
                order = np.lexsort((ids[columns], -score, rows))
                rows, columns, score = rows[order], columns[order], score[order]
                start = np.searchsorted(rows, rows, side="left")
                good = np.arange(len(rows)) - start < neighbours
                out[0].append(asked[at + rows[good]])
                out[1].append(ids[columns[good]])
                out[2].append(score[good])
        a, b, c = (np.concatenate(o) if o else np.zeros(0) for o in out)
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(c, pa.float64())})

    return one


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    neighbours: int = NEIGHBOURS,
    tables: int = TABLES,
    probes: int = PROBES,
    hashes: int = HASHES,
    seed: int = SEED,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the nearest found for ``queries(vec_id, embedding)``.

    Candidates are all ``vectors(vec_id, embedding)`` with another ``vec_id`` in the buckets
    that a query looks into; their cosine is computed in double precision on the original
    vectors. Ranks count from 1, nearest first, ties to the smaller ``vec_id``. Queries and
    vectors that are NULL, zero, or hold NULL or non-finite components, or lack ``vec_id``, take
    no part. A query that meets too few in its buckets is compared with all vectors, so it has
    fewer rows only where there are fewer candidates. Of rows that repeat a query one counts. Empty tables give none. All vectors have the same length.

    Of copies of one vector only the ``neighbours + 1`` smallest ids can be among a query's
    nearest, so no others are indexed. A bucket is compared in blocks of about ``BLOCK``
    vectors; only the nearest of each query leave a block.
    """
    spark = vectors.sparkSession
    bounded_batches(spark)
    good = vectors.where(usable()).where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("id"), "embedding")
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("id"))
    indexed = store(
        good.distinct().withColumn("place", place).where(F.col("place") <= neighbours + 1).drop("place"), "indexed"
    )
    dimension = common_dimension(indexed)
    asked = queries.where(usable()).where("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("id"), "embedding")
    asked = asked.dropDuplicates(["id"])
    if not dimension:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    polytopes = Polytopes(dimension, tables, hashes, seed)
    index = store(_placed(indexed, polytopes, dimension, 0), "index")
    looks = _placed(asked, polytopes, dimension, probes)

    found = _compared(index, looks, ["table", "bucket"], neighbours, dimension)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best(pairs: DataFrame) -> DataFrame:
        # A pair found in several tables has the same score in each.
        once = pairs.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= neighbours)

    ranked = store(best(found), "ranked")
    # Queries that met too few look at every vector: each is in one bucket of the first table.
    full = ranked.where(F.col("rank") == neighbours).select(F.col("query_id").alias("id"))
    short = store(asked.join(full, "id", "left_anti"), "short")
    everything = F.lit(0).alias("whole")
    rest = _compared(
        index.where("table = 0").select("id", "embedding", everything),
        short.select("id", "embedding", everything),
        ["whole"],
        neighbours,
        dimension,
    )
    whole = ranked.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti")
    ranked = whole.select("query_id", "rank", "vec_id", "score").unionByName(
        best(rest).select("query_id", "rank", "vec_id", "score")
    )
    return ranked


def _compared(index: DataFrame, looks: DataFrame, at: list[str], neighbours: int, dimension: int) -> DataFrame:
    """The nearest candidates of each query in the groups ``at``, block by block of both sides.

    A group's vectors and queries are dealt over blocks of about ``BLOCK``, and every pair of
    blocks is compared, so a task gets two blocks however large a group is.
    """

    def sizes(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*at).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(name))

    both = sizes(index, "blocks").join(sizes(looks, "parts"), at)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    left = index.join(both, at).withColumn("block", own("blocks")).withColumn("part", every("parts"))
    right = looks.join(both, at).withColumn("part", own("parts")).withColumn("block", every("blocks"))
    cell = [*at, "block", "part"]
    left, right = (df.drop("blocks", "parts").groupBy(*cell) for df in (left, right))
    return left.cogroup(right).applyInArrow(_search(neighbours, dimension), "query_id long, vec_id long, score double")
