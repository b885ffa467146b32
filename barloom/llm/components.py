"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.schema import shared_dir


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of a link between different nodes.

    ``component`` is the smallest node that links reach. Large-star and small-star steps
    alternate until the links no longer change: every link then points at the smallest node
    of its component. A node with very many links is never gathered: its smallest neighbour
    is a partial aggregate, and the join that hands it out splits skewed keys. Each round is
    a reliable checkpoint. NULLs and links of a node with itself are ignored; no links give
    an empty table.
    """
    shared_dir(links.sparkSession)
    x, y = F.col(a), F.col(b)
    now = links.where(x != y).select(F.greatest(x, y).alias("u"), F.least(x, y).alias("v")).distinct()
    now = now.checkpoint()
    before = _mark(now)
    while True:
        now = _small_star(_large_star(now)).checkpoint()
        after = _mark(now)
        if after == before:
            break
        before = after
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(roots)


def _mark(links: DataFrame) -> tuple:
    """Three numbers that tell whether the set of links is still the same."""
    h = F.xxhash64("u", "v")
    row = links.agg(F.count("*"), F.bit_xor(h), F.sum((h % 1_000_003).cast("long"))).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of each node are linked to the smallest of its neighbours and itself."""
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Smaller neighbours of each node, and itself, are linked to the smallest of them."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()
