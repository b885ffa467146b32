"""The trie of conversations' prefixes, from sorted matrices of turn ids.

Conversations are cut into slabs of ``WIDTH`` turns, so that neither a row nor the padding of a
matrix grows with the longest one. Slabs are range-partitioned by (slab number, prefix before it,
turn ids, conversation): a shard then holds neighbouring paths, however many conversations share
one. In a shard, NumPy sorts the padded matrix of turn ids by ``lexsort``; where a column differs
from the row above, or an earlier column did (OR, accumulated along the row), a node starts; and
``reduceat`` between the starts gives the node's numbers at every depth. Only nodes at the edges of
a shard can go on in another; these partial rows are added up by key.

Sums over a subtree need no second walk: they are sums over the members of a node. With f(c) the
smallest depth at which c is the smallest member of its node, and B(c) the bytes of c's turns above
that depth, the members c of a node at depth d other than its smallest save ``B(c)`` less the
bytes above d; and the leaves below a node are its members that are the smallest of a leaf. f and B
come from a first pass over the shards, the sums from a second.

Turns and prefixes are told apart by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import bounded_batches, release_memory, store

WIDTH = 32
#: Slabs of a shard, on average: the memory of a task.
SHARD_ROWS = 1 << 15
#: Turns or slabs of one conversation that one group of a shuffle holds.
SPAN = 4096
#: Conversations whose ids make one row of a list that spans shards.
PIECE = 4096
SALTS = 16
NODE = ["depth", "k1", "k2"]


def number_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, at, t1, t2, bytes``: turns by their place in their conversation, from 0.

    Order is by ``turn``, NULL first; equal turns by the hash of role and text, so repeated rows
    are turns of their own. NULL in role or text is empty. Rows without ``conv_id`` are left out.
    Turns are range-partitioned, so one conversation may span any number of tasks; the count
    before each task's part comes from one row per conversation and task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long"),
        F.col("turn"),
        F.xxhash64(F.lit(1), role, text).alias("t1"),
        F.xxhash64(F.lit(2), text, role).alias("t2"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    slim = store(slim, "turns")
    # The row number tells apart rows that agree in all else, so that they can be spread.
    order = ["conv_id", F.col("turn").asc_nulls_first(), "t1", "t2"]
    ranged = slim.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order, "row")
    ranged = ranged.sortWithinPartitions(*order).drop("turn", "row")
    added = T.StructType(ranged.schema.fields + T.StructType.fromDDL("part int, here long").fields)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, held = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = np.asarray(batch.column("conv_id"))
            if not len(ids):
                continue
            starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            base = np.zeros(len(starts), np.int64)
            base[0] = held if ids[0] == last else 0
            sizes = np.diff(np.append(starts, len(ids)))
            here = np.arange(len(ids)) - np.repeat(starts - base, sizes)
            last, held = ids[-1], here[-1] + 1
            columns = [*batch.columns, pa.array(np.full(len(ids), part, np.int32)), pa.array(here)]
            yield pa.RecordBatch.from_arrays(columns, names=added.names)

    bounded_batches(turns.sparkSession)
    counted = store(ranged.mapInArrow(count, added), "counted")
    parts = counted.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    # At most one conversation goes on in a part: this table has no more rows than there are parts.
    split = parts.withColumn("before", F.sum("n").over(before)).where("before > 0").drop("n")
    placed = counted.join(split, ["conv_id", "part"], "left")
    at = F.col("here") + F.coalesce(F.col("before"), F.lit(0))
    return placed.select("conv_id", at.alias("at"), "t1", "t2", "bytes")


def trie_nodes(sequences: DataFrame, conversations: DataFrame) -> DataFrame:
    """All nodes of the trie of ``sequences`` (``conv_id, at, t1, t2, bytes``, ``at`` from 0).

    ``conversations`` (``conv_id``) names all members, also those without a turn. Returns
    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``. No conversations: no rows.
    """
    slabs = _slabs(sequences, conversations)
    rows = slabs.agg(F.count("*")).first()[0]
    shards = max(1, math.ceil(rows / SHARD_ROWS))

    first = store(_over_shards(slabs, shards, _outline, OUTLINE), "outline")
    leaf = (F.col("n_children") == 0).alias("leaf")
    known = first.where("not edge").select("conv_id", "depth", "above", leaf)
    known = known.unionByName(_merged(first).select("conv_id", "depth", "above", leaf))
    scalars = known.groupBy("conv_id").agg(F.min_by("above", "depth").alias("b"), F.max("leaf").alias("leaf"))
    slabs = slabs.join(scalars, "conv_id", "left").withColumns(
        {"b": F.coalesce("b", "total"), "leaf": F.coalesce("leaf", F.lit(False)).cast("long")}
    )

    parts = store(_over_shards(slabs, shards, _numbers, NUMBERS), "nodes")
    whole = _merged(
        parts.where("n_convs is not null"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_leaves", "b")),
        F.min_by("b_first", "conv_id").alias("b_first"),
        F.max("parent").alias("parent"),
    )
    whole = store(whole.join(_ends(parts), NODE, "left"), "edges")
    nothing = hashlib.sha256(b"").hexdigest()
    inner = parts.where("not edge")
    nodes = inner.select(*whole.columns).unionByName(whole)
    parents = whole.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("above_conv"))
    # The children of a large node meet its one row on several keys.
    salt = F.pmod(F.xxhash64("k1", "k2"), F.lit(SALTS)).cast("int")
    parents = parents.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    open_nodes = nodes.where("parent is null").withColumn("salt", salt)
    joined = open_nodes.join(parents, ["depth", "p1", "p2", "salt"], "left")
    joined = joined.withColumn("parent", F.col("above_conv")).select(*nodes.columns)
    saved = F.col("b") - F.col("b_first") - (F.col("n_convs") - 1) * F.col("above")
    return nodes.where("parent is not null").unionByName(joined).select(
        "conv_id",
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def _merged(parts: DataFrame, *more) -> DataFrame:
    """Nodes at the edges of shards, their parts added up.

    A child that touches an end of its shard may go on in the next one: such children are not
    among ``n_children`` yet and count here, once each.
    """
    same = [F.max(c).alias(c) for c in ("p1", "p2", "above", "touch")]
    nodes = parts.where("edge").groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.sum("n_children").alias("inside"), *same, *more
    )
    across = nodes.where("touch and depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")
    ).agg(F.count("*").alias("across"))
    children = F.col("inside") + F.coalesce(F.col("across"), F.lit(0))
    out = nodes.join(across, NODE, "left").withColumn("n_children", children)
    return out.drop("inside", "across", "touch")


def _slabs(sequences: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per conversation and ``WIDTH`` turns: prefix key and bytes before, ids, bytes."""
    place = [F.xxhash64(f"t{i}", "at").alias(f"x{i}") for i in (1, 2)]
    rows = sequences.select("conv_id", "at", "bytes", *place, F.floor(F.col("at") / WIDTH).alias("slab"))
    packed = rows.groupBy("conv_id", "slab").agg(
        F.sort_array(F.collect_list(F.struct("at", "x1", "x2", "bytes"))).alias("t"),
        F.bit_xor("x1").alias("y1"),
        F.bit_xor("x2").alias("y2"),
        F.sum("bytes").alias("sum"),
    )
    empty = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    empty = empty.join(packed.where("slab = 0").select("conv_id"), "conv_id", "left_anti")
    empty = empty.selectExpr("conv_id", "0L as slab", "cast(array() as array<struct<at:bigint,x1:bigint,x2:bigint,bytes:bigint>>) as t", "0L as y1", "0L as y2", "0L as sum")
    packed = store(packed.select(*empty.columns).unionByName(empty.select(*empty.columns)), "slabs")
    # What lies before a slab: sums within spans of a conversation, then over its spans.
    spans = packed.withColumn("span", F.floor(F.col("slab") / SPAN))
    sums = [F.bit_xor("y1").alias("z1"), F.bit_xor("y2").alias("z2"), F.sum("sum").alias("zb"), F.max("slab").alias("top")]
    per_span = spans.groupBy("conv_id", "span").agg(*sums)
    whole = W.partitionBy("conv_id")
    earlier = whole.orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    per_span = per_span.select(
        "conv_id",
        "span",
        F.bit_xor("z1").over(earlier).alias("z1"),
        F.bit_xor("z2").over(earlier).alias("z2"),
        F.sum("zb").over(earlier).alias("zb"),
        F.sum("zb").over(whole).alias("total"),
        F.max("top").over(whole).alias("top"),
    )
    near = W.partitionBy("conv_id", "span").orderBy("slab").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    runs = spans.withColumns(
        {"r1": F.bit_xor("y1").over(near), "r2": F.bit_xor("y2").over(near), "rb": F.sum("sum").over(near)}
    ).join(per_span, ["conv_id", "span"])
    pick = lambda name: F.transform("t", lambda x: x[name])
    out = runs.select(
        "conv_id",
        "slab",
        F.coalesce("z1", zero).bitwiseXOR(F.coalesce("r1", zero)).alias("p1"),
        F.coalesce("z2", zero).bitwiseXOR(F.coalesce("r2", zero)).alias("p2"),
        (F.coalesce("zb", zero) + F.coalesce("rb", zero)).alias("before"),
        "total",
        (F.col("slab") == F.col("top")).alias("last"),
        pick("x1").alias("x1"),
        pick("x2").alias("x2"),
        pick("bytes").alias("bytes"),
    )
    return store(out, "paths")


def _over_shards(slabs: DataFrame, shards: int, kernel, schema: str) -> DataFrame:
    """``kernel`` on every shard of neighbouring slabs."""
    near = slabs.repartitionByRange(shards, "slab", "p1", "p2", "x1", "x2", "conv_id")
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    bounded_batches(slabs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            for columns in kernel(Shard(pa.Table.from_batches(held))):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types)], names=arrow.names)
        release_memory()

    return near.mapInArrow(run, schema)


class Shard:
    """The padded matrices of a shard's slabs, sorted, and where nodes start in each column.

    Column 0 stands for the prefix before the slab, column j for its j-th turn.
    """

    def __init__(self, table: pa.Table) -> None:
        get = lambda name: np.asarray(table.column(name).combine_chunks())
        turns = table.column("x1").combine_chunks()
        n = np.diff(np.asarray(turns.offsets)).astype(np.int64)
        rows, width = len(n), int(n.max())
        inside = np.arange(width)[None, :] < n[:, None]
        flat = {c: np.asarray(table.column(c).combine_chunks().flatten()) for c in ("x1", "x2", "bytes")}
        ids = np.full((rows, width), -1, np.int64)  # padding sorts first
        ids[inside] = _dense(flat["x1"], flat["x2"])
        group = _dense(get("slab"), get("p1"), get("p2"))
        conv = get("conv_id")
        order = np.lexsort((conv, *ids.T[::-1], group))
        ids, self.n, self.conv = ids[order], n[order], conv[order]
        self.slab, self.last = get("slab")[order], get("last")[order].astype(bool)
        changed = np.ones((rows, width + 1), bool)
        changed[1:, 0] = group[order][1:] != group[order][:-1]
        changed[1:, 1:] = ids[1:] != ids[:-1]
        self.changed = np.logical_or.accumulate(changed, axis=1)
        self.keys = []
        for p, x in (("p1", "x1"), ("p2", "x2")):
            key = np.zeros((rows, width + 1), np.int64)
            key[:, 0] = get(p)
            key[:, 1:][inside] = flat[x]
            self.keys.append(np.bitwise_xor.accumulate(key, axis=1)[order])
        path = np.zeros((rows, width + 1), np.int64)
        path[:, 0] = get("before")
        path[:, 1:][inside] = flat["bytes"]
        self.path = np.cumsum(path, axis=1)[order]
        self.width, self.rows = width, rows
        self.extra = {c: get(c)[order] for c in ("b", "leaf") if c in table.column_names}

    def nodes(self) -> Iterator[dict]:
        """For each depth column: members' rows, starts among them, and what is known of nodes."""
        for j in range(self.width + 1):
            members = np.flatnonzero(self.n >= j)
            starts = np.flatnonzero(self.changed[members, j])
            if not len(starts):
                continue
            head = members[starts]
            tail = members[np.append(starts[1:], len(members)) - 1]
            touch = (head == 0) | (tail == self.rows - 1)
            child = np.zeros(self.rows, bool)
            if j < self.width:
                child = self.changed[:, j + 1] & (self.n > j)
                if self.n[-1] > j:
                    child[np.flatnonzero(child)[-1]] = False
                child[0] = False  # children that touch an end are left to ``_merged``
            # Column 0 only adds children to a node of the slab before, if there is one.
            own = (j > 0) | (self.slab[head] == 0)
            on = (j == WIDTH) & ~np.logical_and.reduceat(self.last[members], starts)
            yield {
                "j": j,
                "members": members,
                "starts": starts,
                "head": head,
                "own": own,
                "touch": touch & own,
                "edge": touch | on | ~own,
                "depth": self.slab[head] * WIDTH + j,
                "conv_id": np.minimum.reduceat(self.conv[members], starts),
                "n_children": np.add.reduceat(child[members].astype(np.int64), starts),
                "above": self.path[head, j - 1] if j else np.zeros(len(head), np.int64),
                "key": [k[head, j] for k in self.keys],
                "parent": [k[head, j - 1] if j else np.zeros(len(head), np.int64) for k in self.keys],
            }


def _dense(*columns: np.ndarray) -> np.ndarray:
    """Numbers that are equal, and ordered, as the rows of the columns are."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _null(values: np.ndarray, valid: np.ndarray) -> pa.Array:
    return pa.array(values, mask=~np.broadcast_to(valid, values.shape))


OUTLINE = (
    "depth long, k1 long, k2 long, conv_id long, p1 long, p2 long, n_children long, above long, "
    "touch boolean, edge boolean"
)


def _outline(shard: Shard) -> Iterator[list]:
    """Edge nodes; of the others, the highest node of each smallest member, and the leaves."""
    of_above = None
    for node in shard.nodes():
        row_conv = np.zeros(shard.rows, np.int64)
        sizes = np.diff(np.append(node["starts"], len(node["members"])))
        row_conv[node["members"]] = np.repeat(node["conv_id"], sizes)
        row_edge = np.zeros(shard.rows, bool)
        row_edge[node["members"]] = np.repeat(node["edge"], sizes)
        keep = node["edge"] | (node["n_children"] == 0)
        if of_above is not None:
            above_conv, above_edge = of_above
            keep |= above_edge[node["head"]] | (above_conv[node["head"]] != node["conv_id"])
        else:
            keep[:] = True
        of_above = (row_conv, row_edge)
        own = np.broadcast_to(node["own"], keep.shape)[keep]
        yield [
            node["depth"][keep],
            *(k[keep] for k in node["key"]),
            _null(node["conv_id"][keep], own),
            *(_null(p[keep], own & (node["j"] > 0)) for p in node["parent"]),
            node["n_children"][keep],
            _null(node["above"][keep], own),
            node["touch"][keep],
            node["edge"][keep],
        ]


NUMBERS = (
    "depth long, k1 long, k2 long, conv_id long, p1 long, p2 long, n_convs long, n_children long, "
    "n_leaves long, b long, b_first long, above long, ends_sha256 string, parent long, touch boolean, "
    "edge boolean, piece_first long, piece string"
)


def _numbers(shard: Shard) -> Iterator[list]:
    """Nodes with their sums; of edge nodes also the ids that end there, in pieces."""
    above = None
    for node in shard.nodes():
        members, starts, j = node["members"], node["starts"], node["j"]
        sizes = np.diff(np.append(starts, len(members)))
        own = np.broadcast_to(node["own"], starts.shape)
        b = shard.extra["b"][members]
        # The smallest member's b: rows of a node are not in order of ids, so find its row.
        smallest = shard.conv[members] == np.repeat(node["conv_id"], sizes)
        b_first = np.maximum.reduceat(np.where(smallest, b, np.iinfo(np.int64).min), starts)
        parent, known = np.zeros(len(starts), np.int64), np.zeros(len(starts), bool)
        if above is not None:
            conv, edge = above
            parent, known = conv[node["head"]], ~edge[node["head"]]
        row_conv, row_edge = np.zeros(shard.rows, np.int64), np.zeros(shard.rows, bool)
        row_conv[members] = np.repeat(node["conv_id"], sizes)
        row_edge[members] = np.repeat(node["edge"], sizes)
        above = (row_conv, row_edge)
        ending = (shard.n[members] == j) & shard.last[members]
        digests, pieces = [None] * len(starts), []
        stops = np.append(starts[1:], len(members))
        with_ends = np.flatnonzero(np.logical_or.reduceat(ending, starts) & own)
        for i in with_ends:
            rows = members[starts[i] : stops[i]][ending[starts[i] : stops[i]]]
            ids = np.sort(shard.conv[rows])
            if not node["edge"][i]:
                digests[i] = hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()
                continue
            for at in range(0, len(ids), PIECE):
                part = ids[at : at + PIECE].tolist()
                pieces.append((i, part[0], ",".join(map(str, part))))
        numbers = [
            node["depth"],
            *node["key"],
            _null(node["conv_id"], own),
            *(_null(p, own & (j > 0)) for p in node["parent"]),
            np.where(own, sizes, 0),
            node["n_children"],
            np.where(own, np.add.reduceat(shard.extra["leaf"][members], starts), 0),
            np.where(own, np.add.reduceat(b, starts), 0),
            _null(b_first, own),
            _null(node["above"], own),
            digests,
            _null(parent, known),
            node["touch"],
            node["edge"],
            [None] * len(starts),
            [None] * len(starts),
        ]
        yield numbers
        if pieces:
            which = np.array([p[0] for p in pieces])
            blank = [None] * len(pieces)
            yield [
                node["depth"][which],
                *(k[which] for k in node["key"]),
                *[blank] * 12,
                np.ones(len(pieces), bool),
                [p[1] for p in pieces],
                [p[2] for p in pieces],
            ]


def _ends(parts: DataFrame) -> DataFrame:
    """``ends_sha256`` of nodes at the edges of shards: their pieces, streamed in order of ids.

    The ids of one node are in one task, as a digest runs over them in order, but as pieces and
    one batch at a time.
    """
    pieces = parts.where("piece is not null").select(*NODE, "piece_first", "piece")
    pieces = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "piece_first")
    schema = "depth long, k1 long, k2 long, ends_sha256 string"
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    bounded_batches(parts.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running, done = None, None, []
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in NODE))
            for key, piece in zip(keys, batch.column("piece").to_pylist()):
                if key != node:
                    if node is not None:
                        done.append((*node, running.hexdigest()))
                    node, running = key, hashlib.sha256()
                else:
                    running.update(b",")
                running.update(piece.encode())
        if node is not None:
            done.append((*node, running.hexdigest()))
        columns = [[r[i] for r in done] for i in range(4)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, arrow.types)], names=arrow.names)

    return pieces.mapInArrow(digest, schema)


def rebuilt(turns: DataFrame, family: int = 5, shared: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that share their beginnings: ``(sequences, conversations)`` for ``trie_nodes``.

    Conversation c starts with the first h turns of conversation ``c - c % family`` (all if fewer,
    none if absent), h being ``crc32(c) % shared``, and goes on with its own turns after its first h.
    """
    placed = store(number_turns(turns), "placed")
    lengths = placed.groupBy("conv_id").agg(F.count("*").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string")) % shared
    conversations = lengths.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    conversations = store(conversations, "conversations")
    heads = placed.where(F.col("at") < shared - 1)
    base_n = heads.groupBy(F.col("conv_id").alias("base")).agg(F.count("*").alias("base_n"))
    given = conversations.join(base_n, "base", "left")
    given = given.withColumn("given", F.least("h", F.coalesce("base_n", F.lit(0))))
    # A conversation's one row is repeated for every span of its turns.
    span = F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("n") / SPAN))).alias("span")
    per_span = given.select("conv_id", "h", "given", span)
    own = placed.withColumn("span", F.floor(F.col("at") / SPAN)).join(per_span, ["conv_id", "span"])
    own = own.where("at >= h").withColumn("at", F.col("at") - F.col("h") + F.col("given"))
    columns = ["conv_id", "at", "t1", "t2", "bytes"]
    takers = conversations.select("base", F.col("conv_id").alias("to"), "h")
    begun = heads.join(takers, F.col("conv_id") == F.col("base")).where("at < h")
    begun = begun.withColumn("conv_id", F.col("to"))
    return own.select(*columns).unionByName(begun.select(*columns)), conversations.select("conv_id")
