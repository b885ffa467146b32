"""Mixing sources to target weights by Sainte-Laguë apportionment of blocks of equal size.

The words of a source are laid out in shards, in an order drawn by the seed, and each shard is cut
into blocks of equal length (but for one word). Targets in words become whole numbers of blocks: a
source first gets the whole blocks of its target, and the blocks that are left go to the highest
quotients ``v / (2 s + 1)`` (v: blocks wanted, s: blocks held), at most one to a source. The same
rule then deals a source's blocks to its shards. Without the two bounds (never below the whole
blocks of the target, never over one block more), the plain rule would hand a large source the
blocks of many tiny ones, so that it missed its target by more than a block.

A shard that is to give q of its n blocks gives every block ``q div n`` times, and the ``q mod n``
blocks that come first in a seeded permutation once more. Which block a word lies in, and how often
it is taken, follows from its place by arithmetic, so blocks never become rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import store

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
BLOCK = 16
#: A shard is one group of a window: so many words or documents at most on average, at any size.
SHARD_WORDS, SHARD_DOCS = 1 << 20, 1 << 11
#: A source's one row is repeated so often, and its documents spread over as many join keys.
SALTS = 32
#: Larger than any number of blocks of a shard, and prime: multiples of it permute the blocks.
STRIDE = 2_147_483_647


def mark(seed: int) -> Column:
    """A document's place in its shard, drawn from its id and text."""
    doc_id = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    return F.md5(F.concat_ws("|", F.lit(str(seed)), doc_id, F.md5(F.coalesce("text", F.lit("")))))


def number(hex_text: Column) -> Column:
    """The first 48 bits of a hexadecimal digest."""
    return F.conv(F.substring(hex_text, 1, 12), 16, 10).cast("long")


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2
) -> DataFrame:
    """``target`` (words) of each source of a table ``source, source_size``.

    Sources in order of code points, NULL last, take the weights in turn and share ``share`` of
    all words by weight. A target stops at ``most`` times its source; what is over goes to the
    others by weight. Sources are filled in order of size by weight, so that one pass of running
    sums tells which are full. The table has one row per source and its windows run in one task.
    """
    by_code_point = W.orderBy(F.col("source").isNull(), "source")
    table = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("_rank", F.row_number().over(by_code_point) - 1)
    ranked = ranked.withColumn("_w", F.get(table, F.pmod("_rank", F.lit(len(weights)))))
    ranked = ranked.withColumn("_cap", F.col("source_size") * most)
    whole, full_first = W.partitionBy(), W.orderBy(F.col("_cap") / F.col("_w"), "_rank")
    before = full_first.rowsBetween(W.unboundedPreceding, -1)
    asked = F.lit(share) * F.sum("source_size").over(whole)
    rest = asked - F.coalesce(F.sum("_cap").over(before), F.lit(0))
    rest_weight = F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0))
    filled = ranked.withColumn("_full", F.col("_cap") * rest_weight <= rest * F.col("_w"))
    held = F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0)).over(whole)
    open_weight = F.sum(F.when(F.col("_full"), 0).otherwise(F.col("_w"))).over(whole)
    level = (asked - held) / F.when(open_weight > 0, open_weight)
    target = F.when(F.col("_full"), F.col("_cap").cast("double")).otherwise(level * F.col("_w"))
    return filled.withColumn("target", target).drop("_w", "_cap", "_full")


def apportion(parties: DataFrame, wanted: Column, seats: Column, group: list[str], tie: str) -> DataFrame:
    """``parties`` with ``_seats``: of the group's ``seats`` each gets the whole part of ``wanted``,
    and the rest go to the highest quotients ``wanted / (2 whole + 1)`` of those with a fraction.
    """
    rows = parties.withColumns({"_v": wanted, "_s": F.floor(wanted), "_all": seats})
    left = F.col("_all") - F.sum("_s").over(W.partitionBy(*group))
    some = F.col("_v") > F.col("_s")
    quotient = F.when(some, F.col("_v") / (2 * F.col("_s") + 1)).otherwise(-1.0)
    best = W.partitionBy(*group).orderBy(quotient.desc(), tie)
    more = F.when(some & (F.row_number().over(best) <= left), 1).otherwise(0)
    return rows.withColumn("_seats", F.col("_s") + more).drop("_v", "_s", "_all")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    most: int = 2,
    block: int = BLOCK,
    seed: int = 42,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken, spans``, one row for each row of ``docs``.

    ``size`` counts the words of ``text`` (NULL: 0), ``taken`` the words that the mix takes,
    repeats counted, and ``spans`` says which: word numbers ``start`` (from 0) to ``stop``
    (exclusive), ``times``; see ``words_of``. No word is taken over ``most`` times. A source misses
    its target by under one block, and under one more for each of its shards (a shard of W words
    has ``ceil(W / block)`` blocks, fewer than ``block`` of which are a word short).

    Rows with one id and text are exchangeable and lie next to each other; rows with an id of
    NULL are told apart by text. An empty table, or one without words, takes nothing (targets 0).
    Columns besides ``doc_id``, ``text`` and ``source`` are not read. Only slim rows are shuffled:
    documents by (source, shard); a hot source has as many shards as its size asks for.
    """
    slim = docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("_key"),
        mark(seed).alias("_mark"),
    )
    slim = store(slim, "sizes")
    by_source = slim.groupBy("_key", "source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("_rows")
    )
    shards = F.greatest(
        F.ceil(F.col("source_size") / SHARD_WORDS), F.ceil(F.col("_rows") / SHARD_DOCS)
    )
    aims = store(targets(by_source, weights, share, most).withColumn("_shards", shards), "targets")

    spread = F.pmod(number(F.substring("_mark", 21, 12)), F.lit(SALTS))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt")
    few = aims.select("_key", "_shards", "source_size", "target", every)
    rows = slim.withColumn("_salt", spread).join(few, ["_key", "_salt"]).drop("_salt")
    rows = rows.withColumn("_shard", F.pmod(number(F.col("_mark")), F.col("_shards")))

    cell = rows.groupBy("_key", "_shard").agg(F.sum("size").alias("_words"))
    cell = cell.where("_words > 0").withColumn("_blocks", F.ceil(F.col("_words") / block))
    cell = store(cell, "shards")
    of_source = cell.groupBy("_key").agg(F.sum("_blocks").alias("_n"))
    sources = aims.join(of_source, "_key")
    wanted = F.col("target") / F.col("source_size") * F.col("_n")
    every_block = F.sum(wanted.cast("decimal(30,6)")).over(W.partitionBy())
    sources = apportion(sources, wanted, F.round(every_block).cast("long"), [], "_rank")
    cells = cell.join(sources.select("_key", "_n", F.col("_seats").alias("_of_source")), "_key")
    part = F.col("_of_source") * F.col("_blocks") / F.col("_n")
    quotas = apportion(cells, part, F.col("_of_source"), ["_key"], "_shard")
    offset = number(F.md5(F.concat_ws("|", F.lit(str(seed)), "_key", F.col("_shard").cast("string"))))
    quotas = quotas.select("_key", "_shard", "_words", "_blocks", F.col("_seats").alias("_quota"), offset.alias("_offset"))

    before = W.partitionBy("_key", "_shard").orderBy("_mark").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumn("_at", F.coalesce(F.sum("size").over(before), F.lit(0)))
    placed = placed.join(quotas, ["_key", "_shard"], "left")
    placed = placed.withColumn("spans", F.when(F.col("size") > 0, F.expr(SPANS)).otherwise(F.expr(f"filter({SPANS_TYPE}, x -> false)")))
    taken = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + (x["stop"] - x["start"]) * x["times"])
    return placed.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "spans")


SPANS_TYPE = "array(named_struct('start', 0L, 'stop', 0L, 'times', 0L))"
#: Block j of a shard holds words ``j * words div blocks`` up to that of j + 1.
SPANS = f"""
filter(transform(
  sequence(((_at + 1) * _blocks - 1) div _words, ((_at + size) * _blocks - 1) div _words),
  j -> named_struct(
    'start', greatest((j * _words) div _blocks, _at) - _at,
    'stop', least(((j + 1) * _words) div _blocks, _at + size) - _at,
    'times', _quota div _blocks + if((j * {STRIDE}L + _offset) % _blocks < _quota % _blocks, 1L, 0L))),
  x -> x.times > 0)"""


def words_of(text: str = "text", spans: str = "spans") -> Column:
    """The texts that the mix takes of a document: one for each span, with its ``times``."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def cut(span):
        part = F.slice(words, (span["start"] + 1).cast("int"), (span["stop"] - span["start"]).cast("int"))
        return F.struct(F.array_join(part, " ").alias("text"), span["times"].alias("times"))

    return F.transform(spans, cut)
