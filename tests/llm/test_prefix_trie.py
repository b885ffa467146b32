import hashlib
import math
import zlib
from collections import defaultdict

import numpy as np
import pytest

from barloom.llm import prefix_trie
from barloom.llm.queries import ORACLE_SQL
from tests.llm.test_ranked_search import by_sql, same_rows

DDL = "conv_id long, turn int, role string, text string, depth string, b int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], DDL)


def paths(rows):
    """Rebuilt turns of each conversation, by a plain loop."""
    turns = defaultdict(list)
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1] is not None, r[1] or 0))
    for conv, _, role, text in order:
        turns[conv].append((role or "", text or ""))
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(math.fmod(c, 5))  # as SQL does below zero
        out[c] = turns.get(base, [])[:h] + own[h:]
    return out


def brute(rows):
    members = defaultdict(list)
    sequences = paths(rows)
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1].encode()) if node else 0
    out = set()
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(sequences[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.add((min(own), len(node), parent, len(own), children[node], leaves[node], saved[node], digest))
    return out


@pytest.fixture(scope="module")
def odd_rows():
    rng = np.random.default_rng(2)
    rows = []
    for c in range(120):
        for t in range(int(rng.integers(1, 12))):
            rows.append((c, t, rng.choice(["user", "bot"]), rng.choice(["hi", "é", "yes", "no"])))
    rows += [(200 + c, t, "user", "same") for c in range(150) for t in range(3)]  # one path
    rows += [(1_000, t, "user", f"t{t % 3}") for t in range(300)]  # a long conversation
    rows += [(1_001, t, "user", f"t{t % 3}") for t in range(290)]
    rows += [(2_001, None, None, None), (2_001, 3, "bot", ""), (2_002, 5, "", None), (-3, 0, "user", "hi")]
    rows += [(None, 0, "user", "lost")]
    return rows


@pytest.mark.parametrize("width, shard, piece, span", [(32, 1 << 15, 4096, 4096), (4, 40, 3, 2)])
def test_nodes_equal_brute_force(spark, odd_rows, monkeypatch, width, shard, piece, span):
    for name, value in (("WIDTH", width), ("SHARD_ROWS", shard), ("PIECE", piece), ("SPAN", span)):
        monkeypatch.setattr(prefix_trie, name, value)
    got = prefix_trie.trie_nodes(*prefix_trie.rebuilt(table(spark, odd_rows).repartition(4))).collect()
    want = brute(odd_rows)
    assert len(got) == len(want)
    assert {tuple(r) for r in got} == want


def test_small_table_equals_sql(spark, odd_rows, tmp_path):
    rows = [r for r in odd_rows if r[0] is None or 0 <= r[0] < 40 or r[0] in (2_001, 2_002)]
    turns = table(spark, rows)
    got = prefix_trie.trie_nodes(*prefix_trie.rebuilt(turns)).toPandas()
    tables = {"conversations": turns.select("conv_id", "turn", "role", "text")}
    same_rows(got, by_sql(ORACLE_SQL["op13_prefix_trie"], tmp_path, **tables))


def test_repeated_turns_are_turns_of_their_own(spark):
    rows = [(6, 1, "user", "a")] * 40 + [(11, 1, "user", "a")] * 3
    got = prefix_trie.trie_nodes(*prefix_trie.rebuilt(table(spark, rows)))
    assert {tuple(r) for r in got.collect()} == brute(rows)


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "user", "a") for c in (6, 7, 8, 9, 11, 12, 13)]
    want = brute(rows)
    assert any(not seq for seq in paths(rows).values())
    got = prefix_trie.trie_nodes(*prefix_trie.rebuilt(table(spark, rows)))
    assert {tuple(r) for r in got.collect()} == want


def test_no_conversations_no_nodes(spark):
    assert prefix_trie.trie_nodes(*prefix_trie.rebuilt(table(spark, []))).count() == 0
