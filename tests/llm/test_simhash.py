"""SimHash groups against fingerprints and links computed pair by pair."""

import re
from collections import Counter

import xxhash

from barloom.llm import simhash
from barloom.llm.components import components

DDL = "doc_id long, text string, lang string"


def plain_fingerprint(text, words=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    parts = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def smallest(ids, linked):
    """Union-find over all pairs of ``ids``."""
    of = {i: i for i in ids}

    def root(i):
        while of[i] != i:
            i = of[i]
        return i

    ids = sorted(of)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if linked(a, b):
                x, y = root(a), root(b)
                of[max(x, y)] = min(x, y)
    return {i: root(i) for i in ids}


def test_components_of_chains_stars_and_random_graphs(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 60)]
    links += [((i * 7919) % 400 + 1000, (i * 104729) % 400 + 1000) for i in range(250)]
    links += [(5, 5), (900, 901), (901, 900)]
    given = links + [(None, 3), (4, None)]
    found = {r.node: r.component for r in components(spark.createDataFrame(given, "a long, b long")).collect()}
    pairs = {frozenset(p) for p in links if p[0] != p[1]}
    want = smallest({n for p in pairs for n in p}, lambda a, b: frozenset((a, b)) in pairs)
    assert found == want


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints_and_groups_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    want = smallest(texts, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    rows = simhash.simhash_groups(docs).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in rows} == want
    assert max(Counter(want.values()).values()) > 1


def test_links_at_every_distance(spark):
    near = [0, 1, 3, 7, 1 << 63, (1 << 63) | 6, 0xFF00, 0xFF01, 0xFF03]
    signed = [(n - (1 << 64) if n >> 63 else n, i) for i, n in enumerate(near)]
    prints = spark.createDataFrame(signed, "fp long, node long")
    for bits in (1, 2, 3, 4):
        found = simhash.near_links(prints, bits)
        assert found.where("a = b").count() == 0
        got = {r.node: r.component for r in components(found).collect()}
        want = smallest(range(len(near)), lambda a, b: (near[a] ^ near[b]).bit_count() <= bits)
        assert {i: got.get(i, i) for i in want} == want


def test_odd_rows(spark):
    long = "word other " * 50_000
    rows = [
        (1, None, None),
        (2, "", "en"),
        (3, " \t\r\n", "en"),
        (4, "One two", "en"),
        (5, "one  TWO", None),
        (7, long, "en"),
        (6, long + "end", "en"),
        (9, "É one é", "fr"),
        (9, "É one é", "fr"),
        (None, "one two", "en"),
        (None, None, None),
    ]
    frame = spark.createDataFrame(rows, DDL).selectExpr("*", "1 AS fp", "2 AS component_id", "3 AS node")
    found = simhash.simhash_groups(frame)
    assert found.columns == ["doc_id", "fp", "fingerprint", "component_id"]
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in found.collect()), key=repr)
    prints = {i: plain_fingerprint(t) for i, t, _ in rows if i is not None}
    group = smallest(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2) | {None: None}
    assert group[3] == 1 and group[5] == 4 and prints[6] != prints[7]
    want = [(i, f"{plain_fingerprint(t):016x}", group[i]) for i, t, _ in rows]
    assert got == sorted(want, key=repr)
    kept = simhash.drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, *sorted(set(group.values()) - {None})]


def test_empty_table(spark):
    empty = spark.createDataFrame([], DDL)
    assert simhash.simhash_groups(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_a_repeated_id_keeps_its_different_texts(spark):
    rows = [(1, "one two three four"), (1, "five six seven eight"), (2, "nine ten eleven twelve"), (2, "nine ten eleven twelve")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = simhash.drop_near_duplicates(docs)
    assert sorted(map(tuple, kept.collect())) == sorted(set(rows))
