"""Both vector operators against all cosines."""

import numpy as np
import pytest

from barloom.llm import cross_polytope, rp_forest, vectors

DDL = "vec_id long, embedding array<float>, label int"


def cosines(rows):
    x = np.array([r[1] for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x @ x.T


def brute_links(rows, least=0.98):
    """``{vec_id: (n_links, component)}`` of usable rows."""
    near = cosines(rows) >= least
    labels = np.array([r[2] for r in rows])
    near &= labels[:, None] == labels[None, :]
    np.fill_diagonal(near, False)
    ids = np.array([r[0] for r in rows])
    group = ids.copy()
    while True:
        new = np.array([min([group[i], *group[near[i]]]) for i in range(len(ids))])
        if (new == group).all():
            break
        group = new
    return {int(i): (int(near[k].sum()), int(group[k])) for k, i in enumerate(ids)}


def clusters(seed, n=400, size=60, dimension=16):
    """Random vectors, a large group of near copies, a group of copies, a chain."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dimension))
    centre = rng.standard_normal(dimension)
    x[:size] = centre + 0.12 * rng.standard_normal((size, dimension))
    x[size : 2 * size] = x[size]
    for i in range(2 * size, 2 * size + 20):
        x[i + 1] = x[i] + 0.17 * rng.standard_normal(dimension)
    labels = rng.integers(0, 2, n)
    order = rng.permutation(n)
    return [(int(order[i]), [float(v) for v in np.float32(x[i])], int(labels[i])) for i in range(n)]


@pytest.mark.parametrize("seed,leaf,block", [(0, 1000, 1500), (1, 20, 1500), (2, 20, 25), (3, 4, 10)])
def test_links_and_groups(spark, seed, leaf, block):
    rows = clusters(seed)
    want = brute_links(rows)
    found = rp_forest.near_vectors(spark.createDataFrame(rows, DDL), leaf=leaf, block=block).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in found} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)
    assert max(n for n, _ in want.values()) > 25


def test_pairs_near_a_cut_go_to_both_sides():
    rng = np.random.default_rng(4)
    x = vectors.unit(rng.standard_normal((2000, 32)))
    y = vectors.unit(x + 0.13 / np.sqrt(32) * rng.standard_normal(x.shape))
    near = (x * y).sum(axis=1) >= 0.98
    forest = rp_forest.grow(x, 6, 0.98, rp_forest.TREES, 1)
    cells = [set() for _ in range(4000)]
    for row, tree, leaf in zip(*forest.leaves(np.concatenate([x, y]))):
        cells[row].add((tree, leaf))
    assert near.sum() > 1500
    met = np.array([bool(cells[i] & cells[2000 + i]) for i in range(2000)])
    assert met[near].all()
    assert len({c for own in cells for c in own}) > 5 * 40


BAD = [
    (900, None, 1),
    (901, [0.0] * 16, 1),
    (902, [float("nan")] * 16, 1),
    (903, [float("inf")] + [1.0] * 15, 1),
    (904, [None] + [1.0] * 15, 1),
]


def test_unusable_vectors_and_missing_labels(spark):
    rows = clusters(5)
    more = [(910, rows[0][1], None), (None, rows[0][1], rows[0][2])]
    frame = spark.createDataFrame(rows + BAD + more, DDL).selectExpr("*", "1 AS node", "2 AS cell", "3 AS block")
    found = rp_forest.near_vectors(frame).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}
    want = {i: (n, c, c == i) for i, (n, c) in brute_links(rows).items()}
    want |= {i: (0, i, True) for i in (900, 901, 902, 903, 904, 910)} | {None: (0, None, False)}
    assert got == want and len(found) == len(rows) + 7


def test_no_vectors(spark):
    for rows in ([], BAD[:2]):
        found = rp_forest.near_vectors(spark.createDataFrame(rows, DDL)).collect()
        assert [(r.vec_id, r.n_links, r.kept) for r in found] == [(r[0], 0, True) for r in rows]


def test_vectors_scaled_far(spark):
    rows = [(1, [1e30, 2e30], 0), (2, [1e-30, 2e-30], 0), (3, [-1.0, -2.0], 0), (4, [2.0, 4.0], 0)]
    found = rp_forest.near_vectors(spark.createDataFrame(rows, DDL)).collect()
    assert {r.vec_id: r.n_links for r in found} == {1: 2, 2: 2, 3: 0, 4: 2}


def brute_nearest(rows, asked, k=5):
    s, out = cosines(rows), {}
    ids = [r[0] for r in rows]
    for i, own in enumerate(ids):
        if own in asked:
            order = sorted((j for j in range(len(ids)) if ids[j] != own), key=lambda j: (-round(s[i, j], 12), ids[j]))
            out[own] = [(ids[j], s[i, j]) for j in order[:k]]
    return out


def test_hadamard():
    x = np.random.default_rng(0).standard_normal((3, 8))
    h = np.array([[1.0]])
    for _ in range(3):
        h = np.block([[h, h], [h, -h]])
    assert np.allclose(cross_polytope.hadamard(x), x @ h / np.sqrt(8))


def test_keys_are_the_nearest_signed_axes():
    own = cross_polytope.Polytopes(16, 3, 2)
    x = vectors.unit(np.random.default_rng(1).standard_normal((50, 16)))
    for table in range(3):
        want = np.zeros(50, dtype=int)
        for number in range(2):
            y = own.rotated(x, table, number)
            axes = np.concatenate([np.eye(16), -np.eye(16)])
            best = (y @ axes.T).argmax(axis=1)
            want = want * 32 + 2 * (best % 16) + best // 16
        assert (own.keys(x, table) == want).all()
    row, table, bucket = own.probes(x, 6)
    assert all((own.keys(x, t)[r] in bucket[(row == r) & (table == t)]) for r in (0, 7) for t in set(table[row == r]))


@pytest.mark.parametrize("hashes,probes", [(1, 128), (2, 2000)])
def test_recall_on_the_table(spark, sf_dir, hashes, probes):
    frame = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [tuple(r) for r in frame.collect()]
    asked = {r[0] for r in rows if r[0] % 50 == 0}
    want = brute_nearest(rows, asked)
    found = cross_polytope.nearest(frame, frame.where("vec_id % 50 = 0"), hashes=hashes, probes=probes)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    s = {i: dict(brute_nearest(rows, {i}, len(rows))[i]) for i in list(asked)[:5]}
    for i, near in s.items():
        assert all(abs(near[v] - score) < 1e-12 for v, score in got[i])
    recall = np.mean([len({v for v, _ in got[i]} & {v for v, _ in want[i]}) / 5 for i in asked])
    assert recall >= (0.9 if hashes == 1 else 0.6)


def test_copies_ties_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(cross_polytope, "BLOCK", 15)
    rows = [(r[0], r[1]) for r in clusters(6)]
    asked = {r[0] for r in rows if r[0] % 50 == 0}
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = cross_polytope.nearest(frame, frame.where("vec_id % 50 = 0"), probes=16 * 32)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = {i: [v for v, _ in near] for i, near in brute_nearest(rows, asked).items()}
    assert got == want


def test_few_and_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (7, [0.0, 2.0]), (None, [1.0, 0.0]), (100, None), (150, [0.0, 0.0])]
    rows += [(50, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS table")
    found = cross_polytope.nearest(frame, frame.where("vec_id % 50 = 0"), probes=64)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect())
    assert got == [(0, 1, 50, 1.0), (0, 2, 7, 0.0), (50, 1, 0, 1.0), (50, 2, 7, 0.0)]
    empty = frame.limit(0)
    assert cross_polytope.nearest(empty, empty).count() == 0
    assert cross_polytope.nearest(frame, empty).count() == 0


@pytest.mark.parametrize("count", [1, 3, 7, 10, 14])
def test_small_tables_give_all_candidates(spark, count):
    """Probes alone meet too few of so few vectors."""
    rng = np.random.default_rng(count)
    rows = [(i, rng.normal(size=64).tolist()) for i in range(count)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = cross_polytope.nearest(vectors, vectors).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in range(count):
        order = [j for j in np.argsort(-(x @ x[i])) if j != i][:5]
        assert len(got.get(i, [])) == len(order)
        if count <= 6:  # all there are; of more, the five need not be the nearest
            assert got.get(i, []) == order


def test_a_hot_cluster_is_not_copied_down_the_tree():
    """64 dimensions, a third of the rows in one cluster: no link lost, at 57 copies a row (still many)."""
    rng = np.random.default_rng(0)
    n, hot = 9_000, 3_000
    x = rng.normal(size=(n, 64))
    x[:hot] = x[0] / np.linalg.norm(x[0]) + rng.normal(size=(hot, 64)) * 0.14 / 8
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    forest = rp_forest.grow(x, 6, 0.98, rp_forest.TREES, 1)
    row, cell = forest.cells(x)
    assert np.bincount(row, minlength=n)[:hot].mean() < 64  # 2 ** depth in one tree, if every level split it
    some = rng.choice(hot, 400, replace=False)
    near = x[some] @ x[some].T >= 0.98
    leaves = [set(cell[row == r].tolist()) for r in some]
    lost = sum(not leaves[i] & leaves[j] for i, j in zip(*np.nonzero(near)) if i < j)
    assert lost == 0
