"""Errors, ROC area, correlations and bins against plain NumPy."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from barloom import operators as op
from barloom import plans

DDL = "model string, Stock string, Date timestamp, actual double, predicted double"


def _preds(spark, groups):
    start = datetime(2020, 1, 1)
    rows = [
        ("m", symbol, start + timedelta(days=i), float(a), float(p))
        for symbol, pairs in groups.items()
        for i, (a, p) in enumerate(pairs)
    ]
    return spark.createDataFrame(rows, DDL)


def _values(df):
    return {r.Stock: r.value for r in df.collect()}


def _brute_auc(pairs):
    pos = [p for a, p in pairs if a == 1]
    neg = [p for a, p in pairs if a == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("slices", [2, 5, 64])
def test_auc(spark, slices):
    rng = np.random.default_rng(1)
    groups = {
        "distinct": [(int(rng.random() < 0.4), rng.normal()) for _ in range(300)],
        "ties": [(int(rng.random() < 0.4), int(rng.integers(0, 6))) for _ in range(300)],
        "skewed": [(int(rng.random() < 0.4), np.exp(9 * rng.normal())) for _ in range(300)],
        "constant": [(i % 2, 1.0) for i in range(20)],
    }
    preds = _preds(spark, {**groups, "one_class": [(1, 0.3)], "prices": [(17.5, 0.2), (0, 1)]})
    got = _values(op.auc(preds, slices))
    for name, pairs in groups.items():
        assert got[name] == pytest.approx(_brute_auc(pairs), abs=1e-12)
        ml = BinaryClassificationEvaluator(
            rawPredictionCol="predicted", labelCol="actual", numBins=0
        ).evaluate(preds.filter(preds.Stock == name))
        assert got[name] == pytest.approx(ml, abs=1e-9)
    assert got["one_class"] is None and got["prices"] is None


def test_errors_weigh_every_row_alike(spark):
    rng = np.random.default_rng(2)
    pairs = [(rng.random(), rng.random()) for _ in range(65)]  # a batch of 64 and one of 1
    a, p = np.array(pairs).T
    preds = _preds(spark, {"A": pairs})
    assert _values(op.mse(preds))["A"] == pytest.approx(np.mean((p - a) ** 2))
    assert _values(op.rmse(preds))["A"] == pytest.approx(np.sqrt(np.mean((p - a) ** 2)))
    assert _values(op.accuracy(preds))["A"] == pytest.approx(np.mean((p > 0.5) == (a > 0.5)))


def test_correlations(spark):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(50, 3)) @ rng.normal(size=(3, 3))
    rows = [("A", *map(float, r), 4.0) for r in data] + [("A", None, 1.0, 2.0, 4.0)]
    df = spark.createDataFrame(rows, "Stock string, a double, b double, c double, k double")
    got = {(r.col_i, r.col_j): r.r for r in op.corr_pairs(df, ["a", "b", "c", "k"]).collect()}
    want = np.corrcoef(data.T)
    for i, x in enumerate("abc"):
        for j, y in enumerate("abc"):
            assert got[x, y] == pytest.approx(want[i, j])
        assert got[x, "k"] is None and got["k", x] is None
    assert got["k", "k"] is None
    upper = op.corr_pairs(df, ["a", "b", "c"], upper=True, digits=3).collect()
    assert {(r.col_i, r.col_j) for r in upper} == {("a", "b"), ("a", "c"), ("b", "c")}
    assert all(r.r == round(r.r, 3) for r in upper)


def test_histogram_and_scatter_bins(spark):
    rng = np.random.default_rng(4)
    data = rng.normal(size=(200, 2))
    rows = [("A", *map(float, r), 1.0) for r in data]
    df = spark.createDataFrame(rows, "Stock string, x double, y double, k double")
    got = {(r.column, r.bin): r.n for r in op.histogram(df, ["x", "y", "k"], 7).collect()}
    for i, c in enumerate("xy"):
        want, _ = np.histogram(data[:, i], 7)
        assert [got.get((c, b), 0) for b in range(7)] == list(want)
    assert got["k", 0] == 200
    grid = {(r.bin_x, r.bin_y): r.n for r in op.bins2d(df, ["x", "y"], 7).collect()}
    want, _, _ = np.histogram2d(data[:, 0], data[:, 1], 7)
    assert [[grid.get((i, j), 0) for j in range(7)] for i in range(7)] == want.tolist()


def test_density(spark):
    rng = np.random.default_rng(5)
    data = rng.gamma(2.0, size=400)
    rows = [("A", float(v), 1.0) for v in data]
    df = spark.createDataFrame(rows, "Stock string, x double, k double")
    got = op.density(df, ["x", "k"], points=40, bins=512).orderBy("x").collect()
    assert len(got) == 40 and {r.column for r in got} == {"x"}
    h = data.std(ddof=1) * len(data) ** -0.2
    for r in got:
        exact = np.mean(np.exp(-(((r.x - data) / h) ** 2) / 2)) / (h * np.sqrt(2 * np.pi))
        assert r.density == pytest.approx(exact, abs=2e-4)
    assert [got[0].x, got[-1].x] == pytest.approx([data.min(), data.max()])


def test_leaderboard_and_suggestions(spark):
    metrics = spark.createDataFrame(
        [("a", "X", "rmse", 2.0), ("b", "X", "rmse", 1.0), ("a", "X", "auc", 0.9),
         ("b", "X", "auc", 0.7), ("c", "X", "auc", 0.9)],
        "model string, Stock string, metric string, value double",
    )
    ranks = {(r.model, r.metric): r["rank"] for r in plans.leaderboard(metrics).collect()}
    assert ranks == {
        ("a", "rmse"): 2, ("b", "rmse"): 1, ("a", "auc"): 1, ("c", "auc"): 1, ("b", "auc"): 3,
    }
    preds = _preds(
        spark,
        {
            "UP": [(10, 99)] * 30 + [(10, 10), (10, 11), (10, 12)],
            "FLAT": [(10, 0)] * 30 + [(10, 10), (10, 10), (10, 10)],
            "DOWN": [(10, 50)] * 30 + [(10, 10), (10, 9), (10, 9)],
        },
    )
    best = plans.suggest(preds, n_days=3, k=2).orderBy("rank").collect()
    assert [r.Stock for r in best] == ["UP", "FLAT"]
    assert best[0].mean_return == pytest.approx(0.1) and best[0].n_rows == 3
    # The previous actual may lie before the span, and in an earlier chunk.
    for chunk_days in (1, 7, 1024):
        last = plans.suggest(preds, n_days=1, k=3, chunk_days=chunk_days).orderBy("rank").collect()
        assert [(r.Stock, r.n_rows) for r in last] == [("UP", 1), ("FLAT", 1), ("DOWN", 1)]
        assert [r.mean_return for r in last] == pytest.approx([0.2, 0.0, -0.1])
