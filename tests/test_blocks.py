"""Forests as tables, recurrent nets, and training by blocks."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from barloom import operators as op
from barloom import plans
from barloom.models import (
    fit_forests,
    fit_gated_net,
    fit_per_symbol,
    fit_recurrent_net,
    forest,
    load_forests,
    save_forests,
    score_forests,
    score_net,
    score_per_symbol,
    shards,
)
from barloom.models.kernels import GatedCells, RecurrentCells, views
from barloom.models.shards import _train_stream, train_shard
from barloom.models.trees import best_cuts, bootstrap
from barloom.plans import PRICE_FEATURES
from barloom.schema import staged
from barloom.testdata import orders_bars


@pytest.fixture(scope="module")
def features(spark, sf_dir):
    return staged(plans.price_features(orders_bars(spark, sf_dir)))


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_forests_reload_and_do_not_depend_on_layout_or_other_symbols(spark, features, tmp_path):
    forests = fit_forests(features, PRICE_FEATURES, trees=7)
    path = str(tmp_path / "forests")
    save_forests(forests, path)
    again = load_forests(spark, path)
    assert _sorted(again.select(*forests.columns)) == _sorted(forests)
    some = features.filter("Stock IN ('2-HIGH', '5-LOW')").repartition(5, "label")
    moved = fit_forests(some, PRICE_FEATURES, trees=7)
    assert _sorted(moved) == _sorted(forests.filter("Stock IN ('2-HIGH', '5-LOW')"))
    test = features.filter("NOT is_train")
    scored = score_forests(again, test, PRICE_FEATURES, "label")
    assert scored.count() == test.count()
    assert score_forests(again, test.drop("label"), PRICE_FEATURES).filter("actual IS NULL").count() == test.count()
    whole = forests.groupBy("Stock", "tree").agg(F.count("left").alias("inner"), F.count("*").alias("n"))
    assert whole.filter("n <> 2 * inner + 1").count() == 0 and whole.count() == 35


def test_forests_err_as_little_as_one_fit_a_symbol(features):
    forests = fit_forests(features, PRICE_FEATURES)
    scored = score_forests(forests, features.filter("NOT is_train"), PRICE_FEATURES, "label")
    ours = {r.Stock: r.value for r in op.rmse(plans.predictions(scored, "f", "actual", "predicted")).collect()}
    table = staged(features, "Stock")
    fitted = fit_per_symbol(table, forest(PRICE_FEATURES))
    theirs = {r.Stock: r.value for r in op.rmse(score_per_symbol(fitted.models, table, "f")).collect()}
    assert set(ours) == set(theirs)
    assert np.mean([ours[s] / theirs[s] for s in ours]) < 1.05


def test_a_tree_without_a_cut_and_a_symbol_of_one_row(make_bars):
    rows = plans.price_features(make_bars([("A", d, 5.0) for d in range(20)] + [("B", 0, 1.0)]))
    forests = fit_forests(rows, PRICE_FEATURES, trees=3)
    assert {(r.Stock, r.node, r.value) for r in forests.collect()} == {("A", 0, 5.0)}
    with pytest.raises(Exception, match="gini needs labels 0 and 1"):
        fit_forests(rows, PRICE_FEATURES, trees=1, impurity="gini")
    with pytest.raises(Exception, match="a feature has NULL or NaN"):
        fit_forests(rows.withColumn("SMA", F.lit(None).cast("double")), PRICE_FEATURES, trees=1).count()


def test_best_cut_is_that_of_gini_for_labels_of_two_kinds():
    rng = np.random.default_rng(0)
    for _ in range(50):
        w, s = np.zeros((2, 3, 2, 8), np.int64)
        for node, label, *bins in rng.integers(0, [3, 2, 8, 8], (60, 4)):
            for f in range(2):
                w[node, f, bins[f]] += 1
                s[node, f, bins[f]] += label
        place, cut = best_cuts(w, s)
        for node in range(3):
            best = {}
            for f in range(2):
                for c in range(7):
                    left, right = (w[node, f, : c + 1].sum(), s[node, f, : c + 1].sum()), (w[node, f, c + 1 :].sum(), s[node, f, c + 1 :].sum())
                    if left[0] and right[0]:
                        best[f, c] = -sum(n * 2 * (k / n) * (1 - k / n) for n, k in (left, right))
            if place[node] >= 0:
                assert best[place[node], cut[node]] == pytest.approx(max(best.values()))


def test_bootstrap_draws_like_poisson():
    drawn = bootstrap(np.random.default_rng(0).integers(-(2**62), 2**62, 20_000), 20, 1)
    assert drawn.mean() == pytest.approx(1, abs=0.01) and drawn.var() == pytest.approx(1, abs=0.02)
    assert abs(np.corrcoef(drawn.T) - np.eye(20)).max() < 0.05


@pytest.mark.parametrize("kernel", [RecurrentCells(2, 4, 5), RecurrentCells(1, 3, 2)])
def test_gradient_through_time_is_the_derivative(kernel):
    rng = np.random.default_rng(0)
    inputs = kernel.steps * 4
    shapes, size = kernel.shapes(inputs), len(kernel.start(inputs, 0))
    assert size == sum(math.prod(s) for _, s in shapes)
    theta = rng.normal(size=size) * 0.5
    x, y = rng.normal(size=(6, kernel.steps, 4)), rng.normal(size=6)
    x[:, :, 3] = 1
    x[0, :-1, 3] = x[1, 0, 3] = 0  # steps before the first row
    x = x.reshape(6, -1)

    def loss(t):
        return np.mean((kernel.forward(views(t, shapes), x)[0] - y) ** 2)

    grad = np.zeros(size)
    out, cache = kernel.forward(views(theta, shapes), x)
    kernel.backward(views(theta, shapes), cache, 2 * (out - y) / 6, views(grad, shapes))
    for i in range(size):
        step = np.zeros(size)
        step[i] = 1e-6
        slope = (loss(theta + step) - loss(theta - step)) / 2e-6
        assert grad[i] == pytest.approx(slope, abs=1e-7)


def test_one_step_is_the_gated_net():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(60, 3)), rng.normal(size=60)
    out = []
    for kernel, rows in ((GatedCells(2, 4), x), (RecurrentCells(2, 4, 1), np.column_stack([x, np.ones(60)]))):
        theta = kernel.start(rows.shape[1], 3)
        state = np.concatenate([theta, np.zeros(2 * len(theta))])
        _, _, squared, _ = train_shard(kernel, rows, y, state, 0, 1e-2, 8, 5, [1], 0.0)
        out.append(squared)
    assert out[0] == pytest.approx(out[1], rel=1e-4)


def test_recurrent_net_scores_new_rows_and_uses_the_rows_before(spark, features, tmp_path):
    options = {"steps": 4, "hidden": 8, "epochs": 12, "lr": 5e-3, "sync_epochs": 6}
    fitted = fit_recurrent_net(features, PRICE_FEATURES, **options)
    fitted.parameters.write.parquet(str(tmp_path / "net"))
    stored = spark.read.parquet(str(tmp_path / "net"))
    kernel = RecurrentCells(2, 8, 4)
    again = score_net(stored, features, PRICE_FEATURES, kernel, "label", only="NOT is_train")
    assert _sorted(again) == _sorted(fitted.predictions)
    alone = score_net(stored, features.filter("NOT is_train"), PRICE_FEATURES, kernel, "label")
    assert alone.count() == again.count() and _sorted(alone) != _sorted(again)


def _stream(rows, states, sizes):
    """Sorted rows of shards as record batches of the given sizes."""
    table = pa.table({c: [r[i] for r in rows] for i, c in enumerate(("Stock", "_shard", "_row", "_values", "_scale", "_step"))})
    at = 0
    for size in sizes:
        yield from table.slice(at, size).combine_chunks().to_batches()
        at += size


def test_a_task_holds_one_block_whatever_the_batches(monkeypatch):
    monkeypatch.setattr(shards, "BLOCK_ROWS", 16)
    seen = []
    monkeypatch.setattr(shards, "train_shard", lambda *a: seen.append(len(a[1])) or train_shard(*a))
    rng = np.random.default_rng(0)
    rows = []
    for symbol, shard, n in (("A", 0, 50), ("A", 1, 0), ("B", 0, 16), (None, 2, 5)):
        rows.append((symbol, shard, 0, None, [0.0, 0.0, 1.0, 1.0], 0))
        rows += [(symbol, shard, 1, rng.normal(size=2).tolist(), None, None) for _ in range(n)]
    out = []
    for sizes in ([len(rows)], [7] * 11, [1] * len(rows)):
        run = _train_stream(GatedCells(1, 2), 1, 0.5, 1e-2, 4, 3, 1, 0, "Stock")
        out.append([b.to_pydict() for b in run(_stream(rows, None, sizes))])
    assert [(b["Stock"], b["_n"]) for b in out[0]] == [(["A"], [50]), (["B"], [16]), ([None], [5])]
    assert out[0] == out[1] == out[2] and max(seen) == 16
    with pytest.raises(ValueError, match="without the state"):
        list(_train_stream(GatedCells(1, 2), 1, 0.5, 1e-2, 4, 3, 1, 0, "Stock")(_stream(rows[1:], None, [9])))


def test_shards_learn_what_one_shard_learns(make_bars):
    """Early and late rows have different labels; dealt anew each round, four shards agree with one."""
    rows = plans.price_features(make_bars([("A", d, 20.0 + (d > 300) * 10 + d % 5) for d in range(600)]))
    rows = staged(rows.withColumn("is_train", F.col("rn") % 4 != 0))
    options = {"hidden": 8, "epochs": 60, "lr": 1e-2, "batch": 16, "sync_epochs": 3}
    errors = []
    for count in (1, 4):
        fitted = fit_gated_net(rows, PRICE_FEATURES, shards=count, **options)
        errors.append(op.rmse(plans.predictions(fitted.predictions, "n", "actual", "predicted")).first()["value"])
    assert max(errors) < 1.0  # the labels' spread is 5
