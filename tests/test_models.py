"""Fitted models: better than a constant, reloadable, the same on any layout."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from barloom import operators as op
from barloom import plans
from barloom.models import (
    factorization,
    fit_factorization,
    fit_gated_net,
    fit_per_symbol,
    forest,
    load_models,
    save_models,
    score_net,
    score_per_symbol,
    write_scores,
)
from barloom.models.kernels import FactorPairs, GatedCells, products, train_on_moments, views
from barloom.models.shards import train_shard
from barloom.plans import DIRECTION_FEATURES, PRICE_FEATURES
from barloom.schema import staged
from barloom.testdata import orders_bars


@pytest.fixture(scope="module")
def features(spark, sf_dir):
    return staged(plans.price_features(orders_bars(spark, sf_dir)), "Stock")


@pytest.fixture(scope="module")
def spread(features):
    sd = features.filter("NOT is_train").groupBy("Stock").agg(F.stddev("label").alias("sd"))
    return {r.Stock: r.sd for r in sd.collect()}


def _check(preds, features, spread):
    test = features.filter("NOT is_train")
    assert sorted(map(tuple, preds.select("Stock", "Date", "actual").collect())) == sorted(
        map(tuple, test.select("Stock", "Date", "label").collect())
    )
    errors = {r.Stock: r.value for r in op.rmse(preds).collect()}
    assert set(errors) == set(spread)
    for symbol, sd in spread.items():
        assert errors[symbol] < sd, symbol


def _sorted(preds):
    return sorted(map(tuple, preds.collect()))


def test_forest_reload(spark, features, spread, tmp_path):
    fitted = fit_per_symbol(features, forest(PRICE_FEATURES, trees=10))
    assert not fitted.skipped
    preds = score_per_symbol(fitted.models, features, "forest")
    _check(preds, features, spread)
    path = str(tmp_path / "models")
    save_models(fitted.models, spark, path)
    save_models(fitted.models, spark, path)  # replaces
    again = load_models(spark, path)
    assert set(again) == set(spread)
    assert _sorted(score_per_symbol(again, features, "forest")) == _sorted(preds)
    written = write_scores(again, features, "forest", str(tmp_path / "scores"))
    assert written.dtypes == preds.dtypes and _sorted(written) == _sorted(preds)


def test_factorization_reload(spark, features, spread, tmp_path):
    fitted = fit_per_symbol(features, factorization(PRICE_FEATURES, 0.03), scale_label=True)
    preds = score_per_symbol(fitted.models, features, "fm")
    _check(preds, features, spread)
    symbol, model = sorted(fitted.models.items())[0]
    model.write().overwrite().save(str(tmp_path / "fm"))
    again = {symbol: PipelineModel.load(str(tmp_path / "fm"))}
    one = {symbol: model}
    assert _sorted(score_per_symbol(again, features, "fm")) == _sorted(
        score_per_symbol(one, features, "fm")
    )


def test_assembled_vectors(make_bars):
    rows = plans.price_features(make_bars([("A", d, 10.0 + d) for d in range(5)]))
    for r in plans.assemble(rows, PRICE_FEATURES).collect():
        assert list(r.features) == [float(r[c]) for c in PRICE_FEATURES]
    with pytest.raises(Exception, match="null"):
        missing = rows.withColumn("SMA", F.lit(None).cast("double"))
        plans.assemble(missing, PRICE_FEATURES).collect()


def test_symbols_without_train_rows_are_reported(make_bars):
    rows = [("A", d, 10.0 + d % 5) for d in range(30)] + [("B", 0, 5.0)]
    table = staged(plans.price_features(make_bars(rows)), "Stock")
    fitted = fit_per_symbol(table, forest(PRICE_FEATURES, trees=2), symbols=["A", "B", "C"])
    assert set(fitted.models) == {"A"}
    assert fitted.skipped == {"B": "0 train rows, 2 needed", "C": "0 train rows, 2 needed"}


@pytest.mark.parametrize("kernel", [GatedCells(2, 4), GatedCells(1, 3), FactorPairs(4, 0.3)])
def test_gradient_is_the_derivative(kernel):
    rng = np.random.default_rng(0)
    shapes = kernel.shapes(3)
    size = len(kernel.start(3, 0))
    assert size == sum(math.prod(s) for _, s in shapes)
    theta = rng.normal(size=size) * 0.5
    x, y = rng.normal(size=(6, 3)), rng.normal(size=6)

    def loss(t):
        out, _ = kernel.forward(views(t, shapes), x)
        return np.mean((out - y) ** 2)

    grad = np.zeros(size)
    params = views(theta, shapes)
    out, cache = kernel.forward(params, x)
    kernel.backward(params, cache, 2 * (out - y) / 6, views(grad, shapes))
    for i in range(size):
        step = np.zeros(size)
        step[i] = 1e-6
        slope = (loss(theta + step) - loss(theta - step)) / 2e-6
        assert grad[i] == pytest.approx(slope, abs=1e-7)


def test_cell_is_an_lstm_cell_of_one_step():
    """Against the full cell equations, with forget gate and recurrent terms."""
    rng = np.random.default_rng(1)
    kernel = GatedCells(1, 5)
    params = views(rng.normal(size=len(kernel.start(3, 0))), kernel.shapes(3))
    x, h0, c0 = rng.normal(size=(4, 3)), np.zeros((4, 5)), np.zeros((4, 5))
    weight, bias, head, head_bias = params
    recurrent, w_f = rng.normal(size=(5, 20)), rng.normal(size=(3, 5))
    sigmoid = lambda z: 1 / (1 + np.exp(-z))
    r_i, r_g, r_o, r_f = np.split(h0 @ recurrent, 4, axis=1)
    z_i, z_g, z_o = np.split(x @ weight + bias, 3, axis=1)
    c = sigmoid(x @ w_f + r_f) * c0 + sigmoid(z_i + r_i) * np.tanh(z_g + r_g)
    h = sigmoid(z_o + r_o) * np.tanh(c)
    out, _ = kernel.forward(params, x)
    assert out == pytest.approx((h @ head + head_bias)[:, 0])


def test_factor_pairs_is_the_sum_over_pairs():
    rng = np.random.default_rng(2)
    kernel = FactorPairs(3)
    bias, linear, factors = params = views(rng.normal(size=17), kernel.shapes(4))
    x = rng.normal(size=4)
    pairs = sum(factors[i] @ factors[j] * x[i] * x[j] for j in range(4) for i in range(j))
    out, _ = kernel.forward(params, x[None])
    assert out[0] == pytest.approx(bias[0] + linear @ x + pairs)


def test_factorization_in_one_job(features, spread):
    fitted = fit_factorization(features, PRICE_FEATURES)
    preds = plans.predictions(fitted.predictions, "fm", "actual", "predicted")
    _check(preds, features, spread)
    one_by_one = fit_per_symbol(features, factorization(PRICE_FEATURES, 0.03), scale_label=True)
    other = op.rmse(score_per_symbol(one_by_one.models, features, "fm")).collect()
    other = {r.Stock: r.value for r in other}
    for r in op.rmse(preds).collect():
        assert r.value < 1.5 * other[r.Stock]


def test_gated_net(spark, features, spread, tmp_path):
    options = {"hidden": 16, "epochs": 30, "lr": 5e-3, "batch": 16}
    fitted = fit_gated_net(features, PRICE_FEATURES, **options)
    preds = plans.predictions(fitted.predictions, "net", "actual", "predicted")
    _check(preds, features, spread)

    history = fitted.history.orderBy("Stock", "epoch").collect()
    assert len(history) == 30 * len(spread)
    assert all(r.rmse == pytest.approx(math.sqrt(r.loss)) for r in history)
    assert history[29].loss < history[0].loss

    shapes = GatedCells(2, 16).shapes(len(PRICE_FEATURES))
    fitted.parameters.write.parquet(str(tmp_path / "parameters"))
    stored = spark.read.parquet(str(tmp_path / "parameters"))
    table = fitted.parameters.filter(F.col("Stock") == history[0].Stock).collect()
    assert sorted(stored.collect()) == sorted(fitted.parameters.collect())
    assert [(r.name, tuple(r.shape)) for r in table[: len(shapes)]] == shapes
    assert [r.name for r in table[len(shapes) :]] == ["scale.mean", "scale.sd"]
    assert all(len(r["values"]) == math.prod(r.shape) for r in table)

    moved = fit_gated_net(features.repartition(5), PRICE_FEATURES, **options)
    close = fitted.predictions.alias("a").join(moved.predictions.alias("b"), ["Stock", "Date"])
    worst = close.select(F.max(F.abs(F.col("a.predicted") / F.col("b.predicted") - 1))).first()[0]
    assert worst < 1e-6


def test_gated_net_in_shards(features, spread):
    """A symbol trains in many tasks and still learns."""
    fitted = fit_gated_net(
        features, PRICE_FEATURES, hidden=16, epochs=30, lr=5e-3, batch=8, shards=6, sync_epochs=5
    )
    preds = plans.predictions(fitted.predictions, "net", "actual", "predicted")
    _check(preds, features, spread)
    assert fitted.history.count() == 30 * len(spread)
    assert fitted.parameters.select("Stock").distinct().count() == len(spread)


def _history(make_bars, sizes):
    rng = np.random.default_rng(3)
    rows = [(s, d, float(20 + rng.integers(0, 900) / 100)) for s, n in sizes.items() for d in range(n)]
    return plans.price_features(make_bars(rows))


def _of(preds, symbol):
    return sorted(tuple(r) for r in preds.filter(F.col("Stock") == symbol).collect())


@pytest.mark.parametrize("fit", ["net", "factorization"])
def test_a_model_does_not_depend_on_other_symbols(make_bars, fit):
    def train(sizes):
        rows = staged(_history(make_bars, sizes))
        if fit == "factorization":
            return fit_factorization(rows, PRICE_FEATURES, epochs=20)
        return fit_gated_net(rows, PRICE_FEATURES, hidden=8, epochs=12, batch=16, sync_epochs=5)

    one, other = train({"A": 100, "B": 60}), train({"A": 100, "B": 900, "C": 5})
    # Sums of parts come in any order, which shows in the last digits.
    pairs = zip(_of(one.predictions, "A"), _of(other.predictions, "A"), strict=True)
    assert all(a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-10) for a, b in pairs)
    assert len(_of(other.predictions, "B")) == 270


def test_factorization_is_the_same_in_any_number_of_shards(make_bars):
    rows = staged(_history(make_bars, {"A": 400, "B": 30}))
    want = None
    for shards in (1, 3, 8):
        fitted = fit_factorization(rows, PRICE_FEATURES, shards=shards, epochs=60)
        got = [r[3] for r in sorted(map(tuple, fitted.predictions.collect()))]
        want = want or got
        assert got == pytest.approx(want, rel=1e-9)


def test_moments_give_the_gradient_of_the_rows():
    rng = np.random.default_rng(4)
    kernel, x, y = FactorPairs(3), rng.normal(size=(50, 4)), rng.normal(size=50)
    z = np.column_stack([products(x), y])
    theta, losses = train_on_moments(kernel, (z.T @ z).ravel(), 50, 4, 0.05, 40, 7)
    state = np.concatenate([kernel.start(4, 7), np.zeros(2 * len(kernel.start(4, 7)))])
    plain, _, squared, _ = train_shard(kernel, x, y, state, 0, 0.05, None, 40, [1], 0.0)
    assert theta == pytest.approx(plain[: len(theta)], abs=1e-6)
    assert losses == pytest.approx([s / 50 for s in squared], rel=1e-6)


def test_forest_does_not_depend_on_the_layout(features):
    options = {"symbols": ["2-HIGH"]}
    a = fit_per_symbol(features, forest(PRICE_FEATURES, trees=5), **options).models
    moved = features.repartition(7, "label")
    b = fit_per_symbol(moved, forest(PRICE_FEATURES, trees=5), **options).models
    assert _sorted(score_per_symbol(a, features, "f")) == _sorted(score_per_symbol(b, features, "f"))


def test_a_stored_net_scores_new_rows(spark, features, tmp_path):
    fitted = fit_gated_net(features, PRICE_FEATURES, hidden=8, epochs=10, batch=16)
    fitted.parameters.write.parquet(str(tmp_path / "net"))
    stored = spark.read.parquet(str(tmp_path / "net"))
    kernel = GatedCells(2, 8)
    test = features.filter("NOT is_train")
    again = score_net(stored, test, PRICE_FEATURES, kernel, "label")
    assert _sorted(again) == _sorted(fitted.predictions)
    unlabelled = score_net(stored, test.drop("label"), PRICE_FEATURES, kernel)
    assert unlabelled.filter("actual IS NULL").count() == test.count()


def test_no_models_give_an_empty_table(spark, features, tmp_path):
    preds = score_per_symbol({}, features, "none")
    assert preds.count() == 0
    written = write_scores({}, features, "none", str(tmp_path / "scores"))
    assert written.count() == 0 and written.columns == preds.columns
    save_models({}, spark, str(tmp_path / "models"))
    assert load_models(spark, str(tmp_path / "models")) == {}


def test_scores_of_an_earlier_run_stay_out(features, tmp_path):
    fitted = fit_per_symbol(features, forest(PRICE_FEATURES, trees=2)).models
    path = str(tmp_path / "scores")
    assert write_scores(fitted, features, "f", path).select("Stock").distinct().count() == len(fitted)
    one = dict([sorted(fitted.items())[0]])
    assert {r.Stock for r in write_scores(one, features, "f", path).collect()} == set(one)


def test_direction_net_scores(spark, sf_dir):
    rows = op.hash_split(plans.direction_features(orders_bars(spark, sf_dir)), [0.7, 0.3])
    rows = rows.withColumn("is_train", F.col("split") == 0)
    fitted = fit_gated_net(
        rows, DIRECTION_FEATURES, "target", cells=1, hidden=8, lr=5e-3, batch=8, epochs=10,
        scale_label=False,
    )
    preds = plans.predictions(fitted.predictions, "net", "actual", "predicted")
    assert all(0.5 < r.value <= 1 for r in op.auc(preds).collect())
    assert all(0.4 < r.value <= 1 for r in op.accuracy(preds).collect())


def test_compare_models(features):
    fitted = fit_per_symbol(features, forest(PRICE_FEATURES, trees=5))
    preds = score_per_symbol(fitted.models, features, "forest").unionByName(
        plans.naive_predictions(features, ["SMA"])
    )
    board = plans.leaderboard(op.rmse(preds))
    assert {r["rank"] for r in board.collect()} == {1, 2}
