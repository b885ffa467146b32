"""

Every query runs over whole tables. The bars come from the supplied tables:
orders (symbol = order priority, daily), lineitem joined with part (symbol = brand,
daily) and events (symbol = event type, hourly). Model fits have no SQL form and are
checked in ``tests/`` instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import functions as fn
from barloom import operators as op
from barloom import plans
from barloom import sources
from barloom import testdata
from barloom.models import (
    FactorPairs,
    GatedCells,
    RecurrentCells,
    factorization,
    fit_factorization,
    fit_forests,
    fit_gated_net,
    fit_per_symbol,
    fit_recurrent_net,
    forest,
    load_forests,
    load_models,
    save_forests,
    save_models,
    score_forests,
    score_net,
    score_per_symbol,
    write_scores,
)
from barloom.plans import DIRECTION_FEATURES, PRICE_FEATURES
from barloom.schema import configure, epoch_seconds, shared_dir, staged

ENTRY_DIR = "/root/testdata/sf0.001"
COLUMNS = ["Open", "High", "Low", "Close", "Volume"]


def _day(df: DataFrame) -> DataFrame:
    return df.withColumn("Date", F.to_date("Date"))


def _hour(df: DataFrame) -> DataFrame:
    """Hourly bars are compared by epoch seconds."""
    return df.withColumn("Date", epoch_seconds())


def _on(bars: Callable, plan: Callable, shape: Callable = _day) -> Callable:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shape(plan(bars(configure(spark), sf_dir)))

    return query


def _orders(plan: Callable) -> Callable:
    return _on(testdata.orders_bars, plan)


def _stored_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brand bars rolled up once, for plans that read them more than once."""
    return staged(testdata.brand_bars(spark, sf_dir))


def _brands(plan: Callable) -> Callable:
    return _on(_stored_brands, plan)


def _raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows as unclean bars: repeated dates, missing closes, NaN volumes."""
    orders = testdata.table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderpriority").alias("Stock"),
        F.col("o_orderdate").cast("timestamp").alias("Date"),
        F.when(F.col("o_orderstatus") != "P", F.floor(F.col("o_totalprice") / 1e5).cast("double"))
        .alias("Close"),
        F.when(F.col("o_custkey") % 10 == 0, F.lit(float("nan")))
        .otherwise((F.col("o_custkey") % 3).cast("double"))
        .alias("Volume"),
    )


def _parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates written as day-month-year text; those of status P in another format."""
    orders = testdata.table(configure(spark), sf_dir, "orders")
    time = F.col("o_orderdate").cast("timestamp")
    text = F.when(
        F.col("o_orderstatus") == "P", F.date_format(time, "yyyy/MM/dd")
    ).otherwise(F.date_format(time, "d-M-yyyy"))
    return (
        orders.select("o_orderkey", text.alias("Date"))
        .withColumn("parsed", F.to_date(fn.parse_date("Date")))
        .select("o_orderkey", "Date", "parsed")
    )


def _typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text columns under a raw header, brought to the canonical schema."""
    orders = testdata.orders_bars(configure(spark), sf_dir)
    raw = orders.select(
        "Stock",
        F.date_format("Date", "d-M-yyyy").alias("Date"),
        *[F.col(c).cast("string").alias(c) for c in ("Low", "Open", "Volume", "High", "Close")],
        F.col("Close").cast("string").alias("Adjusted Close"),
    )
    return _day(sources.normalise(raw))


def _upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders, moved by a day, put into the bars: some keys exist, some are new."""
    bars = testdata.orders_bars(configure(spark), sf_dir).select("Stock", "Date", "Close")
    delta = testdata.table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("Stock"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 1 DAY")).alias("Date"),
        F.col("o_totalprice").alias("Close"),
        F.col("o_orderkey").alias("batch"),
    )
    return _day(sources.upsert_bars(bars, delta))


def _except(bars: DataFrame) -> DataFrame:
    split = op.time_split(bars)
    train = split.filter("is_train").select("Stock", "High")
    return op.except_rows(split.select("Stock", "High"), train)


def _sequence(bars: DataFrame) -> DataFrame:
    rows = op.sequence_features(bars, ["Close", "Volume"], 3)
    last = F.col("sequence")
    return rows.select(
        "Stock",
        "Date",
        F.size(last).alias("length"),
        last[0]["Close"].alias("first_close"),
        F.element_at(last, -1)["Close"].alias("last_close"),
        F.aggregate(last, F.lit(0.0), lambda s, x: s + x["Volume"]).alias("volume"),
    )


def _naive(bars: DataFrame) -> DataFrame:
    return plans.naive_predictions(
        plans.price_features(bars), ["SMA", "TP", "DTP14", "Open"]
    )


def _direction_scores(bars: DataFrame) -> DataFrame:
    """Direction scored without a model: the opening price in thousands, so with ties."""
    rows = plans.direction_features(bars).filter(~F.col("is_train"))
    rows = rows.withColumn("score", F.floor(F.col("Open") / 1000))
    return plans.predictions(rows, "open_thousands", "target", "score")


def _spread_signs(bars: DataFrame) -> DataFrame:
    rows = plans.direction_features(bars).filter(~F.col("is_train"))
    rows = rows.withColumn("score", (F.col("diffOpenClose") < 0).cast("int"))
    return plans.predictions(rows, "open_below_close", "target", "score")


def _rounded(df: DataFrame, column: str = "value", digits: int = 6) -> DataFrame:
    return df.withColumn(column, F.round(column, digits))


def _errors(bars: DataFrame) -> DataFrame:
    preds = _naive(bars)
    return op.rmse(preds).unionByName(op.mse(preds))


def _describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    brand_types = testdata.table(configure(spark), sf_dir, "part").select(
        F.col("p_brand").alias("Stock"), F.col("p_type").alias("description")
    )
    bars = testdata.brand_bars(spark, sf_dir)
    return _day(plans.describe(plans.naive_predictions(plans.price_features(bars)), brand_types))


def _fit_and_score(df: DataFrame, estimator, name: str, label: str, **options) -> DataFrame:
    table = staged(df, "Stock")
    fitted = fit_per_symbol(table, estimator, label, **options)
    return score_per_symbol(fitted.models, table, name, label)


def _forest_price(bars: DataFrame) -> DataFrame:
    table = staged(plans.price_features(bars))
    return _forest_scores(table, fit_forests(table, PRICE_FEATURES), PRICE_FEATURES, "label", "random_forest")


def _forest_direction(bars: DataFrame) -> DataFrame:
    table = staged(_direction_rows(bars, 0.8))
    return _forest_scores(table, _fit_direction_forest(table), DIRECTION_FEATURES, "target", "forest_direction")


def _fit_direction_forest(table: DataFrame) -> DataFrame:
    return fit_forests(table, DIRECTION_FEATURES, "target", trees=10, impurity="gini")


def _forest_scores(table: DataFrame, forests: DataFrame, features, label: str, name: str) -> DataFrame:
    scored = score_forests(forests, table.filter(~F.col("is_train")), features, label)
    return plans.predictions(scored, name, "actual", "predicted")


def _forest_per_symbol(bars: DataFrame) -> DataFrame:
    """The same forest by Spark ML, a fit for each symbol."""
    return _fit_and_score(plans.price_features(bars), forest(PRICE_FEATURES), "random_forest", "label")


def _factorization_price(bars: DataFrame) -> DataFrame:
    return _fit_and_score(
        plans.price_features(bars),
        factorization(PRICE_FEATURES, step_size=0.03),
        "factorization",
        "label",
        scale_label=True,
    )


def _net_price(bars: DataFrame):
    return fit_gated_net(plans.price_features(bars), PRICE_FEATURES)


def _fit_direction_net(rows: DataFrame):
    return fit_gated_net(
        rows,
        DIRECTION_FEATURES,
        "target",
        cells=1,
        hidden=16,
        lr=5e-4,
        batch=2,
        epochs=50,
        scale_label=False,
    )


def _net_direction(bars: DataFrame):
    return _fit_direction_net(_direction_rows(bars, 0.7))


def _fit_sequence_net(rows: DataFrame):
    return fit_recurrent_net(rows, PRICE_FEATURES, steps=5, hidden=16, lr=5e-3, epochs=50, sync_epochs=25)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _verdict(test: DataFrame, preds: DataFrame, again: DataFrame, label: str, slack: float = 1.0) -> DataFrame:
    """Per symbol: test rows, predicted rows, whether the error is below ``slack`` times the label's
    spread (the error of a constant) and whether predictions by the reloaded model are the same."""
    both = preds.select("Stock", "Date", "actual", "predicted").join(
        again.select("Stock", "Date", F.col("predicted").alias("again")), ["Stock", "Date"]
    )
    gap = F.col("predicted") - F.col("actual")
    apart = F.abs(F.col("predicted") - F.col("again")) > 1e-9 * (1 + F.abs("predicted"))
    scored = both.groupBy("Stock").agg(
        F.count("predicted").alias("n_predicted"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        (F.count(F.when(apart, 1)) == 0).alias("reload_equal"),
    )
    wanted = test.filter(~F.col("is_train")).groupBy("Stock").agg(
        F.count(F.lit(1)).alias("n_test"), F.stddev_pop(label).alias("sd")
    )
    name = "rmse_below_label_sd" if slack == 1.0 else "rmse_near_label_sd"
    below = F.coalesce(F.col("rmse") < slack * F.col("sd"), F.lit(False)).alias(name)
    return wanted.join(scored, "Stock", "left").select(
        "Stock", "n_test", "n_predicted", below, "reload_equal"
    )


def _checked_models(features: DataFrame, estimator, label: str = "label", **options) -> DataFrame:
    table, spark = staged(features, "Stock"), features.sparkSession
    fitted = fit_per_symbol(table, estimator, label, **options)
    path = _folder(spark, "models")
    save_models(fitted.models, spark, path)
    again = write_scores(load_models(spark, path), table, "again", f"{path}/scores", label)
    return _verdict(table, score_per_symbol(fitted.models, table, "model", label), again, label)


def _checked_forests(features: DataFrame, fit, columns, label: str = "label", slack: float = 1.0) -> DataFrame:
    table, spark = staged(features), features.sparkSession
    forests, path = fit(table), _folder(spark, "forests")
    save_forests(forests, path)
    test = table.filter(~F.col("is_train"))
    first, again = (
        score_forests(f, test, columns, label) for f in (forests, load_forests(spark, path))
    )
    return _verdict(table, first, again, label, slack)


def _checked_net(features: DataFrame, fit, kernel, columns, label: str = "label", slack: float = 1.0) -> DataFrame:
    table, spark = staged(features), features.sparkSession
    fitted, path = fit(table), _folder(spark, "net")
    fitted.parameters.write.parquet(path)
    again = score_net(spark.read.parquet(path), table, columns, kernel, label, only="NOT is_train")
    return _verdict(table, fitted.predictions, again, label, slack)


def _direction_rows(bars: DataFrame, train: float) -> DataFrame:
    rows = op.hash_split(plans.direction_features(bars), [train, 1 - train])
    return rows.withColumn("is_train", F.col("split") == 0)


#: Direction is nearly a coin toss: its error may exceed that of the test rows' own mean by so much.
DIRECTION_SLACK = 1.1


def _net_history(bars: DataFrame) -> DataFrame:
    """Per symbol: epochs, and whether the error fell."""
    history = _net_direction(bars).history
    return history.groupBy("Stock").agg(
        F.count("epoch").alias("epochs"),
        (F.min_by("loss", F.col("epoch")) > F.max_by("loss", F.col("epoch"))).alias("fell"),
        F.max(F.col("accuracy").between(0, 1)).alias("accuracy_in_range"),
    )


def _raw_bars(bars: DataFrame) -> DataFrame:
    """Bars as raw files have them: day-month-year dates, an adjusted close."""
    return bars.select(
        "Stock",
        F.date_format("Date", "d-M-yyyy").alias("Date"),
        "Low",
        "Open",
        "Volume",
        "High",
        "Close",
        F.col("Close").alias("Adj Close"),
    )


def _back_from_csv(bars: DataFrame, infer: bool = False) -> DataFrame:
    spark, path = bars.sparkSession, _folder(bars.sparkSession, "csv")
    _raw_bars(bars).write.partitionBy("Stock").option("header", True).csv(path)
    return sources.read_bars(spark, path, infer=infer, symbol=F.col("Stock"))[0]


def _back_from_json(bars: DataFrame) -> DataFrame:
    """A folder per symbol, whose name is where the symbol comes from."""
    spark, path = bars.sparkSession, _folder(bars.sparkSession, "json")
    raw = bars.select("Stock", F.date_format("Date", "yyyy-MM-dd").alias("Date"), *COLUMNS)
    raw = raw.withColumn("AdjClose", F.col("Close"))
    raw = staged(raw, "Stock")
    for row in raw.select("Stock").distinct().collect():
        own = raw.filter(F.col("Stock") == row["Stock"]).drop("Stock")
        own.write.json(f"{path}/{row['Stock']}-dataset.json")
    return sources.read_bars(spark, f"{path}/*-dataset.json", "json")[0]


def _back_by_file_name(bars: DataFrame) -> DataFrame:
    """A CSV file per symbol (a folder, as Spark writes it), named by it; headers differ in order."""
    spark, path = bars.sparkSession, _folder(bars.sparkSession, "csv")
    raw = staged(_raw_bars(bars), "Stock")
    for i, row in enumerate(raw.select("Stock").distinct().orderBy("Stock").collect()):
        own = raw.filter(F.col("Stock") == row["Stock"]).drop("Stock")
        names = own.columns[i:] + own.columns[:i]
        own.select(*names).write.option("header", True).csv(f"{path}/{row['Stock']}.csv")
    return sources.read_bars(spark, f"{path}/*.csv")[0]


def _put_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``_upsert``, into a stored table; the urgent orders only, so other folders stay."""
    bars = testdata.orders_bars(configure(spark), sf_dir).select("Stock", "Date", "Close")
    path = _folder(spark, "put")
    sources.write_bars(bars, path)
    delta = testdata.table(spark, sf_dir, "orders").filter("o_orderpriority IN ('1-URGENT', '2-HIGH')")
    moved = delta.select(
        F.col("o_orderpriority").alias("Stock"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 1 DAY")).alias("Date"),
        F.col("o_totalprice").alias("Close"),
        F.col("o_orderkey").alias("batch"),
    )
    sources.put_bars(moved, path)
    return _day(spark.read.parquet(path).select("Stock", "Date", "Close"))


def _back_from_parquet(bars: DataFrame) -> DataFrame:
    path = _folder(bars.sparkSession, "bars")
    sources.write_bars(bars.withColumn("AdjClose", F.col("Close")), path)
    return sources.read_bars(bars.sparkSession, path, "parquet")[0]


def _back_from_report(bars: DataFrame) -> DataFrame:
    path = _folder(bars.sparkSession, "report")
    plans.metric_report(_errors(bars), path)
    schema = "model string, Stock string, metric string, value double"
    back = bars.sparkSession.read.csv(path, sep="\t", header=True, schema=schema)
    return _rounded(back, digits=2)


def _from_vectors(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The assembled vector taken apart again."""
    vectors = plans.assemble(rows, columns).withColumn("v", vector_to_array("features"))
    return vectors.select("Stock", "Date", *[F.col("v")[i].alias(c) for i, c in enumerate(columns)])


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the whole price feature table of the orders bars."""
    return _day(plans.price_features(testdata.orders_bars(configure(spark), ENTRY_DIR)))


#: What may be missing; any other failed import is an error.
LLM_MODULES = ("corpus_pipeline", "barloom.llm", "barloom.llm.queries")


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries of the subpackage ``llm`` and the pipeline, if they are there."""
    try:
        import corpus_pipeline
        from barloom.llm.queries import QUERIES
    except ModuleNotFoundError as error:
        if error.name not in LLM_MODULES:
            raise
        return {}
    return QUERIES | {"pipeline": corpus_pipeline.run}


def _llm_oracle_sql() -> dict[str, str]:
    try:
        import corpus_pipeline
        from barloom.llm.queries import ORACLE_SQL
    except ModuleNotFoundError as error:
        if error.name not in LLM_MODULES:
            raise
        return {}
    if corpus_pipeline.ORACLE_SQL is None:
        return dict(ORACLE_SQL)
    return ORACLE_SQL | {"pipeline": corpus_pipeline.ORACLE_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    keep = ["Stock", "Date"]
    same = lambda bars: bars
    return _llm_queries() | {
        # sources and keyed access
        "to_bars": _orders(same),
        "to_bars_brand": _brands(same),
        "to_bars_events": _on(testdata.event_bars, same, _hour),
        "normalise": _typed,
        "parse_dates": _parse_dates,
        "upsert_bars": _upsert,
        "lookup": _orders(
            lambda b: sources.lookup(b, "1-URGENT", "1996-01-01", "1998-12-31")
        ),
        # rows and scalar columns
        "clean": _on(_raw_orders, op.clean),
        "clean_by_key": _on(
            _raw_orders, lambda r: op.clean(r, dedupe="key", order_by=["Close"])
        ),
        "clean_subset": _on(_raw_orders, lambda r: op.clean(r, subset=["Close"])),
        "only_symbols": _orders(lambda b: op.only_symbols(b, ["1-URGENT", "5-LOW"])),
        "with_sec": _orders(lambda b: fn.with_sec(b).select(*keep, "sec")),
        "date_parts": _orders(lambda b: fn.date_parts(b).select(*keep, "Year", "Month", "Day")),
        "typical_price": _orders(lambda b: fn.typical_price(b).select(*keep, "TP")),
        "spreads": _orders(
            lambda b: fn.spreads(b).select(*keep, "diffOpenClose", "diffHighLow")
        ),
        # windows
        "trailing_avg": _orders(
            lambda b: op.trailing_avg(b, "Close", 14, out="SMA").select(*keep, "SMA")
        ),
        "trailing_avg_one_day": _orders(
            lambda b: op.trailing_avg(b, "Close", 1, out="avg1").select(*keep, "avg1")
        ),
        "trailing_avg_before_today": _orders(
            lambda b: op.trailing_avg(b, "Close", 14, until=1, out="SMA").select(*keep, "SMA")
        ),
        "trailing_avg_long": _brands(
            lambda b: op.trailing_avg(b, "Close", 400, out="avg400", units=100).select(
                *keep, "avg400"
            )
        ),
        "trailing_avg_long_doubles": _brands(
            lambda b: op.trailing_avg(b, "Close", 400, out="avg400", exact=True).select(
                *keep, "avg400"
            )
        ),
        "mean_deviation": _orders(
            lambda b: op.mean_deviation(
                op.trailing_avg(fn.typical_price(b), "TP", 14, out="DTP14")
            ).select(*keep, "TP", "DTP14", "MD14")
        ),
        "direction_target": _orders(
            lambda b: op.direction_target(b).select(*keep, "Close", "target")
        ),
        "relative_volume": _orders(
            lambda b: op.relative_volume(b, out="rel").select(*keep, "rel")
        ),
        "relative_volume_train": _orders(
            lambda b: op.relative_volume(op.time_split(b), train_only=True, out="rel").select(
                *keep, "rel", "is_train"
            )
        ),
        # feature tables
        "price_features": _orders(plans.price_features),
        "price_features_brand": _brands(plans.price_features),
        # Deviations are rounded to twelve places before they are summed, which engines do
        # differently in the last one.
        "price_features_events": _on(
            testdata.event_bars,
            lambda b: _rounded(plans.price_features(b, units=100), "MD14", 8),
            _hour,
        ),
        "price_features_next_day": _orders(lambda b: plans.price_features(b, "next_day")),
        "direction_features": _orders(plans.direction_features),
        "direction_features_brand": _brands(plans.direction_features),
        "sequence_features": _orders(_sequence),
        # splits, samples, sets
        "time_split": _orders(lambda b: op.time_split(b).select(*keep, "rn", "is_train")),
        "time_split_brand": _brands(lambda b: op.time_split(b).select(*keep, "rn", "is_train")),
        "time_split_by_date": _brands(
            lambda b: op.time_split_by_date(b).select(*keep, "is_train")
        ),
        "hash_split": _orders(
            lambda b: op.hash_split(b, [0.7, 0.2, 0.1], 42).select(*keep, "split")
        ),
        "hash_sample": _orders(lambda b: op.hash_sample(b, 0.05, 42).select(*keep, "Close")),
        "except_rows": _on(testdata.orders_bars, _except, same),
        # profile
        "row_counts": _on(testdata.brand_bars, op.row_counts, same),
        "profile": _on(
            _raw_orders,
            op.profile,
            lambda p: p.withColumns(
                {c: F.to_date(c) for c in ("first_date", "last_date")}
            ),
        ),
        "corr_pairs": _on(
            testdata.brand_bars, lambda b: op.corr_pairs(b, COLUMNS, digits=9), same
        ),
        "corr_upper": _on(
            testdata.orders_bars, lambda b: op.corr_pairs(b, COLUMNS, upper=True, digits=3), same
        ),
        "histogram": _on(testdata.orders_bars, lambda b: op.histogram(b, COLUMNS, 20), same),
        "density": _on(
            testdata.orders_bars,
            lambda b: _rounded(_rounded(op.density(b, COLUMNS, 25, 64), "x"), "density", 12),
            same,
        ),
        "bins2d": _on(testdata.brand_bars, lambda b: op.bins2d(b, COLUMNS, 8), same),
        # prediction errors and reports, on predictions that need no model
        "predictions": _orders(_naive),
        "rmse": _on(testdata.orders_bars, lambda b: _rounded(op.rmse(_naive(b))), same),
        "mse": _on(testdata.orders_bars, lambda b: _rounded(op.mse(_naive(b)), digits=2), same),
        "accuracy": _on(
            testdata.orders_bars, lambda b: _rounded(op.accuracy(_spread_signs(b)), digits=9), same
        ),
        "auc": _on(
            testdata.orders_bars,
            lambda b: _rounded(op.auc(_direction_scores(b)), digits=9),
            same,
        ),
        "auc_brand": _on(
            testdata.brand_bars, lambda b: _rounded(op.auc(_direction_scores(b)), digits=9), same
        ),
        "describe": _describe,
        "prediction_lookup": _orders(
            lambda b: sources.lookup(_naive(b), "2-HIGH", "2000-01-01")
        ),
        "leaderboard": _on(
            testdata.orders_bars,
            lambda b: _rounded(plans.leaderboard(_errors(b)), digits=2),
            same,
        ),
        "suggest": _on(
            testdata.brand_bars,
            lambda b: _rounded(plans.suggest(_naive(b), 60, 5), "mean_return", 9),
            same,
        ),
        # fitted models: rows only
        "random_forest_price": _orders(_forest_price),
        "random_forest_direction": _orders(_forest_direction),
        "factorization_price": _orders(_factorization_price),
        "factorization_all_symbols": _brands(
            lambda b: fit_factorization(plans.price_features(b), PRICE_FEATURES).predictions
        ),
        "gated_net_price": _orders(lambda b: _net_price(b).predictions),
        "forest_all_symbols": _brands(_forest_price),
        "random_forest_per_symbol": _orders(_forest_per_symbol),
        "recurrent_net_price": _orders(lambda b: _fit_sequence_net(plans.price_features(b)).predictions),
        "gated_net_direction": _orders(lambda b: _net_direction(b).predictions),
        "gated_net_history": _on(
            testdata.orders_bars, lambda b: _net_direction(b).history, same
        ),
        # fitted models: what SQL can tell of them
        "checked_forest_price": _on(
            testdata.orders_bars,
            lambda b: _checked_forests(
                plans.price_features(b), lambda f: fit_forests(f, PRICE_FEATURES), PRICE_FEATURES
            ),
            same,
        ),
        "checked_forest_direction": _on(
            testdata.orders_bars,
            lambda b: _checked_forests(
                _direction_rows(b, 0.8), _fit_direction_forest, DIRECTION_FEATURES, "target", DIRECTION_SLACK
            ),
            same,
        ),
        "checked_factorization_price": _on(
            testdata.orders_bars,
            lambda b: _checked_models(
                plans.price_features(b), factorization(PRICE_FEATURES, 0.03), scale_label=True
            ),
            same,
        ),
        "checked_factorization_all_symbols": _on(
            _stored_brands,
            lambda b: _checked_net(
                plans.price_features(b),
                lambda f: fit_factorization(f, PRICE_FEATURES),
                FactorPairs(),
                PRICE_FEATURES,
            ),
            same,
        ),
        "checked_net_price": _on(
            testdata.orders_bars,
            lambda b: _checked_net(
                plans.price_features(b),
                lambda f: fit_gated_net(f, PRICE_FEATURES),
                GatedCells(),
                PRICE_FEATURES,
            ),
            same,
        ),
        "checked_net_direction": _on(
            testdata.orders_bars,
            lambda b: _checked_net(
                _direction_rows(b, 0.7),
                _fit_direction_net,
                GatedCells(1, 16),
                DIRECTION_FEATURES,
                "target",
                DIRECTION_SLACK,
            ),
            same,
        ),
        "checked_net_sequences": _on(
            testdata.orders_bars,
            lambda b: _checked_net(
                plans.price_features(b), _fit_sequence_net, RecurrentCells(2, 16, 5), PRICE_FEATURES
            ),
            same,
        ),
        "checked_net_history": _on(testdata.orders_bars, _net_history, same),
        # files written and read back
        "bars_csv": _orders(_back_from_csv),
        "bars_csv_inferred": _orders(lambda b: _back_from_csv(b, infer=True)),
        "bars_by_file_name": _orders(_back_by_file_name),
        "put_bars": _put_in_place,
        "bars_json": _orders(_back_from_json),
        "bars_parquet": _orders(_back_from_parquet),
        "report_back": _on(testdata.orders_bars, _back_from_report, same),
        "price_vectors": _orders(lambda b: _from_vectors(plans.price_features(b), PRICE_FEATURES)),
        "direction_vectors": _orders(
            lambda b: _from_vectors(plans.direction_features(b), DIRECTION_FEATURES)
        ),
    }


ORDERS_BARS = """
SELECT o_orderpriority AS "Stock", o_orderdate::DATE AS "Date",
       arg_min(o_totalprice, o_orderkey) AS "Open", max(o_totalprice) AS "High",
       min(o_totalprice) AS "Low", arg_max(o_totalprice, o_orderkey) AS "Close",
       count(*)::DOUBLE AS "Volume"
FROM orders GROUP BY 1, 2"""
BRAND_ROWS = """
SELECT p_brand, l_shipdate::DATE AS d, l_extendedprice AS price,
       row_number() OVER (PARTITION BY p_brand, l_shipdate::DATE
         ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos
FROM lineitem JOIN part ON l_partkey = p_partkey"""
BRAND_BARS = f"""
SELECT p_brand AS "Stock", d AS "Date", arg_min(price, pos) AS "Open", max(price) AS "High",
       min(price) AS "Low", arg_max(price, pos) AS "Close", count(*)::DOUBLE AS "Volume"
FROM ({BRAND_ROWS}) AS r GROUP BY 1, 2"""
EVENT_BARS = """
SELECT event_type AS "Stock", date_trunc('hour', ts) AS "Date",
       arg_min("value", event_id) AS "Open", max("value") AS "High", min("value") AS "Low",
       arg_max("value", event_id) AS "Close", count(*)::DOUBLE AS "Volume"
FROM events GROUP BY 1, 2"""
RAW_ORDERS = """
SELECT o_orderpriority AS "Stock", o_orderdate::DATE AS "Date",
       CASE WHEN o_orderstatus <> 'P' THEN floor(o_totalprice / 1e5::DOUBLE) END AS "Close",
       CASE WHEN o_custkey % 10 = 0 THEN 'NaN'::DOUBLE ELSE (o_custkey % 3)::DOUBLE END AS "Volume"
FROM orders"""
UNIT = """('0x' || substr(md5(concat_ws('|', "Stock", epoch("Date")::BIGINT::VARCHAR, '42')), 1, 8))
          ::BIGINT / 4294967296::DOUBLE"""


def _frame(start: int = 14, end: str = "CURRENT ROW") -> str:
    return (
        f'(PARTITION BY "Stock" ORDER BY "Date" RANGE BETWEEN INTERVAL {start} DAYS PRECEDING '
        f"AND {end})"
    )


def _with_bars(select: str, bars: str = ORDERS_BARS) -> str:
    return f"WITH b AS ({bars}) {select}"


def _price_sql(bars: str, date: str = '"Date"') -> str:
    return f"""
WITH b AS ({bars}),
x AS (SELECT *, ("High" + "Low" + "Close") / 3 AS "TP" FROM b),
y AS (SELECT *, avg("Close") OVER w AS "SMA", avg("TP") OVER w AS "DTP14" FROM x
      WINDOW w AS {_frame()}),
z AS (SELECT *, avg(abs("TP" - "DTP14")) OVER {_frame()} AS "MD14",
             row_number() OVER (PARTITION BY "Stock" ORDER BY "Date") AS rn,
             count(*) OVER (PARTITION BY "Stock") AS n,
             avg("Volume") OVER (PARTITION BY "Stock") AS mv FROM y)
SELECT "Stock", {date} AS "Date", "Open", "High", "Low", "Volume" / mv AS "Volume",
       day("Date")::INT AS "Day", month("Date")::INT AS "Month", year("Date")::INT AS "Year",
       "SMA", "TP", "DTP14", "MD14", "Close" AS label, rn,
       rn <= floor(0.7::DOUBLE * n) AS is_train FROM z"""


EVENTS_SQL = f"""
WITH f AS ({_price_sql(EVENT_BARS)}),
g AS (SELECT * REPLACE (
  (sum(round(label * 100)::BIGINT) OVER w)::DOUBLE / (count(*) OVER w * 100) AS "SMA",
  (sum(round("TP" * 300)::BIGINT) OVER w)::DOUBLE / (count(*) OVER w * 300) AS "DTP14")
FROM f WINDOW w AS {_frame()})
SELECT * REPLACE (
  epoch("Date")::BIGINT AS "Date",
  round((sum(abs("TP" - "DTP14")::DECIMAL(28,12)) OVER w)::DOUBLE / count(*) OVER w, 8) AS "MD14")
FROM g WINDOW w AS {_frame()}"""


NEXT_DAY_SQL = f"""
WITH b AS ({ORDERS_BARS}),
x AS (SELECT *, ("High" + "Low" + "Close") / 3 AS "TP" FROM b),
y AS (SELECT *, avg("Close") OVER w AS "SMA", avg("TP") OVER w AS "DTP14" FROM x
      WINDOW w AS {_frame(14, "INTERVAL 1 DAY PRECEDING")}),
z AS (SELECT "Stock", "Date", "Close" AS label, "SMA", "DTP14",
             avg(abs("TP" - "DTP14")) OVER {_frame(14, "INTERVAL 1 DAY PRECEDING")} AS "MD14",
             lag("Open") OVER s AS "Open", lag("High") OVER s AS "High", lag("Low") OVER s AS "Low",
             lag("TP") OVER s AS "TP",
             lag("Volume") OVER s / avg("Volume") OVER (PARTITION BY "Stock") AS "Volume",
             row_number() OVER s AS rn, count(*) OVER (PARTITION BY "Stock") AS n FROM y
      WINDOW s AS (PARTITION BY "Stock" ORDER BY "Date"))
SELECT "Stock", "Date", "Open", "High", "Low", "Volume",
       day("Date")::INT AS "Day", month("Date")::INT AS "Month", year("Date")::INT AS "Year",
       "SMA", "TP", "DTP14", "MD14", label, rn, rn <= floor(0.7::DOUBLE * n) AS is_train
FROM z WHERE "SMA" IS NOT NULL AND "MD14" IS NOT NULL AND "Open" IS NOT NULL"""


def _direction_sql(bars: str) -> str:
    return f"""
WITH b AS ({bars})
SELECT "Stock", "Date", "Open", "High", "Low", "Volume", "Open" - "Close" AS "diffOpenClose",
       "High" - "Low" AS "diffHighLow", year("Date")::INT AS "Year",
       month("Date")::INT AS "Month", day("Date")::INT AS "Day", "Close",
       CASE WHEN lag("Close") OVER s < "Close" THEN 1 ELSE 0 END AS target,
       row_number() OVER s AS rn,
       row_number() OVER s <= floor(0.7::DOUBLE * count(*) OVER (PARTITION BY "Stock")) AS is_train
FROM b WINDOW s AS (PARTITION BY "Stock" ORDER BY "Date")"""


def _split_sql(bars: str) -> str:
    return f"""
WITH b AS ({bars})
SELECT "Stock", "Date", row_number() OVER s AS rn,
       row_number() OVER s <= floor(0.7::DOUBLE * count(*) OVER (PARTITION BY "Stock")) AS is_train
FROM b WINDOW s AS (PARTITION BY "Stock" ORDER BY "Date")"""


def _verdict_sql(rows: str, below: str = "rmse_below_label_sd") -> str:
    """What a fitted model has to show: a prediction for each test row, and the rest true."""
    return f"""
SELECT "Stock", count(*) AS n_test, count(*) AS n_predicted, TRUE AS {below}, TRUE AS reload_equal
FROM ({rows}) AS f WHERE NOT is_train GROUP BY 1"""


def _hash_split_sql(train: float) -> str:
    return f"""SELECT "Stock", {UNIT} < {train}::DOUBLE / 1 AS is_train FROM ({ORDERS_BARS}) AS b"""


def _columns_sql(rows: str, columns: list[str]) -> str:
    cells = ", ".join(f'"{c}"::DOUBLE AS "{c}"' for c in columns)
    return f'SELECT "Stock", "Date", {cells} FROM ({rows}) AS f'


def _naive_sql(bars: str, columns=("SMA", "TP", "DTP14", "Open")) -> str:
    parts = [
        f"""SELECT 'naive_{c}' AS model, "Stock", "Date", label AS actual, "{c}" AS predicted
            FROM f WHERE NOT is_train"""
        for c in columns
    ]
    return f"WITH f AS ({_price_sql(bars)}) " + " UNION ALL ".join(parts)


def _auc_sql(bars: str) -> str:
    return f"""
WITH f AS ({_direction_sql(bars)}),
s AS (SELECT "Stock", target, floor("Open" / 1000) AS score FROM f WHERE NOT is_train),
r AS (SELECT "Stock", target, rank() OVER (PARTITION BY "Stock" ORDER BY score)
             + (count(*) OVER (PARTITION BY "Stock", score) - 1) / 2::DOUBLE AS mid FROM s),
g AS (SELECT "Stock", sum(target)::DOUBLE AS pos, sum(1 - target)::DOUBLE AS neg,
             sum(CASE WHEN target = 1 THEN mid ELSE 0 END) AS ranks FROM r GROUP BY 1)
SELECT 'open_thousands' AS model, "Stock", 'auc' AS metric,
       round((ranks - pos * (pos + 1) / 2) / nullif(pos * neg, 0), 9) AS value FROM g"""


def _error_value_sql(metric: str) -> str:
    value = "avg((predicted - actual) * (predicted - actual))"
    value = f"sqrt({value})" if metric == "rmse" else value
    return f"""SELECT model, "Stock", '{metric}' AS metric, {value} AS value
               FROM ({_naive_sql(ORDERS_BARS)}) AS p GROUP BY 1, 2"""


def _error_sql(metric: str) -> str:
    value = 'avg((predicted - actual) * (predicted - actual))'
    value = f"round(sqrt({value}), 6)" if metric == "rmse" else f"round({value}, 2)"
    return f"""SELECT model, "Stock", '{metric}' AS metric, {value} AS value
               FROM ({_naive_sql(ORDERS_BARS)}) AS p GROUP BY 1, 2"""


def _corr_cells(upper: bool, digits: int) -> str:
    parts = []
    for i, a in enumerate(COLUMNS):
        for j, b in enumerate(COLUMNS):
            if upper and j <= i:
                continue
            r = (
                f'CASE WHEN stddev_pop("{a}") > 0 THEN 1.0::DOUBLE END'
                if a == b
                else f'round(covar_pop("{a}", "{b}") / nullif(stddev_pop("{a}") '
                f'* stddev_pop("{b}"), 0), {digits})'
            )
            parts.append(
                f"""SELECT "Stock", '{a}' AS col_i, '{b}' AS col_j, {r} AS r FROM b GROUP BY 1"""
            )
    return " UNION ALL ".join(parts)


def _bin_sql(c: str, bins: int) -> str:
    lo, hi = f'min("{c}") OVER p', f'max("{c}") OVER p'
    share = f'("{c}" - {lo}) / nullif({hi} - {lo}, 0)'
    return f"CASE WHEN {hi} > {lo} THEN least(floor({share} * {bins}), {bins - 1})::INT ELSE 0 END"


def _histogram_sql(bins: int) -> str:
    parts = [
        f"""SELECT "Stock", '{c}' AS "column", bin, count(*) AS n, min(lo) AS lo, max(hi) AS hi
            FROM (SELECT "Stock", {_bin_sql(c, bins)} AS bin, min("{c}") OVER p AS lo,
                         max("{c}") OVER p AS hi FROM b
                  WINDOW p AS (PARTITION BY "Stock")) AS t GROUP BY 1, 2, 3"""
        for c in COLUMNS
    ]
    return " UNION ALL ".join(parts)


def _density_sql(bins: int, points: int) -> str:
    parts = []
    for c in COLUMNS:
        parts.append(
            f"""SELECT "Stock", '{c}' AS "column", "{c}" AS v, stddev_samp("{c}") OVER p
                  * pow(count(*) OVER p, -0.2::DOUBLE) AS h, count(*) OVER p AS total,
                min("{c}") OVER p AS lo, max("{c}") OVER p AS hi,
                {_bin_sql(c, bins)} AS bin FROM b WINDOW p AS (PARTITION BY "Stock")"""
        )
    return f"""
WITH b AS ({ORDERS_BARS}), v AS ({" UNION ALL ".join(parts)}),
n AS (SELECT "Stock", "column", bin, min(h) AS h, min(total) AS total, min(lo) AS lo,
             min(hi) AS hi, count(*) AS n FROM v WHERE hi > lo GROUP BY 1, 2, 3),
g AS (SELECT *, lo + (bin + 0.5::DOUBLE) * (hi - lo) / {bins} AS c,
             lo + i * ((hi - lo) / {points - 1}) AS x
      FROM n, range({points}) AS r(i))
SELECT "Stock", "column", round(min(x), 6) AS x,
       round(sum(n * exp(-((x - c) / h) * ((x - c) / h) / 2) / (total * h * sqrt(2 * pi()))), 12)
         AS density
FROM g GROUP BY "Stock", "column", i"""


def _bins2d_sql(bins: int) -> str:
    binned = ", ".join(f'{_bin_sql(c, bins)} AS "{c}"' for c in COLUMNS)
    parts = [
        f"""SELECT "Stock", '{a}' AS col_x, '{b}' AS col_y, "{a}" AS bin_x, "{b}" AS bin_y,
                   count(*) AS n FROM t GROUP BY 1, 2, 3, 4, 5"""
        for i, a in enumerate(COLUMNS)
        for b in COLUMNS[i + 1 :]
    ]
    return (
        f'WITH b AS ({BRAND_BARS}), t AS (SELECT "Stock", {binned} FROM b '
        f'WINDOW p AS (PARTITION BY "Stock")) ' + " UNION ALL ".join(parts)
    )


def oracle_sql() -> dict[str, str]:
    long_frame = f'(PARTITION BY "Stock" ORDER BY "Date" RANGE BETWEEN INTERVAL 400 DAYS PRECEDING AND CURRENT ROW)'
    return _llm_oracle_sql() | {
        "to_bars": ORDERS_BARS,
        "to_bars_brand": BRAND_BARS,
        "to_bars_events": f'SELECT * REPLACE (epoch("Date")::BIGINT AS "Date") FROM ({EVENT_BARS}) AS e',
        "normalise": _with_bars(
            'SELECT "Stock", "Date", "Open", "High", "Low", "Close", "Close" AS "AdjClose", '
            '"Volume" FROM b'
        ),
        **dict.fromkeys(
            ("bars_csv", "bars_csv_inferred", "bars_by_file_name", "bars_json", "bars_parquet"),
            _with_bars(
                'SELECT "Stock", "Date", "Low", "Open", "Volume", "High", "Close", '
                '"Close" AS "AdjClose" FROM b'
            ),
        ),
        "report_back": f"""
SELECT model, "Stock", metric, round(value, 2) AS value FROM (
{_error_value_sql("rmse")} UNION ALL {_error_value_sql("mse")}) AS e""",
        "price_vectors": _columns_sql(_price_sql(ORDERS_BARS), PRICE_FEATURES),
        "direction_vectors": _columns_sql(_direction_sql(ORDERS_BARS), DIRECTION_FEATURES),
        **dict.fromkeys(
            (
                "checked_forest_price",
                "checked_factorization_price",
                "checked_net_price",
                "checked_net_sequences",
            ),
            _verdict_sql(_price_sql(ORDERS_BARS)),
        ),
        "checked_factorization_all_symbols": _verdict_sql(_price_sql(BRAND_BARS)),
        "checked_forest_direction": _verdict_sql(_hash_split_sql(0.8), "rmse_near_label_sd"),
        "checked_net_direction": _verdict_sql(_hash_split_sql(0.7), "rmse_near_label_sd"),
        "checked_net_history": _with_bars(
            'SELECT "Stock", 50::BIGINT AS epochs, TRUE AS fell, TRUE AS accuracy_in_range '
            "FROM b GROUP BY 1"
        ),
        "parse_dates": """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y/%m/%d')
            ELSE day(o_orderdate) || '-' || month(o_orderdate) || '-' || year(o_orderdate)
       END AS "Date",
       CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE END AS parsed
FROM orders""",
        "put_bars": f"""
WITH b AS (SELECT "Stock", "Date", "Close" FROM ({ORDERS_BARS}) AS o),
d AS (SELECT o_orderpriority AS "Stock", (o_orderdate + INTERVAL 1 DAY)::DATE AS "Date",
             arg_max(o_totalprice, o_orderkey) AS "Close" FROM orders
      WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2)
SELECT coalesce(d."Stock", b."Stock") AS "Stock", coalesce(d."Date", b."Date") AS "Date",
       coalesce(d."Close", b."Close") AS "Close"
FROM b FULL JOIN d ON b."Stock" = d."Stock" AND b."Date" = d."Date" """,
        "upsert_bars": f"""
WITH b AS (SELECT "Stock", "Date", "Close" FROM ({ORDERS_BARS}) AS o),
d AS (SELECT o_orderpriority AS "Stock", (o_orderdate + INTERVAL 1 DAY)::DATE AS "Date",
             arg_max(o_totalprice, o_orderkey) AS "Close" FROM orders GROUP BY 1, 2)
SELECT coalesce(d."Stock", b."Stock") AS "Stock", coalesce(d."Date", b."Date") AS "Date",
       coalesce(d."Close", b."Close") AS "Close"
FROM b FULL JOIN d ON b."Stock" = d."Stock" AND b."Date" = d."Date" """,
        "lookup": _with_bars(
            """SELECT * FROM b WHERE "Stock" = '1-URGENT'
               AND "Date" BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'"""
        ),
        "clean": f"""SELECT DISTINCT * FROM ({RAW_ORDERS}) AS r
                     WHERE "Close" IS NOT NULL AND NOT isnan("Volume")""",
        "clean_by_key": f"""
SELECT "Stock", "Date", "Close", "Volume" FROM (
  SELECT *, row_number() OVER (PARTITION BY "Stock", "Date"
                               ORDER BY "Close" DESC, "Volume" DESC) AS pos
  FROM ({RAW_ORDERS}) AS r WHERE "Close" IS NOT NULL AND NOT isnan("Volume")) AS t
WHERE pos = 1""",
        "clean_subset": f"""SELECT DISTINCT * FROM ({RAW_ORDERS}) AS r
                            WHERE "Close" IS NOT NULL""",
        "only_symbols": _with_bars("""SELECT * FROM b WHERE "Stock" IN ('1-URGENT', '5-LOW')"""),
        "with_sec": _with_bars('SELECT "Stock", "Date", epoch("Date")::BIGINT AS sec FROM b'),
        "date_parts": _with_bars(
            'SELECT "Stock", "Date", year("Date")::INT AS "Year", month("Date")::INT AS "Month", '
            'day("Date")::INT AS "Day" FROM b'
        ),
        "typical_price": _with_bars(
            'SELECT "Stock", "Date", ("High" + "Low" + "Close") / 3 AS "TP" FROM b'
        ),
        "spreads": _with_bars(
            'SELECT "Stock", "Date", "Open" - "Close" AS "diffOpenClose", '
            '"High" - "Low" AS "diffHighLow" FROM b'
        ),
        "trailing_avg": _with_bars(
            f'SELECT "Stock", "Date", avg("Close") OVER {_frame()} AS "SMA" FROM b'
        ),
        "trailing_avg_one_day": _with_bars(
            f'SELECT "Stock", "Date", avg("Close") OVER {_frame(1)} AS avg1 FROM b'
        ),
        "trailing_avg_before_today": _with_bars(
            f'SELECT "Stock", "Date", '
            f'avg("Close") OVER {_frame(14, "INTERVAL 1 DAY PRECEDING")} AS "SMA" FROM b'
        ),
        "trailing_avg_long": _with_bars(
            f'SELECT "Stock", "Date", (sum(round("Close" * 100)::BIGINT) OVER w)::DOUBLE '
            f"/ (count(*) OVER w * 100) AS avg400 FROM b WINDOW w AS {long_frame}",
            BRAND_BARS,
        ),
        # Closes are over 512, so all their bits are whole numbers of 2 ** -43.
        "trailing_avg_long_doubles": f"""
WITH b AS ({BRAND_BARS}),
s AS (SELECT "Stock", "Date", sum(("Close" * 8796093022208)::HUGEINT) OVER w AS s, count(*) OVER w AS n
      FROM b WINDOW w AS {long_frame}),
t AS (SELECT *, (s // 256)::BIGINT AS upper, (s % 256)::BIGINT AS lower FROM s)
SELECT "Stock", "Date", CASE WHEN s < 9000000000000000000 THEN s::BIGINT::DOUBLE
  ELSE (upper | (lower <> 0)::BIGINT)::DOUBLE * 256 END / 8796093022208 / n AS avg400 FROM t""",
        "mean_deviation": f"""
SELECT "Stock", "Date", "TP", "DTP14", "MD14" FROM ({_price_sql(ORDERS_BARS)}) AS f""",
        "direction_target": f"""
SELECT "Stock", "Date", "Close", target FROM ({_direction_sql(ORDERS_BARS)}) AS f""",
        "relative_volume": _with_bars(
            'SELECT "Stock", "Date", "Volume" / avg("Volume") OVER (PARTITION BY "Stock") AS rel FROM b'
        ),
        "relative_volume_train": f"""
WITH b AS ({ORDERS_BARS}), s AS ({_split_sql(ORDERS_BARS)}),
t AS (SELECT b.*, s.is_train FROM b JOIN s ON b."Stock" = s."Stock" AND b."Date" = s."Date")
SELECT "Stock", "Date", "Volume" / avg("Volume") FILTER (WHERE is_train)
       OVER (PARTITION BY "Stock") AS rel, is_train FROM t""",
        "price_features": _price_sql(ORDERS_BARS),
        "price_features_brand": _price_sql(BRAND_BARS),
        "price_features_events": EVENTS_SQL,
        "price_features_next_day": NEXT_DAY_SQL,
        "direction_features": _direction_sql(ORDERS_BARS),
        "direction_features_brand": _direction_sql(BRAND_BARS),
        "sequence_features": _with_bars(
            'SELECT "Stock", "Date", (count(*) OVER w)::INT AS length, '
            'first_value("Close") OVER w AS first_close, "Close" AS last_close, '
            'sum("Volume") OVER w AS volume FROM b WINDOW w AS (PARTITION BY "Stock" '
            'ORDER BY "Date" ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)'
        ),
        "time_split": _split_sql(ORDERS_BARS),
        "time_split_brand": _split_sql(BRAND_BARS),
        "time_split_by_date": f"""
SELECT "Stock", "Date", is_train FROM ({_split_sql(BRAND_BARS)}) AS s""",
        "hash_split": _with_bars(
            f"""SELECT "Stock", "Date", CASE WHEN u < 0.7::DOUBLE / 1 THEN 0
                  WHEN u < (0.7::DOUBLE + 0.2::DOUBLE) / 1 THEN 1 ELSE 2 END AS split
                FROM (SELECT *, {UNIT} AS u FROM b) AS t"""
        ),
        "hash_sample": _with_bars(
            f"""SELECT "Stock", "Date", "Close" FROM b WHERE {UNIT} < 0.05::DOUBLE"""
        ),
        "except_rows": f"""
WITH f AS ({_price_sql(ORDERS_BARS)})
SELECT "Stock", "High" FROM f EXCEPT SELECT "Stock", "High" FROM f WHERE is_train""",
        "row_counts": _with_bars('SELECT "Stock", count(*) AS n_rows FROM b GROUP BY 1', BRAND_BARS),
        "profile": f"""
SELECT "Stock", count(*) AS n_rows, min("Date") AS first_date, max("Date") AS last_date,
       count(*) - count(DISTINCT "Date") AS n_duplicates,
       count(*) FILTER (WHERE "Close" IS NULL) AS "missing_Close",
       count(*) FILTER (WHERE "Volume" IS NULL OR isnan("Volume")) AS "missing_Volume"
FROM ({RAW_ORDERS}) AS r GROUP BY 1""",
        "corr_pairs": _with_bars(_corr_cells(False, 9), BRAND_BARS),
        "corr_upper": _with_bars(_corr_cells(True, 3)),
        "histogram": _with_bars(_histogram_sql(20)),
        "density": _density_sql(64, 25),
        "bins2d": _bins2d_sql(8),
        "predictions": _naive_sql(ORDERS_BARS),
        "rmse": _error_sql("rmse"),
        "mse": _error_sql("mse"),
        "accuracy": f"""
SELECT 'open_below_close' AS model, "Stock", 'accuracy' AS metric,
       round(avg(CASE WHEN ("diffOpenClose" < 0) = (target = 1) THEN 1 ELSE 0 END), 9) AS value
FROM ({_direction_sql(ORDERS_BARS)}) AS f WHERE NOT is_train GROUP BY 1, 2""",
        "auc": _auc_sql(ORDERS_BARS),
        "auc_brand": _auc_sql(BRAND_BARS),
        "describe": f"""
SELECT p.*, t.description FROM ({_naive_sql(BRAND_BARS, ["SMA"])}) AS p
LEFT JOIN (SELECT p_brand, max(p_type) AS description FROM part GROUP BY 1) AS t
ON p."Stock" = t.p_brand""",
        "prediction_lookup": f"""
SELECT * FROM ({_naive_sql(ORDERS_BARS)}) AS p
WHERE "Stock" = '2-HIGH' AND "Date" >= DATE '2000-01-01'""",
        "leaderboard": f"""
WITH p AS ({_naive_sql(ORDERS_BARS)}),
e AS (SELECT model, "Stock", avg((predicted - actual) * (predicted - actual)) AS v
      FROM p GROUP BY 1, 2),
m AS (SELECT model, "Stock", 'rmse' AS metric, sqrt(v) AS value FROM e
      UNION ALL SELECT model, "Stock", 'mse' AS metric, v AS value FROM e)
SELECT model, "Stock", metric, round(value, 2) AS value,
       rank() OVER (PARTITION BY "Stock", metric ORDER BY value)::INT AS rank FROM m""",
        "suggest": f"""
WITH p AS ({_naive_sql(BRAND_BARS)}),
e AS (SELECT *, max("Date") OVER (PARTITION BY model, "Stock") AS last_day FROM p),
r AS (SELECT model, "Stock", predicted / nullif(lag(actual) OVER (PARTITION BY model, "Stock"
             ORDER BY "Date"), 0) - 1 AS ret, "Date", last_day FROM e),
g AS (SELECT model, "Stock", avg(ret) AS mean_return, count(ret) AS n_rows FROM r
      WHERE "Date" > last_day - INTERVAL 60 DAYS GROUP BY 1, 2 HAVING avg(ret) IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY model
                                   ORDER BY mean_return DESC, "Stock") AS rank FROM g)
SELECT model, "Stock", round(mean_return, 9) AS mean_return, n_rows, rank::INT AS rank
FROM k WHERE rank <= 5""",
    }
