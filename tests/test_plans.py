"""Plan shapes that decide how the work scales."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from barloom import operators as op
from barloom import plans
from barloom.schema import company_names
from barloom.testdata import orders_bars

HEAVY = r"random_forest|factorization|gated_net|checked_|op\d+_|pipeline"
# Fitted models run Python, as do the queries of the package that is not always there.
LIGHT = [n for n in sorted(entry.queries()) if not re.match(HEAVY, n)]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LIGHT)
def test_no_cross_join_and_no_single_task(spark, sf_dir, name):
    plan = plan_of(entry.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "SinglePartition" not in plan
    assert "Python" not in plan and "Pandas" not in plan


def test_price_features_shuffle_once(spark, sf_dir):
    """One exchange and one sort of the bars serve all five windows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bars = spark.read.parquet(_stored(spark, sf_dir))
        plan = plan_of(plans.price_features(bars))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The bars go through (Stock, _chunk) once; the index through its own small exchanges.
    by_chunk = re.findall(r"Exchange hashpartitioning\(Stock#\d+, _chunk#\d+L?, 8\)", plan)
    index = re.findall(r"Exchange hashpartitioning\(Stock#\d+, _groupingexpression", plan)
    assert len(by_chunk) + len(index) <= 3
    assert plan.count("SortMergeJoin") == 1


def _stored(spark, sf_dir):
    from barloom.schema import shared_dir

    path = shared_dir(spark) + "/plan-bars"
    orders_bars(spark, sf_dir).write.mode("overwrite").parquet(path)
    return path


def test_scans_read_only_what_is_needed(spark, sf_dir):
    plan = plan_of(op.row_counts(orders_bars(spark, sf_dir)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert schema == "o_orderdate:timestamp_ntz,o_orderpriority:string"


def test_symbol_filter_reaches_the_scan(spark, sf_dir):
    plan = plan_of(op.only_symbols(orders_bars(spark, sf_dir), ["1-URGENT", "5-LOW"]))
    assert "In(o_orderpriority" in plan


def test_price_features_sort_the_bars_once(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(plans.price_features(spark.read.parquet(_stored(spark, sf_dir))))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The rows are sorted for the first window only; its order serves the others and the merge.
    assert len(re.findall(r"Sort \[Stock#\d+ ASC NULLS FIRST, _chunk#\d+L ASC NULLS FIRST, _sec", plan)) == 1
    assert "SortAggregate" not in plan


def test_one_symbol_is_spread_over_tasks(spark, make_bars):
    bars = make_bars([("HOT", d, 10.0 + d % 9) for d in range(3000)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = plans.price_features(bars, chunk_days=100)
        sizes = rows.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r["count"] for r in sizes) == 3000
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 1500


PER_SYMBOL = {
    "auc": lambda b, p: op.auc(p.withColumn("actual", (F.col("actual") > 10).cast("double"))),
    "suggest": lambda b, p: plans.suggest(p),
    "histogram": lambda b, p: op.histogram(b, ["Open", "Close"]),
    "density": lambda b, p: op.density(b, ["Open", "Close"]),
    "bins2d": lambda b, p: op.bins2d(b, ["Open", "Close"]),
    "split": lambda b, p: op.time_split_by_date(b),
    "describe": lambda b, p: plans.describe(p, company_names(b.sparkSession)),
}


@pytest.mark.parametrize("name", sorted(PER_SYMBOL))
def test_no_rows_are_gathered_by_symbol(spark, sf_dir, name):
    """Beyond the broadcast threshold only aggregated rows are shuffled on the symbol alone."""
    bars = spark.read.parquet(_stored(spark, sf_dir))
    preds = plans.predictions(bars.withColumn("p", F.col("Open") + 1), "m", "Close", "p")
    preds = preds.withColumn("model", F.concat("Stock", F.lit("m")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan_of(PER_SYMBOL[name](bars, preds)).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    alone = re.compile(r"hashpartitioning\((model#\d+, )?(Stock|_pair)#\d+, \d+\)")
    for line, *below in zip(lines, lines[1:], lines[2:], lines[3:]):
        if "Exchange" in line and alone.search(line):
            assert any("Aggregate" in b for b in below), line


def test_one_symbol_s_scores_are_sorted_in_many_tasks(spark):
    rows = spark.range(200_000).selectExpr(
        "'m' AS model", "'HOT' AS Stock", "CAST(id % 2 AS DOUBLE) AS actual", "rand(1) AS predicted"
    )
    settings = {"autoBroadcastJoinThreshold": "-1", "adaptive.coalescePartitions.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(f"spark.sql.{key}", value)
    try:
        plan = plan_of(op.auc(rows))
        (row,) = op.auc(rows).collect()
    finally:
        for key in settings:
            spark.conf.unset(f"spark.sql.{key}")
    assert re.search(r"Exchange hashpartitioning\((\w+#\d+, )*slice#\d+", plan)
    assert 0.49 < row.value < 0.51

