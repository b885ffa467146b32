"""Bars rolled up from the supplied test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.clean import to_bars


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn(
        "ts", F.col("o_orderdate").cast("timestamp")
    )
    return to_bars(orders, "o_orderpriority", "ts", "o_totalprice", "o_orderkey")


def brand_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    rows = table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.withColumn("ts", F.col("l_shipdate").cast("timestamp"))
    # Order, line and part number, unique within a bar, as one number.
    order = F.expr(
        "CAST(l_orderkey * 10 + l_linenumber AS DECIMAL(19,0)) * CAST(1e19 AS DECIMAL(20,0)) "
        "+ CAST(l_partkey AS DECIMAL(19,0))"
    )
    return to_bars(rows.withColumn("pos", order), "p_brand", "ts", "l_extendedprice", "pos")


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn(
        "hour", F.date_trunc("hour", F.col("ts").cast("timestamp"))
    )
    return to_bars(events, "event_type", "hour", "value", "event_id")
