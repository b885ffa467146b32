"""Stored tables changed in place, headers by file, rows without a symbol."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from barloom import operators as op
from barloom import plans, sources
from barloom.operators.chunks import join_symbols


def _files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/Stock=*/*.parquet")}


def _rows(df):
    return sorted(map(tuple, df.select("Stock", "Date", "Close").collect()))


@pytest.mark.parametrize("listed", [1_000, 0])
def test_put_rewrites_only_the_folders_it_touches(spark, make_bars, tmp_path, monkeypatch, listed):
    monkeypatch.setattr(sources.keyed, "LISTED", listed)
    path = str(tmp_path / "bars")
    base = make_bars([(s, d, float(d)) for s in ("A", "B", "C c/=", "10") for d in range(20)])
    sources.write_bars(base, path)
    before = _files(path)
    delta = make_bars([("B", 3, 99.0), ("B", 40, 1.0), ("D", 0, 2.0), ("10", 0, 5.0)]).withColumn("batch", F.lit(1))
    later = make_bars([("B", 3, 77.0)]).withColumn("batch", F.lit(2))
    sources.put_bars(delta.unionByName(later), path)
    after = _files(path)
    same = {f for f in before if after.get(f) == before[f]}
    assert {f.split("Stock=")[1].split("/")[0] for f in same} == {"A", "C c%2F%3D"}
    assert not any(f in after for f in set(before) - same)
    want = sources.upsert_bars(base, delta.unionByName(later))
    assert _rows(spark.read.schema(base.schema).parquet(path)) == _rows(want)


def test_put_into_a_new_table_and_of_nothing(spark, make_bars, tmp_path):
    path = str(tmp_path / "bars")
    rows = make_bars([("A", 0, 1.0), ("B", 0, 2.0)]).withColumn("batch", F.lit(1))
    sources.put_bars(rows, path)
    sources.put_bars(rows.limit(0), path)
    assert _rows(spark.read.parquet(path)) == _rows(rows)
    with pytest.raises(Exception, match="a row has no Stock or Date"):
        sources.put_bars(rows.withColumn("Stock", F.lit(None).cast("string")), path)


def test_headers_are_a_table_and_files_meet_theirs(spark, tmp_path):
    head = "Date,Low,Open,Volume,High,Close,Adj Close"
    for i in range(3):
        line = f"3-1-200{i},1,2,3,4,5,6\n"
        (tmp_path / f"S{i}.csv").write_text(head + "\n" + line * 20_000)
    (tmp_path / "T.csv").write_text("Close,Date,Low,Open,Volume,High,Adjusted Close\n5,3-1-2000,1,2,3,4,6\n")
    found = sources.file_headers(spark, str(tmp_path)).collect()
    assert sorted((os.path.basename(r["_file"]), r["_header"].split(",")[0]) for r in found) == [
        ("S0.csv", "Date"), ("S1.csv", "Date"), ("S2.csv", "Date"), ("T.csv", "Close"),
    ]
    bars, rejects = sources.read_bars(spark, str(tmp_path))
    got = bars.groupBy("Stock").agg(F.count("*"), F.max("Close"), F.max("Open")).collect()
    assert sorted(map(tuple, got)) == [(f"S{i}", 20_000, 5.0, 2.0) for i in range(3)] + [("T", 1, 5.0, 2.0)]
    assert rejects.count() == 0


def test_symbols_of_files_and_of_folders_written_for_files(spark, make_bars, tmp_path):
    raw = make_bars([("X", d, 10.0 + d) for d in range(4)]).select(
        F.date_format("Date", "d-M-yyyy").alias("Date"), "Low", "Open", "Volume", "High", "Close", F.col("Close").alias("Adj Close")
    )
    raw.write.option("header", True).csv(str(tmp_path / "BRK.B.csv"))
    raw.write.option("header", True).csv(str(tmp_path / "A+B c.csv"))
    bars, _ = sources.read_bars(spark, f"{tmp_path}/*.csv")
    assert {r.Stock for r in bars.select("Stock").distinct().collect()} == {"BRK.B", "A+B c"}


def test_rows_without_a_symbol_are_a_group_of_their_own(spark, make_bars):
    """In everything that joins one row of a symbol to its rows."""
    bars = make_bars([(s, d, 10.0 + d % 4) for s in ("A", "none") for d in range(30)])
    bars = bars.withColumn("Stock", F.nullif("Stock", F.lit("none")))
    scores = bars.select(
        F.lit("m").alias("model"), "Stock", "Date", (F.col("Close") > 11).cast("double").alias("actual"), F.col("Open").alias("predicted")
    )
    tables = {
        "histogram": op.histogram(bars, ["Close"], 4),
        "density": op.density(bars, ["Close"], 5, 8),
        "bins2d": op.bins2d(bars, ["Close", "Open"], 4),
        "auc": op.auc(scores),
        "describe": plans.describe(scores, spark.createDataFrame([("A", "x"), (None, "x")], "Stock string, description string")),
    }
    for name, table in tables.items():
        of = {s: sorted(map(repr, (r.asDict() | {"Stock": 0} for r in table.collect() if r.Stock == s))) for s in ("A", None)}
        assert of["A"] and of["A"] == of[None], name
    one = spark.createDataFrame([(None, 1), ("A", 2)], "Stock string, x int")
    assert join_symbols(bars, one, ["Stock"], ["Date"]).count() == bars.count()
