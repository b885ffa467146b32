"""Hand-written files through the readers, writers and the keyed store."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from barloom import functions as fn
from barloom import operators as op
from barloom import plans, sources
from barloom.schema import BAR_SCHEMA, company_names

HEADER = "Date,Low,Open,Volume,High,Close,Adjusted Close\n"


@pytest.fixture
def csv_dir(tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "BRK.B.csv").write_text(
        HEADER
        + "3-1-2000,1,2,100,4,3,3.5\n"
        + "04-01-2000,1,2,100,4,3.5,3.5\n"
        + "2000/01/05,1,2,100,4,3,3.5\n"
        + "6-1-2000,1,,100,4,3,3.5\n"
        + "7-1-2000,1,2,100,4,NaN,3.5\n"
        + "8-1-2000,1,oops,100,4,3,3.5\n"
        + "9-1-2000,1,2,100,4,3,3.5\n"
        + "9-1-2000,1,2,100,4,3,3.5\n"
    )
    (folder / "GT.csv").write_text(HEADER.replace("Adjusted", "Adj") + "3-1-2000,1,2,100,4,3,9\n")
    return str(folder)


def test_csv_folder_in_one_scan(spark, csv_dir):
    bars, rejects = sources.read_bars(spark, csv_dir)
    assert bars.schema.simpleString() == BAR_SCHEMA.simpleString()
    rows = bars.orderBy("Stock", "Date", "Close").collect()
    assert [r.Stock for r in rows] == ["BRK.B"] * 6 + ["GT"]
    assert rows[0].Date == datetime(2000, 1, 3) and rows[1].Date == datetime(2000, 1, 4)
    assert rows[0].AdjClose == 3.5 and rows[-1].AdjClose == 9.0
    assert bars.select(F.count_distinct("Stock")).first()[0] == 2
    bad = {r.Date: r.line for r in rejects.collect()}
    assert set(bad) == {"2000/01/05", "8-1-2000"}
    assert "oops" in bad["8-1-2000"]
    # Neither count depends on which columns a query asks for.
    assert bars.count() == 7 and rejects.count() == 2 and bars.select("Low").count() == 7


def test_clean_drops_null_nan_and_copies(spark, csv_dir):
    bars, _ = sources.read_bars(spark, csv_dir)
    kept = op.clean(bars).filter("Stock = 'BRK.B'").orderBy("Date").collect()
    assert [r.Date.day for r in kept] == [3, 4, 9]
    assert op.profile(bars).filter("Stock = 'BRK.B'").first().n_duplicates == 1


def test_symbols_with_odd_characters(spark, tmp_path):
    for name in ("^GSPC.csv", "BF-B.csv", "A+B.csv"):
        (tmp_path / name).write_text(HEADER + "3-1-2000,1,2,100,4,3,3.5\n")
    bars, _ = sources.read_bars(spark, str(tmp_path))
    assert sorted(r.Stock for r in bars.collect()) == ["A+B", "BF-B", "^GSPC"]


def test_inferred_csv(spark, csv_dir):
    bars, rejects = sources.read_bars(spark, csv_dir + "/BRK.B.csv", infer=True)
    assert bars.schema.simpleString() == BAR_SCHEMA.simpleString()
    assert bars.count() == 6 and rejects.count() == 2
    assert bars.filter("Open IS NULL").count() == 1


@pytest.mark.parametrize("fmt", ["json", "parquet"])
@pytest.mark.parametrize("single_file", [False, True])
def test_round_trip(spark, csv_dir, tmp_path, fmt, single_file):
    bars = op.clean(sources.read_bars(spark, csv_dir)[0])
    path = str(tmp_path / "out")
    sources.write_bars(bars, path, fmt, single_file=single_file)
    with pytest.raises(AnalysisException):
        sources.write_bars(bars, path, fmt)
    again, rejects = sources.read_bars(spark, path, fmt)
    assert again.schema.simpleString() == BAR_SCHEMA.simpleString()
    assert sorted(again.collect()) == sorted(bars.collect())
    assert rejects.count() == 0


def test_json_folder_per_symbol(spark, tmp_path):
    folder = tmp_path / "GT-dataset.json"
    folder.mkdir()
    (folder / "part-0").write_text(
        '{"Date":"2000-01-03T00:00:00.000Z","Open":1.0,"Close":2.0,"High":3.0,"Low":0.5,'
        '"Adj Close":1.5,"Volume":7.0}\n'
        '{"Date":"2000-01-04T00:00:00.000Z","Open":1.0,"Close":2.0}\n'
        "{broken\n"
    )
    bars, rejects = sources.read_bars(spark, str(tmp_path / "*-dataset.json"), "json")
    rows = bars.orderBy("Date").collect()
    assert [(r.Stock, r.Date, r.AdjClose, r.Volume) for r in rows] == [
        ("GT", datetime(2000, 1, 3), 1.5, 7.0),
        ("GT", datetime(2000, 1, 4), None, None),
    ]
    assert [r.line for r in rejects.collect()] == ["{broken"]


def test_lookup_prunes_folders_and_pushes_dates(spark, make_bars, tmp_path):
    path = str(tmp_path / "bars")
    sources.write_bars(make_bars([(s, d, 5.0) for s in "ABC" for d in range(40)]), path)
    df = sources.lookup(spark.read.parquet(path), "B", "1970-01-05", "1970-01-09")
    assert df.count() == 5
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Stock" in plan
    assert "GreaterThanOrEqual(Date" in plan and "LessThanOrEqual(Date" in plan


def test_upsert_keeps_the_last_batch(spark, make_bars):
    base = make_bars([("A", 0, 1.0), ("A", 1, 2.0), ("B", 0, 3.0)]).select(
        "Stock", "Date", "Close"
    )
    delta = spark.createDataFrame(
        [
            ("A", datetime(1970, 1, 2), 7.0, 1),
            ("A", datetime(1970, 1, 2), 8.0, 3),
            ("A", datetime(1970, 1, 2), 9.0, 2),
            ("C", datetime(1970, 1, 1), 4.0, 1),
        ],
        "Stock string, Date timestamp, Close double, batch int",
    )
    rows = sources.upsert_bars(base, delta).orderBy("Stock", "Date").collect()
    assert [(r.Stock, r.Date.day, r.Close) for r in rows] == [
        ("A", 1, 1.0),
        ("A", 2, 8.0),
        ("B", 1, 3.0),
        ("C", 1, 4.0),
    ]


def test_clean_by_key_is_deterministic(spark):
    day = datetime(2000, 1, 3)
    rows = [("A", day, 1.0, 5.0), ("A", day, 2.0, 4.0), ("A", day, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "Stock string, Date timestamp, Close double, Volume double")
    for n in (1, 3):
        kept = op.clean(df.repartition(n), dedupe="key", order_by=["Close"]).collect()
        assert [(r.Close, r.Volume) for r in kept] == [(2.0, 4.0)]


def test_dates_that_do_not_match_become_null(spark):
    df = spark.createDataFrame([("3-1-2000",), ("03-01-2000",), ("2000/01/03",)], "Date string")
    parsed = [r[0] for r in df.select(fn.parse_date("Date")).collect()]
    assert parsed == [datetime(2000, 1, 3), datetime(2000, 1, 3), None]


def test_report_file_and_names(spark, make_bars, tmp_path):
    metrics = spark.createDataFrame(
        [("m", "GT", "rmse", 1.5), ("m", "TXN", "rmse", 2.5)],
        "model string, Stock string, metric string, value double",
    )
    path = str(tmp_path / "report")
    plans.metric_report(metrics, path)
    back = spark.read.csv(path, sep="\t", header=True, inferSchema=True)
    assert back.orderBy("Stock").collect() == metrics.orderBy("Stock").collect()
    named = plans.describe(metrics, company_names(spark)).orderBy("Stock").collect()
    assert [r.description for r in named] == ["Goodyear Tire & Rubber Co", None]


def test_csv_columns_are_bound_by_header(spark, tmp_path):
    other = tmp_path / "GT.csv"
    other.write_text("Date,Open,High,Low,Close,Volume,Adj Close\n1-2-2001,1,3,0.5,2,100,2.5\n")
    bars, rejects = sources.read_bars(spark, str(other))
    (row,) = bars.collect()
    assert (row.Open, row.High, row.Low, row.Close, row.Volume, row.AdjClose) == (1, 3, 0.5, 2, 100, 2.5)
    assert rejects.count() == 0
    named = tmp_path / "TXN.csv"
    named.write_text("Date,AdjClose,Open,High,Low,Close,Volume,Note\n1-2-2001,2.5,1,3,0.5,2,100,x\n")
    (row,) = sources.read_bars(spark, str(named))[0].collect()
    assert (row.Stock, row.Open, row.AdjClose) == ("TXN", 1, 2.5)
    lacking = tmp_path / "PHI.csv"
    lacking.write_text("Date,Open,High,Low,Volume,Adj Close\n1-2-2001,1,3,0.5,100,2.5\n")
    with pytest.raises(ValueError, match="Close"):
        sources.read_bars(spark, str(lacking))


def test_files_with_different_headers(spark, tmp_path):
    (tmp_path / "A.csv").write_text("Date,Low,Open,Volume,High,Close,Adj Close\n1-2-2001,1,2,3,4,5,6\n")
    (tmp_path / "B.csv").write_text("Date,Open,Low,Volume,High,Close,AdjClose\n1-2-2001,1,2,3,4,5,6\n1,2\n")
    bars, rejects = sources.read_bars(spark, str(tmp_path))
    got = {r.Stock: (r.Low, r.Open, r.AdjClose) for r in bars.collect()}
    assert got == {"A": (1, 2, 6), "B": (2, 1, 6)} and [r.Stock for r in rejects.collect()] == ["B"]


def test_short_rows_are_rejected_when_types_are_inferred(spark, tmp_path):
    path = tmp_path / "GT.csv"
    path.write_text("Date,Low,Open,Volume,High,Close,Adj Close\n1-2-2001,1,2,3,4,5,6\n2-2-2001,1,2\n2001-02-03,1,2,3,4,5,6\n")
    bars, rejects = sources.read_bars(spark, str(path), infer=True)
    assert bars.count() == 2 and [r.Date for r in rejects.collect()] == ["2-2-2001"]


def test_unreadable_parquet_values_are_rejected(spark, tmp_path):
    rows = [("A", "1-2-2001", "1.5"), ("A", "someday", "1"), ("A", "2-2-2001", "many")]
    frame = spark.createDataFrame(rows, "Stock string, Date string, Close string")
    for name in ("Low", "Open", "Volume", "High"):
        frame = frame.withColumn(name, F.lit(1.0))
    frame.write.parquet(str(tmp_path / "bars"))
    bars, rejects = sources.read_bars(spark, str(tmp_path / "bars"), "parquet")
    assert bars.count() == 1 and {r.Date for r in rejects.collect()} == {"someday", "2-2-2001"}
