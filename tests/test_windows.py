"""Chunked windows against brute force, whatever the chunk width."""

import math
from bisect import bisect_left, bisect_right
from datetime import datetime

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom import functions as fn
from barloom import operators as op
from barloom import plans

EPOCH = datetime(1970, 1, 1)
SETTINGS = settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
    derandomize=True,
)
# Days around the epoch, so chunk arithmetic meets negative seconds, with gaps.
histories = st.dictionaries(
    st.sampled_from(["A", "B", "C"]),
    st.lists(st.integers(-400, 400), min_size=1, max_size=40, unique=True),
    min_size=1,
)
widths = st.sampled_from([1, 5, 30, 365, 4000])


def _rows(history):
    rng = np.random.default_rng(0)
    return [(s, d, float(rng.integers(400, 5000)) / 100) for s in history for d in sorted(history[s])]


def _by_symbol(df, *columns):
    out = {}
    for r in df.orderBy("Stock", "Date").collect():
        out.setdefault(r.Stock, []).append(tuple(r[c] for c in ("Date", *columns)))
    return out


@SETTINGS
@given(histories, widths, st.sampled_from([(14, 0), (14, 1), (1, 0), (60, 3)]))
def test_trailing_avg(make_bars, history, width, frame):
    days, until = frame
    rows = _rows(history)
    bars = make_bars(rows)
    df = op.trailing_avg(bars, "Close", days, until, out="avg", chunk_days=width)
    df = op.trailing_avg(df, "Close", days, until, out="exact", units=100, chunk_days=width)
    assert df.columns == [*bars.columns, "avg", "exact"]
    got = _by_symbol(df, "avg", "exact")
    for symbol, series in got.items():
        points = [(d, c) for s, d, c in rows if s == symbol]
        assert len(series) == len(points)
        for (date, avg, exact), (day, _) in zip(series, points):
            frame = [c for d, c in points if day - days <= d <= day - until]
            assert (date - EPOCH).days == day
            if not frame:
                assert avg is None and exact is None
                continue
            assert avg == pytest.approx(np.mean(frame), rel=1e-12)
            assert exact == sum(round(c * 100) for c in frame) / (100 * len(frame))
            assert min(frame) - 1e-9 <= avg <= max(frame) + 1e-9


@settings(SETTINGS, max_examples=3)
@given(histories, widths)
def test_feature_tables_do_not_depend_on_chunks(make_bars, history, width):
    bars = make_bars(_rows(history))
    for plan in (
        plans.price_features,
        lambda b, **kw: plans.price_features(b, "next_day", **kw),
        plans.direction_features,
        op.direction_target,
        op.relative_volume,
        op.time_split,
        op.time_split_by_date,
        lambda b, **kw: op.sequence_features(b, ["Close"], 4, block_rows=5, **kw),
    ):
        whole = sorted(plan(bars, chunk_days=100_000).collect())
        assert sorted(plan(bars, chunk_days=width).collect()) == whole


@SETTINGS
@given(histories, widths)
def test_direction_split_and_sequences(make_bars, history, width):
    rows = _rows(history)
    df = op.time_split(op.direction_target(make_bars(rows), chunk_days=width), chunk_days=width)
    df = op.sequence_features(df, ["Close"], 3, block_rows=2, chunk_days=width)
    for symbol, series in _by_symbol(df, "Close", "target", "is_train", "rn", "sequence").items():
        closes = [c for s, _, c in rows if s == symbol]
        n_train = int((0.7 * len(closes)) // 1)
        for i, (_, close, target, is_train, rn, sequence) in enumerate(series):
            assert close == closes[i] and rn == i + 1
            assert target == int(i > 0 and closes[i - 1] < close)
            assert is_train == (i < n_train)
            assert [x.Close for x in sequence] == closes[max(0, i - 2) : i + 1]


def test_frame_ends_are_calendar_days(make_bars):
    bars = make_bars([("A", 0, 10.0), ("A", 14, 20.0), ("B", 0, 10.0), ("B", 15, 20.0)])
    got = _by_symbol(op.trailing_avg(bars, "Close", 14, out="avg"), "avg")
    assert got["A"][1][1] == 15.0  # exactly 14 days back is inside
    assert got["B"][1][1] == 20.0  # 15 days back is not


def test_mean_deviation_uses_each_rows_own_mean(make_bars):
    closes = [10.0, 16.0, 13.0]
    bars = make_bars([("A", d, c) for d, c in enumerate(closes)])
    df = op.trailing_avg(fn.typical_price(bars), "TP", 14, out="DTP14")
    got = _by_symbol(op.mean_deviation(df), "TP", "DTP14", "MD14")["A"]
    own = [abs(tp - mean) for _, tp, mean, _ in got]
    for i, row in enumerate(got):
        assert row[3] == pytest.approx(np.mean(own[: i + 1]))


def test_running_sums_agree_with_frames(make_bars):
    rng = np.random.default_rng(7)
    days = sorted(rng.choice(600, 300, replace=False).tolist())
    bars = make_bars([(s, d, float(rng.integers(400, 5000)) / 100) for s in "AB" for d in days])
    for mode in ("same_day", "next_day"):
        plain = plans.price_features(bars, mode).orderBy("Stock", "Date").collect()
        quick = plans.price_features(bars, mode, units=100, chunk_days=90)
        quick = quick.orderBy("Stock", "Date").collect()
        assert len(plain) == len(quick) > 500
        for a, b in zip(plain, quick):
            assert (a.Stock, a.Date, a.is_train) == (b.Stock, b.Date, b.is_train)
            assert a[2:-1] == pytest.approx(b[2:-1], rel=1e-9, abs=1e-9)


def test_volume_relative_to_train_rows(make_bars):
    bars = make_bars([("A", d, 10.0) for d in range(10)])
    rows = plans.price_features(bars, train_only_volume=True).orderBy("Date").collect()
    volumes = [100.0 + d % 7 for d in range(10)]
    mean = np.mean(volumes[:7])
    assert [r.Volume for r in rows] == pytest.approx([v / mean for v in volumes])
    split = op.time_split(bars)
    alone = op.relative_volume(split, train_only=True).orderBy("Date").collect()
    assert [r.Volume for r in alone] == [r.Volume for r in rows]


def test_one_row_symbol(make_bars):
    row = plans.price_features(make_bars([("A", 0, 10.0)])).first()
    assert row.SMA == 10.0 and row.MD14 == 0.0 and row.is_train is False and row.Volume == 1.0


def test_split_boundary_is_float_floor(make_bars):
    split = op.time_split(make_bars([("A", d, 1.0) for d in range(90)]))
    assert split.filter("is_train").count() == 62
    ends = split.groupBy("is_train").agg(F.min("Date").alias("lo"), F.max("Date").alias("hi"))
    ends = {r.is_train: r for r in ends.collect()}
    assert ends[True].hi < ends[False].lo


@settings(SETTINGS, max_examples=4)
@given(histories, widths)
def test_both_time_splits_agree(make_bars, history, width):
    bars = make_bars(_rows(history))
    by_date = op.time_split_by_date(bars, chunk_days=width)
    numbered = op.time_split(bars, chunk_days=width).drop("rn")
    assert sorted(by_date.collect()) == sorted(numbered.collect())


def test_next_day_features_hold_nothing_of_today(make_bars):
    days = range(60)
    bars = make_bars([("A", d, 10.0 + d) for d in days])
    other = make_bars([("A", d, 10.0 + d if d < 59 else 500.0) for d in days])
    drop = ("label", "Volume")
    one, two = (
        plans.price_features(b, "next_day").drop(*drop).orderBy("Date").collect()
        for b in (bars, other)
    )
    assert one == two


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_hash_draws_ignore_the_layout(spark, make_bars, parts):
    bars = make_bars([(s, d, 1.0) for s in "AB" for d in range(500)])
    moved = bars.repartition(parts)
    assert sorted(op.hash_split(moved, [0.8, 0.2]).collect()) == sorted(
        op.hash_split(bars, [0.8, 0.2]).collect()
    )
    sample = op.hash_sample(moved, 0.05)
    assert sorted(sample.collect()) == sorted(op.hash_sample(bars, 0.05).collect())
    assert 20 < sample.count() < 90
    shares = op.hash_split(bars, [8, 2]).groupBy("split").count().collect()
    assert {r.split: 700 < r["count"] < 900 for r in shares} == {0: True, 1: False}
    assert op.hash_sample(bars, 1.0).count() == 1000


def test_except_is_a_set_difference(spark):
    a = spark.createDataFrame([(1,), (2,), (2,), (3,), (1,)], "x int")
    b = spark.createDataFrame([(1,)], "x int")
    assert sorted(r.x for r in op.except_rows(a, b).collect()) == [2, 3]


def test_prices_off_the_grid_are_an_error(make_bars):
    bars = make_bars([("A", d, 10.0 + d / 10_000) for d in range(5)])
    with pytest.raises(Exception, match="not in steps of 1/100"):
        op.trailing_avg(bars, "Close", 14, units=100).collect()
    assert op.trailing_avg(bars, "Close", 14, units=10_000).count() == 5


def test_a_missing_symbol_is_an_error(make_bars):
    bars = make_bars([("A", 1, 10.0), (None, 2, 11.0)])
    for plan in (plans.price_features, op.time_split, op.direction_target, op.time_split_by_date):
        with pytest.raises(Exception, match="has no Stock"):
            plan(bars).collect()


def _exactly(series, days, until=0):
    """Means of frames by math.fsum, which rounds an exact sum once."""
    day, value = [d for d, _ in series], [v for _, v in series]
    for d in day:
        frame = value[bisect_left(day, d - days) : bisect_right(day, d - until)]
        yield math.fsum(frame) / len(frame) if frame else None


@SETTINGS
@given(histories, widths, st.sampled_from([(14, 0), (14, 1), (60, 3)]), st.integers(-20, 39))
def test_exact_means_of_any_doubles(make_bars, history, width, frame, power):
    rng = np.random.default_rng(power + 99)
    rows = [(s, d, float(rng.standard_normal() + 3) * 2.0**power / 8) for s in history for d in sorted(history[s])]
    bars = make_bars(rows)
    got = _by_symbol(op.trailing_avg(bars, "Close", *frame, out="avg", exact=True, chunk_days=width), "avg")
    for symbol, series in got.items():
        assert [a for _, a in series] == list(_exactly([(d, c) for s, d, c in rows if s == symbol], *frame))


def test_exact_means_over_frames_of_100_000_rows(spark):
    rng = np.random.default_rng(4)
    n, days = 150_000, 100_000
    value = rng.lognormal(3, 4, n) * rng.choice([-1.0, 1.0], n)
    rows = spark.createDataFrame(list(zip(range(n), value.tolist())), "d int, Close double").selectExpr(
        "'A' AS Stock", "timestamp_seconds(d * 86400L) AS Date", "Close"
    )
    df = op.trailing_avg(rows, "Close", days, out="avg", exact=True, chunk_days=1 << 20)
    got = [r.avg for r in df.orderBy("Date").select("avg").collect()]
    for i in [0, 1, 99_999, 100_000, 100_001, 123_456, n - 1]:
        frame = value[max(0, i - days) : i + 1].tolist()
        assert got[i] == math.fsum(frame) / len(frame)


def test_exact_means_without_values_or_sums(spark):
    def means(*values):
        rows = [("A", datetime(2020, 1, 1 + i), v) for i, v in enumerate(values)]
        bars = spark.createDataFrame(rows, "Stock string, Date timestamp, Close double")
        return [r.avg for r in op.trailing_avg(bars, "Close", 1, out="avg", exact=True).orderBy("Date").collect()]

    assert means(None, None, 4.0, None, 0.1) == [None, None, 4.0, 4.0, 0.1]
    assert means(2.0**39, -(2.0**39), 0.1, 0.3) == [2.0**39, 0.0, (0.1 - 2.0**39) / 2, 0.2]
    for odd in (2.0**40, 1e-30, float("nan"), float("inf")):
        with pytest.raises(Exception, match="no exact sum"):
            means(1.0, odd)


def test_exact_deviations(make_bars):
    rows = [("A", d, 10 + (d * 7919 % 101) / 7) for d in range(60)]
    bars = fn.typical_price(make_bars(rows))
    means = op.trailing_avg(bars, "TP", 14, out="DTP14", exact=True)
    got = op.mean_deviation(means, exact=True).orderBy("Date").collect()
    want = _exactly([(i, abs(r.TP - r.DTP14)) for i, r in enumerate(got)], 14)
    assert [r.MD14 for r in got] == list(want)
