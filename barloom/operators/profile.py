"""Per-symbol data profile, correlations and binned densities.

All are one aggregate with map-side partials; the raw rows are never collected,
the output is bounded by symbols x columns x bins.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import KEY, TIME
from .chunks import join_symbols


def row_counts(df: DataFrame, key: str = KEY) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))


def _missing(df: DataFrame, col: str):
    missing = F.col(col).isNull()
    if df.schema[col].dataType.typeName() in ("double", "float"):
        missing = missing | F.isnan(col)
    return F.count(F.when(missing, 1)).alias(f"missing_{col}")


def profile(df: DataFrame, key: str = KEY, time: str = TIME) -> DataFrame:
    """Rows, date range, rows beyond the first per date, missing values per column."""
    others = [c for c in df.columns if c not in (key, time)]
    per_date = df.groupBy(key, time).agg(
        F.count(F.lit(1)).alias("_n"), *[_missing(df, c) for c in others]
    )
    return per_date.groupBy(key).agg(
        F.sum("_n").alias("n_rows"),
        F.min(time).alias("first_date"),
        F.max(time).alias("last_date"),
        (F.sum("_n") - F.count(F.lit(1))).alias("n_duplicates"),
        *[F.sum(f"missing_{c}").alias(f"missing_{c}") for c in others],
    )


def corr_pairs(
    df: DataFrame,
    cols: list[str],
    key: str = KEY,
    upper: bool = False,
    digits: int | None = None,
) -> DataFrame:
    """Pearson matrix per symbol as rows ``(key, col_i, col_j, r)``.

    Uses the rows complete in ``cols``. ``r`` is NULL when a column is constant.
    ``upper`` keeps the pairs above the diagonal only.
    """
    complete = df.na.drop(subset=cols)
    sums = [F.stddev_pop(c).alias(f"sd_{i}") for i, c in enumerate(cols)]
    pairs = list(combinations(range(len(cols)), 2))
    sums += [F.covar_pop(cols[i], cols[j]).alias(f"cv_{i}_{j}") for i, j in pairs]
    one_row = complete.groupBy(key).agg(*sums)

    def cell(i, j):
        if i == j:
            r = F.when(F.col(f"sd_{i}") > 0, F.lit(1.0))
        else:
            a, b = min(i, j), max(i, j)
            r = F.col(f"cv_{a}_{b}") / F.nullif(
                F.col(f"sd_{a}") * F.col(f"sd_{b}"), F.lit(0.0)
            )
        r = r if digits is None else F.round(r, digits)
        return F.struct(
            F.lit(cols[i]).alias("col_i"), F.lit(cols[j]).alias("col_j"), r.alias("r")
        )

    wanted = pairs if upper else [(i, j) for i in range(len(cols)) for j in range(len(cols))]
    cells = F.explode(F.array(*[cell(i, j) for i, j in wanted])).alias("_cell")
    return one_row.select(key, cells).select(key, "_cell.*")


def _ranges(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """Minimum and maximum per symbol and column.

    Joined back without a hint: one row per symbol is broadcast only while it is under the
    session's size threshold, beyond it a symbol's rows are spread over several join keys.
    """
    return df.groupBy(key).agg(
        *[F.min(c).alias(f"_lo_{i}") for i, c in enumerate(cols)],
        *[F.max(c).alias(f"_hi_{i}") for i, c in enumerate(cols)],
    )


def _bin(cols: list[str], i: int, bins: int):
    """Index of the equal-width bin; the maximum falls in the last, a constant in bin 0."""
    lo, hi = F.col(f"_lo_{i}"), F.col(f"_hi_{i}")
    share = (F.col(cols[i]) - lo) / F.nullif(hi - lo, F.lit(0.0))
    index = F.least(F.floor(share * bins), F.lit(bins - 1))
    return F.when(hi > lo, index).otherwise(0).cast("int")


def histogram(df: DataFrame, cols: list[str], bins: int = 10, key: str = KEY) -> DataFrame:
    """Counts per ``(key, column, bin)``; empty bins are absent."""
    rows = df.na.drop(subset=cols)
    rows = join_symbols(rows, _ranges(rows, cols, key), [key], df.columns)
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                _bin(cols, i, bins).alias("bin"),
                F.col(f"_lo_{i}").alias("lo"),
                F.col(f"_hi_{i}").alias("hi"),
            )
            for i, c in enumerate(cols)
        ]
    )
    return (
        rows.select(key, F.explode(cells).alias("_cell"))
        .select(key, "_cell.*")
        .groupBy(key, "column", "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    )


def density(
    df: DataFrame,
    cols: list[str],
    points: int = 50,
    bins: int = 256,
    key: str = KEY,
) -> DataFrame:
    """Gaussian kernel density per ``(key, column, x)`` at ``points`` even steps.

    Rows are first counted in ``bins`` bins and each bin weighs its centre (linear cost;
    Wand, 1994), so the kernel is evaluated ``bins * points`` times per column however many
    rows there are. Bandwidth by Scott's rule, ``sd * n^(-1/5)``; a constant column has none
    and is left out.
    """
    counts = histogram(df, cols, bins, key)
    centre = F.col("lo") + (F.col("bin") + 0.5) * (F.col("hi") - F.col("lo")) / bins
    spread = F.array(
        *[F.struct(F.lit(c).alias("column"), F.stddev_samp(c).alias("sd"),
                   F.count(F.lit(1)).alias("total")) for c in cols]
    )
    width = (
        df.na.drop(subset=cols)
        .groupBy(key)
        .agg(spread.alias("_c"))
        .select(key, F.explode("_c").alias("_c"))
        .select(key, "_c.column", (F.col("_c.sd") * F.pow("_c.total", F.lit(-0.2))).alias("h"),
                "_c.total")
    )
    step = (F.col("hi") - F.col("lo")) / (points - 1)
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i")
    rows = counts.filter("hi > lo")
    same = rows[key].eqNullSafe(width[key]) & (rows["column"] == width["column"])
    rows = rows.join(width, same).drop(width[key], width["column"])
    rows = rows.select(key, "column", "n", "h", "total", centre.alias("c"), "lo", step.alias("s"), grid)
    x = F.col("lo") + F.col("i") * F.col("s")
    z = (x - F.col("c")) / F.col("h")
    norm = F.col("total") * F.col("h") * math.sqrt(2 * math.pi)
    return (
        rows.select(key, "column", "i", x.alias("x"), (F.col("n") * F.exp(-z * z / 2) / norm).alias("d"))
        .groupBy(key, "column", "i")
        .agg(F.min("x").alias("x"), F.sum("d").alias("density"))
        .drop("i")
    )


def bins2d(df: DataFrame, cols: list[str], bins: int = 10, key: str = KEY) -> DataFrame:
    """Counts per ``(key, col_x, col_y, bin_x, bin_y)``: a scatter plot of bounded size."""
    rows = df.na.drop(subset=cols)
    rows = join_symbols(rows, _ranges(rows, cols, key), [key], df.columns)
    cells = F.array(
        *[
            F.struct(
                F.lit(cols[i]).alias("col_x"),
                F.lit(cols[j]).alias("col_y"),
                F.col(f"_b{i}").alias("bin_x"),
                F.col(f"_b{j}").alias("bin_y"),
            )
            for i, j in combinations(range(len(cols)), 2)
        ]
    )
    return (
        rows.select(key, *[_bin(cols, i, bins).alias(f"_b{i}") for i in range(len(cols))])
        .select(key, F.explode(cells).alias("_cell"))
        .select(key, "_cell.*")
        .groupBy(key, "col_x", "col_y", "bin_x", "bin_y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
