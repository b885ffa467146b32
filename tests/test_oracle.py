"""Every query with a SQL form gives DuckDB's rows: names, types, values."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SPARK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "BOOLEAN": "boolean",
}
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for row in rows:
        row = [row[i] for i in order]
        out.append(tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in row))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    described = duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()
    assert dict(df.dtypes) == {row[0]: SPARK_TYPES[row[1]] for row in described}
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    want = _rows(names, result.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert got
    assert got == want


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 1402


def test_a_wrong_frame_is_noticed(spark, duck, sf_dir):
    df = QUERIES["trailing_avg"](spark, sf_dir)
    wrong = duck.execute(ORACLES["trailing_avg"].replace("INTERVAL 14", "INTERVAL 13"))
    names = [d[0] for d in wrong.description]
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) != _rows(names, wrong.fetchall())
