import duckdb
import numpy as np
import pandas as pd
import pytest

from barloom.llm import ranked_search
from barloom.llm.queries import ORACLE_SQL


def by_sql(sql, folder, **tables):
    con = duckdb.connect()
    for name, df in tables.items():
        path = f"{folder}/{name}.parquet"
        df.toPandas().to_parquet(path) if df.count() else df.toPandas().astype(object).to_parquet(path)
        columns = ", ".join(f"{c}::{'BIGINT' if t == 'bigint' else 'VARCHAR' if t == 'string' else t} AS {c}" for c, t in df.dtypes)
        con.sql(f"CREATE VIEW {name} AS SELECT {columns} FROM '{path}'")
    return con.sql(sql).df()


def same_rows(got, want):
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    got, want = (d[columns].astype(object).where(d[columns].notna(), None) for d in (got, want))
    key = lambda row: tuple((x is None, x if x is not None else 0) for x in row)
    assert sorted(map(tuple, got.to_numpy()), key=key) == sorted(map(tuple, want.to_numpy()), key=key)


WORDS = ["the", "The", "of", "été", "x1", "deep", "rare", "日本", "a-b", "ÀB", "zeta"]


@pytest.fixture(scope="module")
def tables(spark):
    rng = np.random.default_rng(3)
    draw = lambda n: " ".join(rng.choice(WORDS, n, p=np.array([9, 3, 6, 2, 1, 1, 0.2, 1, 1, 1, 0.5]) / 25.7))
    docs = [(i, draw(int(n)), "q") for i, n in enumerate(rng.integers(0, 60, 400))]
    docs += [(1000 + i, "the deep of", "q") for i in range(40)]  # ties
    docs += [(7, "rare rare", "q"), (7, "rare rare", "q"), (None, "rare", "q"), (None, "rare zeta", "q")]
    docs += [(2000, None, "q"), (2001, "", "q"), (2002, "-- !", "q"), (2003, "the " * 30_000, "q")]
    items = [(i, draw(int(n)), 1) for i, n in enumerate(rng.integers(1, 30, 12))]
    items += [(50, None, 1), (51, "", 1), (52, "unknown words", 1), (53, "rare", 1), (53, "rare", 1), (53, "zeta", 1)]
    items += [(54, "deep " * 9 + "the", 1)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score string"),
        spark.createDataFrame(items, "item_id long, text string, id int"),
    )


@pytest.mark.parametrize("shard, block", [(1 << 15, 100_000), (64, 5)])
def test_ranking_equals_sql(spark, tables, tmp_path, monkeypatch, shard, block):
    docs, items = tables
    monkeypatch.setattr(ranked_search, "SHARD_DOCS", shard)
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", block)
    got = ranked_search.search(docs.repartition(3), items).toPandas()
    want = by_sql(ORACLE_SQL["op12_ranked_search"], tmp_path, documents=docs.select("doc_id", "text"), benchmark=items.select("item_id", "text"))
    same_rows(got, want)


def test_lists_are_read_until_scores_are_exact():
    rng = np.random.default_rng(0)
    short = 0
    for trial in range(200):
        size, best = int(rng.integers(1, 3000)), int(rng.integers(1, 12))
        lists, whole, read = [], np.zeros(size, np.int64), 0
        for _ in range(rng.integers(0, 8)):
            docs = rng.permutation(size)[: rng.integers(0, size + 1)]
            scores = np.sort(rng.integers(0, rng.choice([3, 1000]), len(docs)))[::-1]
            lists.append((docs, scores))
            whole[docs] += scores
        floor = int(rng.choice([1, 5]))
        found, scores = ranked_search.read_lists(lists, size, best, floor)
        assert len(set(found.tolist())) == len(found)
        assert (whole[found] == scores).all()
        want = sorted(((-s, d) for d, s in enumerate(whole.tolist()) if s >= floor))[:best]
        assert sorted(zip((-scores).tolist(), found.tolist()))[:best] == want


def test_lists_with_a_clear_winner_are_not_read_to_the_end():
    class Watched(np.ndarray):
        longest = 0

        def __getitem__(self, part):
            if isinstance(part, slice) and part.stop is not None:
                Watched.longest = max(Watched.longest, part.stop)
            return np.asarray(super().__getitem__(part))

    n = 100_000
    scores = np.concatenate([[10**9], np.arange(n - 1, 0, -1)])
    found, exact = ranked_search.read_lists([(np.arange(n).view(Watched), scores)] * 2, n, 1)
    assert found.tolist() == [0] and exact.tolist() == [2 * 10**9]
    assert Watched.longest == ranked_search.FIRST


def test_empty_tables(spark, tables):
    docs, items = tables
    assert ranked_search.search(docs.limit(0), items).count() == 0
    assert ranked_search.search(docs, items.limit(0)).count() == 0
    blank = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    assert ranked_search.search(blank, items).count() == 0
    assert isinstance(ranked_search.search(blank, items).toPandas(), pd.DataFrame)
