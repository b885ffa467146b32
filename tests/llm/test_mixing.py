import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import mixing
from barloom.llm.queries import ORACLE_SQL
from tests.llm.test_ranked_search import by_sql, same_rows

DDL = "doc_id long, text string, source string, size int, _key string, spans int"


def corpus(spark, rows):
    return spark.createDataFrame([(i, t, s, 7, "x", 1) for i, t, s in rows], DDL)


@pytest.fixture(scope="module")
def odd_rows():
    rng = np.random.default_rng(5)
    rows = [(i, " ".join(["w"] * int(n)), f"s{i % 7}") for i, n in enumerate(rng.integers(0, 300, 300))]
    rows += [(1000 + i, "a b\tc\x0bd  e", "hot") for i in range(3000)]
    rows += [(1, None, "s1"), (2, "", "s2"), (3, " \t\n", None), (None, "a b", None), (None, "a b c", None)]
    rows += [(4, "x y z", "s3"), (4, "x y z", "s3"), (5, " é x" * 900, "")]
    return rows


def test_mixture_equals_sql(spark, odd_rows, tmp_path):
    docs = corpus(spark, odd_rows)
    mixed = mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").toPandas()
    want = by_sql(ORACLE_SQL["op11_mixture"], tmp_path, documents=docs.select("doc_id", "text", "source"))
    same_rows(mixed, want)


def test_sources_meet_targets_and_words_are_taken_twice_at_most(spark, odd_rows):
    mixed = mixing.mix(corpus(spark, odd_rows)).cache()
    assert mixed.count() == len(odd_rows)
    over = mixed.where("taken > 2 * size or exists(spans, x -> x.times > 2 or x.stop > size)")
    assert over.count() == 0
    off = mixed.groupBy("source").agg(F.abs(F.sum("taken") - F.max("target")).alias("d")).toPandas()
    assert off.d.max() <= 2 * mixing.BLOCK
    again = mixing.mix(corpus(spark, odd_rows[::-1]).repartition(5))
    assert mixed.exceptAll(again).count() == 0
    other = mixing.mix(corpus(spark, odd_rows), seed=7)
    assert mixed.exceptAll(other).count() > 0


def test_spans_give_texts(spark):
    docs = corpus(spark, [(1, "a b  c\td", "s"), (2, "e f", "t")])
    mixed = mixing.mix(docs, block=2).join(docs.select("doc_id", "text"), "doc_id")
    for row in mixed.select("*", mixing.words_of().alias("cut")).collect():
        words = sum(len(c["text"].split()) * c["times"] for c in row["cut"])
        assert words == row["taken"]
        assert all(c["text"] in " ".join(row["text"].split()) for c in row["cut"])


def plain_targets(sizes, weights, share, most):
    goal, open_ = share * sum(sizes), set(range(len(sizes)))
    out = [0.0] * len(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        full = {i for i in open_ if goal * weights[i] / total >= most * sizes[i]}
        for i in full or open_:
            out[i] = most * sizes[i] if full else goal * weights[i] / total
        goal -= sum(out[i] for i in full)
        open_ = open_ - full if full else set()
    return out


def test_targets_equal_resharing_in_turns(spark):
    rng = np.random.default_rng(0)
    for n in (1, 2, 5, 40):
        sizes = [int(x) for x in (10 ** rng.uniform(0, 5, n))]
        table = spark.createDataFrame([(f"s{i:03}", s) for i, s in enumerate(sizes)], "source string, source_size long")
        got = [r["target"] for r in mixing.targets(table).orderBy("source").collect()]
        want = plain_targets(sizes, [(5, 2, 1)[i % 3] for i in range(n)], 1.5, 2)
        assert np.allclose(got, want)


def plain_seats(wanted, seats):
    held = [int(v) for v in wanted]
    for _ in range(seats - sum(held)):
        open_ = [i for i, v in enumerate(wanted) if held[i] < v and held[i] == int(v)]
        held[max(open_, key=lambda i: (wanted[i] / (2 * held[i] + 1), -i))] += 1
    return held


def test_seats_go_to_the_highest_quotients(spark):
    rng = np.random.default_rng(1)
    rows = [(g, i, float(v)) for g in range(6) for i, v in enumerate(rng.exponential(3, 30))]
    table = spark.createDataFrame(rows, "g int, i int, v double")
    seats = F.round(F.sum("v").over(mixing.W.partitionBy("g"))).cast("long")
    got = mixing.apportion(table, F.col("v"), seats, ["g"], "i").toPandas()
    for g, part in got.groupby("g"):
        part = part.sort_values("i")
        assert part._seats.tolist() == plain_seats(part.v.tolist(), round(part.v.sum()))


@pytest.mark.parametrize("rows", [[], [(1, None, None), (2, " ", "a")]])
def test_nothing_to_take(spark, rows):
    mixed = mixing.mix(corpus(spark, rows)).collect()
    assert len(mixed) == len(rows)
    assert all(r["taken"] == r["size"] == r["target"] == 0 and r["spans"] == [] for r in mixed)
