"""Toxicity and language: held-out accuracy, what they learn from, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import langid, toxicity

LARGER = "/root/testdata/sf0.1"


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels")}


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit_toxicity(tables["documents"], tables["labels"])


def test_toxicity_on_held_out_documents(tables, model):
    scored = toxicity.score_toxicity(tables["documents"], model)
    rows = scored.join(tables["labels"], "doc_id").where("held_out").collect()
    assert all(fold(r.doc_id, 5) == 0 for r in rows)
    toxic = [r.score for r in rows if r.toxic == 1]
    clean = [r.score for r in rows if r.toxic == 0]
    area = np.mean([(t > c) + 0.5 * (t == c) for t in toxic for c in clean])
    assert area > 0.93
    assert np.mean([s >= 0.5 for s in toxic]) > 0.85
    assert np.mean([s >= 0.5 for s in clean]) < 0.02
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)


def test_held_out_labels_are_not_read(spark, tables, model):
    turned = tables["labels"].withColumn(
        "toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    assert toxicity.fit_toxicity(tables["documents"], turned) == model


def test_worst_sentence():
    own = toxicity.SentenceScorer(toxicity.ToxicModel({"moron": 6.0, "kind": -4.0}))
    text = "All fine here. You MORON! Bye."
    score, start, end = own.score(text)
    assert score > 0.9 and text[start:end].strip() == "You MORON"
    assert own.score("You kind moron. And so on")[0] < 0.6
    assert own.score("nothing") == (0.0, -1, -1) == own.score(None) == own.score("")
    twice = own.score("a moron kind. a moron kind.")[0]
    one = own.score("a moron kind.")[0]
    assert abs(twice - (1 - (1 - one) ** 2)) < 1e-12


def test_training_gradient():
    """Weights at rest have no slope: small moves don't make the likelihood better."""
    rng = np.random.default_rng(0)
    bags = [([rng.integers(0, 6, 3).tolist() for _ in range(rng.integers(1, 4))], int(rng.integers(0, 2))) for _ in range(80)]
    w = toxicity.train(bags, 6)

    def loss(w):
        total = 0.5 * toxicity.DECAY * (w * w).sum()
        for bag, y in bags:
            q = np.prod([1 - 1 / (1 + np.exp(-(toxicity.BIAS + w[s].sum()))) for s in bag])
            total -= np.log(1 - q if y else q) / len(bags)
        return total

    best = loss(w)
    for i in range(6):
        for step in (-0.05, 0.05):
            assert loss(w + step * np.eye(6)[i]) > best - 1e-4


ODD = [(1, None), (2, ""), (3, "word " * 100_000 + "moron."), (4, "A moron"), (4, "A moron"), (None, "ok")]


def test_toxicity_of_odd_rows(spark):
    frame = spark.createDataFrame(ODD, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS toxic")
    own = toxicity.ToxicModel({"moron": 6.0})
    rows = toxicity.score_toxicity(frame, own).collect()
    got = sorted(((r.doc_id, r.held_out, r.predicted) for r in rows), key=repr)
    want = [(i, i is not None and fold(i, 5) == 0, int("moron" in (t or ""))) for i, t in ODD]
    assert got == sorted(want, key=repr)
    kept = toxicity.drop_toxic(frame, own)
    assert kept.columns == frame.columns
    assert sorted(kept.select("doc_id").toPandas()["doc_id"].fillna(0)) == [0, 1, 2]
    empty = frame.limit(0)
    assert toxicity.score_toxicity(empty, own).count() == 0 == toxicity.drop_toxic(empty, own).count()


def test_toxicity_without_labels(spark, tables):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    nulls = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    for labels in (empty, nulls):
        own = toxicity.fit_toxicity(tables["documents"].limit(5), labels)
        assert own.weights == {}
        assert toxicity.score_toxicity(tables["documents"].limit(5), own).agg(F.max("score")).first()[0] == 0


def test_language_of_held_out_documents(tables):
    docs = tables["documents"]
    own = langid.fit_languages(docs)
    assert sorted(own.dictionaries) == ["de", "en", "es", "fr"]
    rows = langid.identify(docs, own).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert all(fold(r.doc_id, 4) == 2 for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
    assert np.mean([r.rejected for r in rows]) < 0.02
    wrong = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, "xx").otherwise(F.col("lang")))
    assert langid.fit_languages(wrong) == own


def test_margins():
    model = langid.LanguageModel({"a": b"hello there my friend " * 9, "b": b"bonjour mon cher ami " * 9})
    own = langid.Compressors(model)
    assert own.predict("Hello, THERE friend")[0] == "a"
    assert own.predict("mon cher ami, bonjour mon cher, bonjour cher ami")[0] == "b"
    assert own.predict("zzzz")[2] < langid.MIN_MARGIN
    assert [own.predict(t)[0] for t in (None, "", "123 $$ _")] == ["und"] * 3
    assert langid.Compressors(langid.LanguageModel({})).predict("x") == ("und", 0.0, 0.0)


def test_language_of_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", None), (3, "hello there " * 50_000, "en"), (5, "12 34", "fr"), (5, "12 34", "fr"), (None, "hello there", "en")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS score", "2 AS place")
    own = langid.fit_languages(frame.where("doc_id = 3"))
    found = langid.identify(frame, own)
    got = sorted(((r.doc_id, r.lang_pred) for r in found.collect()), key=repr)
    assert got == sorted([(1, "und"), (2, "und"), (3, "en"), (5, "und"), (5, "und"), (None, "en")], key=repr)
    kept = langid.drop_unidentified(frame, own)
    assert kept.columns == frame.columns and kept.count() == 2
    empty = frame.limit(0)
    assert langid.fit_languages(empty).dictionaries == {}
    assert langid.identify(empty, own).count() == 0 == langid.drop_unidentified(empty, own).count()


def test_copies_take_one_place_in_a_dictionary(spark):
    """Thousands of copies of each text: every text is in its language's dictionary all the same."""
    words = {f"l{n}": [f"{chr(97 + n)}{chr(97 + i % 26)}{chr(97 + i // 26)} " for i in range(60)] for n in range(2)}
    distinct = spark.createDataFrame([(lang, (w * 60).strip()) for lang, own in words.items() for w in own], "lang string, text string")
    docs = distinct.crossJoin(spark.range(300)).select(F.monotonically_increasing_id().alias("doc_id"), "lang", "text")
    own = langid.fit_languages(docs).dictionaries
    for lang, parts in words.items():
        assert [w for w in parts if w.strip().encode() not in own[lang]] == []
    # Texts that differ only beyond what is read of them are copies too.
    tails = spark.range(1000).selectExpr("id AS doc_id", "'x' AS lang", "repeat('same words ', 500) || id AS text")
    other = spark.createDataFrame([(i, "x", f"tale {'abcdefgh'[i % 8]}{'abcdefgh'[i // 8]}") for i in range(64)], "doc_id long, lang string, text string")
    found = langid.fit_languages(tails.unionByName(other)).dictionaries["x"]
    assert found.count(b"same words same") < 400 and found.count(b"tale") > 30


def test_only_copies_collapse_in_the_toxic_sample(spark, monkeypatch):
    """Unrelated documents that share a line stay; copies go before the sample is bounded."""
    line = min((f"a line that many of them share {i}" for i in range(50_000)), key=lambda s: zlib.crc32(s.encode()))

    def text(i):
        return f"{line}. " + ". ".join(f"sentence {k} of the document {i} alone" for k in range(6))

    ids = [i for i in range(2_000) if fold(i, 5)][:240]
    rows = [(i, text(n), n % 2) for n, i in enumerate(ids[:40])]
    rows += [(i, text("copied"), 1) for i in ids[40:]]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = toxicity._sample(frame.drop("toxic"), frame.drop("text"), 5, 0).collect()
    assert {(r.text, r.y) for r in got} == {(t, y) for _, t, y in rows} and len(got) == 41
    monkeypatch.setattr(toxicity, "SAMPLE_TOXIC", 21)
    assert sum(r.y for r in toxicity._sample(frame.drop("toxic"), frame.drop("text"), 5, 0).collect()) == 21


def test_a_tiny_language_is_learned(spark):
    rows = [(i, "the cat sat on the mat and the dog ran off", "en") for i in range(5)] + [(50, "xyq wvz kjh qqx zzv", "xx"), (51, "123", "nn")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_languages(docs, 1, 1)
    found = langid.identify(docs, model, 1, 1).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in found if r["doc_id"] != 51} == {**{i: "en" for i in range(5)}, 50: "xx"}
    assert {r["lang_pred"] for r in found} <= {"en", "xx", "und"}
