"""The stages, each against its operator's own results, and what is registered."""

import corpus_pipeline
import __spark_entry__ as entry
from barloom.llm import langid, secret_scan, simhash, toxicity
from barloom.llm.queries import LANGUAGE_FOLDS, QUERIES, TOXIC_FOLDS

SF = "/root/testdata/sf0.01"


def ids(df):
    return {r[0] for r in df.select("doc_id").collect()}


def test_everything_is_registered():
    own = entry.queries()
    assert QUERIES.keys() | {"pipeline"} <= own.keys()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_stages_decide_as_their_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "secrets", "packing"]

    model = toxicity.fit_toxicity(docs, labels, *TOXIC_FOLDS)
    toxic = {r.doc_id for r in toxicity.score_toxicity(docs, model).where("predicted = 1").collect()}
    clean = stages["toxicity"](spark, docs, SF).cache()
    assert toxic and ids(clean) == ids(docs) - toxic and clean.dtypes == docs.dtypes

    languages = langid.fit_languages(clean, *LANGUAGE_FOLDS)
    named = stages["language"](spark, clean, SF).cache()
    unknown = {r.doc_id for r in langid.identify(clean, languages).where("rejected").collect()}
    assert ids(named) == ids(clean) - unknown and named.dtypes == docs.dtypes

    once = stages["near_duplicates"](spark, named, SF).cache()
    first = {r.component_id for r in simhash.simhash_groups(named).collect()}
    assert ids(once) == first and once.count() == len(first) < named.count() and once.dtypes == docs.dtypes

    safe = stages["secrets"](spark, once, SF).cache()
    assert safe.count() == once.count() and safe.dtypes == docs.dtypes
    before = {r.doc_id: r for r in once.collect()}
    scanner = secret_scan.Scanner()
    for r in safe.collect():
        spans = scanner.spans(before[r.doc_id].text)
        if spans:
            assert r.text == secret_scan.redact(before[r.doc_id].text, spans) and r.n_chars == len(r.text)
        else:
            assert r == before[r.doc_id]

    packed = stages["packing"](spark, safe, SF)
    assert ids(packed) == ids(safe)
    whole = corpus_pipeline.run(spark, SF)
    assert {(r.doc_id, r.piece, r.ids_crc32) for r in whole.collect()} == {
        (r.doc_id, r.piece, r.ids_crc32) for r in packed.collect()
    }
    for df in (clean, named, once, safe):
        df.unpersist()


def test_no_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
