"""The pipeline's stages, one by one and together."""

import corpus_pipeline
from obsflow.llm import contamination, near_duplicates

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    by_name = dict(corpus_pipeline.STAGES)
    assert list(by_name) == ["language_id", "near_duplicates", "decontamination", "secrets", "encoding"]
    known = by_name["language_id"](spark, docs, SF)
    assert known.schema == docs.schema and 0 < known.count() <= docs.count()
    single = by_name["near_duplicates"](spark, docs, SF)
    assert single.columns == docs.columns
    assert {r.doc_id for r in single.collect()} == {r.class_id for r in near_duplicates.classes(docs).collect()}
    clean = by_name["decontamination"](spark, docs, SF)
    bad = contamination.find_contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated")
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - {r.doc_id for r in bad.collect()}
    masked = by_name["secrets"](spark, docs, SF)
    assert masked.columns == docs.columns and masked.count() == docs.count()
    assert all(r.n_chars == len(r.text) for r in masked.collect())


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(r.round_trip and r.n_tokens == len(r.token_ids) for r in rows)
