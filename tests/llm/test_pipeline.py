"""The pipeline on the smallest tables."""

import corpus_pipeline as pipeline

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    names, before = docs.columns, docs.count()
    for _, stage in pipeline.STAGES[:-2]:
        docs = stage(spark, docs, DIR).cache()
        assert docs.columns == names and 0 < docs.count() <= before
        before = docs.count()
    assert docs.select("doc_id").distinct().count() == before
    mixed = pipeline.STAGES[3][1](spark, docs, DIR)
    assert mixed.columns == names
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "mixing", "bpe"]


def test_run(spark):
    out = pipeline.run(spark, DIR)
    assert out.where("n_tokens <> size(ids)").count() == 0 and out.count() > 0
