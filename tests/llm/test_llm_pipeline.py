"""The registered queries of the package, and the pipeline's stages one after the other."""

import corpus_pipeline
from parity import compare, connect
from weirflow.llm import registry

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = registry.documents(spark, SF)
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, SF).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "byte_bpe":
            assert after.columns == columns
            before = after
    assert after.count() == before.count() > 100
    kept = {r.doc_id for r in after.collect()}
    from weirflow.llm import decontamination, ngram_join

    left = spark.read.parquet(f"{tmp_path}/pii")
    assert ngram_join.link_classes(spark.read.parquet(f"{tmp_path}/ngram_jaccard")).filter("component_id <> doc_id").count() == 0
    assert decontamination.contamination(spark.read.parquet(f"{tmp_path}/decontamination"), registry.benchmark(spark, SF)).filter(
        decontamination.is_contaminated()).count() == 0
    assert {r.doc_id for r in left.collect()} == kept
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, after.collect()))


def test_stages_without_documents(spark):
    empty = registry.documents(spark, SF).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_decontamination_equals_sql(spark):
    ok, note = compare(registry.op8_decontamination(spark, SF), connect(SF), registry.oracle_sql()["op8_decontamination"])
    assert ok, note
