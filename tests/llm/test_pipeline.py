"""Each stage of the pipeline against a plain version, and the run as a whole."""

from __future__ import annotations

from collections import Counter
from llm_cases import documents, hard, no_docs  # noqa: F401

import corpus_pipeline
from siltstone.llm import language, quality
from siltstone.llm.common import settled


def test_stages_in_turn(spark, small, documents):
    kinds, docs = documents.dtypes, documents
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = Counter(map(tuple, docs.collect()))
        after = settled(stage(spark, docs, small), "test-pipeline")
        if k < 4:
            assert after.dtypes == kinds
            now = Counter(map(tuple, after.collect()))
            assert set(now) <= set(before)
        if k == 0:
            model = quality.train(docs, spark.read.parquet(f"{small}/labels.parquet"))
            good = {r.doc_id for r in quality.scored(docs, model).where("predicted = 1").collect()}
            assert {r.doc_id for r in after.collect()} == good
        if k == 1:
            found = language.identified(docs, language.train(docs)).where("lang_pred <> 'und' AND NOT ambiguous")
            assert {r.doc_id for r in found.collect()} == {r.doc_id for r in after.collect()}
        if k < 3:
            assert max(now.values()) == 1
        if k == 3:
            assert max(now.values()) <= 2
        if k == 4:
            whole = Counter(r.doc_id for r in docs.collect())
            assert Counter(r.doc_id for r in after.where("piece = 0").collect()) == whole
        docs = after


def test_stages_take_hard_and_no_documents(spark, small, hard, no_docs):
    clashing = hard.toDF(*no_docs.columns, "salt_", "size_", "letters_", "a.b")
    for docs in (hard.select(*no_docs.columns), clashing, no_docs):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = settled(stage(spark, docs, small), "test-pipeline")
            assert docs.columns == columns
        settled(corpus_pipeline.STAGES[-1][1](spark, docs, small), "test-pipeline").count()


def test_run_equals_its_stages(spark, small, documents):
    """The rows of ``run`` are those of the stages, each written and read again before the next."""
    docs = documents
    for _, stage in corpus_pipeline.STAGES:
        docs = settled(stage(spark, docs, small), "test-pipeline")
    found = settled(corpus_pipeline.run(spark, small), "test-pipeline")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert found.columns == docs.columns
    assert Counter(map(tuple, found.select(columns).collect())) == Counter(map(tuple, docs.select(columns).collect()))
    assert found.select("sequence_id").distinct().count() == docs.select("sequence_id").distinct().count()
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5 and corpus_pipeline.ORACLE_SQL is None
