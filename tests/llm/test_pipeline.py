import brute
import corpus_pipeline
import pytest
from messy_texts import messy_texts
from termloom.llm.queries import llm_queries

SMOKE = "/root/testdata/sf0.001"


def test_stages_of_messy_documents(spark, messy):
    docs = messy
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMOKE)
        assert docs.schema == messy.schema, name
        docs = spark.createDataFrame(docs.collect(), messy.schema)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMOKE).collect()
    assert sorted({r.doc_id or -1 for r in packed}) == sorted({r.doc_id or -1 for r in docs.collect()})


def test_stages_pass_empty_tables_on(spark, no_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SMOKE).count() == 0


def test_one_document_of_a_group_stays(spark, messy):
    kept = corpus_pipeline.simhash_near_dedup(spark, messy, SMOKE).collect()
    docs = sorted(((i, t) for i, t, _, _ in messy_texts() if i is not None), key=lambda d: d[0])
    roots = brute.linked([brute.simhash(t) for _, t in docs])
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(docs[root][0] for root in set(roots))
    assert sum(r.doc_id is None for r in kept) == 2


def test_pipeline_equals_a_plain_version(spark):
    packed = corpus_pipeline.run(spark, SMOKE).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMOKE}/documents.parquet").collect()}
    ids = sorted(docs)
    roots = brute.linked([brute.simhash(docs[i]) for i in ids])
    kept = [(ids[r], docs[ids[r]]) for r in sorted(set(roots))]
    left = [i for (i, _), (_, gone, rest) in zip(kept, brute.without_repeats(kept, 50)) if rest or not gone]
    assert sorted({r.doc_id for r in packed}) == left


@pytest.mark.parametrize("name", sorted(llm_queries()))
def test_registered_queries_run(spark, name):
    assert llm_queries()[name](spark, SMOKE).count() > 0
