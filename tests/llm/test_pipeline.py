"""The registered queries against DuckDB, and the pipeline against its parts."""

import pytest

import corpus_pipeline
from medallion.checks.compare import compare_frames, duck_connection
from medallion.llm import oracle, queries
from medallion.llm.leaks import LeakParams, find_leaks
from medallion.llm.quality import score_documents
from tests.llm.test_jaccard import brute

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_query_equals_its_sql(llm_spark, name):
    result = compare_frames(queries.QUERIES[name](llm_spark, SF), duck_connection(SF), oracle.SQL[name])
    assert result["columns_match"] and result["hash_match"], result


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "ngram_jaccard", "decontaminate", "mix_sources", "shard"]


def test_each_stage_does_its_part_on_what_the_last_kept(llm_spark):
    from medallion.llm.common import staged, table
    from medallion.llm.jaccard import JaccardParams
    from medallion.llm.mixing import mix

    docs = table(llm_spark, SF, "documents")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, staged(stage(llm_spark, docs, SF), f"test-{name}")
        kept.append({r.doc_id for r in docs.select("doc_id").collect()})
        if name == "quality_classifier":
            want = {r.doc_id for r in score_documents(before, table(llm_spark, SF, "labels")).where("predicted = 1").collect()}
        if name == "ngram_jaccard":
            want = {top for _, top in brute([(r.doc_id, r.text) for r in before.collect()], JaccardParams(shingle=5, percent=80)).values()}
        if name == "decontaminate":
            leaked = {r.doc_id for r in find_leaks(before, table(llm_spark, SF, "benchmark"), params=LeakParams()).collect()}
            want = kept[-2] - leaked
        if name == "mix_sources":
            want = {r.doc_id for r in mix(before).where("kept").collect()}
        if name == "shard":
            want = kept[-2]
        else:
            assert docs.columns == table(llm_spark, SF, "documents").columns
        assert kept[-1] == want, name
    assert {r.doc_id for r in corpus_pipeline.run(llm_spark, SF).collect()} == kept[-1]


def test_stages_pass_empty_tables(llm_spark, no_documents):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(llm_spark, no_documents, SF)
        assert out.count() == 0 and (name == "shard" or out.columns == no_documents.columns)


def test_the_first_stage_passes_awkward_rows(llm_spark, odd_documents):
    kept = corpus_pipeline.quality_classifier(llm_spark, odd_documents, SF)
    good = {r.doc_id for r in score_documents(odd_documents, llm_spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
    assert kept.schema == odd_documents.schema and {r.doc_id for r in kept.collect()} == good


def test_stages_pass_awkward_rows(llm_spark, odd_documents):
    docs = odd_documents
    for name, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(llm_spark, docs, SF)
        assert name == "shard" or docs.columns == odd_documents.columns
    assert docs.count() > 0
