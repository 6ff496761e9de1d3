"""The pipeline, stage by stage."""

import corpus_pipeline
from newsloom.llm.queries import ORACLES, QUERIES
from tests.llm.tables import edge, none

SF = "/root/testdata/sf0.001"


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_stages(spark):
    for docs in (spark.read.parquet(f"{SF}/documents.parquet"), edge(spark), none(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "packing":
                assert out.columns == docs.columns and out.count() <= docs.count()
                docs = corpus_pipeline.written(out)
            else:
                assert out.agg({"doc_tokens": "count"}).first()[0] >= docs.count()


def test_run_packs_what_the_stages_keep(spark):
    pieces = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"} == set(pieces.columns) and pieces.count() > 0
