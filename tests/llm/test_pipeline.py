"""The pipeline keeps what it should, stage by stage."""

from __future__ import annotations

import corpus_pipeline
from lumenfold.llm.queries import oracle_sql, queries

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, DATA).cache()
        assert docs.columns == columns, name
        assert 0 < docs.count() <= before
        before = docs.count()
    placed = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert {r.doc_id for r in placed.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_queries_are_named():
    assert sorted(queries(), key=lambda n: int(n[2:].split("_")[0])) == list(sorted(queries(), key=lambda n: int(n[2:].split("_")[0])))
    assert {int(n[2:].split("_")[0]) for n in queries()} == set(range(1, 11))
    assert set(oracle_sql()) < set(queries())
