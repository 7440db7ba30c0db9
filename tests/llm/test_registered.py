"""Registered corpus queries against their SQL, and the pipeline against its stages by hand."""

import pytest

import __spark_entry__ as registry
from checks.compare import connect, difference
from staypath.llm import queries
from tests.conftest import SF_DIR

import corpus_pipeline


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query_equals_sql(spark, name):
    df = registry.queries()[name](spark, SF_DIR)
    answer = connect(SF_DIR).execute(registry.oracle_sql()[name])
    assert difference((df.columns, [tuple(r) for r in df.collect()]), ([c[0] for c in answer.description], answer.fetchall())) is None


def test_every_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14)) and "pipeline" in registry.queries()


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF_DIR).cache()
        assert out.columns == docs.columns, name
        assert {r.doc_id for r in out.select("doc_id").collect()} <= {r.doc_id for r in docs.select("doc_id").collect()}
        docs = out
    left = docs.count()
    assert 0 < left < 200
    done = corpus_pipeline.run(spark, SF_DIR)
    assert done.count() == left and done.where("not lossless").count() == 0
