"""The registered corpus queries beside their SQL, and the pipeline stage by stage."""

import os

import corpus_pipeline
import oracle
import pytest
from weirflow.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = QUERIES[name](spark, FOLDER)
    if name in SQL:
        assert oracle.compare(frame, con, SQL[name]) == []
    else:
        assert frame.count() > 0


def test_pipeline_keeps_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = spark.createDataFrame([(90001, None, "en", "src0", 0), (None, "", None, None, None), (90002, "a b", "en", "src1", 3), (90002, "a b", "en", "src1", 3)], docs.schema)
    docs = docs.unionByName(extra).selectExpr("*", "1 AS k", "'x' AS _row", "2 AS copies")
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0.6 * sizes[0]
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert set(docs.columns) < set(mixed.columns) and mixed.count() > sizes[-1]
