"""The operators' queries against their SQL, and the pipeline's stages against each other."""

import duckdb
import pytest

import corpus_pipeline
from check import TABLES, rows_of
from postlens.llm.queries import QUERIES, SQL
from postlens.llm.shared import load, session

DIRECTORY = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIRECTORY}/{t}.parquet'")
    cursor = con.execute(SQL[name])
    df = QUERIES[name](spark, DIRECTORY)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([c[0] for c in cursor.description], cursor.fetchall())


def test_pipeline(spark):
    session(spark)
    docs = load(spark, DIRECTORY, "documents")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, DIRECTORY)
        assert done.columns == docs.columns, name
        after = done.count()
        assert 0 < after <= before, name
        docs, before = spark.createDataFrame(done.collect(), docs.schema), after
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    packed = corpus_pipeline.run(spark, DIRECTORY)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids
