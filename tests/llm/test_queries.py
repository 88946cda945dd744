"""Registered operator queries against their SQL, and the pipeline's stages."""

import duckdb
import pytest

import corpus_pipeline
from check_queries import TABLES, rows_of
from hearthmill.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, sql, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert len(got)
    if name in ORACLES:
        want = sql.execute(ORACLES[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)


def test_language_of_held_out_documents(spark):
    got = QUERIES["op1_language"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    right = got.where("held_out").join(truth, "doc_id").selectExpr("avg(cast(lang = lang_pred as int)) as a").first()["a"]
    assert right > 0.98


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF_DIR)
        assert after.columns == columns, name
        assert after.count() >= 0.7 * before.count(), name
        before = after
    mixed = corpus_pipeline.run(spark, SF_DIR)
    assert mixed.columns[: len(columns)] == columns
    assert {r[0] for r in mixed.select("doc_id").distinct().collect()} == {r[0] for r in before.select("doc_id").collect()}


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert docs.count() == 0
