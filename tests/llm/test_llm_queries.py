"""The registered queries: their SQL where there is one, and what each must return."""

from __future__ import annotations

import duckdb
import pytest

import corpus_pipeline
from lotcraft.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SF_DIR)
    result = db.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(result.fetchall(), key=repr)


@pytest.mark.parametrize("number", range(1, 14))
def test_one_query_an_operator(number):
    assert sum(name.startswith(f"op{number}_") for name in queries.QUERIES) == 1


def test_pipeline_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut_lineage(stage(spark, docs, SF_DIR), "stage")
        assert docs.columns == columns, name
        assert 0 < docs.count() <= 3 * rows, name
