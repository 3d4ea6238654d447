"""The registered queries against their SQL in DuckDB, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from tests.test_registry import FOLDER, TABLES, comparable
from tidemark.llm.oracles import ORACLES
from tidemark.llm.queries import QUERIES

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the driver's tables are not here")


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    frame = QUERIES[name](spark, FOLDER)
    answer = con.sql(ORACLES[name])
    assert sorted(frame.columns) == sorted(answer.columns)
    assert comparable(frame.columns, [tuple(r) for r in frame.collect()]) == comparable(answer.columns, answer.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_reads_every_row(spark, name):
    frame = QUERIES[name](spark, FOLDER)
    rows = frame.collect()
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    if "doc_id" in frame.columns:
        assert len(rows) == documents == len({r.doc_id for r in rows})
    else:
        assert len({i for r in rows for i in r.doc_ids}) <= documents
