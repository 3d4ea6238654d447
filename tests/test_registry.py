"""Registered queries against their SQL in DuckDB, on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from workload.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
# a sample of every family; TIDEMARK_ALL_QUERIES=1 compares all of them
SAMPLE = ["ingest_text_scan", "collapse_republished", "unpivot_population", "parse_date_vote", "fix_unit_drift",
          "scd2_build", "scd2_merge", "asof_lookup", "window_dedup", "window_dedup_merge", "publish_race", "key_audit", "dense_key", "fact_snapshot", "fact_penalty", "star_kpis",
          "v_facility_monthly", "measure_by_state_period", "kpis", "watchlist", "segment_compare", "staffing_controlled",
          "risk_backtest", "fines_timeline", "enforcement_summary", "finding_market", "check_keys", "run_log"]
NAMES = list(QUERIES) if os.environ.get("TIDEMARK_ALL_QUERIES") else SAMPLE

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def one(v):
        if isinstance(v, float):
            return repr(round(v, 6) + 0.0)
        return str(v)[:10] if hasattr(v, "isoformat") else str(v)

    return sorted(tuple(one(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    frame = entry.queries()[name](spark, FOLDER)
    answer = duck.sql(entry.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(answer.columns)
    assert comparable(frame.columns, [tuple(r) for r in frame.collect()]) == comparable(answer.columns, answer.fetchall())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
