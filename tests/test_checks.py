"""Key checks of a table in one scan."""

import pytest

from tidemark.plans import checks

GEOGRAPHY = "geography_key bigint, zip_code string, city string, state_code string"


def scans(frame):
    return frame._jdf.queryExecution().sparkPlan().toString().count("FileScan")


@pytest.fixture
def geography(spark, tmp_path):
    rows = [(1, "1", "a", "AL"), (1, "1", "a", "AL"), (2, "2", None, "AL"), (3, "2", None, "AL"), (None, "3", "b", "CA"), (None, None, None, None)]
    spark.createDataFrame(rows, GEOGRAPHY).write.parquet(str(tmp_path / "g"))
    return spark.read.schema(GEOGRAPHY).parquet(str(tmp_path / "g"))


def metrics(frame):
    return {(r.rule, r.target.split("(")[0]): (r.rows_checked, r.violations, r.detail) for r in frame.collect()}


def test_all_keys_of_a_table_from_one_scan(spark, geography):
    found = checks.check_keys({"dim_geography": geography})
    assert scans(found) == 1
    assert metrics(found) == {("primary_key", "dim_geography"): (6, 2, ""), ("not_null", "dim_geography"): (6, 2, ""),
                              ("natural_key", "dim_geography"): (6, 2, "")}
    both = [checks.check_unique(geography, ["geography_key"], "g", "primary_key"), checks.check_not_null(geography, ["geography_key"], "g"),
            checks.check_unique(geography, ["zip_code", "city", "state_code"], "g", "natural_key")]
    assert [tuple(r)[2:4] for part in both for r in part.collect()] == [(6, 2)] * 3


def test_a_table_without_rows_has_zeros(spark, geography):
    found = checks.check_keys({"dim_geography": geography.limit(0), "dim_chain": spark.createDataFrame([], "chain_key bigint, chain_name string")})
    assert {(r.rows_checked, r.violations) for r in found.collect()} == {(0, 0)} and found.count() == 6


def test_all_foreign_keys_of_a_fact_from_one_scan(spark, tmp_path):
    columns = list(checks.FOREIGN_KEYS["fact_snapshot"])
    rows = [(1, 1, 1, 1, 1), (1, -1, 1, 7, 1), (1, 2, -1, 7, None), (9, 1, 1, 1, 1)]
    schema = ", ".join(f"{c} bigint" for c in columns)
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "f"))
    tables = {"fact_snapshot": spark.read.schema(schema).parquet(str(tmp_path / "f"))}
    for dim, key in checks.FOREIGN_KEYS["fact_snapshot"].values():
        tables[dim] = spark.createDataFrame([(-1,), (1,), (2,)], f"{key} bigint")
    found = checks.check_foreign_keys(tables)
    assert scans(found) == 1
    got = {r.target.split(".")[1]: (r.rows_checked, r.violations, r.detail) for r in found.collect()}
    assert got == {"snapshot_date_key": (4, 1, "0 at Unknown"), "facility_key": (4, 0, "1 at Unknown"), "geography_key": (4, 0, "1 at Unknown"),
                   "ownership_key": (4, 2, "0 at Unknown"), "chain_key": (4, 1, "0 at Unknown")}
