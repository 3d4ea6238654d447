"""The log of the cleaning rules against separate reports, and how often rows are read for it."""

from pyspark.sql import functions as F

from tests import snapshots
from tidemark import fixed_values as V
from tidemark.plans import cleaning_log, dimensions, facts, runlog
from tidemark.session import stored
from tidemark.sources.text import MALFORMED, POSITION, load_snapshots

TIME = "processing_date"


def lines(parts):
    return sorted(tuple(r) for part in parts for r in part.select("snapshot_date", "rule", "target", "rows_affected", "detail").collect())


def test_log_equals_separate_reports(spark, tmp_path):
    source = snapshots.build(tmp_path / "source")
    providers, penalties, survivors = load_snapshots(spark, source, None, str(tmp_path / "staged"))
    providers = stored(providers.unionByName(providers.limit(2).withColumns({"ccn": F.lit("12"), MALFORMED: F.lit(True)})), "rows")
    dims = dimensions.build_dimensions(providers, penalties, list(POSITION))
    snapshot = stored(facts.fact_snapshot(providers, dims, list(POSITION)), "fact")
    penalties = stored(penalties, "rows")
    events = penalties.limit(3)
    found = lines(cleaning_log.of_build(providers, penalties, survivors, {**dims, "fact_snapshot": snapshot, "fact_penalty": events}))
    plain = lines([
        runlog.log_key_quality(runlog.key_quality(providers, "ccn", [TIME]), TIME),
        runlog.log_nulls(runlog.null_report(providers, V.NULL_REPORT_FIELDS, [TIME]), TIME),
        runlog.log_suspects(runlog.suspect_report(snapshot, ["snapshot_date_key"]), "snapshot_date_key")])
    assert [l for l in found if l[1] in ("Q1", "Q3", "Q4")] == plain
    repeated = providers.groupBy(TIME, "ccn").count().filter("count > 1").groupBy(TIME).agg(F.sum(F.col("count") - 1).alias("n")).collect()
    assert [(l[0], l[3]) for l in found if l[4].startswith("repeated")] == sorted((str(r[TIME]), r.n) for r in repeated)
    bad = providers.filter(F.col(MALFORMED)).groupBy(TIME).count().collect()
    assert [(l[0], l[3]) for l in found if l[4].startswith("fields")] == sorted((str(r[TIME]), r["count"]) for r in bad)
    empty = [(str(p[TIME]), c) for p in providers.select(TIME).distinct().collect() for c in V.CANONICAL_COLUMNS[V.REQUIRED_FILE]
             if c in providers.columns and c != TIME and not providers.filter(F.col(TIME) == p[TIME]).agg(F.count(c)).first()[0]]
    absent = [(l[0], l[2]) for l in found if l[1] == "Q7"]
    assert set(empty) <= set(absent)


def test_staged_rows_of_a_kind_are_read_once(spark, tmp_path):
    path = str(tmp_path / "rows")
    columns = ["ccn", *[c for c in V.CANONICAL_COLUMNS["penalties"] if c not in ("ccn", TIME)]]
    spark.createDataFrame([["1"] * len(columns)], columns).withColumns({TIME: F.current_date(), MALFORMED: F.lit(False)}).write.parquet(path)
    plan = cleaning_log.profile(spark.read.parquet(path), "penalties")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1
