import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests import snapshots
from tidemark.plans import checks, compare, dimensions, publish, runlog, semantic
from tidemark.plans.facts import PENALTY_FACT, fact_penalty
from tidemark.session import stored
from tidemark.sources import text


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    source = snapshots.build(tmp_path_factory.mktemp("source"))
    root = str(tmp_path_factory.mktemp("warehouse"))
    publish.build_warehouse(spark, source, root, "run-1", "2026-01-01T00:00:00")
    return source, root


def rows_of_star(spark, root):
    """The flat views of a published star, without surrogate keys: what readers see."""
    dims = {n: publish.read_table(spark, root, n) for n in (
        "dim_date", "dim_facility", "dim_geography", "dim_ownership", "dim_chain", "dim_penalty_type")}
    out = []
    for view in (semantic.facility_view(publish.read_table(spark, root, "fact_snapshot"), dims),
                 semantic.penalty_view(publish.read_table(spark, root, "fact_penalty"), dims), *dims.values()):
        shown = [c for c in sorted(view.columns) if not c.endswith("_key") or c.endswith("date_key")]
        out.append((shown, sorted([tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in view.select(*shown).collect()], key=str)))
    return out


def table(spark, root, name):
    return publish.read_table(spark, root, name)


def test_snapshot_fact(spark, built, rows):
    fact = table(spark, built[1], "fact_snapshot")
    got = rows(fact, "snapshot_date_key", "ccn", "certified_beds", "total_nursing_turnover_pct", "chain_key", "is_suspect", "resident_days")
    assert got == [
        (20190101, "015009", 60, None, -1, False, 48.0 * 31), (20190101, "015010", 0, None, -1, True, 48.0 * 31),
        (20201001, "015009", 60, 52.0, -1, False, 48.0 * 31), (20201001, "015011", 60, 40.0, -1, False, 48.0 * 31),
        (20260701, "015009", 61, 52.0, 1, False, 48.0 * 31), (20260701, "015011", 60, 52.0, 0, False, 48.0 * 31)]


def test_penalty_fact(spark, built, rows):
    fact = table(spark, built[1], "fact_penalty")
    got = rows(fact, "penalty_event_key", "penalty_date_key", "ccn", "fine_id", "fine_amount_usd", "payment_denial_days")
    # the re-priced 2018 fine keeps its last amount; the denial keeps its row, not its length
    assert got == [(1, 20180509, "015009", None, 5782, None), (2, 20180509, "015009", None, 5800, None),
                   (3, 20180601, "015010", None, None, None), (4, 20191225, "015009", "F1", 150, None),
                   (5, 20260105, "015011", "F2", 900, None)]


def test_dimensions(spark, built, rows):
    facility = table(spark, built[1], "dim_facility").filter("ccn = '015009'")
    got = rows(facility, "special_focus_status", "abuse_icon", "effective_date", "expiry_date", "is_current")
    day = dt.date
    assert got == [("None", True, day(2020, 10, 1), None, True), ("SFF", None, day(2019, 1, 1), day(2020, 10, 1), False)]
    geography = table(spark, built[1], "dim_geography")
    assert rows(geography, "geography_key", "city", "urban_rural") == [(-1, "Unknown", "Unknown"), (1, "SEARCY", "Unknown")]
    chain = table(spark, built[1], "dim_chain")
    assert rows(chain, "chain_key", "chain_name", "chain_size_band") == [
        (-1, "Unknown", "Unknown"), (0, "Independent (no chain)", "Independent (1)"), (1, "BIG CHAIN", "Large chain (50+)")]
    owner = table(spark, built[1], "dim_ownership")
    assert rows(owner, "ownership_type", "ownership_group")[-2:] == [("Tribal", "Unknown"), ("Unknown", "Unknown")]


def test_views_join_every_fact_row(spark, built):
    dims = {n: table(spark, built[1], n) for n in (
        "dim_date", "dim_facility", "dim_geography", "dim_ownership", "dim_chain", "dim_penalty_type")}
    facility = semantic.facility_view(table(spark, built[1], "fact_snapshot"), dims)
    penalty = semantic.penalty_view(table(spark, built[1], "fact_penalty"), dims)
    assert facility.count() == 6 and penalty.count() == 5
    assert compare.kpis(facility, penalty).first().m5_fine_usd == 5800 + 5782 + 150 + 900
    assert facility.filter("snapshot_month_th = 'กรกฎาคม'").count() == 2


def test_checks_pass_and_log_is_written(spark, built):
    log = spark.read.parquet(f"{built[1]}/run_log")
    assert log.filter("rule = 'fk'").count() == 11 and log.filter("step = 'load' and rows_affected > 0").count() == 0
    assert log.columns == [c.split()[0] for c in runlog.SCHEMA.split(", ")]


def test_cleaning_rules_are_logged(spark, built):
    log = spark.read.parquet(f"{built[1]}/run_log")
    fired = {r.rule for r in runlog.quality_log(log).collect()}
    assert fired == {f"Q{k}" for k in range(1, 9)}
    repeats = log.filter("rule = 'Q2' and target = 'provider_info' and detail like 'repeated%'").collect()
    assert [(r.snapshot_date, r.rows_affected) for r in repeats] == [("2019-01-01", 1)]
    assert {r.detail for r in log.filter("rule = 'Q2' and target = 'penalties' and detail like '%sightings%'").collect()} == {"7 sightings of 5 events"}
    assert log.filter("rule = 'Q5'").first().target == "ownership_type"
    assert not Path(built[1], "staged", "run-1").exists()


def test_quoted_line_breaks_and_short_rows(spark, tmp_path, rows):
    source = tmp_path / "source"
    snapshots.providers(source, "2026-07-29", "2026", [
        snapshots.provider(f"0150{k:02d}", provider_name=f"Home\n of, {k}" if k % 3 == 0 else f"Home {k}") for k in range(12)], "2026-07-01")
    snapshots.providers(source, "2026-08-29", "2026", [snapshots.provider(f"0150{k:02d}") for k in range(12)], "2026-08-01")
    broken = source / "2026-08-29" / "NH_ProviderInfo_Jun2026.csv"
    broken.write_text(broken.read_text("latin-1") + '"015099","short"\n', "latin-1")
    kinds = {l.path.split("/")[-2]: l.quoted_breaks for l in text.layouts(spark, [str(source)+"/2026-07-29/NH_ProviderInfo_Jun2026.csv", str(broken)])}
    assert kinds == {"2026-07-29": True, "2026-08-29": False}
    root = str(tmp_path / "warehouse")
    publish.build_warehouse(spark, str(source), root, "r", "2026-01-01T00:00:00")
    fact = publish.read_table(spark, root, "fact_snapshot")
    assert rows(fact.filter("snapshot_date_key = 20260701"), "ccn", "certified_beds") == [(f"0150{k:02d}", 60) for k in range(12)]
    names = publish.read_table(spark, root, "dim_facility").filter("provider_name = 'HOME OF, 3'")
    assert names.count() == 1
    log = spark.read.parquet(f"{root}/run_log").filter("detail like 'fields do not match%'").collect()
    assert [(r.target, r.rows_affected) for r in log] == [("provider_info", 1)]


def test_views_start_no_job(spark, built):
    dims = {n: table(spark, built[1], n) for n in (
        "dim_date", "dim_facility", "dim_geography", "dim_ownership", "dim_chain", "dim_penalty_type")}
    facts = table(spark, built[1], "fact_snapshot"), table(spark, built[1], "fact_penalty")
    context = spark.sparkContext
    context.setJobGroup("views", "views")
    semantic.facility_view(facts[0], dims)
    semantic.penalty_view(facts[1], dims)
    assert list(context.statusTracker().getJobIdsForGroup("views")) == []
    context.setJobGroup("", "")


def test_facts_plan_without_jobs_beside_writes(spark, built, monkeypatch):
    from tidemark.operators import ordering, votes
    from tidemark.plans import facts

    context = spark.sparkContext

    def writing(frame, *rest):
        context.setJobGroup("writes", "writes")
        out = stored(frame, *rest)
        context.setJobGroup("plan", "plan")
        return out

    for module in (ordering, votes):
        monkeypatch.setattr(module, "stored", writing)
    dims = {n: table(spark, built[1], n) for n in ("dim_facility", "dim_geography", "dim_ownership", "dim_chain")}
    names = ["ccn", "provider_name", "city", "state_code", "zip_code", "ownership_type", "chain_name", *facts._WHOLE, *facts._DECIMAL]
    rows = spark.createDataFrame([("015009", *["1"] * (len(names) - 1))], ", ".join(f"{n} string" for n in names)).withColumns(
        {"processing_date": F.lit("2026-07-01").cast("date"), "source_row": F.lit(1)})
    context.setJobGroup("plan", "plan")
    frame = facts.fact_snapshot(rows, dims, ["source_row"])
    # the size of the merged values behind the medians: a count of a stored table
    assert len(context.statusTracker().getJobIdsForGroup("plan")) <= 2
    context.setJobGroup("", "")
    assert frame.count() == 1


def test_a_window_of_fines_prunes_years(spark, built):
    from tidemark.plans import roster

    dims = {n: table(spark, built[1], n) for n in (
        "dim_date", "dim_facility", "dim_geography", "dim_ownership", "dim_chain", "dim_penalty_type")}
    fact = table(spark, built[1], "fact_penalty")
    penalty = semantic.penalty_view(fact, dims)
    seen = roster.in_window(penalty, F.lit("2026-07-01").cast("date"))
    assert sorted(r.penalty_year for r in seen.collect()) == [2026]
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_year" in plan
    assert [r.penalty_year for r in penalty.select("penalty_year").distinct().orderBy("penalty_year").collect()] == [2018, 2019, 2026]


def test_gate_keeps_readers_on_the_old_release(spark, built, tmp_path):
    root = built[1]
    bad = {"dim_ownership": table(spark, root, "dim_ownership").unionByName(
        table(spark, root, "dim_ownership").limit(1)).withColumn("ownership_group", F.lit("Other"))}
    with pytest.raises(checks.GateClosed) as closed:
        publish.publish(spark, bad, root, "run-bad", "2026-01-02T00:00:00")
    assert {p.rule for p in closed.value.problems} == {"primary_key", "natural_key", "known_group"}
    assert publish.current_release(spark, root).endswith("run-1")
    log = spark.read.parquet(f"{root}/run_log").filter("run_id = 'run-bad'")
    assert log.filter("rows_affected > 0").count() == 3
    publish.copy_log(spark, root, "run-bad", str(tmp_path / "log"))
    assert spark.read.option("header", True).csv(str(tmp_path / "log")).count() == log.count()


def test_new_release_replaces_the_old_one(spark, tmp_path):
    root = str(tmp_path)
    assert publish.current_release(spark, root) is None
    with pytest.raises(ValueError, match="nothing is published"):
        publish.read_table(spark, root, "dim_ownership")
    for run in ("a", "b"):
        table_ = spark.createDataFrame([(1, f"type {run}", "Unknown", False)],
                                       "ownership_key bigint, ownership_type string, ownership_group string, is_for_profit boolean")
        publish.publish(spark, {"dim_ownership": table_}, root, run, f"2026-01-0{'ab'.index(run) + 1}")
    assert publish.read_table(spark, root, "dim_ownership").first().ownership_type == "type b"


def test_stale_facts_and_unexpected_columns_are_refused(spark):
    dims = spark.createDataFrame([("v2",)], "key_version string")
    facts = spark.createDataFrame([("v2", 1), ("v1", 2)], "key_version string, x int")
    with pytest.raises(ValueError, match="rebuild"):
        checks.refuse_stale(facts, dims)
    assert checks.refuse_stale(facts.filter("x = 1"), dims).count() == 1
    with pytest.raises(ValueError, match=r"unexpected columns \['x'\]"):
        checks.conform(facts, ["key_version"], "fact")


def test_no_penalty_file_at_all(spark, rows):
    empty = fact_penalty(None, spark.range(0), {})
    assert empty.columns == PENALTY_FACT and empty.count() == 0
    types = dimensions.dim_penalty_type(None, spark)
    assert rows(types) == [(-1, "Unknown", False), (1, "Fine", True), (2, "Payment Denial", False)]


def test_calendar(spark):
    calendar = dimensions.dim_date(spark)
    known = checks.calendar_check(calendar).first()
    assert (str(known.first_day), str(known.last_day), known.missing_days, known.leap_days) == ("1960-01-01", "2027-12-31", 0, 17)
    row = calendar.filter("date_key = 20261124").first()
    assert (row.year, row.quarter, row.month, row.us_fiscal_year, row.covid_period) == (2026, 4, 11, 2027, "Post-COVID")
    edges = {r.date_key: r.covid_period for r in calendar.filter("date_key in (20200229, 20200301, 20211231, 20220101, -1)").collect()}
    assert edges == {20200229: "Pre-COVID", 20200301: "COVID", 20211231: "COVID", 20220101: "Post-COVID", -1: "Unknown"}


def test_run_log_of_the_cleaning_rules(spark):
    frame = spark.createDataFrame([("p", "015009", None), ("p", "015009", "1"), ("p", "15", "2")], "period string, ccn string, v string")
    nulls = runlog.log_nulls(runlog.null_report(frame, ["v", "ccn"], ["period"]), "period")
    keys = runlog.log_key_quality(runlog.key_quality(frame, "ccn", ["period"]), "period")
    log = runlog.run_log([nulls, keys], "r", "t")
    got = sorted((r.rule, r.target, r.rows_affected, r.detail) for r in log.collect())
    assert got == [("Q1", "ccn", 3, "1 wrong width, 1 duplicated"), ("Q3", "v", 1, "null in 33.3% of rows")]
    assert runlog.quality_log(log).count() == 2


def test_seeded_bad_versions(spark):
    day = lambda m: dt.date(2020, m, 1)
    versions = spark.createDataFrame([
        ("1", day(1), day(4), False), ("1", day(3), None, True), ("2", day(1), None, True), ("2", day(2), None, True),
        ("3", day(1), None, False)], "ccn string, effective_date date, expiry_date date, is_current boolean")
    got = {r.rule: r.violations for r in checks.scd2_check(versions).collect()}
    assert got == {"scd2_one_current": 1, "scd2_closed_has_expiry": 1, "scd2_no_overlap": 1}


def test_population_outside_the_plausible_range_is_refused(spark, tmp_path):
    few = spark.createDataFrame([("CA", "California", 2024, 6_000_000, "s"), ("CA", "California", 2024, 6_000_000, "s")],
                                "state_code string, state_name string, year int, pop_65plus bigint, source string")
    with pytest.raises(checks.GateClosed) as closed:
        publish.publish(spark, {"ref_state_population": few}, str(tmp_path), "r", "t")
    assert {p.rule for p in closed.value.problems} == {"primary_key", "unique", "enough_states", "plausible_total"}
