"""Questions on a small facility view and the traps they must not fall into."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.plans import (
    cohorts, compare, enforcement, findings, gradients, risk, roster, segments, semantic, states,
)
from tidemark.plans.semantic import Filters

P1, P2, P3 = dt.date(2019, 1, 1), dt.date(2026, 4, 1), dt.date(2026, 7, 1)
FACILITY = ("ccn string, snapshot_date date, state_code string, ownership_group string, chain_size_band string, "
            "certified_beds bigint, avg_residents_per_day double, reported_total_nurse_hprd double, "
            "total_nursing_turnover_pct double, overall_rating bigint, cycle1_total_deficiencies bigint, is_suspect boolean, "
            "special_focus_status string")


def key(d):
    return d.year * 10000 + d.month * 100 + d.day


def row(ccn, day, state="CA", owner="For profit", band="Large chain (50+)", beds=100, residents=80.0, hprd=3.5, turnover=45.0,
        rating=3, defic=5, suspect=False, focus="None"):
    return (ccn, day, state, owner, band, beds, residents, hprd, turnover, rating, defic, suspect, focus)


@pytest.fixture(scope="module", autouse=True)
def interpreted(spark):
    """Frames here hold a handful of rows: compiling each plan would take most of the time."""
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield
    spark.conf.unset("spark.sql.codegen.wholeStage")
    spark.conf.unset("spark.sql.codegen.factoryMode")


@pytest.fixture(scope="module")
def facility(spark):
    rows = [
        row("1", P1, turnover=None, band="Unknown", rating=4), row("2", P1, turnover=None, band="Unknown", owner="Non profit", rating=None),
        row("3", P1, "AK", turnover=None, band="Unknown", beds=50, residents=20.0),
        row("1", P2, rating=3, defic=4), row("2", P2, owner="Non profit", band="Independent (1)"),
        row("1", P3, rating=2, defic=7), row("2", P3, owner="Non profit", band="Independent (1)", rating=None, hprd=None),
        row("4", P3, "AK", "Government", "Small chain (2-9)", beds=0, residents=None, hprd=4.2, rating=5),
        row("5", P3, "TX", "Unknown", "Unknown", beds=20, residents=30.0, suspect=True, rating=1, hprd=2.0, turnover=75.0),
    ]
    frame = spark.createDataFrame(rows, FACILITY)
    day = F.col("snapshot_date")
    return frame.select(
        "*", (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint").alias("snapshot_date_key"),
        F.year(day).alias("snapshot_year"), F.date_format(day, "yyyy-MM").alias("snapshot_year_month"), F.lit("x").alias("covid_period"),
        (F.col("avg_residents_per_day") * 30).alias("resident_days"), (F.col("reported_total_nurse_hprd") / 4).alias("reported_rn_hprd"),
        F.concat(F.lit("State "), "state_code").alias("state_name"), F.lit("West").alias("census_region"),
        F.concat(F.lit("F"), "ccn").alias("provider_name"), F.col("ownership_group").alias("ownership_type"),
        F.when(F.col("chain_size_band") == "Unknown", "Unknown").otherwise("C").alias("chain_name"),
        F.lit(True).alias("abuse_icon"), F.lit(3).alias("health_inspection_rating"), F.lit(3).alias("staffing_rating"))


@pytest.fixture(scope="module")
def penalty(spark):
    rows = [("1", dt.date(2023, 7, 1), "Fine", 1000, None, "CA", "For profit", "Large chain (50+)"),
            ("1", P3, "Fine", 500, None, "CA", "For profit", "Large chain (50+)"),
            ("1", dt.date(2023, 6, 30), "Fine", 9999, None, "CA", "For profit", "Large chain (50+)"),
            ("2", dt.date(2025, 1, 1), "Payment Denial", None, 30, "CA", "Non profit", "Independent (1)"),
            ("3", dt.date(2017, 5, 5), "Fine", 70, None, "AK", "For profit", "Unknown")]
    frame = spark.createDataFrame(rows, "ccn string, penalty_date date, penalty_type string, fine_amount_usd bigint, "
                                  "payment_denial_days bigint, state_code string, ownership_group string, chain_size_band string")
    return frame.select("*", F.year("penalty_date").alias("penalty_year"), F.quarter("penalty_date").alias("penalty_quarter"),
                        F.lit(1).cast("bigint").alias("penalty_count"), F.lit("West").alias("census_region"))


@pytest.fixture(scope="module")
def population(spark):
    return spark.createDataFrame([(s, y, 1000 * n) for n, s in enumerate(("AK", "CA"), 1) for y in (2020, 2024)],
                                 "state_code string, year int, pop_65plus bigint")


CASES = {
    "single period": Filters(periods=[key(P3)]), "earliest period": Filters(periods=[key(P1)]), "state and ownership": Filters(states=["CA"], ownership=["Non profit"]),
    "nothing": Filters(states=["AK"], ownership=["Government"], chain_bands=["Large chain (50+)"]),
    "no suspects": Filters(include_suspect=False), "large chains": Filters(chain_bands=["Large chain (50+)"]),
}


@pytest.mark.parametrize("case", CASES)
def test_every_question_survives_every_filter(facility, penalty, population, case):
    f = CASES[case]
    saturation = semantic.market_saturation(facility, population)
    frames = [
        compare.trend(facility, f), compare.penalties_by_year(penalty, f), compare.penalties_by_state(facility, penalty, f),
        compare.compare_ownership(facility, penalty, f), compare.compare_chain(facility, penalty, f),
        compare.hprd_bands(facility, f), compare.turnover_bands(facility, f), compare.market(facility, saturation, f),
        compare.watchlist(facility, penalty, f), compare.watchlist_summary(facility, f), compare.kpis(facility, penalty, f)]
    for frame in frames:
        frame.collect()
    found = findings.all_findings(facility, penalty, saturation, f).collect()
    assert len(found) == 9 and {r.strength for r in found} <= {"solid", "tentative", "blocked"}
    if case == "nothing":
        assert {r.strength for r in found} == {"blocked"}


def test_filters_do_not_depend_on_order():
    a, b = Filters(states=["B", "A"], periods=[2, 1]), Filters(states=("A", "B"), periods=(1, 2))
    assert a == b and hash(a) == hash(b) and a != Filters(states=["A"])


def test_latest_is_inside_the_filter_and_penalties_ignore_the_period(facility, penalty):
    early = Filters(periods=[key(P1)])
    got = compare.kpis(facility, penalty, early).first()
    assert (got.latest_period_key, got.facilities, got.m5_fine_usd, got.m6_penalty_events) == (key(P1), 3, 11569, 5)
    assert got.m4_turnover_pct is None                              # absent column: null, not 0


def test_suspects_stay_in_filtered_questions_and_out_of_the_roster(facility, penalty):
    assert compare.kpis(facility, penalty).first().facilities == 4
    assert roster.facility_roster(facility, penalty).count() == 3
    assert roster.facility_roster(facility, penalty, f=Filters()).count() == 4


def test_fine_window_includes_both_ends(facility, penalty):
    got = {r.ccn: (r.fine_total, r.fine_events, r.denial_days, r.fines_per_bed) for r in roster.facility_roster(facility, penalty).collect()}
    assert got == {"1": (1500, 2, 0, 15.0), "2": (0, 0, 30, 0.0), "4": (0, 0, 0, None)}
    context = roster.roster_context(facility, penalty).first()
    assert (str(context.window_start), str(context.window_end), context.facilities, context.beds) == ("2023-07-01", "2026-07-01", 3, 200)


def test_segments_count_rated_facilities_and_stay_whole(facility, penalty):
    got = {r.segment: r for r in segments.segment_compare(facility, penalty, "ownership_group").collect()}
    assert set(got) == {"For profit", "Non profit", "Government"}
    assert (got["Non profit"].facilities, got["Non profit"].rated_facilities, got["Non profit"].avg_rating) == (1, 0, None)
    assert (got["Non profit"].fined_facilities, got["Non profit"].fine_total) == (1, 0)     # a denial counts
    assert got["Government"].occupancy is None and got["Government"].fines_per_bed is None
    fan = segments.fanout_check(facility, penalty, "For profit").first()
    assert (fan.true_beds, fan.naive_beds, fan.inflation) == (100, 300, 3.0)


def test_differences_are_between_bands_that_exist(spark):
    frame = spark.createDataFrame([(10.0, 2), (10.0, 4), (62.0, 5), (150.0, 1)], "turnover_pct double, rating bigint").withColumns({
        "beds": F.lit(10), "residents": F.lit(5.0), "nurse_hprd": F.lit(None).cast("double"), "fine_total": F.lit(0),
        "was_fined": F.lit(False), "deficiencies": F.lit(1), "health_inspection_rating": F.lit(2)})
    got = gradients.turnover_gradient(frame).collect()
    assert [(r.band, r.facilities, r.d_avg_rating, r.nurse_hprd) for r in got] == [("< 30%", 2, None, 0.0), ("60-65%", 1, 2.0, 0.0)]
    assert got[0].national_turnover_median == 36.0


def test_zero_cut_flags_everyone(spark):
    frame = spark.createDataFrame([(str(i), 0.0, i, None, 4, "None") for i in range(4)],
                                  "ccn string, fines_per_bed double, deficiencies int, nurse_hprd double, rating int, special_focus_status string")
    got = risk.risk_score(frame).orderBy("ccn").collect()
    assert [(r.flag_prior_fine, r.risk_score, r.risk_reasons) for r in got] == [
        (True, 2, "heavily fined")] * 3 + [(True, 3, "heavily fined, many deficiencies")]
    quiet = risk.risk_score(frame.withColumn("fines_per_bed", F.lit(None).cast("double")).withColumn("deficiencies", F.lit(None).cast("int")))
    assert {(r.risk_score, r.risk_reasons) for r in quiet.collect()} == {(0, "-")}


def test_trajectory_starts_with_the_first_period_of_the_year(facility, penalty):
    scored = risk.risk_score(roster.facility_roster(facility, penalty))
    got = {r.ccn: (r.rating_change, r.deficiency_change, r.declining) for r in risk.with_trajectory(scored, facility).collect()}
    assert got == {"1": (-1, 3, True), "2": (None, 0, False), "4": (None, None, False)}
    first = risk.risk_score(roster.facility_roster(facility, penalty, key(P2)))
    assert {r.rating_change for r in risk.with_trajectory(first, facility, key(P2)).collect()} == {None}
    assert risk.risk_watchlist(risk.with_trajectory(scored, facility), 2).count() == 2


def test_backtest_and_lift(facility, penalty):
    scored = risk.risk_score(roster.facility_roster(facility, penalty, key(P1)))
    outcome = risk.with_outcome(scored, facility, penalty, key(P3), F.lit(P3))
    got = {r.ccn: (r.exited, r.fines_later, r.fined_later) for r in outcome.collect()}
    assert got == {"1": (False, 1500, True), "2": (False, 0, False), "3": (True, None, False)}
    lift = risk.risk_lift(outcome).first()
    assert (lift.population, lift.base_pct_fined, round(lift.base_pct_exited, 4)) == (3, 50.0, 33.3333)
    assert sum(r.facilities for r in risk.risk_backtest(outcome).collect()) == 3


def test_cohort_and_exit(facility):
    pairs = cohorts.matched_cohort(facility, key(P1))
    assert sorted((r.ccn, r.rating_from, r.rating_to, r.ownership_group) for r in pairs.collect()) == [
        ("1", 4, 2, "For profit"), ("2", None, None, "Non profit")]
    summary = cohorts.matched_summary(pairs).first()
    assert (summary.matched_facilities, summary.rating_change, summary.pct_declined) == (2, -2.0, 100.0)
    left = cohorts.capacity_exit(facility, key(P1)).first()
    assert (left.exited_facilities, left.exited_beds, left.exited_occupancy_before) == (1, 50, 0.4)
    same = cohorts.capacity_exit(facility, key(P1), key(P1)).first()
    assert (same.exited_facilities, same.exited_share_pct, same.exited_rating_before) == (0, 0.0, 0.0)


def test_exit_ignores_suspects_on_the_later_side(spark, facility):
    later = facility.withColumn("is_suspect", F.col("snapshot_date_key") == key(P3))
    assert cohorts.capacity_exit(later, key(P1)).first().exited_facilities == 1


def test_population_year_newest_against_nearest(spark, facility, population):
    early = states.state_market(facility, population, key(P1), min_facilities=1)
    assert {r.state_code: r.pop_65plus for r in early.collect()} == {"CA": 2000, "AK": 1000}
    assert states.nearest_year(population, F.lit(2022)).first().population_year == 2020      # earlier on a tie
    assert semantic.market_saturation(facility, population).select("population_year").distinct().count() == 2   # null for a state without
    ranked = states.opportunity_score(states.state_market(facility, population, min_facilities=1)).collect()
    assert [(r.state_code, r.rank) for r in ranked if r.rank] and all(r.pop_65plus for r in ranked if r.rank)


def test_eras_follow_from_the_data(spark):
    def rows(quarters):
        return spark.createDataFrame([(y, q, k, 10, None, "1", "CA") for y, q in quarters for k in ("Fine", "Payment Denial")],
                                     "penalty_year int, penalty_quarter int, penalty_type string, fine_amount_usd bigint, "
                                     "payment_denial_days bigint, ccn string, state_code string")
    gappy = enforcement.fines_timeline(rows([(2016, 4), (2017, 1), (2017, 2), (2023, 1), (2023, 2), (2023, 3)]))
    got = [(r.year_quarter, r.era, r.incomplete) for r in gappy.collect() if r.penalty_type == "Fine"]
    assert got == [("2016-Q4", 0, False), ("2017-Q1", 0, True), ("2017-Q2", 0, True), ("2023-Q1", 1, False), ("2023-Q2", 1, True), ("2023-Q3", 1, True)]
    assert enforcement.fines_timeline(rows([(2020, 1)]), ["NY"]).count() == 0


def test_box_and_mix(spark):
    frame = spark.createDataFrame([("a", float(v), v % 5 + 1) for v in [1, 2, 3, 4, 5, 100]] + [("b", None, None)],
                                  "segment string, x double, rating int")
    box = segments.box_stats(frame, "x").collect()
    assert [(r.segment, r.n, r.whisker_low, r.median, r.whisker_high) for r in box] == [("a", 6, 1.0, 3.5, 5.0)]
    mix = segments.rating_mix(frame).collect()
    assert len(mix) == 5 and abs(sum(r.share for r in mix) - 1) < 1e-12


def test_monotone_direction(spark):
    cross = spark.createDataFrame([("a", 0, 3.0), ("a", 1, 2.0), ("a", 3, 1.0), ("b", 0, 1.0), ("b", 1, 1.0), ("c", 0, 1.0)],
                                  "ownership string, chain_ord int, m double")
    got = {r.ownership: (r.steps, r.monotone) for r in segments.monotone_check(cross, "m", True).collect()}
    assert got == {"a": (2, True), "b": (1, False), "c": (0, True)}


def test_parity_notices_a_changed_formula(facility):
    view = semantic.measure_by_state_period(facility)
    assert all(r.within_tolerance for r in compare.measure_parity(facility, view).collect())
    wrong = view.withColumn("m1_occupancy_rate", F.col("m1_occupancy_rate") + 0.01)
    assert [r.measure for r in compare.measure_parity(facility, wrong).collect() if not r.within_tolerance] == ["m1_occupancy_rate"]


def test_concentration_counts_every_state(spark):
    from tidemark.plans import findings

    n = 150
    facility = spark.createDataFrame(
        [(20260701, f"S{k:03d}", 100, False) for k in range(n)],
        "snapshot_date_key int, state_code string, certified_beds int, is_suspect boolean")
    # the five largest totals have the lowest rate per bed
    from unittest import mock
    rows = spark.createDataFrame([(f"S{k:03d}", 100 if k < 145 else 100_000, 1000 if k < 145 else 20_000, (10.0 if k < 145 else 0.2)) for k in range(n)],
                                 "state_code string, total_beds long, m5_fine_usd long, fine_per_bed double")
    with mock.patch.object(findings, "fines_per_bed_by_state", lambda *_: rows):
        found = findings.finding_concentration(facility, facility).first().asDict()
    assert n in found.values()
    share = 5 * 20_000 / (5 * 20_000 + 145 * 1000)
    assert any(isinstance(v, float) and abs(v - share) < 1e-9 for v in found.values())
