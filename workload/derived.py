"""Findings: the numbers each rests on."""

from tidemark.plans import findings, semantic
from tidemark.plans.semantic import Filters
from workload.registry import query
from workload.views import HPRD_SQL, MARKET_SQL, SUMMARY_SQL, TURNOVER_SQL, WATCH_SQL, by_state_sql, compare_sql

FINDING = "bq:s strength:s label_a:s label_b:s value_a:f value_b:f gap:f n:i"


def row(bq, strength, label_a, label_b, value_a, value_b, gap, n, source, where="TRUE"):
    return f"""SELECT '{bq}' AS bq, {strength} AS strength, {label_a} AS label_a, {label_b} AS label_b, {value_a} AS value_a,
    {value_b} AS value_b, {gap} AS gap, {n} AS n FROM {source} WHERE {where}"""


GROUPS = f"(SELECT * FROM ({compare_sql('ownership_group')}) c WHERE grp <> 'Unknown' AND m7_avg_overall_rating IS NOT NULL)"


@query("finding_group_gap", FINDING, row(
    "BQ2", "'solid'", "hi.grp", "lo.grp", "hi.m7_avg_overall_rating", "lo.m7_avg_overall_rating",
    "hi.m7_avg_overall_rating - lo.m7_avg_overall_rating", f"(SELECT SUM(facilities) FROM {GROUPS} s)",
    f"(SELECT * FROM {GROUPS} a ORDER BY m7_avg_overall_rating DESC, facilities DESC, grp DESC LIMIT 1) hi, "
    f"(SELECT * FROM {GROUPS} b ORDER BY m7_avg_overall_rating, facilities DESC, grp LIMIT 1) lo"))
def finding_group_gap(f):
    return findings.finding_group_gap(f.facility, f.penalty)


SCALE = f"(SELECT * FROM ({compare_sql('chain_size_band')}) c WHERE m3_nurse_hprd IS NOT NULL AND facilities >= 10)"


@query("finding_scale", FINDING, row(
    "BQ8", f"CASE WHEN (SELECT COUNT(*) FROM {SCALE} s) >= 2 THEN 'solid' ELSE 'blocked' END", "lo.grp", "hi.grp", "lo.m3_nurse_hprd",
    "hi.m3_nurse_hprd", "hi.m3_nurse_hprd - lo.m3_nurse_hprd", f"COALESCE((SELECT SUM(facilities) FROM {SCALE} s), 0)",
    "(SELECT 1) one "
    f"LEFT JOIN (SELECT * FROM {SCALE} a ORDER BY m3_nurse_hprd DESC, facilities DESC, grp DESC LIMIT 1) hi ON TRUE "
    f"LEFT JOIN (SELECT * FROM {SCALE} b ORDER BY m3_nurse_hprd, facilities DESC, grp LIMIT 1) lo ON TRUE"))
def finding_scale(f):
    """Bands of at least 10 facilities: the smaller folders have few."""
    return findings.finding_scale(f.facility, f.penalty, min_group=10)


def steps(bands: str, label: str, sign: str) -> str:
    return f"""(SELECT *, {sign}(m7_avg_overall_rating - LAG(m7_avg_overall_rating) OVER (ORDER BY lowest)) AS step,
    LAG({label}) OVER (ORDER BY lowest) AS prev, LAG(m7_avg_overall_rating) OVER (ORDER BY lowest) AS prev_value
    FROM ({bands}) b WHERE m7_avg_overall_rating IS NOT NULL)"""


def steepest(bq: str, bands: str, label: str, sign: str) -> str:
    stepped = steps(bands, label, sign)
    return row(bq, "'solid'", "prev", label, "prev_value", "m7_avg_overall_rating", "step",
               f"(SELECT SUM(facilities) FROM {stepped} t)",
               f"(SELECT * FROM {stepped} s WHERE step IS NOT NULL ORDER BY step DESC, lowest LIMIT 1) x")


@query("finding_marginal_gain", FINDING, steepest("BQ3", HPRD_SQL, "hprd_band", "+"))
def finding_marginal_gain(f):
    return findings.finding_marginal_gain(f.facility)


@query("finding_cliff", FINDING, steepest("BQ4", TURNOVER_SQL, "turnover_band", "-"))
def finding_cliff(f):
    return findings.finding_cliff(f.facility)


FINED = f"(SELECT * FROM ({by_state_sql('TRUE', 'TRUE')}) s WHERE m5_fine_usd > 0)"


@query("finding_concentration", FINDING, row(
    "BQ7", "'solid'", "h.state_code", "s.state_code", "h.fine_per_bed", "s.fine_per_bed",
    f"(SELECT SUM(m5_fine_usd) FROM (SELECT * FROM {FINED} f ORDER BY m5_fine_usd DESC, state_code LIMIT 5) t) / CAST((SELECT SUM(m5_fine_usd) FROM {FINED} f) AS DOUBLE)",
    f"(SELECT COUNT(*) FROM {FINED} f)",
    f"(SELECT * FROM {FINED} f ORDER BY fine_per_bed DESC, state_code LIMIT 1) h, "
    f"(SELECT * FROM {FINED} f WHERE total_beds >= (SELECT quantile_cont(CAST(total_beds AS DOUBLE), 0.5) FROM {FINED} m) ORDER BY fine_per_bed, state_code LIMIT 1) s"))
def finding_concentration(f):
    return findings.finding_concentration(f.facility, f.penalty)


TREND = """(SELECT snapshot_date_key, snapshot_year_month, SUM(avg_residents_per_day) / NULLIF(SUM(certified_beds), 0) AS occ
  FROM fx_facility GROUP BY 1, 2)"""


@query("finding_trend", FINDING, row(
    "BQ5", "'tentative'", "a.snapshot_year_month", "b.snapshot_year_month", "a.occ", "b.occ", "(b.occ - a.occ) * 100",
    f"(SELECT COUNT(*) FROM {TREND} t)",
    f"(SELECT * FROM {TREND} t ORDER BY snapshot_date_key LIMIT 1) a, (SELECT * FROM {TREND} t ORDER BY snapshot_date_key DESC LIMIT 1) b"))
def finding_trend(f):
    return findings.finding_trend(f.facility)


@query("finding_decline", FINDING, row(
    "BQ6", "'solid'", "'declined'", "'fined among the five worst'", "declined",
    f"(SELECT COUNT(*) FROM ({WATCH_SQL % 5}) w WHERE fines_usd > 0)", "declined * 100.0 / compared", "compared", f"({SUMMARY_SQL}) s"))
def finding_decline(f):
    return findings.finding_decline(f.facility, f.penalty)


STATES = f"(SELECT * FROM ({MARKET_SQL % ('TRUE', 'TRUE')}) m WHERE facilities >= 3)"


def three(measure: str, direction: str) -> str:
    return f"""(SELECT string_agg(state_code, ', ' ORDER BY nr) FROM (SELECT state_code, ROW_NUMBER() OVER
    (ORDER BY {measure} {direction} NULLS LAST, state_code) AS nr FROM {STATES} s) t WHERE nr <= 3)"""


@query("finding_market", FINDING, row(
    "BQ1 occupancy", "CASE WHEN COUNT(*) > 0 THEN 'solid' ELSE 'blocked' END", three("m1_occupancy_rate", "DESC"), three("m1_occupancy_rate", "ASC"), "MAX(m1_occupancy_rate)",
    "MIN(m1_occupancy_rate)", "MAX(m1_occupancy_rate) - MIN(m1_occupancy_rate)", "COUNT(*)", f"{STATES} x") + " UNION ALL " + row(
    "BQ1 beds per 1000", "CASE WHEN COUNT(*) > 0 THEN 'solid' ELSE 'blocked' END", three("m10_beds_per_1000_elderly", "ASC"), three("m10_beds_per_1000_elderly", "DESC"),
    "MIN(m10_beds_per_1000_elderly)", "MAX(m10_beds_per_1000_elderly)", "SUM(total_certified_beds) / (SUM(pop_65plus) / 1000.0)",
    "COUNT(*)", f"{STATES} x", "m10_beds_per_1000_elderly IS NOT NULL"))
def finding_market(f):
    """States with at least 3 facilities: the smaller folders have few per state."""
    return findings.finding_market(f.facility, semantic.market_saturation(f.facility, f.population), min_facilities=3)


@query("finding_blocked", FINDING, "SELECT 'BQ2' AS bq, 'blocked' AS strength, NULL AS label_a, NULL AS label_b, NULL AS value_a, "
       "NULL AS value_b, NULL AS gap, COUNT(*) AS n FROM fx_facility WHERE state_code = 'NO SUCH STATE'")
def finding_blocked(f):
    """A choice that matches nothing still gives a row that says so."""
    return findings.finding_group_gap(f.facility, f.penalty, Filters(states=["NO SUCH STATE"]))
