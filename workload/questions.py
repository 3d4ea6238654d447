"""The star-based questions: markets, segments, gradients, cohorts, risk, enforcement."""

from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.plans import (
    cohorts, enforcement, gradients, risk, roster, segments, states,
)
from workload.ctes import on_star
from workload.registry import query

NEWEST = "snapshot_date_key = (SELECT k FROM fx_latest)"


def roster_of(f):
    return f.roster()


# --- markets -----------------------------------------------------------------------

@query("available_periods", "period_key:i period:d year:i facilities:i", """
  SELECT snapshot_date_key AS period_key, snapshot_date AS period, snapshot_year AS year, COUNT(*) AS facilities
  FROM fx_facility GROUP BY 1, 2, 3""")
def available_periods(f):
    return states.available_periods(f.facility)


@query("nearest_year", "year:i population_year:i exact:b", """
  SELECT year, population_year, population_year = year AS exact FROM (
    SELECT p.year, y.year AS population_year, ROW_NUMBER() OVER (PARTITION BY p.year ORDER BY ABS(p.year - y.year), y.year) AS nr
    FROM (SELECT DISTINCT snapshot_year AS year FROM fx_facility) p, (SELECT DISTINCT year FROM fx_population) y) x WHERE nr = 1""")
def nearest_year(f):
    return states.nearest_years(states.available_periods(f.facility), f.population)


def market_sql(period: str, minimum: int, year: int) -> str:
    return f"""
  SELECT s.*, pop_65plus, beds / (pop_65plus / 1000.0) AS beds_per_1k_65plus, facilities < {minimum} AS too_few, pop_65plus IS NULL AS no_population
  FROM (SELECT state_code, MAX(state_name) AS state_name, MAX(census_region) AS census_region, COUNT(*) AS facilities,
               SUM(certified_beds) AS beds, SUM(avg_residents_per_day) / NULLIF(SUM(certified_beds), 0) AS occupancy,
               AVG(overall_rating) AS avg_overall_rating, COUNT(overall_rating) AS rated_facilities,
               AVG(reported_total_nurse_hprd) AS avg_nurse_hprd
        FROM fx_facility WHERE {period} AND state_code <> 'Unknown' AND NOT is_suspect GROUP BY state_code) s
  LEFT JOIN fx_population p ON p.state_code = s.state_code AND p.year = {year}"""


MARKET = ("state_code:s state_name:s census_region:s facilities:i beds:i pop_65plus:i beds_per_1k_65plus:f occupancy:f "
          "avg_overall_rating:f rated_facilities:i avg_nurse_hprd:f too_few:b no_population:b")
MARKET_1999 = market_sql("snapshot_date_key = 19990401", 3, 1999)
MARKET_NOW = market_sql(NEWEST, 3, 2000)


@query("state_market", MARKET, MARKET_1999)
def state_market(f):
    return states.state_market(f.facility, f.population, 19990401, min_facilities=3)


def _market_now(f):
    return states.state_market(f.facility, f.population, min_facilities=3)


def percent_rank_sql(measure: str, higher: bool) -> str:
    """Share of ranked rows below, plus the middle of the ties: no rank function."""
    sign = "<" if higher else ">"
    return f"""(SELECT (COUNT(*) FILTER (WHERE o.{measure} {sign} m.{measure}) + (COUNT(*) FILTER (WHERE o.{measure} = m.{measure}) + 1) / 2.0)
      / COUNT(o.{measure}) FROM mk o WHERE NOT o.too_few AND NOT o.no_population)"""


SCORE_SQL = f"""
  SELECT s.*, CASE WHEN opportunity_score IS NOT NULL THEN RANK() OVER (ORDER BY ROUND(opportunity_score, 12) DESC NULLS LAST) END AS rank
  FROM (SELECT *, (pct_supply + pct_demand + pct_contest) / 3 AS opportunity_score FROM (
    SELECT m.*, CASE WHEN ok THEN {percent_rank_sql('beds_per_1k_65plus', False)} END AS pct_supply,
           CASE WHEN ok THEN {percent_rank_sql('occupancy', True)} END AS pct_demand,
           CASE WHEN ok THEN {percent_rank_sql('avg_overall_rating', False)} END AS pct_contest
    FROM (SELECT *, NOT too_few AND NOT no_population AS ok FROM mk) m) p) s"""
SCORED = f"{MARKET} pct_supply:f pct_demand:f pct_contest:f opportunity_score:f rank:i"


@query("opportunity_score", SCORED, f"WITH mk AS ({MARKET_NOW}) {SCORE_SQL}")
def opportunity_score(f):
    return states.opportunity_score(_market_now(f))


@query("top_opportunities", SCORED, f"WITH mk AS ({MARKET_NOW}) {SCORE_SQL} WHERE opportunity_score IS NOT NULL "
       "ORDER BY ROUND(opportunity_score, 12) DESC, state_code LIMIT 10")
def top_opportunities(f):
    return states.top_opportunities(states.opportunity_score(_market_now(f)))


@query("national_baseline", "facilities:i beds:i pop_65plus:i beds_per_1k_65plus:f occupancy:f avg_overall_rating:f states:i states_ranked:i", f"""
  SELECT SUM(facilities) AS facilities, SUM(beds) AS beds, SUM(pop_65plus) AS pop_65plus,
         SUM(CASE WHEN NOT no_population THEN beds END) / (SUM(pop_65plus) / 1000.0) AS beds_per_1k_65plus,
         SUM(occupancy * beds) / SUM(beds) AS occupancy, SUM(avg_overall_rating * rated_facilities) / SUM(rated_facilities) AS avg_overall_rating,
         COUNT(*) AS states, COUNT(*) FILTER (WHERE NOT too_few AND NOT no_population) AS states_ranked
  FROM ({MARKET_NOW}) m""")
def national_baseline(f):
    return states.national_baseline(_market_now(f))


@query("market_quadrant", "state_code:s facilities:i beds_per_1k_65plus:f occupancy:f avg_overall_rating:f rating_bin:s "
       "median_beds_per_1k:f median_occupancy:f attractive_corner:b", f"""
  SELECT *, CASE WHEN avg_overall_rating BETWEEN 1 AND 2.75 THEN '< 2.75' WHEN avg_overall_rating <= 3 THEN '2.75–3.00'
                 WHEN avg_overall_rating <= 3.15 THEN '3.00–3.15' WHEN avg_overall_rating <= 3.3 THEN '3.15–3.30'
                 WHEN avg_overall_rating <= 5 THEN '> 3.30' END AS rating_bin,
         beds_per_1k_65plus < median_beds_per_1k AND occupancy > median_occupancy AS attractive_corner
  FROM ({MARKET_NOW}) m, (SELECT quantile_cont(beds_per_1k_65plus, 0.5) AS median_beds_per_1k,
                                 quantile_cont(occupancy, 0.5) AS median_occupancy FROM ({MARKET_NOW}) q) c""")
def market_quadrant(f):
    return states.market_quadrant(_market_now(f))


# --- segments ------------------------------------------------------------------------

FACILITIES_SQL = """SELECT ccn, %s AS segment, certified_beds AS beds, avg_residents_per_day AS residents, overall_rating AS rating,
  reported_total_nurse_hprd AS nurse_hprd, reported_rn_hprd AS rn_hprd, total_nursing_turnover_pct AS turnover
  FROM fx_facility WHERE %s AND %s <> 'Unknown' AND NOT is_suspect"""


def segment_sql(segment: str) -> str:
    rows = FACILITIES_SQL % (segment, NEWEST, segment)
    weighted = lambda c: f"SUM({c} * residents) / NULLIF(SUM(CASE WHEN {c} IS NOT NULL THEN residents END), 0)"
    return f"""
  SELECT o.*, rn_hprd / NULLIF(nurse_hprd, 0) AS rn_share, COALESCE(fine_total, 0) AS fine_total, COALESCE(fine_events, 0) AS fine_events,
         COALESCE(denial_days, 0) AS denial_days, COALESCE(fined_facilities, 0) AS fined_facilities,
         COALESCE(fine_total, 0) / CAST(NULLIF(beds, 0) AS DOUBLE) AS fines_per_bed, COALESCE(fined_facilities, 0) * 1.0 / facilities AS share_fined
  FROM (SELECT segment, COUNT(*) AS facilities, SUM(beds) AS beds, SUM(residents) / NULLIF(SUM(beds), 0) AS occupancy, AVG(rating) AS avg_rating,
               COUNT(rating) AS rated_facilities, {weighted('nurse_hprd')} AS nurse_hprd, {weighted('rn_hprd')} AS rn_hprd,
               {weighted('turnover')} AS turnover_pct, AVG(nurse_hprd) AS nurse_hprd_unweighted, AVG(turnover) AS turnover_pct_unweighted
        FROM ({rows}) r GROUP BY segment) o
  LEFT JOIN (SELECT segment, SUM(fine_amount_usd) AS fine_total, COUNT(*) FILTER (WHERE fine_amount_usd > 0) AS fine_events,
                    SUM(payment_denial_days) AS denial_days, COUNT(DISTINCT p.ccn) AS fined_facilities
             FROM fx_penalty p JOIN ({rows}) r ON r.ccn = p.ccn, fx_latest
             WHERE penalty_date >= d - INTERVAL '3' YEAR AND penalty_date <= d GROUP BY segment) x ON x.segment = o.segment"""


SEGMENT = ("segment:s facilities:i beds:i occupancy:f avg_rating:f rated_facilities:i nurse_hprd:f rn_hprd:f rn_share:f turnover_pct:f "
           "nurse_hprd_unweighted:f turnover_pct_unweighted:f fine_total:i fine_events:i denial_days:i fined_facilities:i "
           "fines_per_bed:f share_fined:f")


@query("segment_compare", SEGMENT, segment_sql("ownership_group"))
def segment_compare(f):
    return segments.segment_compare(f.facility, f.penalty, "ownership_group")


@query("star_segment_compare", SEGMENT, on_star(segment_sql("ownership_group")))
def star_segment_compare(f):
    """Segments over the star: both facts joined with their dimensions."""
    return segments.segment_compare(f.star_facility, f.star_penalty, "ownership_group")


@query("segment_compare_type", SEGMENT, segment_sql("ownership_type"))
def segment_compare_type(f):
    return segments.segment_compare(f.facility, f.penalty, "ownership_type")


@query("segment_compare_chain", SEGMENT, segment_sql("chain_size_band"))
def segment_compare_chain(f):
    return segments.segment_compare(f.facility, f.penalty, "chain_size_band")


@query("segment_facilities", "ccn:s segment:s beds:i residents:f rating:i nurse_hprd:f rn_hprd:f turnover:f",
       FACILITIES_SQL % ("chain_size_band", "snapshot_date_key = 20000401", "chain_size_band"))
def segment_facilities(f):
    return segments.segment_facilities(f.facility, "chain_size_band", 20000401)


CROSS_SQL = f"""
  SELECT ownership_group AS ownership, chain_size_band AS chain_size, COUNT(*) AS facilities, SUM(certified_beds) AS beds, AVG(overall_rating) AS avg_rating,
         SUM(reported_total_nurse_hprd * avg_residents_per_day) / NULLIF(SUM(CASE WHEN reported_total_nurse_hprd IS NOT NULL THEN avg_residents_per_day END), 0) AS nurse_hprd,
         SUM(total_nursing_turnover_pct * avg_residents_per_day) / NULLIF(SUM(CASE WHEN total_nursing_turnover_pct IS NOT NULL THEN avg_residents_per_day END), 0) AS turnover_pct,
         CASE ownership_group WHEN 'For profit' THEN 0 WHEN 'Non profit' THEN 1 ELSE 2 END AS ownership_ord,
         CASE chain_size_band WHEN 'Independent (1)' THEN 0 WHEN 'Small chain (2-9)' THEN 1 WHEN 'Medium chain (10-49)' THEN 2 ELSE 3 END AS chain_ord
  FROM fx_facility WHERE {NEWEST} AND chain_size_band <> 'Unknown' AND NOT is_suspect GROUP BY 1, 2"""


@query("segment_cross", "ownership:s chain_size:s facilities:i beds:i avg_rating:f nurse_hprd:f turnover_pct:f ownership_ord:i chain_ord:i", CROSS_SQL)
def segment_cross(f):
    return segments.segment_cross(f.facility)


@query("chain_data_periods", "period:d period_key:i facilities:i with_chain_data:i", """
  SELECT snapshot_date AS period, snapshot_date_key AS period_key, COUNT(*) AS facilities,
         SUM(CASE WHEN chain_name <> 'Unknown' THEN 1 ELSE 0 END) AS with_chain_data FROM fx_facility GROUP BY 1, 2""")
def chain_data_periods(f):
    return segments.chain_data_periods(f.facility)


# --- roster and gradients ----------------------------------------------------------------

ROSTER = ("ccn:s provider_name:s special_focus_status:s abuse_icon:b state_code:s ownership_group:s ownership_type:s "
          "chain_size_band:s chain_name:s beds:i residents:f resident_days:f nurse_hprd:f rn_hprd:f turnover_pct:f rating:i "
          "staffing_rating:i health_inspection_rating:i deficiencies:i fine_total:i fine_events:i denial_days:i fines_per_bed:f was_fined:b")


@query("facility_roster", ROSTER, "SELECT * FROM fx_roster")
def facility_roster(f):
    return roster.facility_roster(f.facility, f.penalty)


@query("star_roster", ROSTER, "SELECT * FROM fx_star_roster")
def star_roster(f):
    """The roster over the star: both facts joined with their dimensions."""
    return roster.facility_roster(f.star_facility, f.star_penalty)


@query("facility_roster_filtered", ROSTER, "SELECT * FROM fx_roster_1998 WHERE state_code IN ('NATION_1', 'NATION_3', 'NATION_7') AND ownership_group = 'For profit'")
def facility_roster_filtered(f):
    chosen = roster.Filters(states=["NATION_1", "NATION_3", "NATION_7"], ownership=["For profit"], include_suspect=False)
    return roster.facility_roster(f.facility, f.penalty, 19980101, chosen)


@query("roster_context", "period_key:i window_start:d window_end:d facilities:i beds:i", """
  SELECT l.k AS period_key, CAST(l.d - INTERVAL '3' YEAR AS DATE) AS window_start, l.d AS window_end, r.facilities, r.beds
  FROM fx_latest l, (SELECT COUNT(*) AS facilities, COALESCE(SUM(beds), 0) AS beds FROM fx_roster) r""")
def roster_context(f):
    return roster.roster_context(f.facility, f.penalty)


BAND_SQL = """COUNT(*) AS facilities, COALESCE(SUM(beds), 0) AS beds, AVG(rating) AS avg_rating,
  AVG(CASE WHEN rating IS NOT NULL THEN CASE WHEN rating <= 2 THEN 100.0 ELSE 0 END END) AS pct_1_2_star,
  AVG(CASE WHEN rating IS NOT NULL THEN CASE WHEN rating >= 4 THEN 100.0 ELSE 0 END END) AS pct_4_5_star,
  AVG(health_inspection_rating) AS health_inspection_rating, AVG(deficiencies) AS deficiencies,
  COALESCE(SUM(fine_total), 0) / CAST(GREATEST(COALESCE(SUM(beds), 0), 1) AS DOUBLE) AS fines_per_bed,
  AVG(CASE WHEN was_fined THEN 100.0 ELSE 0 END) AS pct_fined,
  COALESCE(SUM(residents), 0) / GREATEST(COALESCE(SUM(beds), 0), 1) AS occupancy,
  COALESCE(SUM(nurse_hprd * residents), 0) / GREATEST(COALESCE(SUM(CASE WHEN nurse_hprd IS NOT NULL THEN residents END), 0), 1) AS nurse_hprd,
  COALESCE(SUM(turnover_pct * residents), 0) / GREATEST(COALESCE(SUM(CASE WHEN turnover_pct IS NOT NULL THEN residents END), 0), 1) AS turnover_pct"""


def gradient_sql(value: str, bands: list, source: str = "fx_roster") -> str:
    arms = " ".join(f"WHEN {value} >= {lo} AND {value} < {hi} THEN {i}" for i, (lo, hi, _) in enumerate(bands))
    names = " ".join(f"WHEN {i} THEN '{label}'" for i, (_, _, label) in enumerate(bands))
    steps = ", ".join(f"{c} - LAG({c}) OVER (ORDER BY band_ord) AS d_{c}" for c in gradients.STEPPED)
    return f"""SELECT g.*, CASE band_ord {names} END AS band, {steps} FROM (
    SELECT band_ord, {BAND_SQL} FROM (SELECT *, CASE {arms} END AS band_ord FROM {source}) b WHERE band_ord IS NOT NULL GROUP BY band_ord) g"""


GRADIENT = ("band:s band_ord:i facilities:i beds:i avg_rating:f pct_1_2_star:f pct_4_5_star:f health_inspection_rating:f deficiencies:f "
            "fines_per_bed:f pct_fined:f occupancy:f nurse_hprd:f turnover_pct:f d_avg_rating:f d_health_inspection_rating:f "
            "d_fines_per_bed:f d_occupancy:f")


@query("staffing_gradient", GRADIENT, gradient_sql("nurse_hprd", V.STAFFING_BANDS))
def staffing_gradient(f):
    return gradients.staffing_gradient(roster_of(f))


def floor_sql(side: str, condition: str) -> str:
    return f"""SELECT '{side}' AS side, (SELECT COUNT(nurse_hprd) FROM fx_roster) AS measured_facilities,
    (SELECT COUNT(*) - COUNT(nurse_hprd) FROM fx_roster) AS missing_hprd, 3.48 AS staffing_floor,
    COUNT(*) * 100.0 / (SELECT COUNT(nurse_hprd) FROM fx_roster) AS pct_of_measured, {BAND_SQL} FROM fx_roster WHERE nurse_hprd {condition} 3.48"""


@query("staffing_floor", "side:s measured_facilities:i missing_hprd:i staffing_floor:f facilities:i pct_of_measured:f "
       "health_inspection_rating:f fines_per_bed:f pct_fined:f avg_rating:f deficiencies:f",
       f"{floor_sql('below', '<')} UNION ALL {floor_sql('above', '>=')}")
def staffing_floor(f):
    return gradients.staffing_floor(roster_of(f))


def quartile_sql(where: str) -> str:
    return f"""SELECT r.*, CASE WHEN nurse_hprd <= c1 THEN 0 WHEN nurse_hprd <= c2 THEN 1 WHEN nurse_hprd <= c3 THEN 2 ELSE 3 END AS quartile_ord
  FROM fx_roster r, (SELECT quantile_cont(nurse_hprd, 0.25) AS c1, quantile_cont(nurse_hprd, 0.5) AS c2, quantile_cont(nurse_hprd, 0.75) AS c3
                     FROM fx_roster WHERE {where}) c WHERE {where}"""


QUARTILE_NAME = "CASE quartile_ord WHEN 0 THEN 'Q1 thinnest' WHEN 1 THEN 'Q2' WHEN 2 THEN 'Q3' ELSE 'Q4 richest' END"


@query("staffing_controlled", "ownership_group:s hprd_quartile:s quartile_ord:i facilities:i nurse_hprd:f health_inspection_rating:f "
       "avg_rating:f fines_per_bed:f", f"""
  SELECT ownership_group, quartile_ord, {QUARTILE_NAME} AS hprd_quartile, {BAND_SQL}
  FROM ({quartile_sql("nurse_hprd IS NOT NULL AND ownership_group <> 'Unknown'")}) q GROUP BY ownership_group, quartile_ord""")
def staffing_controlled(f):
    return gradients.staffing_controlled(roster_of(f))


@query("turnover_gradient", f"{GRADIENT} national_turnover_weighted:f national_turnover_median:f", f"""
  SELECT g.*, n.* FROM ({gradient_sql("turnover_pct", V.TURNOVER_BANDS)}) g,
    (SELECT SUM(turnover_pct * residents) / GREATEST(SUM(residents), 1) AS national_turnover_weighted,
            quantile_cont(turnover_pct, 0.5) AS national_turnover_median FROM fx_roster WHERE turnover_pct IS NOT NULL) n""")
def turnover_gradient(f):
    return gradients.turnover_gradient(roster_of(f))


SCAN_SIDE = """COUNT(*) FILTER (WHERE {c}) AS {p}n, AVG(rating) FILTER (WHERE {c}) AS {p}rating,
  SUM(residents) FILTER (WHERE {c}) / SUM(beds) FILTER (WHERE {c}) AS {p}occ, SUM(fine_total) FILTER (WHERE {c}) / CAST(SUM(beds) FILTER (WHERE {c}) AS DOUBLE) AS {p}fpb"""


@query("split_scan", "cut:i facilities_below:i pct_below:f rating_below:f rating_above:f rating_gap:f occupancy_below:f occupancy_above:f "
       "occupancy_gap_pts:f fines_per_bed_below:f fines_per_bed_above:f", f"""
  SELECT cut, lo_n AS facilities_below, lo_n * 100.0 / (lo_n + hi_n) AS pct_below, lo_rating AS rating_below, hi_rating AS rating_above,
         lo_rating - hi_rating AS rating_gap, lo_occ AS occupancy_below, hi_occ AS occupancy_above, (lo_occ - hi_occ) * 100 AS occupancy_gap_pts,
         lo_fpb AS fines_per_bed_below, hi_fpb AS fines_per_bed_above
  FROM (SELECT cut, {SCAN_SIDE.format(c='turnover_pct < cut', p='lo_')}, {SCAN_SIDE.format(c='turnover_pct >= cut', p='hi_')}
        FROM fx_roster, (VALUES {', '.join(f'({c})' for c in V.SPLIT_CUTS)}) AS v(cut) WHERE turnover_pct IS NOT NULL GROUP BY cut) s
  WHERE lo_n >= 10 AND hi_n >= 10""")
def split_scan(f):
    """At least 10 facilities on either side: the smaller folders have under 200 in all."""
    return gradients.split_scan(roster_of(f), min_side=10)


CONTROLLED_SQL = f"""
  SELECT quartile_ord, {QUARTILE_NAME} AS hprd_quartile, turnover_ord, CASE turnover_ord WHEN 0 THEN '< 40%' WHEN 1 THEN '40-50%' WHEN 2 THEN '50-60%' ELSE '60%+' END AS turnover_band, {BAND_SQL}
  FROM (SELECT *, CASE WHEN turnover_pct >= 0 AND turnover_pct < 40 THEN 0 WHEN turnover_pct >= 40 AND turnover_pct < 50 THEN 1
                       WHEN turnover_pct >= 50 AND turnover_pct < 60 THEN 2 WHEN turnover_pct >= 60 AND turnover_pct < 101 THEN 3 END AS turnover_ord
        FROM ({quartile_sql("nurse_hprd IS NOT NULL AND turnover_pct IS NOT NULL")}) q) b WHERE turnover_ord IS NOT NULL GROUP BY quartile_ord, turnover_ord"""


@query("turnover_controlled", "hprd_quartile:s quartile_ord:i turnover_band:s turnover_ord:i facilities:i avg_rating:f occupancy:f fines_per_bed:f", CONTROLLED_SQL)
def turnover_controlled(f):
    return gradients.turnover_controlled(roster_of(f))


@query("pivot_matrix", "hprd_quartile:s quartile_ord:i value_0:f n_0:i value_1:f n_1:i value_2:f n_2:i value_3:f n_3:i",
       "SELECT hprd_quartile, quartile_ord, " + ", ".join(
           f"MAX(CASE WHEN turnover_ord = {i} THEN avg_rating END) AS value_{i}, MAX(CASE WHEN turnover_ord = {i} THEN facilities END) AS n_{i}"
           for i in range(4)) + f" FROM ({CONTROLLED_SQL}) c GROUP BY hprd_quartile, quartile_ord")
def pivot_matrix(f):
    return gradients.pivot_matrix(gradients.turnover_controlled(roster_of(f)), "avg_rating")


@query("kpi_summary", "facilities:i beds:i residents:f occupancy:f nurse_hprd:f rn_share:f turnover_pct:f avg_rating:f pct_1_2_star:f "
       "fine_total:i fine_events:i deficiencies:f fines_per_bed:f pct_fined:f below_floor_pct:f", """
  SELECT COUNT(*) AS facilities, SUM(beds) AS beds, SUM(residents) AS residents, SUM(residents) / SUM(beds) AS occupancy,
         SUM(nurse_hprd * residents) / SUM(CASE WHEN nurse_hprd IS NOT NULL THEN residents END) AS nurse_hprd,
         SUM(CASE WHEN nurse_hprd IS NOT NULL THEN rn_hprd * residents END) / SUM(nurse_hprd * residents) AS rn_share,
         SUM(turnover_pct * residents) / SUM(CASE WHEN turnover_pct IS NOT NULL THEN residents END) AS turnover_pct, AVG(rating) AS avg_rating,
         100.0 * COUNT(*) FILTER (WHERE rating <= 2) / COUNT(rating) AS pct_1_2_star, SUM(fine_total) AS fine_total, SUM(fine_events) AS fine_events,
         AVG(deficiencies) AS deficiencies, SUM(fine_total) / CAST(SUM(beds) AS DOUBLE) AS fines_per_bed,
         100.0 * COUNT(*) FILTER (WHERE was_fined) / COUNT(*) AS pct_fined, 100.0 * COUNT(*) FILTER (WHERE nurse_hprd < 3.48) / COUNT(nurse_hprd) AS below_floor_pct
  FROM fx_roster""")
def kpi_summary(f):
    return gradients.kpi_summary(roster_of(f))


@query("drill_top_n", "ccn:s provider_name:s ownership_group:s chain_size_band:s beds:i rating:i nurse_hprd:f turnover_pct:f fine_total:i "
       "fine_events:i fines_per_bed:f", "SELECT * FROM fx_roster WHERE state_code = 'NATION_7' ORDER BY fine_total DESC, ccn LIMIT 25")
def drill_top_n(f):
    return roster.drill_top_n(roster_of(f), "NATION_7")


# --- cohorts ---------------------------------------------------------------------------------

@query("period_trend", "period:d period_key:i year:i facilities:i beds:i residents:f occupancy:f nurse_hprd:f rn_hprd:f avg_rating:f deficiencies:f", """
  SELECT snapshot_date AS period, snapshot_date_key AS period_key, snapshot_year AS year, COUNT(*) AS facilities, SUM(certified_beds) AS beds,
         SUM(avg_residents_per_day) AS residents, SUM(avg_residents_per_day) / NULLIF(SUM(certified_beds), 0) AS occupancy,
         SUM(reported_total_nurse_hprd * avg_residents_per_day) / NULLIF(SUM(CASE WHEN reported_total_nurse_hprd IS NOT NULL THEN avg_residents_per_day END), 0) AS nurse_hprd,
         SUM(reported_rn_hprd * avg_residents_per_day) / NULLIF(SUM(CASE WHEN reported_rn_hprd IS NOT NULL THEN avg_residents_per_day END), 0) AS rn_hprd,
         AVG(overall_rating) AS avg_rating, AVG(cycle1_total_deficiencies) AS deficiencies
  FROM fx_facility WHERE NOT is_suspect GROUP BY 1, 2, 3""")
def period_trend(f):
    return cohorts.period_trend(f.facility)


SIDES = {"beds": "certified_beds", "res": "avg_residents_per_day", "hprd": "reported_total_nurse_hprd", "rn": "reported_rn_hprd",
         "rating": "overall_rating", "defic": "cycle1_total_deficiencies"}
PAIRS_SQL = "SELECT a.ccn, b.state_code, b.ownership_group, " + ", ".join(
    f"{t}.{c} AS {n}_{w}" for n, c in SIDES.items() for t, w in (("a", "from"), ("b", "to"))) + """
  FROM (SELECT * FROM fx_facility WHERE snapshot_date_key = 19980101 AND NOT is_suspect) a
  JOIN (SELECT * FROM fx_facility WHERE snapshot_date_key = 20010701 AND NOT is_suspect) b ON b.ccn = a.ccn"""


def _pairs(f):
    return cohorts.matched_cohort(f.facility, 19980101, 20010701)


@query("matched_cohort", "ccn:s state_code:s ownership_group:s beds_from:i beds_to:i res_from:f res_to:f hprd_from:f hprd_to:f rn_from:f "
       "rn_to:f rating_from:i rating_to:i defic_from:i defic_to:i", PAIRS_SQL)
def matched_cohort(f):
    return _pairs(f)


MATCH_WEIGHTED = lambda n, w: f"SUM({n}_{w} * res_{w}) / SUM(CASE WHEN {n}_{w} IS NOT NULL THEN res_{w} END)"


@query("matched_summary", "matched_facilities:i beds_from:i beds_to:i residents_from:f residents_to:f occupancy_from:f occupancy_to:f "
       "occupancy_change_pts:f nurse_hprd_from:f nurse_hprd_to:f nurse_hprd_change_pct:f rn_hprd_from:f rn_hprd_to:f rn_share_from:f "
       "rn_share_to:f rating_from:f rating_to:f rating_change:f deficiencies_from:f deficiencies_to:f pct_improved:f pct_unchanged:f pct_declined:f", f"""
  SELECT *, (occupancy_to - occupancy_from) * 100 AS occupancy_change_pts, (nurse_hprd_to / nurse_hprd_from - 1) * 100 AS nurse_hprd_change_pct,
         rn_hprd_from / nurse_hprd_from * 100 AS rn_share_from, rn_hprd_to / nurse_hprd_to * 100 AS rn_share_to, rating_to - rating_from AS rating_change
  FROM (SELECT COUNT(*) AS matched_facilities, SUM(beds_from) AS beds_from, SUM(beds_to) AS beds_to, SUM(res_from) AS residents_from, SUM(res_to) AS residents_to,
               SUM(res_from) / SUM(beds_from) AS occupancy_from, SUM(res_to) / SUM(beds_to) AS occupancy_to,
               {MATCH_WEIGHTED('hprd', 'from')} AS nurse_hprd_from, {MATCH_WEIGHTED('hprd', 'to')} AS nurse_hprd_to,
               {MATCH_WEIGHTED('rn', 'from')} AS rn_hprd_from, {MATCH_WEIGHTED('rn', 'to')} AS rn_hprd_to,
               AVG(rating_from) AS rating_from, AVG(rating_to) AS rating_to, AVG(defic_from) AS deficiencies_from, AVG(defic_to) AS deficiencies_to,
               100.0 * COUNT(*) FILTER (WHERE rating_to > rating_from) / COUNT(rating_to - rating_from) AS pct_improved,
               100.0 * COUNT(*) FILTER (WHERE rating_to = rating_from) / COUNT(rating_to - rating_from) AS pct_unchanged,
               100.0 * COUNT(*) FILTER (WHERE rating_to < rating_from) / COUNT(rating_to - rating_from) AS pct_declined
        FROM ({PAIRS_SQL}) p) s""")
def matched_summary(f):
    return cohorts.matched_summary(_pairs(f))


@query("capacity_exit", "exited_facilities:i exited_beds:i exited_share_pct:f exited_occupancy_before:f stayed_occupancy_before:f "
       "exited_rating_before:f stayed_rating_before:f exited_hprd_before:f stayed_hprd_before:f", """
  SELECT COUNT(*) FILTER (WHERE gone) AS exited_facilities, COALESCE(SUM(certified_beds) FILTER (WHERE gone), 0) AS exited_beds,
         COUNT(*) FILTER (WHERE gone) * 100.0 / COUNT(*) AS exited_share_pct,
         COALESCE(SUM(avg_residents_per_day) FILTER (WHERE gone) / SUM(certified_beds) FILTER (WHERE gone), 0) AS exited_occupancy_before,
         COALESCE(SUM(avg_residents_per_day) FILTER (WHERE NOT gone) / SUM(certified_beds) FILTER (WHERE NOT gone), 0) AS stayed_occupancy_before,
         COALESCE(AVG(overall_rating) FILTER (WHERE gone), 0) AS exited_rating_before, COALESCE(AVG(overall_rating) FILTER (WHERE NOT gone), 0) AS stayed_rating_before,
         COALESCE(AVG(reported_total_nurse_hprd) FILTER (WHERE gone), 0) AS exited_hprd_before,
         COALESCE(AVG(reported_total_nurse_hprd) FILTER (WHERE NOT gone), 0) AS stayed_hprd_before
  FROM (SELECT a.*, b.ccn IS NULL AS gone FROM (SELECT * FROM fx_facility WHERE snapshot_date_key = 19980101 AND NOT is_suspect) a
        LEFT JOIN (SELECT ccn FROM fx_facility WHERE snapshot_date_key = 20010701) b ON b.ccn = a.ccn) x""")
def capacity_exit(f):
    return cohorts.capacity_exit(f.facility, 19980101, 20010701)


@query("rating_migration", "rating_from:i rating_to:i facilities:i pct_of_row:f", f"""
  SELECT rating_from, rating_to, COUNT(*) AS facilities, COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (PARTITION BY rating_from) AS pct_of_row
  FROM ({PAIRS_SQL}) p WHERE rating_from IS NOT NULL AND rating_to IS NOT NULL GROUP BY rating_from, rating_to""")
def rating_migration(f):
    return cohorts.rating_migration(_pairs(f))


# --- risk --------------------------------------------------------------------------------------

SCORE = "ccn:s rating:i deficiencies:i nurse_hprd:f fines_per_bed:f special_focus_status:s risk_score:i risk_reasons:s"


@query("risk_score", SCORE, "SELECT * FROM fx_scored")
def risk_score(f):
    return risk.risk_score(roster_of(f))


def _trajectory(f, period=20010701):
    scored = risk.risk_score(f.roster(period))
    return risk.with_trajectory(scored, f.facility, period)


TRAJECTORY_SQL = """
  SELECT s.*, s.rating - b.overall_rating AS rating_change, s.deficiencies - b.cycle1_total_deficiencies AS deficiency_change,
         COALESCE(s.rating < b.overall_rating, FALSE) AS declining
  FROM fx_scored_now s LEFT JOIN fx_facility b ON b.ccn = s.ccn AND b.snapshot_date_key = 20010101"""


@query("risk_watchlist", "ccn:s provider_name:s state_code:s ownership_group:s chain_size_band:s beds:i rating:i rating_change:i deficiencies:i "
       "deficiency_change:i nurse_hprd:f turnover_pct:f fine_total:i fines_per_bed:f special_focus_status:s abuse_icon:b risk_score:i risk_reasons:s",
       f"SELECT * FROM ({TRAJECTORY_SQL}) t ORDER BY risk_score DESC, declining DESC, fines_per_bed DESC NULLS LAST, ccn LIMIT 50")
def risk_watchlist(f):
    return risk.risk_watchlist(_trajectory(f))


@query("risk_counts", "facilities:i flagged_any:i flagged_high:i declining_count:i special_focus_count:i below_floor_count:i", f"""
  SELECT COUNT(*) AS facilities, COUNT(*) FILTER (WHERE risk_score > 0) AS flagged_any, COUNT(*) FILTER (WHERE risk_score >= 5) AS flagged_high,
         COUNT(*) FILTER (WHERE declining) AS declining_count, SUM(f1) AS special_focus_count, SUM(f5) AS below_floor_count FROM ({TRAJECTORY_SQL}) t""")
def risk_counts(f):
    return risk.risk_counts(_trajectory(f))


def _outcome(f):
    scored = risk.risk_score(f.roster(19980101))
    return risk.with_outcome(scored, f.facility, f.penalty, 20010701, F.lit("2001-07-01").cast("date"))


@query("risk_backtest", "risk_score:i facilities:i pct_fined_later:f fines_per_bed_later:f avg_rating_later:f pct_exited:f avg_rating_before:f thin:b", """
  SELECT risk_score, COUNT(*) AS facilities, AVG(CASE WHEN NOT exited THEN CASE WHEN fined_later THEN 100.0 ELSE 0 END END) AS pct_fined_later,
         COALESCE(SUM(fines_later) FILTER (WHERE NOT exited), 0) / CAST(GREATEST(COALESCE(SUM(beds_later) FILTER (WHERE NOT exited), 0), 1) AS DOUBLE) AS fines_per_bed_later,
         AVG(rating_later) FILTER (WHERE NOT exited) AS avg_rating_later, AVG(CASE WHEN exited THEN 100.0 ELSE 0 END) AS pct_exited,
         AVG(rating) AS avg_rating_before, COUNT(*) < 100 AS thin FROM fx_outcome GROUP BY risk_score""")
def risk_backtest(f):
    return risk.risk_backtest(_outcome(f))


@query("risk_lift", "population:i top_cut:f base_pct_fined:f base_fines_per_bed:f top_facilities:i top_pct_fined:f top_fines_per_bed:f "
       "top_pct_exited:f base_pct_exited:f lift_incidence:f lift_dollars:f", """
  SELECT *, top_pct_fined / NULLIF(base_pct_fined, 0) AS lift_incidence, top_fines_per_bed / NULLIF(base_fines_per_bed, 0) AS lift_dollars
  FROM (SELECT COUNT(*) AS population, MAX(cut) AS top_cut, AVG(CASE WHEN NOT exited THEN CASE WHEN fined_later THEN 100.0 ELSE 0 END END) AS base_pct_fined,
               SUM(fines_later) / CAST(SUM(beds_later) AS DOUBLE) AS base_fines_per_bed, COUNT(*) FILTER (WHERE risk_score >= cut) AS top_facilities,
               AVG(CASE WHEN fined_later THEN 100.0 ELSE 0 END) FILTER (WHERE NOT exited AND risk_score >= cut) AS top_pct_fined,
               COALESCE(SUM(fines_later) FILTER (WHERE risk_score >= cut), 0) / CAST(GREATEST(COALESCE(SUM(beds_later) FILTER (WHERE risk_score >= cut), 0), 1) AS DOUBLE) AS top_fines_per_bed,
               AVG(CASE WHEN exited THEN 100.0 ELSE 0 END) FILTER (WHERE risk_score >= cut) AS top_pct_exited, AVG(CASE WHEN exited THEN 100.0 ELSE 0 END) AS base_pct_exited
        FROM fx_outcome, (SELECT quantile_cont(CAST(risk_score AS DOUBLE), 0.95) AS cut FROM fx_outcome) c) x""")
def risk_lift(f):
    return risk.risk_lift(_outcome(f))


# --- enforcement -----------------------------------------------------------------------------------



@query("fines_timeline", "year:i quarter:i year_quarter:s penalty_type:s events:i fines:i denial_days:i facilities:i era:i incomplete:b", f"""
  SELECT c.*, e.era, e.incomplete FROM (
    SELECT penalty_year AS year, penalty_quarter AS quarter, concat(CAST(penalty_year AS VARCHAR), '-Q', CAST(penalty_quarter AS VARCHAR)) AS year_quarter,
           penalty_type, COUNT(*) AS events, COALESCE(SUM(fine_amount_usd), 0) AS fines, COALESCE(SUM(payment_denial_days), 0) AS denial_days,
           COUNT(DISTINCT ccn) AS facilities FROM fx_penalty GROUP BY 1, 2, 3, 4) c
  JOIN (SELECT *, ROW_NUMBER() OVER (PARTITION BY era ORDER BY i DESC) <= 2 AS incomplete FROM (
          SELECT *, SUM(CASE WHEN gap > 1 THEN 1 ELSE 0 END) OVER (ORDER BY i) AS era FROM (
            SELECT *, i - LAG(i) OVER (ORDER BY i) AS gap FROM (
              SELECT DISTINCT penalty_year AS year, penalty_quarter AS quarter, penalty_year * 4 + penalty_quarter AS i FROM fx_penalty) q) g) s) e
    ON e.year = c.year AND e.quarter = c.quarter""")
def fines_timeline(f):
    return enforcement.fines_timeline(f.penalty)


@query("avg_fine_by_year", "year:i events:i fines:i avg_fine:f", """
  SELECT penalty_year AS year, COUNT(*) AS events, SUM(fine_amount_usd) AS fines, SUM(fine_amount_usd) / CAST(COUNT(*) AS DOUBLE) AS avg_fine
  FROM fx_penalty WHERE penalty_type = 'Fine' GROUP BY 1""")
def avg_fine_by_year(f):
    return enforcement.avg_fine_by_year(f.penalty)


ENFORCE_SQL = f"""
  SELECT b.*, COALESCE(fines, 0) AS fines, COALESCE(fine_events, 0) AS fine_events, COALESCE(fined_facilities, 0) AS fined_facilities,
         COALESCE(denial_days, 0) AS denial_days, COALESCE(fines, 0) / CAST(NULLIF(beds, 0) AS DOUBLE) AS fines_per_bed,
         COALESCE(fined_facilities, 0) * 100.0 / facilities AS pct_facilities_fined, COALESCE(fines, 0) / CAST(NULLIF(fine_events, 0) AS DOUBLE) AS avg_fine
  FROM (SELECT state_code, state_name, census_region, COUNT(*) AS facilities, SUM(certified_beds) AS beds, AVG(overall_rating) AS avg_rating
        FROM fx_facility WHERE {NEWEST} AND NOT is_suspect GROUP BY 1, 2, 3) b
  LEFT JOIN (SELECT state_code, SUM(fine_amount_usd) AS fines, COUNT(*) FILTER (WHERE fine_amount_usd > 0) AS fine_events,
                    COUNT(DISTINCT ccn) AS fined_facilities, SUM(payment_denial_days) AS denial_days
             FROM fx_penalty, fx_latest WHERE penalty_date >= d - INTERVAL '3' YEAR AND penalty_date <= d GROUP BY 1) p ON p.state_code = b.state_code
  WHERE facilities >= 3"""


def _enforcement(f):
    return enforcement.state_enforcement(f.facility, f.penalty, min_facilities=3)


@query("state_enforcement", "state_code:s state_name:s census_region:s facilities:i beds:i avg_rating:f fines:i fine_events:i fined_facilities:i "
       "denial_days:i fines_per_bed:f pct_facilities_fined:f avg_fine:f", ENFORCE_SQL)
def state_enforcement(f):
    return _enforcement(f)


@query("enforcement_summary", "states:i total_fines:i national_fines_per_bed:f national_pct_fined:f top5_share_of_dollars:f top5_share_of_beds:f "
       "hardest:s hardest_per_bed:f softest:s softest_per_bed:f spread:f", f"""
  SELECT t.*, h.state_code AS hardest, h.fines_per_bed AS hardest_per_bed, s.state_code AS softest, s.fines_per_bed AS softest_per_bed,
         h.fines_per_bed / CASE WHEN s.fines_per_bed > 1 THEN s.fines_per_bed WHEN h.fines_per_bed IS NOT NULL THEN 1.0 END AS spread
  FROM (SELECT COUNT(*) AS states, COALESCE(SUM(fines), 0) AS total_fines, SUM(fines) / CAST(SUM(beds) AS DOUBLE) AS national_fines_per_bed,
               SUM(fined_facilities) * 100.0 / SUM(facilities) AS national_pct_fined,
               SUM(CASE WHEN nr <= 5 THEN fines END) * 100.0 / SUM(fines) AS top5_share_of_dollars, SUM(CASE WHEN nr <= 5 THEN beds END) * 100.0 / SUM(beds) AS top5_share_of_beds
        FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY fines DESC, state_code) AS nr FROM ({ENFORCE_SQL}) e) r) t
  LEFT JOIN (SELECT * FROM ({ENFORCE_SQL}) e ORDER BY fines_per_bed DESC NULLS LAST, state_code LIMIT 1) h ON TRUE
  LEFT JOIN (SELECT * FROM ({ENFORCE_SQL}) e ORDER BY fines_per_bed ASC NULLS FIRST, state_code DESC LIMIT 1) s ON TRUE""")
def enforcement_summary(f):
    return enforcement.enforcement_summary(_enforcement(f))


# --- distributions -------------------------------------------------------------------------------------

@query("rating_mix", "segment:s level:i facilities:i share:f n:i median:f", f"""
  SELECT g.segment, l.level, COUNT(*) FILTER (WHERE rating = level) AS facilities, COUNT(*) FILTER (WHERE rating = level) / CAST(COUNT(*) AS DOUBLE) AS share,
         COUNT(*) AS n, quantile_cont(CAST(rating AS DOUBLE), 0.5) AS median
  FROM ({FACILITIES_SQL % ('ownership_group', NEWEST, 'ownership_group')}) g, (VALUES (1), (2), (3), (4), (5)) AS l(level)
  WHERE rating IS NOT NULL GROUP BY g.segment, l.level""")
def rating_mix(f):
    return segments.rating_mix(segments.segment_facilities(f.facility, "ownership_group"))


@query("box_stats", "segment:s n:i whisker_low:f q1:f median:f q3:f whisker_high:f", f"""
  SELECT v.segment, COUNT(*) AS n, LEAST(MIN(CASE WHEN turnover >= q1 - 1.5 * (q3 - q1) THEN turnover END), q1) AS whisker_low, q1, median, q3,
         GREATEST(MAX(CASE WHEN turnover <= q3 + 1.5 * (q3 - q1) THEN turnover END), q3) AS whisker_high
  FROM ({FACILITIES_SQL % ('chain_size_band', NEWEST, 'chain_size_band')}) v
  JOIN (SELECT segment, quantile_cont(turnover, 0.25) AS q1, quantile_cont(turnover, 0.5) AS median, quantile_cont(turnover, 0.75) AS q3
        FROM ({FACILITIES_SQL % ('chain_size_band', NEWEST, 'chain_size_band')}) w GROUP BY segment) q ON q.segment = v.segment
  WHERE turnover IS NOT NULL GROUP BY v.segment, q1, median, q3""")
def box_stats(f):
    return segments.box_stats(segments.segment_facilities(f.facility, "chain_size_band"), "turnover")


def monotone_sql(measure: str, falling: bool) -> str:
    return f"""SELECT ownership, '{measure}' AS measure, COUNT(step) AS steps, MIN(step) AS smallest_step, MAX(step) AS largest_step,
    COALESCE({'MAX(step) < 0' if falling else 'MIN(step) > 0'}, TRUE) AS monotone
    FROM (SELECT ownership, {measure} - LAG({measure}) OVER (PARTITION BY ownership ORDER BY chain_ord) AS step FROM ({CROSS_SQL}) c) s GROUP BY ownership"""


@query("monotone_check", "ownership:s measure:s steps:i smallest_step:f largest_step:f monotone:b",
       " UNION ALL ".join(monotone_sql(m, d) for m, d in (("nurse_hprd", True), ("turnover_pct", False), ("avg_rating", True))))
def monotone_check(f):
    cross = segments.segment_cross(f.facility)
    return segments.monotone_check(cross, "nurse_hprd", True).unionByName(
        segments.monotone_check(cross, "turnover_pct", False)).unionByName(
        segments.monotone_check(cross, "avg_rating", True))


CHURN_SQL = """SELECT a.ownership_type AS type_from, b.ownership_type AS type_to, a.ownership_group AS group_from, b.ownership_group AS group_to
  FROM (SELECT * FROM fx_facility WHERE snapshot_date_key = 19980101) a JOIN (SELECT * FROM fx_facility WHERE snapshot_date_key = 20010701) b ON b.ccn = a.ccn"""


@query("category_churn", "facilities_in_both:i type_changed:i group_changed:i", f"""
  SELECT COUNT(*) AS facilities_in_both, SUM(CASE WHEN type_from <> type_to THEN 1 ELSE 0 END) AS type_changed,
         SUM(CASE WHEN group_from <> group_to THEN 1 ELSE 0 END) AS group_changed FROM ({CHURN_SQL}) c""")
def category_churn(f):
    return segments.category_churn(f.facility, 19980101, 20010701)


@query("top_transitions", "type_from:s type_to:s facilities:i", f"""
  SELECT type_from, type_to, COUNT(*) AS facilities FROM ({CHURN_SQL}) c WHERE type_from <> type_to GROUP BY 1, 2
  ORDER BY 3 DESC, 1, 2 LIMIT 4""")
def top_transitions(f):
    return segments.top_transitions(f.facility, 19980101, 20010701)


@query("fanout_check", "true_beds:i naive_beds:i inflation:f", f"""
  SELECT true_beds, naive_beds, naive_beds / CAST(true_beds AS DOUBLE) AS inflation FROM
    (SELECT SUM(certified_beds) AS true_beds FROM fx_facility WHERE {NEWEST} AND ownership_group = 'For profit' AND NOT is_suspect) t,
    (SELECT SUM(certified_beds) AS naive_beds FROM fx_facility f JOIN fx_penalty p ON p.ccn = f.ccn
     WHERE {NEWEST} AND f.ownership_group = 'For profit' AND NOT is_suspect) n""")
def fanout_check(f):
    return segments.fanout_check(f.facility, f.penalty, "For profit")


@query("pivot_share", "chain_size:s chain_ord:i for_profit:i non_profit:i government:i share_for_profit:f share_non_profit:f share_government:f", f"""
  SELECT *, for_profit / CAST(total AS DOUBLE) AS share_for_profit, non_profit / CAST(total AS DOUBLE) AS share_non_profit, government / CAST(total AS DOUBLE) AS share_government
  FROM (SELECT chain_size, chain_ord, SUM(CASE WHEN ownership = 'For profit' THEN facilities ELSE 0 END) AS for_profit,
               SUM(CASE WHEN ownership = 'Non profit' THEN facilities ELSE 0 END) AS non_profit,
               SUM(CASE WHEN ownership = 'Government' THEN facilities ELSE 0 END) AS government, SUM(facilities) AS total
        FROM ({CROSS_SQL}) c GROUP BY chain_size, chain_ord) p""")
def pivot_share(f):
    return segments.pivot_share(segments.segment_cross(f.facility))
