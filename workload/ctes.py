"""SQL statements of the derived frames and of the star, for comparison."""

from __future__ import annotations

import re

from tidemark import fixed_values as V

CTES: dict[str, str] = {}


def with_ctes(body: str, recursive: bool = False) -> str:
    """Put the CTEs a statement mentions in front of it, in dependency order."""
    needed: list[str] = []
    seen: set[str] = set()

    def visit(text: str):
        for name in CTES:
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                visit(CTES[name])
                needed.append(name)

    visit(body)
    if not needed:
        return body
    keyword = "WITH RECURSIVE" if recursive or any("UNION ALL -- step" in CTES[n] for n in needed) else "WITH"
    return f"{keyword} " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed) + "\n" + body


def case(column: str, mapping: dict[str, str], default: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {column} {arms} ELSE {default} END"


CTES["fx_g"] = """
  SELECT l_suppkey, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS period, COUNT(*) AS n,
         CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS beds,
         CAST(SUM(CASE WHEN l_returnflag <> 'R' THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS residents,
         CAST(SUM(CAST(ROUND(l_discount * 100) AS BIGINT)) AS BIGINT) AS d,
         CAST(SUM(CAST(ROUND(l_tax * 100) AS BIGINT)) AS BIGINT) AS t,
         CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS deficiencies
  FROM lineitem GROUP BY l_suppkey, CAST(date_trunc('quarter', l_shipdate) AS DATE)"""

CTES["fx_panel"] = """
  SELECT lpad(CAST(g.l_suppkey AS VARCHAR(20)), 6, '0') AS ccn, g.period,
         CAST(year(g.period) AS BIGINT) * 10000 + CAST(month(g.period) AS BIGINT) * 100 + 1 AS snapshot_date_key,
         g.beds, g.residents,
         CASE WHEN g.n % 7 = 0 THEN NULL ELSE CAST(g.d AS DOUBLE) * 0.8 / g.n END AS nurse_hprd,
         CASE WHEN g.n % 7 = 0 THEN NULL ELSE CAST(g.d AS DOUBLE) * 0.2 / g.n END AS rn_hprd,
         CASE WHEN g.period < DATE '1997-01-01' OR g.n % 9 = 0 THEN NULL
              ELSE CAST(g.t AS DOUBLE) * 11.5 / g.n END AS turnover_pct,
         CASE WHEN g.n % 11 = 0 THEN NULL ELSE 1 + g.n % 5 END AS overall_rating,
         CASE WHEN g.n % 13 = 0 THEN NULL ELSE 1 + g.d % 5 END AS health_inspection_rating,
         g.deficiencies,
         (g.residents * 1.0 > 0.85 * g.beds) AS is_suspect,
         n.n_name AS state_code, r.r_name AS census_region,
         CASE g.l_suppkey % 3 WHEN 0 THEN 'For profit' WHEN 1 THEN 'Non profit' ELSE 'Government' END AS ownership_group,
         CASE WHEN g.period < DATE '1999-01-01' THEN NULL
              WHEN g.l_suppkey % 4 = 0 THEN 'Independent (1)'
              WHEN g.l_suppkey % 4 = 1 THEN 'Small chain (2-9)'
              WHEN g.l_suppkey % 4 = 2 THEN 'Medium chain (10-49)' ELSE 'Large chain (50+)' END AS chain_size_band
  FROM fx_g g JOIN supplier s ON s.s_suppkey = g.l_suppkey
  JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey"""

CTES["fx_attrs"] = """
  SELECT ccn, period,
         CASE WHEN beds < 450 THEN 'small' WHEN beds < 600 THEN 'medium' ELSE 'large' END AS size_band,
         CASE WHEN deficiencies % 4 = 0 THEN NULL WHEN deficiencies > 8 THEN 'SFF' ELSE 'None' END AS focus,
         CASE WHEN period < DATE '1997-01-01' THEN NULL ELSE (deficiencies % 2 = 0) END AS icon
  FROM fx_panel"""

CTES["fx_facility"] = """
  SELECT snapshot_date_key, period AS snapshot_date, year(period) AS snapshot_year,
         concat(CAST(year(period) AS VARCHAR), '-', lpad(CAST(month(period) AS VARCHAR), 2, '0')) AS snapshot_year_month,
         CASE WHEN period <= DATE '2020-02-29' THEN 'Pre-COVID' WHEN period <= DATE '2021-12-31' THEN 'COVID'
              ELSE 'Post-COVID' END AS covid_period,
         ccn, concat('FACILITY ', ccn) AS provider_name,
         CASE WHEN deficiencies > 10 THEN 'SFF' WHEN deficiencies = 10 THEN 'SFF Candidate' ELSE 'None' END AS special_focus_status,
         deficiencies % 2 = 0 AS abuse_icon, state_code, concat('State of ', state_code) AS state_name, census_region,
         CASE grp WHEN 'For profit' THEN CASE WHEN deficiencies % 2 = 0 THEN 'For profit - Corporation' ELSE 'For profit - Partnership' END
                  WHEN 'Non profit' THEN 'Non profit - Corporation'
                  ELSE CASE WHEN deficiencies % 3 = 0 THEN 'Government - City' ELSE 'Government - County' END END AS ownership_type,
         grp AS ownership_group, grp = 'For profit' AS is_for_profit,
         CASE WHEN chain_size_band IS NULL THEN 'Unknown' WHEN chain_size_band = 'Independent (1)' THEN 'Independent (no chain)'
              ELSE concat('CHAIN ', CAST(CAST(ccn AS BIGINT) % 12 AS VARCHAR)) END AS chain_name,
         COALESCE(chain_size_band, 'Unknown') AS chain_size_band,
         COALESCE(chain_size_band, 'Unknown') = 'Independent (1)' AS is_independent,
         beds AS certified_beds, CAST(residents AS DOUBLE) AS avg_residents_per_day,
         CAST(residents * day(last_day(period)) AS DOUBLE) AS resident_days,
         nurse_hprd AS reported_total_nurse_hprd, rn_hprd AS reported_rn_hprd,
         turnover_pct AS total_nursing_turnover_pct, overall_rating, 1 + beds % 5 AS staffing_rating,
         health_inspection_rating, deficiencies AS cycle1_total_deficiencies,
         COALESCE(is_suspect, FALSE) AS is_suspect
  FROM (SELECT *, CASE WHEN period >= DATE '2000-01-01' AND CAST(ccn AS BIGINT) % 10 = 7 THEN 'Government'
                       ELSE ownership_group END AS grp FROM fx_panel) p"""

CTES["fx_sighting"] = """
  SELECT p.period AS stamp, lpad(CAST(l_suppkey AS VARCHAR(20)), 6, '0') AS ccn,
         CAST(l_shipdate AS DATE) + (CASE WHEN l_orderkey % 17 = 0 AND p.period >= DATE '2000-07-01' THEN 1 ELSE 0 END)
           AS penalty_date,
         CASE WHEN l_linenumber % 4 = 0 THEN 'Payment Denial' ELSE 'Fine' END AS penalty_type,
         CASE WHEN l_linenumber % 4 <> 0 AND p.period >= DATE '2000-01-01'
              THEN concat(CAST(l_orderkey AS VARCHAR(20)), '-', CAST(l_linenumber AS VARCHAR(20)),
                          '-', CAST(l_partkey AS VARCHAR(20)), '-', CAST(CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS VARCHAR(20)))
              END AS fine_id,
         CASE WHEN l_linenumber % 4 <> 0
              THEN CAST(ROUND(l_extendedprice) AS BIGINT) + CASE WHEN l_orderkey % 5 = 0 THEN CAST(year(p.period) AS BIGINT) - 1995 ELSE 0 END
              END AS fine_amount_usd,
         CASE WHEN l_linenumber % 4 = 0 THEN CAST(l_quantity AS BIGINT) END AS payment_denial_days,
         l_orderkey, l_linenumber, l_partkey,
         CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS cents
  FROM lineitem JOIN (SELECT DISTINCT period FROM fx_panel) p
    ON CAST(l_shipdate AS DATE) < p.period AND CAST(l_shipdate AS DATE) >= p.period - INTERVAL '3' YEAR
  WHERE l_returnflag = 'R' AND l_discount >= 0.07"""

# staged dedup: occurrence -> natural key -> back-fill -> identity -> last sighting
CTES["fx_keyed"] = """
  SELECT s.*, concat(ccn, '|', CAST(penalty_date AS VARCHAR), '|', penalty_type, '|',
                     CAST(ROW_NUMBER() OVER (PARTITION BY stamp, ccn, penalty_date, penalty_type
                          ORDER BY l_orderkey, l_linenumber, l_partkey, cents) - 1 AS VARCHAR)) AS natural_key
  FROM fx_sighting s"""
CTES["fx_filled"] = """
  SELECT k.* EXCLUDE (fine_id), k.fine_id AS reported_id, f.filled AS fine_id,
         COALESCE(f.filled, k.natural_key) AS identity
  FROM fx_keyed k LEFT JOIN (
    SELECT natural_key, fine_id AS filled FROM (
      SELECT natural_key, fine_id, ROW_NUMBER() OVER (PARTITION BY natural_key
             ORDER BY stamp, l_orderkey, l_linenumber, l_partkey, cents) AS nr
      FROM fx_keyed WHERE fine_id IS NOT NULL) ids WHERE nr = 1) f USING (natural_key)"""
CTES["fx_event"] = """
  SELECT *, CASE WHEN fine_id IS NULL THEN 'natural_key' ELSE 'fine_id' END AS fine_id_source FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY identity ORDER BY stamp DESC, ccn DESC, penalty_date DESC,
              l_orderkey DESC, l_linenumber DESC, l_partkey DESC, cents DESC) AS nr,
           COUNT(*) OVER (PARTITION BY identity) AS sightings
    FROM fx_filled) ranked WHERE nr = 1"""

CTES["fx_penalty"] = """
  SELECT e.penalty_date, year(e.penalty_date) AS penalty_year, quarter(e.penalty_date) AS penalty_quarter,
         e.stamp, e.ccn, COALESCE(f.provider_name, 'Unknown') AS provider_name,
         COALESCE(f.state_code, 'Unknown') AS state_code, COALESCE(f.state_name, 'Unknown') AS state_name,
         COALESCE(f.census_region, 'Unknown') AS census_region, COALESCE(f.ownership_group, 'Unknown') AS ownership_group,
         COALESCE(f.chain_name, 'Unknown') AS chain_name, COALESCE(f.chain_size_band, 'Unknown') AS chain_size_band,
         e.penalty_type, e.penalty_type = 'Fine' AS is_monetary, e.fine_id, e.fine_id_source,
         e.fine_amount_usd, e.payment_denial_days, 1 AS penalty_count
  FROM fx_event e LEFT JOIN fx_facility f ON f.ccn = e.ccn AND f.snapshot_date = e.stamp"""

CTES["fx_population"] = """
  SELECT n_name AS state_code, y.year AS year, COUNT(*) * 1000 AS pop_65plus
  FROM customer JOIN nation ON c_nationkey = n_nationkey, (VALUES (1998), (1999), (2000)) AS y(year)
  GROUP BY n_name, y.year"""

CTES["fx_raw"] = """
  SELECT CAST(year(o_orderdate) AS BIGINT) AS batch, o_orderkey AS source_row,
         CASE o_custkey % 3 WHEN 0 THEN CAST(o_custkey AS VARCHAR(20))
              WHEN 1 THEN concat(' ', lpad(CAST(o_custkey AS VARCHAR(20)), 6, '0'), ' ')
              ELSE concat('12345', CAST(o_custkey AS VARCHAR(20))) END AS id_text,
         CASE o_orderkey % 9 WHEN 0 THEN '' WHEN 1 THEN 'n/a'
              WHEN 2 THEN concat(CAST(CAST(ROUND(o_totalprice) AS BIGINT) AS VARCHAR(20)), ' %')
              ELSE concat('$', CAST(CAST(ROUND(o_totalprice) AS BIGINT) AS VARCHAR(20))) END AS number_text,
         CASE WHEN o_orderkey % 50 = 0 THEN 'unknown'
              WHEN year(o_orderdate) % 2 = 0
                THEN concat(CAST(month(o_orderdate) AS VARCHAR(2)), '/', CAST(day(o_orderdate) AS VARCHAR(2)), '/', CAST(year(o_orderdate) AS VARCHAR(4)))
              ELSE concat(CAST(day(o_orderdate) AS VARCHAR(2)), '/', CAST(month(o_orderdate) AS VARCHAR(2)), '/', CAST(year(o_orderdate) AS VARCHAR(4)))
              END AS date_text,
         CASE WHEN year(o_orderdate) < 1997 THEN NULL ELSE
           CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN ' n ' ELSE '' END END AS flag_text,
         concat('  ', o_orderpriority, CASE WHEN o_orderkey % 2 = 0 THEN '   x' ELSE ' X' END) AS label_text,
         CASE WHEN year(o_orderdate) % 3 = 0 THEN CAST(o_orderkey % 97 AS DOUBLE) / 100.0
              ELSE CAST(o_orderkey % 97 AS DOUBLE) END AS drifting_pct
  FROM orders"""

# --- provider rows as text -----------------------------------------------------
CTES["fx_provider_once"] = """
  SELECT period AS processing_date, sk AS source_row, ccn,
    concat(' Facility  ', ccn, CASE WHEN beds % 7 = 0 THEN ' Home' ELSE ' home' END) AS provider_name,
    CASE WHEN beds % 4 <> 0 THEN concat('Owner ', CAST(sk % 5 + CASE WHEN period >= DATE '1999-01-01' THEN 1 ELSE 0 END AS VARCHAR)) END AS legal_business_name,
    CASE WHEN sk % 5 = 0 THEN 'Medicare' ELSE 'Medicare and Medicaid' END AS provider_type,
    CASE WHEN sk % 7 = 0 THEN 'Y' ELSE 'N' END AS resides_in_hospital,
    CASE WHEN deficiencies % 5 = 0 THEN 'maybe' WHEN sk % 3 = 0 THEN ' yes' ELSE '0' END AS ccrc_flag,
    CASE WHEN period >= DATE '1997-01-01' THEN CASE WHEN deficiencies > 10 THEN 'SFF' WHEN deficiencies = 10 THEN 'Y'
         WHEN deficiencies % 2 = 0 THEN NULL ELSE 'N' END END AS special_focus_status,
    CASE WHEN period >= DATE '1997-01-01' THEN CASE deficiencies % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END END AS abuse_icon,
    CAST(beds // 5 AS VARCHAR) AS certified_beds,
    CAST(residents // 5 AS VARCHAR) || '.5' AS avg_residents_per_day,
    CAST(2 + beds % 4 AS VARCHAR) || '.' || lpad(CAST(deficiencies * 7 % 100 AS VARCHAR), 2, '0') AS reported_total_nurse_hprd,
    '0.' || lpad(CAST(beds % 100 AS VARCHAR), 2, '0') AS reported_rn_hprd,
    CASE WHEN period >= DATE '1997-01-01' THEN CASE WHEN beds % 31 = 0 THEN '250'
         WHEN year(period) % 3 = 0 THEN '0.' || CAST(30 + beds % 50 AS VARCHAR)
         ELSE CAST(30 + beds % 50 AS VARCHAR) || ' %' END END AS total_nursing_turnover_pct,
    CAST(overall_rating AS VARCHAR) AS overall_rating, CAST(1 + beds % 5 AS VARCHAR) AS staffing_rating,
    CAST(health_inspection_rating AS VARCHAR) AS health_inspection_rating,
    CAST(deficiencies AS VARCHAR) AS cycle1_total_deficiencies,
    CASE WHEN sk % 2 = 0 THEN CAST(1000 + sk % 40 AS VARCHAR) ELSE CAST(20000 + sk % 40 AS VARCHAR) || '-1234' END AS zip_code,
    CASE WHEN month(period) = 1 THEN ' springfield  ' ELSE 'Springfield ' END || CAST(sk % 4 AS VARCHAR) AS city,
    CASE sk % 6 WHEN 0 THEN 'AL' WHEN 1 THEN 'ca ' WHEN 2 THEN ' NY' WHEN 3 THEN 'TX' WHEN 4 THEN 'PR' ELSE 'ZZ' END AS state_code,
    CASE WHEN beds % 3 <> 0 THEN 'County ' || CAST(beds % 5 AS VARCHAR) END AS county_parish,
    CASE WHEN period >= DATE '1998-01-01' THEN CASE sk % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'n' ELSE '?' END END AS urban_flag,
    CAST(30 + sk % 20 AS VARCHAR) || '.' || CAST(beds % 10 AS VARCHAR) AS latitude,
    '-' || CAST(80 + sk % 20 AS VARCHAR) || '.' || CAST(beds % 10 AS VARCHAR) AS longitude,
    CASE WHEN period >= DATE '2000-01-01' AND sk % 4 = 1 THEN 'Government - State'
         WHEN sk % 5 = 0 THEN 'For profit -  Corporation' WHEN sk % 5 = 1 THEN 'Non profit - Other'
         WHEN sk % 5 = 2 THEN 'Government - City/county' WHEN sk % 5 = 3 THEN 'For profit - Individual'
         ELSE 'Tribal' END AS ownership_type,
    CASE WHEN period >= DATE '1999-01-01' AND sk % 4 <> 0 THEN
         CASE WHEN beds % 2 = 0 THEN ' chain ' ELSE 'CHAIN  ' END || CAST(sk % 9 AS VARCHAR) END AS chain_name,
    CASE WHEN period >= DATE '1999-01-01' AND beds % 3 <> 0 THEN CAST(100 + sk % 9 AS VARCHAR) END AS chain_id,
    CASE WHEN period >= DATE '1999-01-01' THEN CAST((sk % 9) * 8 + CASE WHEN period >= DATE '2000-01-01' THEN 1 ELSE 0 END AS VARCHAR) END AS num_facilities_in_chain
  FROM (SELECT *, CAST(ccn AS BIGINT) AS sk FROM fx_panel) p"""
CTES["fx_provider"] = """
  SELECT * FROM fx_provider_once UNION ALL
  SELECT * REPLACE (source_row + 1000000000 AS source_row, '1' AS certified_beds, 'Repeated' AS provider_name)
  FROM fx_provider_once WHERE source_row % 23 = 5"""


def squeezed(c: str) -> str:
    return f"NULLIF(regexp_replace(trim({c}), '\\s+', ' ', 'g'), '')"


def number(c: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_replace({c}, '[$,%\\s]', '', 'g'), '') AS DOUBLE)"


def yes_no(c: str) -> str:
    return (f"CASE WHEN upper(trim({c})) IN ('Y','YES','TRUE','1') THEN TRUE "
            f"WHEN upper(trim({c})) IN ('N','NO','FALSE','0') THEN FALSE END")


def chain_band(c: str) -> str:
    return (f"CASE WHEN {c} <= 1 THEN 'Independent (1)' WHEN {c} BETWEEN 2 AND 9 THEN 'Small chain (2-9)' "
            f"WHEN {c} BETWEEN 10 AND 49 THEN 'Medium chain (10-49)' WHEN {c} >= 50 THEN 'Large chain (50+)' "
            f"ELSE 'Unknown' END")


def bed_band(c: str) -> str:
    return (f"CASE WHEN {c} < 50 THEN 'Small (<50 beds)' WHEN {c} < 100 THEN 'Medium (50-99 beds)' "
            f"WHEN {c} < 200 THEN 'Large (100-199 beds)' WHEN {c} >= 200 THEN 'Very large (200+ beds)' END")


# --- dimensions ------------------------------------------------------------------
CTES["fx_place_rows"] = f"""
  SELECT lpad(substr(trim(zip_code), 1, 5), 5, '0') AS zip_code, upper({squeezed('city')}) AS city,
         upper({squeezed('state_code')}) AS state_code, {squeezed('county_parish')} AS county_parish, urban_flag,
         {number('latitude')} AS latitude, {number('longitude')} AS longitude, processing_date, source_row
  FROM fx_provider"""
CTES["fx_places"] = f"""
  SELECT zip_code, city, county_parish, state_code,
         {case('state_code', {s[0]: s[2] for s in V.STATES}, "'Unknown'")} AS state_name,
         {case('state_code', {s[0]: s[3] for s in V.STATES}, "'Unknown'")} AS census_region,
         CASE upper(urban_flag) WHEN 'Y' THEN 'Urban' WHEN 'N' THEN 'Rural' ELSE 'Unknown' END AS urban_rural,
         latitude, longitude
  FROM (SELECT zip_code, city, state_code, AVG(latitude) AS latitude, AVG(longitude) AS longitude,
               arg_max(county_parish, rank) FILTER (WHERE county_parish IS NOT NULL) AS county_parish,
               arg_max(urban_flag, rank) FILTER (WHERE urban_flag IS NOT NULL) AS urban_flag
        FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY processing_date, source_row) AS rank FROM fx_place_rows) r
        GROUP BY zip_code, city, state_code) described"""
CTES["fx_dim_geography"] = """
  SELECT ROW_NUMBER() OVER (ORDER BY state_code, zip_code, city) AS geography_key, * FROM fx_places
  UNION ALL SELECT -1, 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown', NULL, NULL"""
CTES["fx_dim_ownership"] = f"""
  SELECT ROW_NUMBER() OVER (ORDER BY ownership_type) AS ownership_key, ownership_type, grp AS ownership_group,
         grp = 'For profit' AS is_for_profit
  FROM (SELECT ownership_type, {case('ownership_type', V.OWNERSHIP_GROUPS, "'Unknown'")} AS grp
        FROM (SELECT DISTINCT {squeezed('ownership_type')} AS ownership_type FROM fx_provider) t) o
  UNION ALL SELECT -1, 'Unknown', 'Unknown', FALSE"""
CTES["fx_dim_chain"] = f"""
  SELECT ROW_NUMBER() OVER (ORDER BY chain_name) AS chain_key, chain_id, chain_name,
         CAST(size AS INTEGER) AS num_facilities_in_chain, {chain_band('size')} AS chain_size_band,
         FALSE AS is_independent
  FROM (SELECT chain_name, arg_max(chain_id, CASE WHEN chain_id IS NOT NULL THEN rank END) AS chain_id,
               arg_max(size, CASE WHEN size IS NOT NULL THEN rank END) AS size
        FROM (SELECT upper({squeezed('chain_name')}) AS chain_name, {squeezed('chain_id')} AS chain_id,
                     {number('num_facilities_in_chain')} AS size,
                     ROW_NUMBER() OVER (ORDER BY processing_date, source_row) AS rank
              FROM fx_provider) named WHERE chain_name IS NOT NULL GROUP BY chain_name) chains
  UNION ALL SELECT 0, NULL, 'Independent (no chain)', 1, 'Independent (1)', TRUE
  UNION ALL SELECT -1, NULL, 'Unknown', NULL, 'Unknown', FALSE"""
CTES["fx_dim_penalty_type"] = """
  SELECT ROW_NUMBER() OVER (ORDER BY penalty_type) AS penalty_type_key, penalty_type,
         lower(penalty_type) = 'fine' AS is_monetary
  FROM (SELECT DISTINCT trim(penalty_type) AS penalty_type FROM fx_sighting) t
  UNION ALL SELECT -1, 'Unknown', FALSE"""
CTES["fx_first_provider"] = """
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY processing_date, ccn ORDER BY source_row) AS nr
                 FROM fx_provider) ranked WHERE nr = 1"""
CTES["fx_tracked"] = f"""
  SELECT p.ccn, p.processing_date AS period, upper({squeezed('provider_name')}) AS a1,
         upper({squeezed('legal_business_name')}) AS a2, {squeezed('provider_type')} AS a3,
         CAST({yes_no('resides_in_hospital')} AS VARCHAR) AS a4, CAST({yes_no('ccrc_flag')} AS VARCHAR) AS a5,
         CASE WHEN q.has_focus THEN COALESCE(m.focus, 'None') ELSE m.focus END AS a6,
         CAST({yes_no('abuse_icon')} AS VARCHAR) AS a7, {bed_band(number('certified_beds'))} AS a8
  FROM fx_first_provider p
  JOIN (SELECT processing_date, COUNT(special_focus_status) > 0 AS has_focus FROM fx_provider GROUP BY 1) q
    ON q.processing_date = p.processing_date,
  LATERAL (SELECT CASE trim(p.special_focus_status) WHEN 'Y' THEN 'SFF' WHEN 'N' THEN 'None'
                  ELSE NULLIF(trim(p.special_focus_status), '') END AS focus) m"""


def versions_sql(source: str, attributes: list[str]) -> str:
    """Walk the periods of every member one by one (not the window form)."""
    a = attributes
    known = ", ".join(f"COALESCE(n.{x}, w.{x}) AS {x}" for x in a)
    changed = " OR ".join(f"COALESCE(n.{x} <> w.{x}, FALSE)" for x in a)
    return f"""
  SELECT ccn, nr, period, {', '.join(a)}, period AS opened, 1 AS version FROM {source}_line WHERE nr = 1
  UNION ALL -- step
  SELECT n.ccn, n.nr, n.period, {known},
         CASE WHEN {changed} THEN n.period ELSE w.opened END,
         w.version + CASE WHEN {changed} THEN 1 ELSE 0 END
  FROM {source}_walk w JOIN {source}_line n ON n.ccn = w.ccn AND n.nr = w.nr + 1"""


def closed_versions_sql(source: str, attributes: list[str]) -> str:
    last = ", ".join(f"arg_max({x}, CASE WHEN {x} IS NOT NULL THEN nr END) AS {x}" for x in attributes)
    return f"""
  SELECT v.*, LEAD(effective_date) OVER (PARTITION BY ccn ORDER BY effective_date) AS expiry_date,
         LEAD(effective_date) OVER (PARTITION BY ccn ORDER BY effective_date) IS NULL AS is_current
  FROM (SELECT ccn, version, {last}, MIN(opened) AS effective_date FROM {source}_walk GROUP BY ccn, version) v"""


ATTRS = ["size_band", "focus", "icon"]
TRACKED = [f"a{i}" for i in range(1, 9)]
CTES["fx_attrs_line"] = """
  SELECT ccn, period, size_band, focus, CAST(icon AS VARCHAR) AS icon,
         ROW_NUMBER() OVER (PARTITION BY ccn ORDER BY period) AS nr FROM fx_attrs"""
CTES["fx_attrs_walk"] = versions_sql("fx_attrs", ATTRS)
CTES["fx_attrs_versions"] = closed_versions_sql("fx_attrs", ATTRS)
CTES["fx_tracked_line"] = """
  SELECT *, ROW_NUMBER() OVER (PARTITION BY ccn ORDER BY period) AS nr FROM fx_tracked"""
CTES["fx_tracked_walk"] = versions_sql("fx_tracked", TRACKED)
CTES["fx_tracked_versions"] = closed_versions_sql("fx_tracked", TRACKED)
CTES["fx_dim_facility"] = """
  SELECT ROW_NUMBER() OVER (ORDER BY ccn, effective_date) AS facility_key, ccn, a1 AS provider_name,
         a2 AS legal_business_name, a3 AS provider_type, CAST(a4 AS BOOLEAN) AS resides_in_hospital,
         CAST(a5 AS BOOLEAN) AS ccrc_flag, a6 AS special_focus_status, CAST(a7 AS BOOLEAN) AS abuse_icon,
         a8 AS bed_size_band, effective_date, expiry_date, is_current FROM fx_tracked_versions
  UNION ALL SELECT -1, 'Unknown', 'Unknown', 'Unknown', 'Unknown', NULL, NULL, 'Unknown', NULL, 'Unknown', NULL, NULL, FALSE"""

# --- facts ---------------------------------------------------------------------------
CTES["fx_keys"] = f"""
  SELECT p.*, COALESCE(g.geography_key, -1) AS geography_key, COALESCE(o.ownership_key, -1) AS ownership_key,
         CASE WHEN NOT q.has_chain THEN -1 WHEN {squeezed('p.chain_name')} IS NULL THEN 0
              ELSE COALESCE(c.chain_key, -1) END AS chain_key
  FROM fx_first_provider p
  JOIN (SELECT processing_date, COUNT(chain_name) > 0 AS has_chain FROM fx_provider GROUP BY 1) q
    ON q.processing_date = p.processing_date
  LEFT JOIN fx_dim_geography g ON g.zip_code = lpad(substr(trim(p.zip_code), 1, 5), 5, '0')
    AND g.city = upper({squeezed('p.city')}) AND g.state_code = upper({squeezed('p.state_code')})
  LEFT JOIN fx_dim_ownership o ON o.ownership_type = {squeezed('p.ownership_type')}
  LEFT JOIN fx_dim_chain c ON c.chain_name = upper({squeezed('p.chain_name')})"""
CTES["fx_medians"] = f"""
  SELECT processing_date, quantile_cont({number('total_nursing_turnover_pct')}, 0.5) AS median
  FROM fx_first_provider GROUP BY 1"""
CTES["fx_fact_snapshot"] = f"""
  SELECT year(x.processing_date) * 10000 + month(x.processing_date) * 100 + day(x.processing_date) AS snapshot_date_key,
         COALESCE(d.facility_key, -1) AS facility_key, geography_key, ownership_key, chain_key, x.ccn,
         certified_beds, avg_residents_per_day,
         avg_residents_per_day * day(last_day(x.processing_date)) AS resident_days,
         reported_total_nurse_hprd, reported_rn_hprd, total_nursing_turnover_pct, overall_rating, staffing_rating,
         health_inspection_rating, cycle1_total_deficiencies,
         COALESCE(certified_beds > 0 AND (avg_residents_per_day / certified_beds < 0
                  OR avg_residents_per_day / certified_beds > 1.2), FALSE)
         OR COALESCE(certified_beds <= 0, FALSE)
         OR COALESCE(total_nursing_turnover_pct <= 0 OR total_nursing_turnover_pct > 200, FALSE) AS is_suspect
  FROM (SELECT k.processing_date, k.ccn, geography_key, ownership_key, chain_key,
               CAST({number('certified_beds')} AS BIGINT) AS certified_beds,
               {number('avg_residents_per_day')} AS avg_residents_per_day,
               {number('reported_total_nurse_hprd')} AS reported_total_nurse_hprd,
               {number('reported_rn_hprd')} AS reported_rn_hprd,
               CASE WHEN m.median < 1.5 THEN {number('total_nursing_turnover_pct')} * 100
                    ELSE {number('total_nursing_turnover_pct')} END AS total_nursing_turnover_pct,
               CAST({number('overall_rating')} AS BIGINT) AS overall_rating,
               CAST({number('staffing_rating')} AS BIGINT) AS staffing_rating,
               CAST({number('health_inspection_rating')} AS BIGINT) AS health_inspection_rating,
               CAST({number('cycle1_total_deficiencies')} AS BIGINT) AS cycle1_total_deficiencies
        FROM fx_keys k LEFT JOIN fx_medians m ON m.processing_date = k.processing_date) x
  LEFT JOIN fx_dim_facility d ON d.ccn = x.ccn AND d.effective_date <= x.processing_date
       AND (d.expiry_date IS NULL OR x.processing_date < d.expiry_date)"""
CTES["fx_fact_penalty"] = """
  SELECT ROW_NUMBER() OVER (ORDER BY penalty_date_key, ccn, penalty_type_key, stamp, l_orderkey, l_linenumber, l_partkey, cents)
           AS penalty_event_key, penalty_date_key, facility_key, geography_key, ownership_key, chain_key, penalty_type_key,
         ccn, fine_id, fine_id_source, fine_amount_usd, payment_denial_days, 1 AS penalty_count
  FROM (SELECT e.*, year(penalty_date) * 10000 + month(penalty_date) * 100 + day(penalty_date) AS penalty_date_key,
               COALESCE(k.geography_key, -1) AS geography_key, COALESCE(k.ownership_key, -1) AS ownership_key,
               COALESCE(k.chain_key, -1) AS chain_key, COALESCE(t.penalty_type_key, -1) AS penalty_type_key,
               COALESCE(d.facility_key,
                        (SELECT MIN(f.facility_key) FROM fx_dim_facility f WHERE f.ccn = e.ccn), -1) AS facility_key
        FROM fx_event e
        LEFT JOIN fx_keys k ON k.ccn = e.ccn AND k.processing_date = e.stamp
        LEFT JOIN fx_dim_penalty_type t ON t.penalty_type = e.penalty_type
        LEFT JOIN fx_dim_facility d ON d.ccn = e.ccn AND d.effective_date <= e.stamp
             AND (d.expiry_date IS NULL OR e.stamp < d.expiry_date)) x"""
CTES["fx_dim_date"] = f"""
  SELECT year(d) * 10000 + month(d) * 100 + day(d) AS date_key, d AS full_date, year(d) AS year, quarter(d) AS quarter,
         month(d) AS month, CASE month(d) {' '.join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(V.MONTH_NAMES_TH, 1))} END AS month_name_th,
         concat(CAST(year(d) AS VARCHAR), '-', lpad(CAST(month(d) AS VARCHAR), 2, '0')) AS year_month,
         year(d) + CASE WHEN month(d) >= 10 THEN 1 ELSE 0 END AS us_fiscal_year,
         CASE WHEN d <= DATE '2020-02-29' THEN 'Pre-COVID' WHEN d <= DATE '2021-12-31' THEN 'COVID' ELSE 'Post-COVID' END AS covid_period
  FROM (SELECT CAST(day AS DATE) AS d FROM generate_series(DATE '1960-01-01', DATE '2027-12-31', INTERVAL 1 DAY) AS s(day)) days"""

# --- one row per facility of the newest period, fines summed first ------------------
CTES["fx_latest"] = "SELECT MAX(snapshot_date_key) AS k, MAX(snapshot_date) AS d FROM fx_facility"
CTES["fx_fines"] = """
  SELECT ccn, SUM(fine_amount_usd) AS fine_total, COUNT(*) FILTER (WHERE fine_amount_usd > 0) AS fine_events,
         SUM(payment_denial_days) AS denial_days
  FROM fx_penalty, fx_latest WHERE penalty_date >= d - INTERVAL '3' YEAR AND penalty_date <= d GROUP BY ccn"""


def roster_sql(where: str, fines: str) -> str:
    return f"""
  SELECT f.*, certified_beds AS beds, avg_residents_per_day AS residents, reported_total_nurse_hprd AS nurse_hprd,
         reported_rn_hprd AS rn_hprd, total_nursing_turnover_pct AS turnover_pct, overall_rating AS rating,
         cycle1_total_deficiencies AS deficiencies, COALESCE(x.fine_total, 0) AS fine_total,
         COALESCE(x.fine_events, 0) AS fine_events, COALESCE(x.denial_days, 0) AS denial_days,
         COALESCE(x.fine_total, 0) / NULLIF(CAST(certified_beds AS DOUBLE), 0) AS fines_per_bed,
         COALESCE(x.fine_total, 0) > 0 AS was_fined
  FROM fx_facility f LEFT JOIN {fines} x ON x.ccn = f.ccn WHERE {where} AND NOT is_suspect"""


CTES["fx_roster"] = roster_sql("snapshot_date_key = (SELECT k FROM fx_latest)", "fx_fines")
CTES["fx_fines_1998"] = """
  SELECT ccn, SUM(fine_amount_usd) AS fine_total, COUNT(*) FILTER (WHERE fine_amount_usd > 0) AS fine_events,
         SUM(payment_denial_days) AS denial_days
  FROM fx_penalty WHERE penalty_date >= DATE '1995-01-01' AND penalty_date <= DATE '1998-01-01' GROUP BY ccn"""
CTES["fx_roster_1998"] = roster_sql("snapshot_date_key = 19980101", "fx_fines_1998")


def scored_sql(roster: str) -> str:
    return f"""
  SELECT *, 3 * f1 + 2 * f2 + 2 * f3 + f4 + f5 AS risk_score,
         CASE WHEN f1 + f2 + f3 + f4 + f5 = 0 THEN '-' ELSE concat_ws(', ',
           CASE WHEN f1 = 1 THEN 'special focus' END, CASE WHEN f2 = 1 THEN '1-2 stars' END,
           CASE WHEN f3 = 1 THEN 'heavily fined' END, CASE WHEN f4 = 1 THEN 'many deficiencies' END,
           CASE WHEN f5 = 1 THEN 'below 3.48 HPRD' END) END AS risk_reasons
  FROM (SELECT r.*, CASE WHEN special_focus_status IN ('SFF', 'SFF Candidate') THEN 1 ELSE 0 END AS f1,
               CASE WHEN rating <= 2 THEN 1 ELSE 0 END AS f2, CASE WHEN fines_per_bed >= c.fc THEN 1 ELSE 0 END AS f3,
               CASE WHEN deficiencies >= c.dc THEN 1 ELSE 0 END AS f4, CASE WHEN nurse_hprd < 3.48 THEN 1 ELSE 0 END AS f5
        FROM {roster} r, (SELECT quantile_cont(fines_per_bed, 0.75) AS fc,
             quantile_cont(CAST(deficiencies AS DOUBLE), 0.75) AS dc FROM {roster}) c) flags"""


CTES["fx_scored"] = scored_sql("fx_roster")
CTES["fx_scored_1998"] = scored_sql("fx_roster_1998")
CTES["fx_outcome"] = """
  SELECT s.*, l.rating_later, l.beds_later, l.beds_later IS NULL AS exited,
         CASE WHEN l.beds_later IS NOT NULL THEN COALESCE(p.fines, 0) END AS fines_later,
         l.beds_later IS NOT NULL AND COALESCE(p.fines, 0) > 0 AS fined_later
  FROM fx_scored_1998 s
  LEFT JOIN (SELECT ccn, overall_rating AS rating_later, certified_beds AS beds_later FROM fx_facility
             WHERE snapshot_date_key = 20010701 AND NOT is_suspect) l ON l.ccn = s.ccn
  LEFT JOIN (SELECT ccn, SUM(fine_amount_usd) AS fines FROM fx_penalty
             WHERE penalty_date BETWEEN DATE '1998-07-01' AND DATE '2001-07-01' GROUP BY ccn) p ON p.ccn = s.ccn"""

CTES["fx_fines_now"] = """
  SELECT ccn, SUM(fine_amount_usd) AS fine_total, COUNT(*) FILTER (WHERE fine_amount_usd > 0) AS fine_events,
         SUM(payment_denial_days) AS denial_days
  FROM fx_penalty WHERE penalty_date >= DATE '1998-07-01' AND penalty_date <= DATE '2001-07-01' GROUP BY ccn"""
CTES["fx_roster_now"] = roster_sql("snapshot_date_key = 20010701", "fx_fines_now")
CTES["fx_scored_now"] = scored_sql("fx_roster_now")

# --- the same views and the roster over the star: facts joined with dimensions --------
CTES["fx_star_facility"] = """
  SELECT f.*, t.full_date AS snapshot_date, t.year AS snapshot_year, t.year_month AS snapshot_year_month, d.provider_name,
         d.special_focus_status, d.abuse_icon, g.state_code, g.state_name, g.census_region, o.ownership_type, o.ownership_group,
         o.is_for_profit, c.chain_name, c.chain_size_band, c.is_independent
  FROM fx_fact_snapshot f, fx_dim_date t, fx_dim_facility d, fx_dim_geography g, fx_dim_ownership o, fx_dim_chain c
  WHERE t.date_key = f.snapshot_date_key AND d.facility_key = f.facility_key AND g.geography_key = f.geography_key
    AND o.ownership_key = f.ownership_key AND c.chain_key = f.chain_key"""
CTES["fx_star_penalty"] = """
  SELECT f.*, t.full_date AS penalty_date, t.year AS penalty_year, g.state_code, o.ownership_group, c.chain_size_band, k.penalty_type
  FROM fx_fact_penalty f, fx_dim_date t, fx_dim_facility d, fx_dim_geography g, fx_dim_ownership o, fx_dim_chain c, fx_dim_penalty_type k
  WHERE t.date_key = f.penalty_date_key AND d.facility_key = f.facility_key AND g.geography_key = f.geography_key
    AND o.ownership_key = f.ownership_key AND c.chain_key = f.chain_key AND k.penalty_type_key = f.penalty_type_key"""


def on_star(sql: str) -> str:
    """A statement over the flat views as one over the star."""
    return re.sub(r"\bfx_(facility|penalty|latest|fines|roster)\b", r"fx_star_\1", sql)


for _name in ("fx_latest", "fx_fines", "fx_roster"):
    CTES[on_star(_name)] = on_star(CTES[_name])
