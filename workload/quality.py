"""Checks, run log and reconciliation over the derived star."""

from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.functions import clean
from tidemark.operators import dedup, votes
from tidemark.plans import checks, runlog
from workload.cleaning import FIELDS, HITS
from workload.frames import SIGHTING
from workload.registry import query

CHECK = "rule:s target:s rows_checked:i violations:i"


def star(f):
    return {**f.dims, "fact_snapshot": f.fact_snapshot, "fact_penalty": f.fact_penalty}


def unique_sql(rule, table, keys, source):
    return f"""SELECT '{rule}' AS rule, '{table}({','.join(keys)})' AS target, COUNT(*) AS rows_checked,
    COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {', '.join(keys)} FROM {source}) d) AS violations FROM {source}"""


def keys_sql(table, source):
    keys = checks.PRIMARY_KEYS[table]
    parts = [unique_sql("primary_key", table, keys, source),
             f"SELECT 'not_null', '{table}({','.join(keys)})', COUNT(*), COUNT(*) FILTER (WHERE {' OR '.join(k + ' IS NULL' for k in keys)}) FROM {source}"]
    if table in checks.NATURAL_KEYS:
        parts.append(unique_sql("natural_key", table, checks.NATURAL_KEYS[table], source))
    return parts


BUILT = {"dim_facility": "fx_dim_facility", "dim_geography": "fx_dim_geography", "dim_ownership": "fx_dim_ownership",
         "dim_chain": "fx_dim_chain", "dim_penalty_type": "fx_dim_penalty_type", "fact_snapshot": "fx_fact_snapshot",
         "fact_penalty": "fx_fact_penalty"}


@query("check_keys", CHECK, " UNION ALL ".join(p for t, s in BUILT.items() for p in keys_sql(t, s)))
def check_keys(f):
    return checks.check_keys({t: frame for t, frame in star(f).items() if t in BUILT})


@query("check_keys_bad", CHECK, """
  SELECT 'unique' AS rule, 'lineitem(l_orderkey,l_linenumber)' AS target, COUNT(*) AS rows_checked,
         COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) d) AS violations FROM lineitem
  UNION ALL SELECT 'not_null', 'panel(turnover_pct)', COUNT(*), COUNT(*) - COUNT(turnover_pct) FROM fx_panel""")
def check_keys_bad(f):
    """The same checks on columns that do repeat and do lack values."""
    return checks.check_unique(f.table("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem").unionByName(
        checks.check_not_null(f.panel, ["turnover_pct"], "panel"))


@query("fk_orphans", f"{CHECK} detail:s", " UNION ALL ".join(
    f"""SELECT 'fk' AS rule, '{fact}.{column}' AS target, COUNT(*) AS rows_checked,
    COUNT(*) FILTER (WHERE d.k IS NULL) AS violations, concat(CAST(COUNT(*) FILTER (WHERE x.{column} = -1) AS VARCHAR), ' at Unknown') AS detail
    FROM fx_{fact} x LEFT JOIN (SELECT {key} AS k FROM {'fx_dim_date UNION ALL SELECT -1' if dim == 'dim_date' else 'fx_' + dim}) d ON d.k = x.{column}"""
    for fact, keys in checks.FOREIGN_KEYS.items() for column, (dim, key) in keys.items()))
def fk_orphans(f):
    return checks.check_foreign_keys(star(f))


@query("fk_orphans_bad", f"{CHECK} detail:s", """
  SELECT 'fk' AS rule, 'lineitem.l_suppkey' AS target, COUNT(*) AS rows_checked, COUNT(*) FILTER (WHERE s_suppkey IS NULL) AS violations,
         '0 at Unknown' AS detail FROM lineitem LEFT JOIN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 7 <> 0) s ON s_suppkey = l_suppkey""")
def fk_orphans_bad(f):
    return checks.fk_orphans(f.table("lineitem"), f.table("supplier").filter(F.col("s_suppkey") % 7 != 0),
                             "l_suppkey", "s_suppkey", "lineitem.l_suppkey")


@query("scd2_check", f"{CHECK} detail:s", """
  SELECT rule, 'dim_facility' AS target, n AS rows_checked, 0 AS violations, concat(CAST(m AS VARCHAR), ' members') AS detail
  FROM (SELECT COUNT(*) AS n, COUNT(DISTINCT ccn) AS m FROM fx_dim_facility WHERE facility_key <> -1) c,
       (VALUES ('scd2_one_current'), ('scd2_closed_has_expiry'), ('scd2_no_overlap')) AS r(rule)""")
def scd2_check(f):
    return checks.scd2_check(f.dims["dim_facility"].filter(F.col("facility_key") != V.UNKNOWN_KEY))


@query("scd2_check_bad", CHECK, """
  SELECT 'scd2_one_current' AS rule, 'broken' AS target, COUNT(*) AS rows_checked,
         (SELECT COUNT(*) FROM (SELECT ccn FROM bad WHERE cur GROUP BY ccn HAVING COUNT(*) > 1) x) AS violations FROM bad
  UNION ALL SELECT 'scd2_closed_has_expiry', 'broken', COUNT(*), COUNT(*) FILTER (WHERE NOT cur AND ends IS NULL) FROM bad
  UNION ALL SELECT 'scd2_no_overlap', 'broken', COUNT(*), COUNT(*) FILTER (WHERE effective_date < before) FROM
    (SELECT *, LAG(ends) OVER (PARTITION BY ccn ORDER BY effective_date) AS before FROM bad) l""".replace("bad", """(
    SELECT ccn, effective_date, CASE WHEN CAST(ccn AS BIGINT) % 3 = 0 THEN TRUE ELSE is_current AND CAST(ccn AS BIGINT) % 5 <> 0 END AS cur,
           CAST(expiry_date + INTERVAL (CASE WHEN CAST(ccn AS BIGINT) % 4 = 0 THEN 100 ELSE 0 END) DAY AS DATE) AS ends FROM fx_attrs_versions) b"""),
       recursive=True)
def scd2_check_bad(f):
    """Versions with two current rows, open closed rows and overlaps."""
    from tidemark.operators.versions import scd2_build

    key = F.col("ccn").cast("bigint")
    broken = scd2_build(f.attrs, "ccn", "period", ["size_band", "focus", "icon"]).withColumns({
        "is_current": F.when(key % 3 == 0, True).otherwise(F.col("is_current") & (key % 5 != 0)),
        "expiry_date": F.date_add("expiry_date", F.when(key % 4 == 0, 100).otherwise(0))})
    return checks.scd2_check(broken, target="broken")


def rules_sql(table, rules):
    return " UNION ALL ".join(
        f"SELECT '{r}' AS rule, '{table}' AS target, COUNT(*) AS rows_checked, COUNT(*) FILTER (WHERE NOT ({p})) AS violations FROM fx_{table}"
        for r, p in rules.items())


@query("check_rules", CHECK, " UNION ALL ".join([
    rules_sql("fact_snapshot", {
        "overall_rating_range": "overall_rating BETWEEN 1 AND 5", "staffing_rating_range": "staffing_rating BETWEEN 1 AND 5",
        "health_rating_range": "health_inspection_rating BETWEEN 1 AND 5", "beds_nonneg": "certified_beds >= 0",
        "residents_nonneg": "avg_residents_per_day >= 0", "turnover_is_percent": "total_nursing_turnover_pct BETWEEN 0 AND 200"}),
    rules_sql("fact_penalty", {
        "count_is_one": "penalty_count = 1", "fine_nonneg": "fine_amount_usd >= 0", "denial_days_nonneg": "payment_denial_days >= 0",
        "fine_id_source_known": "fine_id_source IN ('fine_id', 'natural_key')"}),
    rules_sql("dim_facility", {"range_forward": "expiry_date > effective_date"}),
    rules_sql("dim_geography", {"zip_width": "geography_key = -1 OR length(zip_code) = 5", "latitude": "latitude BETWEEN -90 AND 90",
                                "longitude": "longitude BETWEEN -180 AND 180"}),
    rules_sql("dim_ownership", {"known_group": "ownership_group IN ('For profit', 'Non profit', 'Government', 'Unknown')"}),
    rules_sql("dim_chain", {"size_nonneg": "num_facilities_in_chain >= 0"})]))
def check_rules(f):
    """The turnover of 250 percent in the source is what these rules catch."""
    tables = star(f)
    return checks.union_all([checks.check_rules(tables[t], t) for t in (
        "fact_snapshot", "fact_penalty", "dim_facility", "dim_geography", "dim_ownership", "dim_chain")])


@query("check_population", f"{CHECK} detail:s", """
  SELECT 'unique' AS rule, 'ref_state_population(state_code,year)' AS target, COUNT(*) AS rows_checked,
         COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT state_code, year FROM fx_population) d) AS violations, '' AS detail FROM fx_population
  UNION ALL SELECT 'enough_states', 'ref_state_population', COUNT(*), CASE WHEN COUNT(DISTINCT state_code) < 51 THEN 1 ELSE 0 END,
         concat(CAST(COUNT(DISTINCT state_code) AS VARCHAR), ' states') FROM fx_population WHERE year = 2000
  UNION ALL SELECT 'plausible_total', 'ref_state_population', COUNT(*), CASE WHEN SUM(pop_65plus) > 50000000 AND SUM(pop_65plus) < 75000000 THEN 0 ELSE 1 END,
         CAST(SUM(pop_65plus) AS VARCHAR) FROM fx_population WHERE year = 2000""")
def check_population(f):
    return checks.check_population(f.population)


@query("key_version_check", "key_version:s fact_rows:i stale:b", """
  SELECT key_version, COUNT(*) AS fact_rows, key_version <> 'run-2' AS stale FROM
    (SELECT CASE WHEN l_orderkey % 100 = 0 THEN 'run-1' ELSE 'run-2' END AS key_version FROM lineitem) f GROUP BY key_version""")
def key_version_check(f):
    facts = f.table("lineitem").withColumn(
        "key_version", F.when(F.col("l_orderkey") % 100 == 0, "run-1").otherwise("run-2"))
    return checks.key_version_check(facts, f.table("supplier").withColumn("key_version", F.lit("run-2")))


@query("canary", "measure:s rows_checked:i actual:f expected:f passed:b", """
  SELECT m.measure, c.n AS rows_checked, m.v AS actual, m.e AS expected, COALESCE(ABS(m.v - m.e) < 0.0005, FALSE) AS passed
  FROM (SELECT COUNT(*) AS n, MAX(certified_beds) AS beds, MAX(avg_residents_per_day) AS residents, MAX(avg_residents_per_day / certified_beds) AS occupancy,
               MAX(resident_days) AS resident_days FROM fx_facility WHERE ccn = '000005' AND snapshot_date_key = 19990101) c,
       LATERAL (VALUES ('beds', c.beds, 500.0), ('residents', c.residents, 400.0), ('occupancy', c.occupancy, 0.8), ('resident_days', c.resident_days, 12400.0)) AS m(measure, v, e)""")
def canary(f):
    return checks.canary(f.facility, "000005", 19990101,
                         {"beds": 500, "residents": 400, "occupancy": 0.8, "resident_days": 12400})


@query("reconcile", "compared:i agreeing:i drifting:i net_drift:i published_total:i", """
  SELECT COUNT(*) AS compared, COUNT(*) FILTER (WHERE ABS(drift) < 1) AS agreeing, COUNT(*) FILTER (WHERE ABS(drift) >= 1) AS drifting,
         COALESCE(SUM(drift), 0) AS net_drift, COALESCE(SUM(total), 0) AS published_total
  FROM (SELECT p.total, COALESCE(e.fines, 0) - p.total AS drift
        FROM (SELECT ccn, SUM(fine_amount_usd) AS total FROM fx_sighting WHERE stamp = DATE '2001-07-01' GROUP BY ccn) p
        LEFT JOIN (SELECT ccn, SUM(COALESCE(fine_amount_usd, 0)) AS fines FROM fx_event
                   WHERE penalty_date >= DATE '1998-07-01' AND penalty_date < DATE '2001-07-01' GROUP BY ccn) e ON e.ccn = p.ccn
        WHERE p.total > 0) x""")
def reconcile(f):
    """Events of a window against the totals one file reported for it."""
    window = f.penalty.filter((F.col("penalty_date") >= "1998-07-01") & (F.col("penalty_date") < "2001-07-01"))
    published = f.sighting.filter(F.col("stamp") == "2001-07-01").groupBy("ccn").agg(
        F.sum("fine_amount_usd").alias("published"))
    return checks.reconcile(window, published, "ccn", "fine_amount_usd", "published")


@query("dedup_upper_bound", "groups:i groups_over:i surplus_rows:i", """
  SELECT COUNT(*) AS groups, COUNT(*) FILTER (WHERE stored > COALESCE(bound, 0)) AS groups_over,
         SUM(GREATEST(stored - COALESCE(bound, 0), 0)) AS surplus_rows
  FROM (SELECT ccn, penalty_date, penalty_type, COUNT(*) AS stored FROM fx_event GROUP BY 1, 2, 3) s
  LEFT JOIN (SELECT ccn, penalty_date, penalty_type, MAX(n) AS bound FROM
             (SELECT stamp, ccn, penalty_date, penalty_type, COUNT(*) AS n FROM fx_sighting GROUP BY 1, 2, 3, 4) f GROUP BY 1, 2, 3) b
    USING (ccn, penalty_date, penalty_type)""")
def dedup_upper_bound(f):
    return checks.dedup_upper_bound(f.sighting, dedup.window_dedup(f.sighting, SIGHTING), "stamp",
                                    ["ccn", "penalty_date", "penalty_type"])


@query("all_or_nothing_unknown", "unknown_rows:i in_blank_periods:i blank_periods:i violations:i", """
  SELECT SUM(unknown) AS unknown_rows, SUM(CASE WHEN unknown = n THEN unknown ELSE 0 END) AS in_blank_periods,
         COUNT(*) FILTER (WHERE unknown = n) AS blank_periods, SUM(CASE WHEN unknown <> n THEN unknown ELSE 0 END) AS violations
  FROM (SELECT snapshot_date_key, COUNT(*) AS n, COUNT(*) FILTER (WHERE chain_key = -1) AS unknown FROM fx_fact_snapshot GROUP BY 1) p""")
def all_or_nothing_unknown(f):
    return checks.all_or_nothing_unknown(f.fact_snapshot, "chain_key")


NULLS_SQL = " UNION ALL ".join(
    f"SELECT CAST(batch AS VARCHAR) AS snapshot_date, 'clean' AS step, 'Q3' AS rule, '{c}' AS target, COUNT(*) - COUNT({c}) AS rows_affected "
    f"FROM fx_raw GROUP BY batch HAVING COUNT(*) > COUNT({c})" for c in FIELDS)
DRIFT_SQL = """CASE WHEN quantile_cont(drifting_pct, 0.5) IS NULL THEN 'no value, not scaled'
  WHEN quantile_cont(drifting_pct, 0.5) < 1.5 THEN 'proportion, multiplied by 100' ELSE 'percentage, left as is' END"""


@query("run_log", "run_id:s logged_at:s snapshot_date:s step:s rule:s target:s rows_affected:i", f"""
  SELECT 'run-1' AS run_id, '2026-01-01T00:00:00' AS logged_at, l.* FROM ({NULLS_SQL}
  UNION ALL SELECT CAST(batch AS VARCHAR), 'clean', 'Q1', 'ccn', COUNT(*) FROM fx_raw GROUP BY batch
  UNION ALL SELECT CAST(batch AS VARCHAR), 'clean', 'Q6', 'date_text', present - GREATEST(h0, h1, h2, h3, h4)
    FROM (SELECT batch, COUNT(NULLIF(trim(date_text), '')) AS present, {HITS} FROM fx_raw GROUP BY batch) h
  UNION ALL SELECT CAST(batch AS VARCHAR), 'clean', 'Q8', 'drifting_pct', COUNT(drifting_pct) FROM fx_raw GROUP BY batch) l""")
def run_log(f):
    """Null, key, date and unit entries of every batch, as one run writes them."""
    by, raw = ["batch"], f.raw
    known = raw.groupBy("batch").agg(F.count("drifting_pct").alias("known"))
    parts = [
        runlog.log_nulls(runlog.null_report(raw, FIELDS, by), "batch"),
        runlog.log_key_quality(runlog.key_quality(
            raw.withColumn("ccn", clean.normalize_id("id_text")), "ccn", by), "batch"),
        runlog.log_date_votes(votes.date_votes(raw, "date_text", by), "batch", "date_text"),
        runlog.log_unit_drift(votes.unit_medians(raw, "drifting_pct", by), known, "batch", "drifting_pct"),
    ]
    return runlog.run_log(parts, "run-1", "2026-01-01T00:00:00")


LOG_SQL = """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, strftime(ts, '%H') AS snapshot_date,
  CASE event_type WHEN 'error' THEN 'load' ELSE 'clean' END AS step, concat(CASE WHEN user_id % 3 = 0 THEN 'fk_' ELSE 'Q' END, CAST(user_id % 8 AS VARCHAR)) AS rule,
  event_type AS target, CAST(floor(value) AS BIGINT) % 40 AS rows_affected, CAST(event_id AS VARCHAR) AS detail FROM events"""


def _events_log(f):
    user = F.col("user_id")
    return f.table("events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"), F.date_format("ts", "HH").alias("snapshot_date"),
        F.when(F.col("event_type") == "error", "load").otherwise("clean").alias("step"),
        F.concat(F.when(user % 3 == 0, "fk_").otherwise("Q"), (user % 8).cast("string")).alias("rule"),
        F.col("event_type").alias("target"), (F.floor("value") % 40).alias("rows_affected"),
        F.col("event_id").cast("string").alias("detail"))


@query("quality_log", "rule:s step:s snapshot_date:s target:s rows_affected:i detail:s", f"""
  SELECT rule, step, snapshot_date, target, rows_affected, detail FROM ({LOG_SQL}) l
  WHERE run_id = (SELECT MAX(run_id) FROM ({LOG_SQL}) m) AND rule LIKE 'Q%'
  ORDER BY rule, snapshot_date, step, target, detail, rows_affected""")
def quality_log(f):
    return runlog.quality_log(_events_log(f))


@query("quality_rollup", "rule:s step:s entries:i rows_affected:i", f"""
  SELECT rule, step, COUNT(*) AS entries, SUM(rows_affected) AS rows_affected FROM ({LOG_SQL}) l
  WHERE rule LIKE 'Q%' AND rows_affected > 0 GROUP BY rule, step""")
def quality_rollup(f):
    return runlog.quality_rollup(_events_log(f))
