"""Dimensions, facts, versions, as-of lookups and the window dedup."""

import uuid

from pyspark.sql import functions as F

from tidemark.functions import clean
from tidemark.operators import dedup, increments
from tidemark.operators.ordering import dense_key as number_rows
from tidemark.operators.versions import asof_lookup, scd2_build
from tidemark.operators.lookups import join_unique
from tidemark.plans import checks, dimensions, facts, publish, runlog, semantic
from tidemark.session import scratch_path, stored
from workload.ctes import squeezed
from workload.frames import SIGHTING
from workload.registry import query

CALENDAR = "date_key:i full_date:d year:i quarter:i month:i month_name_th:s year_month:s us_fiscal_year:i covid_period:s"


@query("dim_date", f"{CALENDAR} orders:i", """
  SELECT d.*, COUNT(*) AS orders FROM fx_dim_date d JOIN orders o ON CAST(o.o_orderdate AS DATE) = d.full_date GROUP BY ALL""")
def dim_date(f):
    """Calendar rows of every order date, with the orders of that day."""
    days = f.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("orders"))
    return dimensions.calendar_of(days, "day", dimensions.dim_date(f.spark))


@query("dim_scd1_latest", "geography_key:i zip_code:s city:s county_parish:s state_code:s state_name:s census_region:s "
       "urban_rural:s latitude:f longitude:f", "SELECT * FROM fx_dim_geography")
def dim_geography(f):
    return f.dims["dim_geography"]


@query("dim_distinct", "ownership_key:i ownership_type:s ownership_group:s is_for_profit:b", "SELECT * FROM fx_dim_ownership")
def dim_ownership(f):
    return f.dims["dim_ownership"]


@query("dim_chain", "chain_key:i chain_id:s chain_name:s num_facilities_in_chain:i chain_size_band:s is_independent:b",
       "SELECT * FROM fx_dim_chain")
def dim_chain(f):
    return f.dims["dim_chain"]


@query("dim_penalty_type", "penalty_type_key:i penalty_type:s is_monetary:b", "SELECT * FROM fx_dim_penalty_type")
def dim_penalty_type(f):
    return f.dims["dim_penalty_type"]


@query("dim_facility", "facility_key:i ccn:s provider_name:s legal_business_name:s provider_type:s resides_in_hospital:b "
       "ccrc_flag:b special_focus_status:s abuse_icon:b bed_size_band:s effective_date:d expiry_date:d is_current:b",
       "SELECT * FROM fx_dim_facility")
def dim_facility(f):
    return f.dims["dim_facility"]


@query("scd2_build", "ccn:s size_band:s focus:s icon:b effective_date:d expiry_date:d is_current:b",
       "SELECT * FROM fx_attrs_versions")
def scd2(f):
    return scd2_build(f.attrs, "ccn", "period", ["size_band", "focus", "icon"])


@query("scd2_merge", "ccn:s size_band:s focus:s icon:b effective_date:d expiry_date:d is_current:b", "SELECT * FROM fx_attrs_versions")
def scd2_merge(f):
    """The same versions, built from three stretches of periods that are merged one after the other."""
    tracked = ["size_band", "focus", "icon"]
    stretches = between(f.attrs, "period", ["1995-01-01", "1998-01-01"])
    first = scd2_build(stretches[0], "ccn", "period", tracked)
    versions = stored(number_rows(first, ["ccn", "effective_date"], "version_key"), "versions")
    for newer in stretches[1:]:
        versions = stored(increments.scd2_merge(versions, newer, "ccn", "period", tracked, "version_key"), "versions")
    return versions


def between(frame, column, cuts):
    """Rows before the first cut, between the cuts, and from the last on."""
    edges = [None, *cuts, None]
    return [frame.where((F.lit(True) if a is None else F.col(column) >= a) & (F.lit(True) if b is None else F.col(column) < b))
            for a, b in zip(edges[:-1], edges[1:])]


@query("dense_key", "key:i o_orderdate:d o_orderkey:i",
       "SELECT ROW_NUMBER() OVER (ORDER BY o_orderdate, o_orderkey) AS key, o_orderdate, o_orderkey FROM orders")
def dense_key(f):
    """Keys in order over all orders, through the sliced path that no single task sorts alone."""
    orders = f.table("orders").select("o_orderdate", "o_orderkey")
    return number_rows(orders, ["o_orderdate", "o_orderkey"], "key", limit=2_000)


def _versions(f):
    versions = scd2_build(f.attrs, "ccn", "period", ["size_band", "focus", "icon"])
    return number_rows(versions, ["ccn", "effective_date"], "version_key")


def _asked(f):
    """Questions about versions: every line, some before the first sighting, some unknown."""
    key = F.col("l_suppkey") + F.when(F.col("l_orderkey") % 19 == 0, 500_000).otherwise(0)
    return f.table("lineitem").select(
        F.lpad(key.cast("string"), 6, "0").alias("ccn"),
        F.date_sub(F.col("l_shipdate").cast("date"), F.when(F.col("l_orderkey") % 7 == 0, 400).otherwise(0)).alias("asked"))


@query("asof_lookup", "ccn:s asked:d version_key:i status:s facts:i", """
  SELECT ccn, asked, COALESCE(version_key, first_key, -1) AS version_key,
         CASE WHEN version_key IS NOT NULL THEN 'match' WHEN first_key IS NOT NULL THEN 'clamped' ELSE 'missing' END AS status,
         COUNT(*) AS facts
  FROM (SELECT a.ccn, a.asked, v.version_key, e.first_key
        FROM (SELECT lpad(CAST(l_suppkey + CASE WHEN l_orderkey % 19 = 0 THEN 500000 ELSE 0 END AS VARCHAR), 6, '0') AS ccn,
                     CAST(l_shipdate AS DATE) - CASE WHEN l_orderkey % 7 = 0 THEN 400 ELSE 0 END AS asked
              FROM lineitem) a
        LEFT JOIN fx_numbered v ON v.ccn = a.ccn AND v.effective_date <= a.asked AND (v.expiry_date IS NULL OR a.asked < v.expiry_date)
        LEFT JOIN (SELECT ccn, MIN(version_key) AS first_key FROM fx_numbered GROUP BY ccn) e ON e.ccn = a.ccn) x
  GROUP BY ALL""".replace("fx_numbered", "(SELECT *, ROW_NUMBER() OVER (ORDER BY ccn, effective_date) AS version_key FROM fx_attrs_versions)"),
       recursive=True)
def asof(f):
    found = asof_lookup(_asked(f), _versions(f), "ccn", "asked", "version_key", status="status")
    return found.groupBy("ccn", "asked", "version_key", "status").agg(F.count("*").alias("facts"))


@query("asof_report", "status:s facts:i", """
  SELECT CASE WHEN version_key IS NOT NULL THEN 'match' WHEN first_key IS NOT NULL THEN 'clamped' ELSE 'missing' END AS status,
         COUNT(*) AS facts
  FROM (SELECT v.period AS version_key, e.first_key
        FROM (SELECT lpad(CAST(l_suppkey + CASE WHEN l_orderkey % 19 = 0 THEN 500000 ELSE 0 END AS VARCHAR), 6, '0') AS ccn,
                     CAST(l_shipdate AS DATE) - CASE WHEN l_orderkey % 7 = 0 THEN 400 ELSE 0 END AS asked
              FROM lineitem) a
        LEFT JOIN (SELECT ccn, MIN(period) AS first_key FROM fx_attrs GROUP BY ccn) e ON e.ccn = a.ccn
        LEFT JOIN (SELECT ccn, MIN(period) AS period FROM fx_attrs GROUP BY ccn) v ON v.ccn = a.ccn AND v.period <= a.asked) x
  GROUP BY 1""")
def asof_report(f):
    found = asof_lookup(_asked(f), _versions(f), "ccn", "asked", "version_key", status="status")
    return found.groupBy("status").agg(F.count("*").alias("facts"))


@query("dim_lookup", "processing_date:d ccn:s source_row:i geography_key:i ownership_key:i", f"""
  SELECT p.processing_date, p.ccn, p.source_row, COALESCE(g.geography_key, -1) AS geography_key, COALESCE(o.ownership_key, -1) AS ownership_key
  FROM (SELECT *, CASE WHEN source_row % 10 = 3 THEN 'elsewhere' ELSE city END AS place FROM fx_provider) p
  LEFT JOIN fx_dim_geography g ON g.zip_code = lpad(substr(trim(p.zip_code), 1, 5), 5, '0')
    AND g.city = upper({squeezed('p.place')}) AND g.state_code = upper({squeezed('p.state_code')})
  LEFT JOIN fx_dim_ownership o ON o.ownership_type = {squeezed('p.ownership_type')}""")
def dim_lookup(f):
    moved = f.provider.withColumn("city", F.when(F.col("source_row") % 10 == 3, "elsewhere").otherwise(F.col("city")))
    keyed = facts.with_geography_key(moved, f.dims["dim_geography"])
    return facts.with_ownership_key(keyed, f.dims["dim_ownership"])


@query("tri_state_lookup", "processing_date:d ccn:s source_row:i chain_key:i", f"""
  SELECT p.processing_date, p.ccn, p.source_row, CASE WHEN NOT has_chain THEN -1 WHEN {squeezed('p.chain_name')} IS NULL THEN 0
         ELSE COALESCE(c.chain_key, -1) END AS chain_key
  FROM fx_provider p
  JOIN (SELECT processing_date, COUNT(chain_name) > 0 AS has_chain FROM fx_provider GROUP BY 1) q ON q.processing_date = p.processing_date
  LEFT JOIN fx_dim_chain c ON c.chain_name = upper({squeezed('p.chain_name')})""")
def tri_state_lookup(f):
    return facts.with_chain_key(f.provider, f.dims["dim_chain"])


FACT1 = ("snapshot_date_key:i facility_key:i geography_key:i ownership_key:i chain_key:i ccn:s certified_beds:i "
         "avg_residents_per_day:f resident_days:f reported_total_nurse_hprd:f reported_rn_hprd:f "
         "total_nursing_turnover_pct:f overall_rating:i staffing_rating:i health_inspection_rating:i "
         "cycle1_total_deficiencies:i is_suspect:b")


@query("published_snapshot", FACT1, """
  SELECT * REPLACE (CASE WHEN total_nursing_turnover_pct > 200 THEN 0 ELSE total_nursing_turnover_pct END AS total_nursing_turnover_pct)
  FROM fx_fact_snapshot""")
def published_snapshot(f):
    """The snapshot fact as readers see it after a build from text with quoted line breaks."""
    return publish.read_table(f.spark, f.published, "fact_snapshot")


@query("published_ownership", "ownership_key:i ownership_type:s ownership_group:s is_for_profit:b", "SELECT * FROM fx_dim_ownership")
def published_ownership(f):
    """A dimension read back with its stored keys from that build."""
    return publish.read_table(f.spark, f.published, "dim_ownership")


@query("gate_refuses_release", "rule:s target:s violations:i followed:s", """
  SELECT 'turnover_is_percent' AS rule, 'fact_snapshot' AS target, COUNT(*) AS violations, 'run-1' AS followed
  FROM fx_fact_snapshot WHERE total_nursing_turnover_pct > 200""")
def gate_refuses_release(f):
    """A release with impossible turnover is logged and refused: readers stay on the one before."""
    root, run = f.published, f"bad-{uuid.uuid4().hex}"
    try:
        publish.publish(f.spark, {**f.dims, "fact_snapshot": f.fact_snapshot}, root, run, "2026-01-02T00:00:00")
    except checks.GateClosed:
        pass
    followed = publish.current_release(f.spark, root).rsplit("/", 1)[-1]
    log = f.spark.read.parquet(f"{root}/run_log")
    return log.filter((F.col("run_id") == run) & (F.col("rows_affected") > 0)).select(
        "rule", "target", F.col("rows_affected").alias("violations"), F.lit(followed).alias("followed"))


SEEN = ("snapshot_date_key:i ccn:s certified_beds:i avg_residents_per_day:f resident_days:f overall_rating:i is_suspect:b "
        "provider_name:s bed_size_band:s effective_date:d zip_code:s city:s county_parish:s latitude:f ownership_type:s chain_name:s chain_id:s")


@query("incremental_build", SEEN, """
  SELECT f.*, d.provider_name, d.bed_size_band, d.effective_date, g.zip_code, g.city, g.county_parish, g.latitude, o.ownership_type, c.chain_name, c.chain_id
  FROM fx_fact_snapshot f JOIN fx_dim_facility d USING (facility_key) JOIN fx_dim_geography g USING (geography_key)
  JOIN fx_dim_ownership o USING (ownership_key) JOIN fx_dim_chain c USING (chain_key)""")
def incremental_build(f):
    """What readers see after the periods were merged in three goes: keys are other numbers, all else is as in one build."""
    read = lambda name: publish.read_table(f.spark, f.grown, name)
    rows = read("fact_snapshot")
    for dim, key in (("dim_facility", "facility_key"), ("dim_geography", "geography_key"), ("dim_ownership", "ownership_key"), ("dim_chain", "chain_key")):
        table = read(dim)
        rows = rows.join(table.drop("ccn"), key)
    return rows


@query("incremental_events", "penalty_date_key:i ccn:s penalty_type:s fine_id:s fine_id_source:s fine_amount_usd:i payment_denial_days:i "
       "effective_date:d ownership_type:s", """
  SELECT f.*, t.penalty_type, d.effective_date, o.ownership_type FROM fx_fact_penalty f JOIN fx_dim_penalty_type t USING (penalty_type_key)
  JOIN fx_dim_facility d USING (facility_key) JOIN fx_dim_ownership o USING (ownership_key)""")
def incremental_events(f):
    """The penalty fact of that warehouse, from an identity index upserted three times."""
    read = lambda name: publish.read_table(f.spark, f.grown, name)
    rows = read("fact_penalty")
    for dim, key in (("dim_facility", "facility_key"), ("dim_penalty_type", "penalty_type_key"), ("dim_ownership", "ownership_key")):
        rows = rows.join(read(dim).drop("ccn"), key)
    return rows


@query("publish_race", "run:s built:i followed:i refused:b", """
  SELECT run, CASE run WHEN 'first' THEN n ELSE profit END AS built, CASE run WHEN 'third' THEN profit ELSE n END AS followed, run = 'second' AS refused
  FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE is_for_profit) AS profit FROM fx_dim_ownership) d, (VALUES ('first'), ('second'), ('third')) AS r(run)""")
def publish_race(f):
    """Two builds start from one generation: the second is refused and may start again from what the first published."""
    root, table = scratch_path(f.spark, "race"), f.dims["dim_ownership"]
    base, rows = publish.generation(f.spark, root), []
    for run, frame, start in (("first", table, base), ("second", table.where("is_for_profit"), base), ("third", table.where("is_for_profit"), None)):
        try:
            publish.publish(f.spark, {"dim_ownership": frame}, root, run, "2026-01-01T00:00:00", base=start)
            refused = False
        except publish.StaleRelease:
            refused = True
        built = f.spark.read.parquet(f"{root}/releases/{run}/dim_ownership").count()
        rows.append((run, built, publish.read_table(f.spark, root, "dim_ownership").count(), refused))
    return f.spark.createDataFrame(rows, "run string, built long, followed long, refused boolean")


@query("stale_release_refused", "target:s key_version:s fact_rows:i stale:b refused:b", """
  SELECT 'fact_snapshot' AS target, 'old' AS key_version, COUNT(*) AS fact_rows, TRUE AS stale, TRUE AS refused FROM fx_fact_snapshot
  UNION ALL SELECT 'fact_penalty', 'old', COUNT(*), TRUE, TRUE FROM fx_fact_penalty""")
def stale_release_refused(f):
    """A release with dimensions numbered again beside facts of the old numbering: readers are refused the facts."""
    root = scratch_path(f.spark, "mixed")
    clean_ = f.fact_snapshot.withColumn("total_nursing_turnover_pct", F.least("total_nursing_turnover_pct", F.lit(200.0)))
    publish.publish(f.spark, {**f.dims, "fact_snapshot": clean_, "fact_penalty": f.fact_penalty}, root, "old", "2026-01-01T00:00:00")
    publish.publish(f.spark, f.dims, root, "new", "2026-01-02T00:00:00", inherit=True)
    refused = []
    for name in ("fact_snapshot", "fact_penalty"):
        try:
            publish.read_table(f.spark, root, name)
        except publish.StaleKeys:
            refused.append(name)
    return publish.key_versions(f.spark, root).withColumn("refused", F.col("target").isin(refused))


@query("calendar_check", "first_day:d last_day:d days:i missing_days:i leap_days:i", """
  SELECT MIN(d) AS first_day, MAX(d) AS last_day, COUNT(*) AS days, date_diff('day', MIN(d), MAX(d)) + 1 - COUNT(*) AS missing_days,
         COUNT(*) FILTER (WHERE month(d) = 2 AND day(d) = 29) AS leap_days
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) x""")
def calendar_check(f):
    """Span, gaps and leap days of the calendar rows that orders refer to."""
    days = f.table("orders").select(clean.date_key(F.col("o_orderdate").cast("date")).alias("date_key")).distinct()
    return checks.calendar_check(join_unique(dimensions.dim_date(f.spark), days, "date_key", "left_semi"))


@query("published_log", "rule:s logged:b", " UNION ALL ".join(f"SELECT 'Q{k}' AS rule, TRUE AS logged" for k in range(1, 9)))
def published_log(f):
    """Which cleaning rules the log of that build holds."""
    log = runlog.quality_log(f.spark.read.parquet(f"{f.published}/run_log"))
    return log.groupBy("rule").agg(F.count("*").alias("n")).select("rule", (F.col("n") > 0).alias("logged"))


@query("fact_snapshot", FACT1, "SELECT * FROM fx_fact_snapshot")
def fact_snapshot(f):
    return f.fact_snapshot_rows


FACT2 = ("penalty_event_key:i penalty_date_key:i facility_key:i geography_key:i ownership_key:i chain_key:i "
         "penalty_type_key:i ccn:s fine_id:s fine_id_source:s fine_amount_usd:i payment_denial_days:i penalty_count:i")


@query("fact_penalty", FACT2, "SELECT * FROM fx_fact_penalty")
def fact_penalty(f):
    return f.fact_penalty_rows


EVENT = ("stamp:d ccn:s penalty_date:d penalty_type:s fine_id:s fine_id_source:s fine_amount_usd:i "
         "payment_denial_days:i natural_key:s identity:s sightings:i l_orderkey:i l_linenumber:i l_partkey:i cents:i")


@query("window_dedup", EVENT, "SELECT * FROM fx_event")
def window_dedup(f):
    return dedup.window_dedup(f.sighting, SIGHTING)


@query("window_dedup_merge", EVENT, "SELECT * FROM fx_event")
def window_dedup_merge(f):
    """The same events, from an identity index that three stretches of periods are merged into."""
    first, *rest = [increments.event_index(part, SIGHTING) for part in between(f.staged_sighting, "stamp", ["1997-01-01", "2000-04-01"])]
    index = stored(first, "event-index")
    events = stored(number_rows(increments.events_of(index, SIGHTING), ["identity", "fine_id_source"], "event_key"), "events")
    for part in rest:
        newer = stored(part, "event-index")
        after = stored(increments.merged_index(index, newer, SIGHTING), "event-index")
        events = stored(increments.upserted_events(events, index, after, newer, c=SIGHTING), "events")
        index = after
    return events


@query("dedup_report", "rows_before:i events_after:i repeats:i natural_keys:i collapsed_by_id:i backfilled_ids:i "
       "events_by_id:i events_by_natural_key:i repeat_share:f", """
  SELECT *, rows_before - events_after AS repeats, natural_keys - events_after AS collapsed_by_id,
         (rows_before - events_after) / CAST(rows_before AS DOUBLE) AS repeat_share
  FROM (SELECT COUNT(*) AS rows_before, COUNT(DISTINCT identity) AS events_after, COUNT(DISTINCT natural_key) AS natural_keys,
               COUNT(*) FILTER (WHERE fine_id IS NOT NULL AND reported_id IS NULL) AS backfilled_ids,
               COUNT(DISTINCT CASE WHEN fine_id IS NOT NULL THEN identity END) AS events_by_id,
               COUNT(DISTINCT CASE WHEN fine_id IS NULL THEN identity END) AS events_by_natural_key
        FROM fx_filled) x""")
def dedup_report(f):
    return dedup.dedup_report(f.sighting, SIGHTING)


@query("key_audit", "keys_audited:i ids_audited:i keys_with_many_ids:i ids_with_many_keys:i orphan_events:i orphan_money:i", """
  SELECT (SELECT COUNT(*) FROM (SELECT natural_key FROM fx_filled WHERE fine_id IS NOT NULL GROUP BY 1) a) AS keys_audited,
         (SELECT COUNT(*) FROM (SELECT fine_id FROM fx_filled WHERE fine_id IS NOT NULL GROUP BY 1) a) AS ids_audited,
         (SELECT COUNT(*) FROM (SELECT natural_key FROM fx_filled WHERE fine_id IS NOT NULL GROUP BY 1 HAVING COUNT(DISTINCT fine_id) > 1) a) AS keys_with_many_ids,
         (SELECT COUNT(*) FROM (SELECT fine_id FROM fx_filled WHERE fine_id IS NOT NULL GROUP BY 1 HAVING COUNT(DISTINCT natural_key) > 1) a) AS ids_with_many_keys,
         COUNT(*) AS orphan_events, COALESCE(SUM(fine_amount_usd), 0) AS orphan_money
  FROM (SELECT natural_key, fine_amount_usd, ROW_NUMBER() OVER (PARTITION BY natural_key
               ORDER BY stamp, ccn, penalty_date, l_orderkey, l_linenumber, l_partkey, cents) AS nr
        FROM (SELECT *, COUNT(fine_id) OVER (PARTITION BY ccn, penalty_date, penalty_type, fine_amount_usd) AS siblings
              FROM fx_filled) s WHERE fine_id IS NULL AND siblings > 0) o WHERE nr = 1""")
def key_audit(f):
    return dedup.key_audit(f.sighting, SIGHTING)


@query("v_facility_monthly", "snapshot_date_key:i snapshot_date:d snapshot_year:i snapshot_quarter:i snapshot_year_month:s "
       "snapshot_month_th:s covid_period:s ccn:s provider_name:s provider_type:s bed_size_band:s special_focus_status:s "
       "abuse_icon:b state_code:s state_name:s census_region:s county_parish:s city:s zip_code:s urban_rural:s latitude:f "
       "longitude:f ownership_type:s ownership_group:s is_for_profit:b chain_name:s chain_size_band:s is_independent:b "
       "certified_beds:i avg_residents_per_day:f resident_days:f reported_total_nurse_hprd:f total_nursing_turnover_pct:f "
       "overall_rating:i is_suspect:b", """
  SELECT d.full_date AS snapshot_date, d.year AS snapshot_year, d.quarter AS snapshot_quarter, d.year_month AS snapshot_year_month,
         d.month_name_th AS snapshot_month_th, d.covid_period, fa.provider_name, fa.provider_type, fa.bed_size_band,
         fa.special_focus_status, fa.abuse_icon, g.* EXCLUDE (geography_key), o.* EXCLUDE (ownership_key),
         c.chain_name, c.chain_size_band, c.is_independent, f.*
  FROM fx_fact_snapshot f JOIN fx_dim_date d ON d.date_key = f.snapshot_date_key
  JOIN fx_dim_facility fa ON fa.facility_key = f.facility_key JOIN fx_dim_geography g ON g.geography_key = f.geography_key
  JOIN fx_dim_ownership o ON o.ownership_key = f.ownership_key JOIN fx_dim_chain c ON c.chain_key = f.chain_key""")
def v_facility_monthly(f):
    return semantic.facility_view(f.fact_snapshot, f.dims)


@query("v_penalty_event", "penalty_event_key:i penalty_date:d penalty_year:i penalty_quarter:i penalty_year_month:s "
       "us_fiscal_year:i covid_period:s ccn:s provider_name:s bed_size_band:s state_code:s state_name:s census_region:s "
       "ownership_group:s chain_name:s chain_size_band:s penalty_type:s is_monetary:b fine_id:s fine_id_source:s "
       "fine_amount_usd:i payment_denial_days:i penalty_count:i", """
  SELECT f.*, d.full_date AS penalty_date, d.year AS penalty_year, d.quarter AS penalty_quarter, d.year_month AS penalty_year_month,
         d.us_fiscal_year, d.covid_period, fa.provider_name, fa.bed_size_band, g.state_code, g.state_name, g.census_region,
         o.ownership_group, c.chain_name, c.chain_size_band, t.penalty_type, t.is_monetary
  FROM fx_fact_penalty f JOIN fx_dim_date d ON d.date_key = f.penalty_date_key
  JOIN fx_dim_facility fa ON fa.facility_key = f.facility_key JOIN fx_dim_geography g ON g.geography_key = f.geography_key
  JOIN fx_dim_ownership o ON o.ownership_key = f.ownership_key JOIN fx_dim_chain c ON c.chain_key = f.chain_key
  JOIN fx_dim_penalty_type t ON t.penalty_type_key = f.penalty_type_key""")
def v_penalty_event(f):
    return semantic.penalty_view(f.fact_penalty, f.dims)
