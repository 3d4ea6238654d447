"""Cleaning rules over the dirty text derived from orders."""

from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.functions import bands, clean
from tidemark.operators import votes
from tidemark.operators.ordering import first_per_key
from tidemark.plans import runlog
from workload.ctes import bed_band, case, chain_band, number, squeezed, yes_no
from workload.registry import query

PADDED = "CASE WHEN length(trim(id_text)) >= 6 THEN trim(id_text) ELSE lpad(trim(id_text), 6, '0') END"


@query("normalize_id", "source_row:i ccn:s", f"SELECT source_row, {PADDED} AS ccn FROM fx_raw")
def normalize_id(f):
    return f.raw.select("source_row", clean.normalize_id("id_text").alias("ccn"))


@query("normalize_zip", "source_row:i zip_code:s",
       "SELECT source_row, lpad(substr(trim(id_text), 1, 5), 5, '0') AS zip_code FROM fx_raw")
def normalize_zip(f):
    return f.raw.select("source_row", clean.normalize_zip("id_text").alias("zip_code"))


@query("normalize_text", "source_row:i label:s label_upper:s",
       f"SELECT source_row, {squeezed('label_text')} AS label, upper({squeezed('label_text')}) AS label_upper FROM fx_raw")
def normalize_text(f):
    return f.raw.select("source_row", clean.normalize_text("label_text").alias("label"),
                        clean.normalize_text("label_text", upper=True).alias("label_upper"))


@query("to_number", "source_row:i value:f", f"SELECT source_row, {number('number_text')} AS value FROM fx_raw")
def to_number(f):
    return f.raw.select("source_row", clean.to_number("number_text").alias("value"))


@query("normalize_yes_no", "source_row:i flag:b", f"SELECT source_row, {yes_no('flag_text')} AS flag FROM fx_raw")
def normalize_yes_no(f):
    return f.raw.select("source_row", clean.normalize_yes_no("flag_text").alias("flag"))


@query("normalize_flag_domain", "batch:i source_row:i status:s", """
  SELECT r.batch, source_row, CASE WHEN has_column THEN COALESCE(m, 'None') ELSE m END AS status
  FROM (SELECT batch, source_row, CASE trim(flag_text) WHEN 'Y' THEN 'SFF' WHEN 'N' THEN 'None' WHEN '' THEN NULL
               ELSE trim(flag_text) END AS m FROM fx_raw) r
  JOIN (SELECT batch, COUNT(flag_text) > 0 AS has_column FROM fx_raw GROUP BY batch) q ON q.batch = r.batch""")
def normalize_flag_domain(f):
    return votes.normalize_flag_domain(f.raw, "flag_text", "status", ["batch"])


FORMATS = ["%Y-%m-%d", "%m/%d/%Y", "%d/%m/%Y", "%Y/%m/%d", "%m-%d-%Y"]
HITS = ", ".join(f"COUNT(TRY_STRPTIME(date_text, '{p}')) AS h{i}" for i, p in enumerate(FORMATS))
BEST = "CASE " + " ".join(f"WHEN h{i} = GREATEST(h0, h1, h2, h3, h4) THEN {i}" for i in range(5)) + " END"
PARSED = "CASE best " + " ".join(
    f"WHEN {i} THEN CAST(TRY_STRPTIME(date_text, '{p}') AS DATE)" for i, p in enumerate(FORMATS)) + " END"


@query("parse_date_vote", "batch:i source_row:i parsed:d", f"""
  SELECT r.batch, source_row, {PARSED} AS parsed
  FROM fx_raw r JOIN (SELECT batch, {BEST} AS best FROM (SELECT batch, {HITS} FROM fx_raw GROUP BY batch) h) b
    ON b.batch = r.batch""")
def parse_date_vote(f):
    return votes.parse_date_vote(f.raw, "date_text", "parsed", ["batch"])


@query("date_votes", "batch:i present:i hits:i format_index:i unparsed:i", f"""
  SELECT batch, present, GREATEST(h0, h1, h2, h3, h4) AS hits, {BEST} AS format_index,
         present - GREATEST(h0, h1, h2, h3, h4) AS unparsed
  FROM (SELECT batch, COUNT(NULLIF(trim(date_text), '')) AS present, {HITS} FROM fx_raw GROUP BY batch) h""")
def date_votes(f):
    return votes.date_votes(f.raw, "date_text", ["batch"])


@query("map_category", "priority:s grp:s is_urgent:b orders:i", """
  SELECT priority, grp, grp = 'Urgent' AS is_urgent, COUNT(*) AS orders
  FROM (SELECT o_orderpriority AS priority, CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'Urgent'
               WHEN '3-MEDIUM' THEN 'Normal' WHEN '5-LOW' THEN 'Normal' ELSE 'Unknown' END AS grp FROM orders) o
  GROUP BY priority, grp""")
def map_category(f):
    groups = {"1-URGENT": "Urgent", "2-HIGH": "Urgent", "3-MEDIUM": "Normal", "5-LOW": "Normal"}
    mapped = f.table("orders").select(F.col("o_orderpriority").alias("priority")).withColumn(
        "grp", clean.map_category(F.col("priority"), groups, V.UNKNOWN_LABEL))
    return mapped.groupBy("priority", "grp", (F.col("grp") == "Urgent").alias("is_urgent")).agg(
        F.count("*").alias("orders"))


@query("ownership_groups", "ownership_type:s ownership_group:s is_for_profit:b rows:i", f"""
  SELECT ownership_type, grp AS ownership_group, grp = 'For profit' AS is_for_profit, COUNT(*) AS rows
  FROM (SELECT ownership_type, {case('ownership_type', V.OWNERSHIP_GROUPS, "'Unknown'")} AS grp
        FROM (SELECT {squeezed('ownership_type')} AS ownership_type FROM fx_provider) t) o GROUP BY ALL""")
def ownership_groups(f):
    named = f.provider.select(clean.normalize_text("ownership_type").alias("ownership_type"))
    grouped = named.withColumn("ownership_group", clean.ownership_group(F.col("ownership_type")))
    return grouped.groupBy("ownership_type", "ownership_group").agg(F.count("*").alias("rows")).withColumn(
        "is_for_profit", F.col("ownership_group") == V.FOR_PROFIT)


FIELDS = ["number_text", "flag_text", "drifting_pct", "id_text"]


@query("null_report", "batch:i rows:i field:s nulls:i share:f", " UNION ALL ".join(
    f"SELECT batch, COUNT(*) AS rows, '{c}' AS field, COUNT(*) - COUNT({c}) AS nulls, "
    f"(COUNT(*) - COUNT({c})) / CAST(COUNT(*) AS DOUBLE) AS share FROM fx_raw GROUP BY batch" for c in FIELDS))
def null_report(f):
    return runlog.null_report(f.raw, FIELDS, ["batch"])


@query("key_quality", "batch:i rows:i wrong_width:i duplicates:i", f"""
  SELECT batch, COUNT(*) AS rows, COUNT(*) FILTER (WHERE length(ccn) <> 6) AS wrong_width,
         COUNT(*) - COUNT(DISTINCT ccn) AS duplicates
  FROM (SELECT batch, {PADDED} AS ccn FROM fx_raw) k GROUP BY batch""")
def key_quality(f):
    return runlog.key_quality(f.raw.withColumn("ccn", clean.normalize_id("id_text")), "ccn", ["batch"])


@query("fix_unit_drift", "batch:i source_row:i pct:f", """
  SELECT r.batch, source_row, CASE WHEN m.median < 1.5 THEN drifting_pct * 100 ELSE drifting_pct END AS pct
  FROM fx_raw r JOIN (SELECT batch, quantile_cont(drifting_pct, 0.5) AS median FROM fx_raw GROUP BY batch) m
    ON m.batch = r.batch""")
def fix_unit_drift(f):
    return votes.fix_unit_drift(f.raw, "drifting_pct", "pct", ["batch"])


SUSPECT = """COALESCE(residents * 1.0 / NULLIF(CASE WHEN beds > 0 THEN beds END, 0) > 1.2
  OR residents * 1.0 / NULLIF(CASE WHEN beds > 0 THEN beds END, 0) < 0, FALSE)"""


@query("flag_suspect", "period:d occupancy:i beds:i turnover:i flagged:i", f"""
  SELECT period, SUM(CASE WHEN o THEN 1 ELSE 0 END) AS occupancy, SUM(CASE WHEN b THEN 1 ELSE 0 END) AS beds,
         SUM(CASE WHEN t THEN 1 ELSE 0 END) AS turnover, SUM(CASE WHEN o OR b OR t THEN 1 ELSE 0 END) AS flagged
  FROM (SELECT period, {SUSPECT} AS o, beds <= 0 AS b, COALESCE(turnover <= 0 OR turnover > 200, FALSE) AS t
        FROM (SELECT period, beds - 500 AS beds, residents - 100 AS residents, turnover_pct * 4 AS turnover FROM fx_panel) p) q
  GROUP BY period""")
def flag_suspect(f):
    rows = f.panel.select("period", (F.col("beds") - 500).alias("certified_beds"),
                          (F.col("residents") - 100).alias("avg_residents_per_day"),
                          (F.col("turnover_pct") * 4).alias("total_nursing_turnover_pct"))
    per_reason = runlog.suspect_report(rows, ["period"])
    wide = per_reason.groupBy("period").pivot("reason", ["occupancy", "beds", "turnover"]).agg(F.sum("rows"))
    flagged = rows.groupBy("period").agg(F.count(F.when(clean.is_suspect(), 1)).alias("flagged"))
    return wide.join(flagged, "period")


@query("blank_impossible", "l_orderkey:i l_linenumber:i days:i blanked:i", """
  SELECT l_orderkey, l_linenumber, SUM(CASE WHEN d >= 0 THEN d END) AS days, SUM(CASE WHEN d < 0 THEN 1 ELSE 0 END) AS blanked
  FROM (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) - 10 AS d FROM lineitem) x GROUP BY 1, 2""")
def blank_impossible(f):
    days = f.table("lineitem").withColumn("d", F.col("l_quantity").cast("bigint") - 10)
    return days.groupBy("l_orderkey", "l_linenumber").agg(
        F.sum(clean.blank_impossible("d")).alias("days"), F.count(F.when(F.col("d") < 0, 1)).alias("blanked"))


@query("date_key", "source_row:i date_key:i", """
  SELECT source_row, COALESCE(year(d) * 10000 + month(d) * 100 + day(d), -1) AS date_key
  FROM (SELECT source_row, CAST(TRY_STRPTIME(date_text, '%d/%m/%Y') AS DATE) AS d FROM fx_raw) p""")
def date_key(f):
    return f.raw.select("source_row", clean.date_key(votes.parse_as(F.col("date_text"), 2)).alias("date_key"))


@query("first_per_key", "processing_date:d ccn:s source_row:i provider_name:s certified_beds:s",
       "SELECT processing_date, ccn, source_row, provider_name, certified_beds FROM fx_first_provider")
def first_of_period(f):
    return first_per_key(f.provider.select("processing_date", "ccn", "source_row", "provider_name", "certified_beds"),
                         ["processing_date", "ccn"], ["source_row"])


@query("bed_band", "band:s facilities:i",
       f"SELECT {bed_band('beds')} AS band, COUNT(*) AS facilities "
       "FROM (SELECT NULLIF(beds // 5, 100) AS beds FROM fx_panel) b GROUP BY 1")
def bed_bands(f):
    beds = F.floor(F.col("beds") / 5)
    return f.panel.select(bands.bed_band(F.when(beds != 100, beds)).alias("band")).groupBy("band").agg(
        F.count("*").alias("facilities"))


@query("chain_band", "band:s parts:i",
       f"SELECT {chain_band('n')} AS band, COUNT(*) AS parts "
       "FROM (SELECT CASE WHEN p_size % 7 <> 0 THEN p_size + p_partkey % 5 END AS n FROM part) p GROUP BY 1")
def chain_bands(f):
    size = F.when(F.col("p_size") % 7 != 0, F.col("p_size") + F.col("p_partkey") % 5)
    return f.table("part").select(bands.chain_band(size).alias("band")).groupBy("band").agg(
        F.count("*").alias("parts"))


@query("resident_days", "ccn:s period:d resident_days:i",
       "SELECT ccn, period, residents * day(last_day(period)) AS resident_days FROM fx_panel")
def resident_days(f):
    return f.panel.select("ccn", "period", (F.col("residents") * clean.days_in_month("period")).alias("resident_days"))
