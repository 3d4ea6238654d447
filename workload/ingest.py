"""Sources: files, eras, periods and the population reference."""

from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.operators.ordering import number_in_group
from tidemark.session import scratch_path
from tidemark.sources import catalog, population, text
from workload.registry import query

# a listing of files derived from orders: one path per order
FILES_SQL = """
  SELECT CAST(o_orderdate AS DATE) AS snapshot_date, o_totalprice AS price, o_orderkey AS k,
         concat('/archive/', CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '/', CASE o_orderkey % 8
           WHEN 0 THEN 'ProviderInfo_Download.csv' WHEN 1 THEN 'NH_ProviderInfo_Jun2026.csv'
           WHEN 2 THEN '._NH_ProviderInfo_Jun2026.csv' WHEN 3 THEN 'nh_penalties_jul2026.CSV'
           WHEN 4 THEN 'NH_StateUSAverages_Jun2026.csv' WHEN 5 THEN 'FY_2026_SNF_VBP_Facility_Performance.csv'
           WHEN 6 THEN 'FY_2026_SNF_VBP_Aggregate_Performance.csv' ELSE 'a1b2_Penalties_Download.csv' END) AS path
  FROM orders"""
LOGICAL_SQL = """CASE o WHEN 0 THEN 'provider_info' WHEN 1 THEN 'provider_info' WHEN 3 THEN 'penalties'
  WHEN 4 THEN 'state_averages' WHEN 5 THEN 'vbp' WHEN 7 THEN 'penalties' END"""


def files(f):
    key = F.col("o_orderkey")
    names = ["ProviderInfo_Download.csv", "NH_ProviderInfo_Jun2026.csv", "._NH_ProviderInfo_Jun2026.csv",
             "nh_penalties_jul2026.CSV", "NH_StateUSAverages_Jun2026.csv",
             "FY_2026_SNF_VBP_Facility_Performance.csv", "FY_2026_SNF_VBP_Aggregate_Performance.csv",
             "a1b2_Penalties_Download.csv"]
    name = F.array(*[F.lit(n) for n in names])[(key % 8).cast("int")]
    path = F.concat(F.lit("/archive/"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/"), name)
    return f.table("orders").select(
        path.alias("path"), key.alias("k"), F.col("o_totalprice").alias("price")).withColumn(
            "snapshot_date", catalog.period_of("path"))


@query("ingest_text_scan", "batch:i source_row:i id_text:s number_text:s date_text:s flag_text:s label_text:s", """
  SELECT batch, source_row, id_text, CASE WHEN number_text IN ('', 'n/a') THEN NULL ELSE number_text END AS number_text,
         date_text, CASE WHEN flag_text = '' THEN NULL ELSE flag_text END AS flag_text, label_text FROM fx_raw""")
def ingest_text_scan(f):
    """Write the dirty text as delimited files, then scan them as a source would."""
    folder = scratch_path(f.spark, "text")
    raw = f.raw.drop("drifting_pct")
    (raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns]).write
     .option("header", True).option("encoding", V.TEXT_ENCODING)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(folder))
    return text.ingest_text_scan(f.spark, folder)


@query("period_catalog", "snapshot_date:d",
       "SELECT DISTINCT CAST(o_orderdate AS DATE) AS snapshot_date FROM orders")
def period_catalog(f):
    return catalog.period_catalog(files(f))


@query("first_per_quarter", "year:i quarter:i snapshot_date:d", """
  SELECT year(o_orderdate) AS year, quarter(o_orderdate) AS quarter, CAST(MIN(o_orderdate) AS DATE) AS snapshot_date
  FROM orders GROUP BY 1, 2""")
def first_per_quarter(f):
    return catalog.first_per_quarter(catalog.period_catalog(files(f)))


CHOSEN_SQL = f"""
  SELECT snapshot_date, logical, arg_min(path, concat(name, path)) AS path, COUNT(*) AS candidates
  FROM (SELECT *, regexp_extract(path, '[^/]+$') AS name, {LOGICAL_SQL.replace('CASE o', 'CASE k % 8')} AS logical
        FROM ({FILES_SQL}) f) c
  WHERE logical IS NOT NULL GROUP BY snapshot_date, logical"""


@query("classify_files", "snapshot_date:d logical:s path:s candidates:i", CHOSEN_SQL)
def classify_files(f):
    return catalog.classify_files(files(f))


@query("catalog_of_kind", "snapshot_date:d path:s candidates:i", f"SELECT * EXCLUDE logical FROM ({CHOSEN_SQL}) c WHERE logical = 'penalties'")
def catalog_of_kind(f):
    """The files of one kind, in order of their periods."""
    return catalog.of_kind(catalog.classify_files(files(f)), "penalties", "logical").orderBy("snapshot_date")


@query("only_periods", "snapshot_date:d path:s k:i", f"""
  SELECT snapshot_date, path, k FROM ({FILES_SQL}) f WHERE snapshot_date IN (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders UNION ALL
    SELECT MIN(CAST(o_orderdate AS DATE)) FROM orders)""")
def only_periods(f):
    """The files of the periods that a reader names: here the first and the last."""
    listed = files(f)
    ends = listed.agg(F.min("snapshot_date").alias("a"), F.max("snapshot_date").alias("b")).first()
    return catalog.only_periods(listed, [ends.a, ends.b])


@query("usable_periods", "snapshot_date:d has_provider:b has_penalties:b files:i status:s", f"""
  SELECT *, CASE WHEN NOT has_provider THEN 'skipped' WHEN NOT has_penalties THEN 'no penalties' ELSE 'complete' END AS status
  FROM (SELECT snapshot_date, COUNT(*) FILTER (WHERE logical = 'provider_info') > 0 AS has_provider,
               COUNT(*) FILTER (WHERE logical = 'penalties') > 0 AS has_penalties, COUNT(*) AS files
        FROM ({CHOSEN_SQL}) c GROUP BY snapshot_date) u""")
def usable_periods(f):
    return catalog.usable_periods(catalog.classify_files(files(f)))


SIZES_SQL = """SELECT CAST(o_orderdate AS DATE) AS snapshot_date,
  CASE WHEN COUNT(*) % 6 = 0 THEN 0 ELSE COUNT(*) * 1000 END AS length FROM orders GROUP BY 1"""
LEDGER_SQL = """SELECT CAST(o_orderdate AS DATE) AS snapshot_date,
  COUNT(*) * 1000 - CASE WHEN COUNT(*) % 5 = 0 THEN 1 ELSE 0 END AS length FROM orders
  WHERE o_orderdate < DATE '2000-01-01' GROUP BY 1"""


@query("incremental_pending", "snapshot_date:d length:i reason:s", f"""
  SELECT c.snapshot_date, c.length, CASE WHEN l.length IS NULL THEN 'new' ELSE 'size mismatch' END AS reason
  FROM ({SIZES_SQL}) c LEFT JOIN ({LEDGER_SQL}) l ON l.snapshot_date = c.snapshot_date
  WHERE l.length IS NULL OR (c.length <> 0 AND c.length <> l.length)""")
def incremental_pending(f):
    n = F.count("*")
    day = F.col("o_orderdate").cast("date").alias("snapshot_date")
    orders = f.table("orders")
    sizes = orders.groupBy(day).agg(F.when(n % 6 == 0, 0).otherwise(n * 1000).alias("length"))
    ledger = orders.filter(F.col("o_orderdate") < "2000-01-01").groupBy(day).agg(
        (n * 1000 - F.when(n % 5 == 0, 1).otherwise(0)).alias("length"))
    return catalog.incremental_pending(sizes, ledger)


OLD = {"o_orderkey": "PROVNUM", "o_clerk": "PROVNAME", "o_state": "STATE ", "o_owner": "ownership",
       "o_price": "Overall_Rating", "o_day": "FILEDATE"}


def _old_layout(f):
    """Orders under the oldest era's headers, with odd case and a trailing blank."""
    return f.table("orders").select(
        F.col("o_orderkey").cast("string").alias("PROVNUM"), F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("PROVNAME"),
        F.col("o_orderstatus").alias("STATE "), F.col("o_orderpriority").alias("ownership"),
        (F.col("o_custkey") % 5).cast("string").alias("Overall_Rating"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("FILEDATE"), F.lit("x").alias("unmapped"))


@query("canonicalize", "ccn:s provider_name:s state_code:s ownership_type:s overall_rating:s processing_date:s "
       "chain_name:s latitude:s era:s", """
  SELECT CAST(o_orderkey AS VARCHAR) AS ccn, concat('Order ', CAST(o_orderkey AS VARCHAR)) AS provider_name,
         o_orderstatus AS state_code, o_orderpriority AS ownership_type, CAST(o_custkey % 5 AS VARCHAR) AS overall_rating,
         strftime(o_orderdate, '%Y-%m-%d') AS processing_date, NULL AS chain_name, NULL AS latitude, '2019' AS era
  FROM orders""")
def canonicalize(f):
    return text.canonicalize(_old_layout(f), "provider_info")


@query("detect_era", "layout:s era:s columns_mapped:i rows:i", """
  SELECT layout, era, columns_mapped, COUNT(*) AS rows FROM orders,
    (VALUES ('first', '2019', 6), ('second', '2020', 3), ('third', '2026', 4)) AS v(layout, era, columns_mapped)
  GROUP BY layout, era, columns_mapped""")
def detect_era(f):
    """Three layouts of the same rows; the era follows from the header alone."""
    orders = f.table("orders")
    layouts = {
        "first": _old_layout(f),
        "second": orders.select(F.col("o_orderkey").alias("Federal Provider Number"),
                                F.col("o_custkey").alias("Penalty Date"), F.col("o_orderstatus").alias("Penalty Type")),
        "third": orders.select(F.col("o_orderkey").alias("CMS Certification Number (CCN)"),
                               F.col("o_custkey").alias("penalty date"), F.col("o_orderstatus").alias("PENALTY TYPE"),
                               F.col("o_totalprice").alias("Fine ID")),
    }
    counted = None
    for name, frame in layouts.items():
        era, hits = text.detect_era("provider_info" if name == "first" else "penalties", frame.columns)
        part = frame.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("layout"), F.lit(era).alias("era"), F.lit(hits).alias("columns_mapped"), "rows")
        counted = part if counted is None else counted.unionByName(part)
    return counted


FIRST_DATE_SQL = """
  SELECT batch, MIN(source_row) FILTER (WHERE parsed IS NOT NULL) AS first_row, COUNT(DISTINCT parsed) AS distinct_dates
  FROM (SELECT batch, source_row, CASE WHEN batch % 2 = 0 THEN CAST(TRY_STRPTIME(date_text, '%m/%d/%Y') AS DATE)
               ELSE CAST(TRY_STRPTIME(date_text, '%d/%m/%Y') AS DATE) END AS parsed FROM fx_raw) p GROUP BY batch"""


@query("processing_date", "snapshot_date:d processing_date:d distinct_dates:i label_differs:b", f"""
  SELECT make_date(d.batch, 1, 1) AS snapshot_date, CAST(o.o_orderdate AS DATE) AS processing_date, distinct_dates,
         CAST(o.o_orderdate AS DATE) <> make_date(d.batch, 1, 1) AS label_differs
  FROM ({FIRST_DATE_SQL}) d JOIN orders o ON o.o_orderkey = d.first_row""")
def processing_date(f):
    rows = f.raw.select(F.make_date(F.col("batch").cast("int"), F.lit(1), F.lit(1)).alias("snapshot_date"),
                        F.col("date_text").alias("processing_date"), "source_row")
    return text.processing_dates(rows, ["source_row"])


# publications: every order date is one; those of a month share a processing date
PUBLISHED_SQL = f"""
  SELECT DISTINCT snapshot_date, CAST(date_trunc('month', snapshot_date) AS DATE) AS processing_date, logical
  FROM ({CHOSEN_SQL}) c WHERE logical IN ('provider_info', 'penalties')"""
SURVIVOR_SQL = f"""
  SELECT processing_date, logical, source_date, MAX(source_date) OVER (PARTITION BY processing_date) AS snapshot_date, publications
  FROM (SELECT processing_date, logical, MAX(snapshot_date) AS source_date, COUNT(*) AS publications
        FROM ({PUBLISHED_SQL}) p GROUP BY processing_date, logical) w"""


def _published(f):
    chosen = catalog.classify_files(files(f)).filter(F.col("logical").isin("provider_info", "penalties"))
    return chosen.select(
        "snapshot_date", F.trunc("snapshot_date", "month").alias("processing_date"), "logical", "candidates")


@query("collapse_republished", "processing_date:d logical:s source_date:d snapshot_date:d publications:i inherited:b",
       f"SELECT *, source_date < snapshot_date AS inherited FROM ({SURVIVOR_SQL}) s")
def collapse_republished(f):
    return catalog.collapse_republished(_published(f))


@query("source_coverage", "logical:s files:i carried:i superseded:i unread:i rows_carried:i", f"""
  SELECT c.logical, COUNT(*) AS files, COUNT(*) FILTER (WHERE s.source_date = c.snapshot_date) AS carried,
         COUNT(*) FILTER (WHERE s.source_date <> c.snapshot_date) AS superseded,
         COUNT(*) FILTER (WHERE s.source_date IS NULL) AS unread,
         COALESCE(SUM(CASE WHEN s.source_date = c.snapshot_date THEN candidates END), 0) AS rows_carried
  FROM ({CHOSEN_SQL}) c
  LEFT JOIN ({SURVIVOR_SQL}) s ON s.logical = c.logical AND s.processing_date = CAST(date_trunc('month', c.snapshot_date) AS DATE)
  GROUP BY c.logical""")
def source_coverage(f):
    on_disk = catalog.classify_files(files(f)).select(
        "snapshot_date", F.trunc("snapshot_date", "month").alias("processing_date"), "logical",
        F.col("candidates").alias("row_count"))
    return catalog.source_coverage(on_disk, catalog.collapse_republished(_published(f)))


# --- population ------------------------------------------------------------------
WIDE_SQL = """
  SELECT c_nationkey AS state, n_name AS name, c_custkey % 3 AS sex,
         CASE WHEN c_custkey % 11 = 0 THEN 999 ELSE c_custkey % 100 END AS age,
         c_custkey % 50 AS p2020, c_custkey % 70 AS p2021, c_custkey % 90 AS p2022
  FROM customer JOIN nation ON n_nationkey = c_nationkey"""


def _wide(f):
    key = F.col("c_custkey")
    people = f.table("customer").join(f.table("nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    return people.select(
        F.col("c_nationkey").cast("string").alias("STATE"), F.col("n_name").alias("NAME"),
        (key % 3).cast("string").alias("SEX"), F.when(key % 11 == 0, 999).otherwise(key % 100).cast("string").alias("AGE"),
        *[(key % m).cast("string").alias(f"POPEST{y}_CIV") for y, m in ((2020, 50), (2021, 70), (2022, 90))])


LONG_SQL = " UNION ALL ".join(
    f"SELECT CAST(state AS VARCHAR) AS state_fips, name AS state_name, {y} AS year, SUM(p{y}) AS pop_65plus "
    f"FROM ({WIDE_SQL}) w WHERE sex = 0 AND age >= 65 AND age <> 999 AND state <> 0 GROUP BY state, name"
    for y in (2020, 2021, 2022))


@query("unpivot_population", "state_fips:s state_name:s year:i pop_65plus:i", LONG_SQL)
def unpivot_population(f):
    return population.unpivot_population(_wide(f))


@query("state_population", "state_code:s state_name:s year:i pop_65plus:i source:s", f"""
  SELECT m.code AS state_code, state_name, year, pop_65plus, 'estimates' AS source FROM ({LONG_SQL}) l
  JOIN (VALUES {', '.join(f"('{s[1]}', '{s[0]}')" for s in V.STATES if s[1])}) AS m(fips, code)
    ON m.fips = lpad(state_fips, 2, '0')""")
def state_population(f):
    return population.state_population(population.unpivot_population(_wide(f)), "estimates")


@query("json_rows_sum", "state_fips:s state_name:s year:i pop_65plus:i", """
  SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_fips, c_name AS state_name, 2023 AS year,
         (c_custkey % 10) * 12 + 66 AS pop_65plus FROM customer""")
def json_rows_sum(f):
    """One payload per customer: a header row and one row of twelve counts."""
    key = F.col("c_custkey") % 10
    header = F.array(F.lit("NAME"), *[F.lit(v) for v in V.POPULATION_VARIABLES], F.lit("state"))
    line = F.array(F.col("c_name"), *[(key + i).cast("string") for i in range(12)],
                   F.lpad(F.col("c_nationkey").cast("string"), 2, "0"))
    payloads = f.table("customer").select(F.to_json(F.array(header, line)).alias("payload"))
    return population.json_rows_sum(payloads, "payload", 2023)


@query("quoted_breaks_scan", "bucket:i place:i o_orderkey:i note:s", r"""
  SELECT o_orderkey % 10 AS bucket, row_number() OVER (PARTITION BY o_orderkey % 10 ORDER BY o_orderkey) - 1 AS place, o_orderkey,
         CASE o_orderkey % 5 WHEN 0 THEN concat('plain ', o_orderpriority) WHEN 1 THEN concat('two', chr(10), 'lines ', o_orderpriority)
           WHEN 2 THEN concat('says "hi", then', chr(10), chr(10), 'stops') WHEN 3 THEN concat('"', chr(10), '" ', o_orderstatus)
           ELSE concat('comma, ', o_orderpriority) END AS note
  FROM orders""")
def quoted_breaks_scan(f):
    """Order notes with line breaks, quotes and commas, written as ten files, read back in blocks, in file order."""
    key, note = F.col("o_orderkey"), F.col("o_orderpriority")
    notes = f.table("orders").select(
        (key % 10).alias("bucket"), key.cast("string").alias("o_orderkey"),
        F.when(key % 5 == 0, F.concat(F.lit("plain "), note)).when(key % 5 == 1, F.concat(F.lit("two\nlines "), note))
        .when(key % 5 == 2, 'says "hi", then\n\nstops').when(key % 5 == 3, F.concat(F.lit('"\n" '), "o_orderstatus"))
        .otherwise(F.concat(F.lit("comma, "), note)).alias("note"))
    folder = scratch_path(f.spark, "notes")
    (notes.repartition(10, "bucket").sortWithinPartitions("bucket", key.cast("bigint")).write.partitionBy("bucket").option("header", True)
     .option("encoding", V.TEXT_ENCODING).option("escape", '"').csv(folder))
    read = text.ingest_quoted_scan(f.spark, [folder], ["o_orderkey", "note"])
    placed = number_in_group(read, ["file_path"], list(text.POSITION), "place")
    return placed.withColumn("bucket", F.regexp_extract("file_path", "bucket=([0-9]+)", 1))
