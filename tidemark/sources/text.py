"""Reading text snapshots whose headers change over time."""

from __future__ import annotations

import csv
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark import fixed_values as V
from tidemark.functions.clean import normalize_id, normalize_zip, null_tokens_to_null
from tidemark.operators.lookups import lookup_join
from tidemark.operators.votes import parse_date_vote
from tidemark.session import COMPRESSION
from tidemark.sources import catalog, records

POSITION = ("file_block", "row_in_block")
MALFORMED = "malformed"


def ingest_text_scan(spark: SparkSession, paths, columns: list[str] | None = None, *,
                     multiline: bool = False, malformed: bool = False) -> DataFrame:
    """Scan delimited files as text only; usual "no value" tokens become null.

    Files are split unless ``multiline`` is asked for, so a large file is read by
    many tasks; ``ingest_quoted_scan`` splits files with quoted line breaks, too. Two position columns keep file order: they
    only ever compare rows of one file, where they do not depend on the plan.
    ``malformed`` adds a flag for rows that do not have the columns' number of fields.
    """
    reader = (
        spark.read.option("header", True).option("encoding", V.TEXT_ENCODING)
        .option("inferSchema", False).option("multiLine", multiline)
        .option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("mode", "PERMISSIVE").option("enforceSchema", True)
    )
    broken = "__broken"
    if columns:
        listed = [*columns, broken] if malformed else columns
        reader = reader.option("columnNameOfCorruptRecord", broken).schema(
            T.StructType([T.StructField(c, T.StringType()) for c in listed]))
    raw = reader.csv(paths)
    names = [c for c in raw.columns if c != broken]
    return raw.select(
        *[null_tokens_to_null(F.col(f"`{c}`")).alias(c) for c in names],
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias(POSITION[0]),
        F.monotonically_increasing_id().alias(POSITION[1]),
        *([F.col(broken).isNotNull().alias(MALFORMED)] if columns and malformed else []),
    )


def ingest_quoted_scan(spark: SparkSession, paths: list[str], columns: list[str], *, by_file: bool = False) -> DataFrame:
    """The same rows for files that quote line breaks, which are split as well (see ``records``)."""
    found = records.ingest_quoted_scan(spark, paths, columns, MALFORMED, by_file=by_file)
    return found.withColumns({c: null_tokens_to_null(F.col(f"`{c}`")) for c in columns})


@dataclass(frozen=True)
class Layout:
    """What one look at a file tells: its header, and whether it quotes line breaks."""

    path: str
    header: tuple[str, ...]
    quoted_breaks: bool


def layouts(spark: SparkSession, paths: list[str]) -> list[Layout]:
    """Header and kind of every file, by two text scans over all files together.

    A line with an odd number of quote characters is part of a value that goes
    on, or of a stray quote; either way its lines have to be put together to
    records. All others are read line by line. One small row per file reaches the driver.
    """
    if not paths:
        return []
    found = []
    for r in first_lines(spark, paths).orderBy("path").collect():
        spans = r.line.count('"') % 2 == 1
        found.append(Layout(r.path, tuple(header_of(spark, r.path) if spans else next(csv.reader([r.line]), [])), r.odd))
    return found


def first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, odd, line)``: the first line of every file, and whether any of its lines has an odd number of quotes.

    A row per file is sent to the lines, which are not shuffled.
    """
    lines = spark.read.text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"))
    # in bytes: the text is not UTF-8
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"')))
    files = lines.groupBy("path").agg(F.min(F.when(F.col("block") == 0, F.col("at"))).alias("at"),
                                      F.max(quotes % 2 == 1).alias("odd"))
    return lines.join(F.broadcast(files), ["path", "at"]).select(
        "path", "odd", F.decode(F.col("value").cast("binary"), V.TEXT_ENCODING).alias("line"))


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of one file; only its first line is read."""
    return (
        spark.read.option("header", True).option("encoding", V.TEXT_ENCODING).option("multiLine", True)
        .option("inferSchema", False).csv(path).columns
    )


def era_columns(logical: str, era: str) -> dict[str, str]:
    index = V.ERA_NAMES.index(era)
    return {name: eras[index] for name, eras in V.CANONICAL_COLUMNS[logical].items()
            if eras[index] is not None}


def detect_era(logical: str, columns: list[str]) -> tuple[str, int]:
    """Era whose column names fit best, and the number that fit.

    Case is ignored. Eras whose id column is present go first, then the most
    hits, then the newest.
    """
    present = {c.strip().lower() for c in columns}
    hits = {
        era: sum(source.lower() in present for source in era_columns(logical, era).values())
        for era in V.ERA_NAMES
    }
    keyed = [e for e in V.ERA_NAMES if era_columns(logical, e)["ccn"].lower() in present]
    best = max(keyed or V.ERA_NAMES, key=lambda e: hits[e])
    if hits[best] == 0:
        raise ValueError(f"no known layout of {logical} matches columns {sorted(present)[:8]}")
    return best, hits[best]


def canonicalize(frame: DataFrame, logical: str, keep: list[str] = ()) -> DataFrame:
    """Rename to canonical columns; columns the era lacks become null.

    Adds ``era``. ``keep`` names technical columns to pass through unchanged.
    """
    spelled = {c.strip().lower(): c for c in frame.columns if c not in keep}
    era, _ = detect_era(logical, list(spelled))
    found = {name: spelled[source.lower()] for name, source in era_columns(logical, era).items()
             if source.lower() in spelled}
    absent = [c for c in V.MUST_HAVE[logical] if c not in found]
    if absent:
        raise ValueError(f"{logical} ({era}) lacks required columns {absent}")
    return frame.select(
        *[(F.col(f"`{found[c]}`") if c in found else F.lit(None)).cast("string").alias(c)
          for c in V.CANONICAL_COLUMNS[logical]],
        F.lit(era).alias("era"), *keep,
    )


def layout_report(columns: list[str], logical: str) -> dict:
    """Era, mapped and absent columns of a layout: what the run log records."""
    era, hits = detect_era(logical, columns)
    present = {c.strip().lower() for c in columns}
    mapped = {n for n, s in era_columns(logical, era).items() if s.lower() in present}
    return {"era": era, "columns": len(columns), "mapped": hits,
            "absent": sorted(set(V.CANONICAL_COLUMNS[logical]) - mapped)}


def processing_dates(rows: DataFrame, position: list[str], period: str = "snapshot_date",
                     column: str = "processing_date") -> DataFrame:
    """Time axis of every file: its first parsed processing date, else its label.

    Also how many distinct dates it held and whether label and date differ.
    """
    parsed = parse_date_vote(rows.select(period, column, *position), column, "__d", [period])
    known = F.col("__d").isNotNull()
    first = F.min_by("__d", F.when(known, F.struct(*position)))
    return parsed.groupBy(period).agg(
        first.alias("__first"), F.count_distinct("__d").alias("distinct_dates"),
    ).select(
        period, F.coalesce("__first", F.col(period).cast("date")).alias("processing_date"),
        "distinct_dates",
    ).withColumn("label_differs", F.col("processing_date") != F.col(period).cast("date"))


def read_logical(spark: SparkSession, chosen: DataFrame, logical: str,
                 found: list[Layout] | None = None, *, by_file: bool = False) -> DataFrame | None:
    """All chosen files of one logical table as one canonical frame.

    The file list is small (one per period); files with equal headers are scanned
    together, those with quoted line breaks record by record. Every row
    carries its period, its position in the file and whether it was malformed.
    With ``by_file`` records put together are shuffled to their files before they are parsed.
    """
    if found is None:
        found = layouts_of(spark, chosen, logical)
    alike: dict[tuple, list[str]] = {}
    for layout in found:
        alike.setdefault((layout.header, layout.quoted_breaks), []).append(layout.path)
    parts = [
        canonicalize(ingest_quoted_scan(spark, group, list(header), by_file=by_file) if quoted else
                     ingest_text_scan(spark, group, list(header), malformed=True), logical,
                     keep=["file_path", *POSITION, MALFORMED])
        for (header, quoted), group in alike.items()
    ]
    if not parts:
        return None
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    # a row per file: its name is taken apart once, not with every row; parts of a file follow each other
    files = spark.createDataFrame([(l.path,) for l in found], "file_path string").select(
        "file_path", catalog.period_of("file_path").alias("snapshot_date"), catalog.part_start("file_path").alias("__start"))
    columns = rows.columns
    rows = rows.join(F.broadcast(files), "file_path", "left").withColumns({
        "ccn": normalize_id("ccn"), POSITION[0]: F.col(POSITION[0]) + F.col("__start")}).select(*columns, "snapshot_date")
    return rows.withColumn("zip_code", normalize_zip("zip_code")) if "zip_code" in rows.columns else rows


def layouts_of(spark: SparkSession, chosen: DataFrame, logical: str) -> list[Layout]:
    return layouts(spark, [r.path for r in chosen.filter(F.col("logical") == logical)
                           .orderBy("snapshot_date").select("path").collect()])


def load_snapshots(spark: SparkSession, root: str, periods: list | None = None,
                   staging: str | None = None) -> tuple[DataFrame, DataFrame | None, DataFrame]:
    """Provider rows, penalty rows and the surviving-file table of a folder.

    Rows carry ``snapshot_date`` (the period's label) and ``processing_date``
    (the time axis). Republished periods are collapsed file by file; superseded
    penalty files are not read. With ``staging`` each kind is parsed once, written
    there by period, and everything after reads what was written. Files read line by line
    are written as they are read, a task has few periods; records put together are
    spread over all tasks and shuffled to their files first, before they are parsed.
    """
    def parsed(chosen, logical, name):
        found = layouts_of(spark, chosen, logical)
        rows = read_logical(spark, chosen, logical, found, by_file=staging is not None)
        if rows is None or staging is None:
            return rows
        path = f"{staging}/{name}"
        rows.write.option("compression", COMPRESSION).partitionBy("snapshot_date").parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    files = catalog.only_periods(catalog.list_files(spark, root), periods)
    chosen = catalog.classify_files(files)
    usable = catalog.usable_periods(chosen).filter("has_provider").select("snapshot_date")
    chosen = lookup_join(chosen, usable, "snapshot_date", "left_semi")
    providers = parsed(chosen, V.REQUIRED_FILE, "provider_rows")
    if providers is None:
        raise ValueError(f"no period below {root} has a {V.REQUIRED_FILE} file")
    axis = processing_dates(providers, list(POSITION)).select("snapshot_date", "processing_date")
    survivors = catalog.collapse_republished(
        lookup_join(chosen.select("snapshot_date", "logical"), axis, "snapshot_date", "inner"))

    def of_period(rows, logical):
        kept = catalog.keep_surviving(rows.drop("processing_date"), survivors, logical)
        label = survivors.filter(F.col("logical") == logical).select(
            "snapshot_date", "processing_date")
        return lookup_join(kept, label, "snapshot_date", "inner")

    serving = survivors.select("logical", F.col("source_date").alias("snapshot_date"))
    penalties = parsed(lookup_join(chosen, serving, ["logical", "snapshot_date"], "left_semi"), "penalties", "penalty_rows")
    return (of_period(providers, V.REQUIRED_FILE),
            of_period(penalties, "penalties") if penalties is not None else None,
            survivors)
