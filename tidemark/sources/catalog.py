"""The catalogue of periods and files, as DataFrame operations.

A catalogue row is (snapshot_date, path, length). The rules work on rows, so they
serve a folder listing as well as a catalogue table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidemark import fixed_values as V
from tidemark.functions.clean import col
from tidemark.operators.lookups import join_unique, lookup_join
from tidemark.operators.ordering import first_per_key


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root/<yyyy-MM-dd>/``; file contents are never read.

    A file may be a folder of parts, ``<name>/part-00000...``, as Spark writes
    it. Parts follow each other by number; each has the header.
    """
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
        .groupBy(whole_file("path").alias("path")).agg(F.sum("length").alias("length"))
    )
    return found.select(period_of("path").alias("snapshot_date"), "path", "length").filter(
        F.col("snapshot_date").isNotNull())


def whole_file(path: Column | str) -> Column:
    """Path of the file that a part belongs to; of any other file its own."""
    return F.regexp_replace(col(path), r"(/\d{4}-\d{2}-\d{2}/[^/]+)/part-\d[^/]*$", "$1")


def part_start(path: Column | str) -> Column:
    """Where a part, ``part-<number>...[.c<number>]...``, starts in its file, in order only.

    A part has room for 2^36 bytes, a writer's task (the first number) for 256 parts.
    """
    name = F.substring_index(col(path), "/", -1)
    task = F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("bigint")
    again = F.regexp_extract(name, r"\.c(\d+)", 1).try_cast("bigint")
    start = F.shiftleft(F.shiftleft(task, 8) + F.coalesce(again, F.lit(0)), 36)
    return F.when(name.startswith("part-"), F.coalesce(start, F.lit(0))).otherwise(0).cast("bigint")


def period_of(path: Column | str) -> Column:
    text = F.regexp_extract(col(path), r"/(\d{4}-\d{2}-\d{2})/[^/]+(?:/part-\d[^/]*)?$", 1)
    return F.when(text != "", F.try_to_date(text, "yyyy-MM-dd"))


def file_name(path: Column | str) -> Column:
    return F.substring_index(whole_file(path), "/", -1)


def classify(path: Column | str) -> Column:
    """Logical table of a file by its name; archive sidecars have none."""
    path, name = col(path), file_name(path)
    sidecar = name.startswith("._") | path.rlike(r"(?:^|/)__MACOSX/")
    logical = reduce(
        lambda later, p: F.when(name.rlike("(?i)" + p[1]), p[0]).otherwise(later),
        reversed(V.FILE_PATTERNS), F.lit(None))
    return F.when(~sidecar, logical)


def period_catalog(files: DataFrame) -> DataFrame:
    return files.select("snapshot_date").distinct()


def of_kind(catalog: DataFrame, kind: str, column: str = "kind") -> DataFrame:
    return catalog.filter(F.col(column) == kind)


def only_periods(frame: DataFrame, periods: list | None, column: str = "snapshot_date") -> DataFrame:
    return frame if not periods else frame.filter(F.col(column).isin(list(periods)))


def first_per_quarter(catalog: DataFrame, date: str = "snapshot_date") -> DataFrame:
    """The earliest period of every calendar quarter."""
    keyed = catalog.withColumn("year", F.year(date)).withColumn("quarter", F.quarter(date))
    return first_per_key(keyed, ["year", "quarter"], [date])


def classify_files(files: DataFrame) -> DataFrame:
    """First file by name per (period, logical table)."""
    return (
        files.withColumn("logical", classify("path")).filter(F.col("logical").isNotNull())
        .groupBy("snapshot_date", "logical")
        .agg(F.min_by("path", file_name("path")).alias("path"), F.count("*").alias("candidates"))
    )


def incremental_pending(catalog: DataFrame, ledger: DataFrame, force: bool = False) -> DataFrame:
    """Periods still to be loaded: not in the ledger, or loaded with another size.

    A catalogue size of 0 means "not published"; then any loaded copy counts.
    """
    if force:
        return catalog
    loaded = ledger.groupBy("snapshot_date").agg(F.max("length").alias("loaded_length"))
    joined = join_unique(catalog, loaded, "snapshot_date", "left")
    complete = F.col("loaded_length").isNotNull() & (
        (F.col("length") == 0) | (F.col("length") == F.col("loaded_length")))
    return joined.filter(~complete).withColumn(
        "reason", F.when(F.col("loaded_length").isNull(), "new").otherwise("size mismatch"))


def usable_periods(chosen: DataFrame) -> DataFrame:
    """Per period which parts exist; without the required file it is dropped.

    ``chosen`` is the output of ``classify_files``.
    """
    has = lambda logical: F.max(F.col("logical") == logical)
    return chosen.groupBy("snapshot_date").agg(
        has(V.REQUIRED_FILE).alias("has_provider"), has("penalties").alias("has_penalties"),
        F.count("*").alias("files"),
    ).withColumn("status", F.when(~F.col("has_provider"), "skipped")
                 .when(~F.col("has_penalties"), "no penalties").otherwise("complete"))


def collapse_republished(files: DataFrame) -> DataFrame:
    """Which file serves each logical table of a processing date.

    ``files`` has (snapshot_date, processing_date, logical) of usable periods.
    Publications that share a processing date are one period: the later one wins
    every file it has, a file it lacks is inherited. All files of the period carry
    the label of the later publication.
    """
    winners = files.groupBy("processing_date", "logical").agg(
        F.max("snapshot_date").alias("source_date"),
        F.count_distinct("snapshot_date").alias("publications"))
    period = W.partitionBy("processing_date")   # one row per logical table
    return winners.withColumn("snapshot_date", F.max("source_date").over(period)).withColumn(
        "inherited", F.col("source_date") < F.col("snapshot_date"))


def keep_surviving(rows: DataFrame, survivors: DataFrame, logical: str) -> DataFrame:
    """Rows of the surviving files of one table, under their period's label."""
    chosen = survivors.filter(F.col("logical") == logical).select(
        F.col("source_date").alias("snapshot_date"), F.col("snapshot_date").alias("__label"))
    return lookup_join(rows, chosen, "snapshot_date", "inner").withColumn(
        "snapshot_date", F.col("__label")).drop("__label")


def source_coverage(files: DataFrame, survivors: DataFrame) -> DataFrame:
    """Every file on disk is carried, superseded by a later one, or unread.

    ``files``: (snapshot_date, processing_date, logical, row_count) of all files;
    ``processing_date`` is null where the period was not usable.
    """
    served = survivors.select(
        "processing_date", "logical", F.col("source_date").alias("__source"))
    joined = files.join(served, ["processing_date", "logical"], "left")
    status = (
        F.when(F.col("__source").isNull(), "unread")
        .when(F.col("__source") == F.col("snapshot_date"), "carried").otherwise("superseded")
    )
    counted = joined.withColumn("status", status).groupBy("logical").agg(
        F.count("*").alias("files"),
        *[F.count(F.when(F.col("status") == s, 1)).alias(s)
          for s in ("carried", "superseded", "unread")],
        F.sum(F.when(F.col("status") == "carried", F.col("row_count")).otherwise(0)).alias("rows_carried"),
    )
    return counted
