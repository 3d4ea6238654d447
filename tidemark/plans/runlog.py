"""The run log: what every rule did, as rows built from aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import fixed_values as V
from tidemark.functions.clean import suspect_reasons
from tidemark.functions.measures import count_where

SCHEMA = ("run_id string, logged_at string, snapshot_date string, step string, rule string, "
          "target string, rows_affected bigint, detail string")


def entries(frame: DataFrame, step: str, rule: str, target: Column | str, rows: Column | str,
            detail: Column | str, period: Column | None = None) -> DataFrame:
    """Turn a frame of findings into log rows, without run id and time yet."""
    as_col = lambda x: F.lit(x) if isinstance(x, str) else x
    return frame.select(
        F.coalesce((period if period is not None else F.lit("")).cast("string"), F.lit("")).alias("snapshot_date"),
        F.lit(step).alias("step"), F.lit(rule).alias("rule"),
        as_col(target).cast("string").alias("target"),
        F.coalesce(F.col(rows) if isinstance(rows, str) else rows, F.lit(0)).cast("bigint").alias("rows_affected"),
        as_col(detail).cast("string").alias("detail"))


def run_log(parts: list[DataFrame], run_id: str, logged_at: str) -> DataFrame:
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    return rows.select(F.lit(run_id).alias("run_id"), F.lit(logged_at).alias("logged_at"),
                       "snapshot_date", "step", "rule", "target", "rows_affected", "detail")


# --- metrics of the cleaning rules, per period -----------------------------------

def null_report(frame: DataFrame, fields: list[str], by: list[str]) -> DataFrame:
    """Nulls per column and period, with their share of rows; nothing is imputed."""
    wide = frame.groupBy(*by).agg(
        F.count("*").alias("rows"),
        *[count_where(F.col(f).isNull()).alias(f) for f in fields])
    return wide.unpivot([*by, "rows"], list(fields), "field", "nulls").withColumn(
        "share", F.col("nulls") / F.col("rows"))


def key_quality(frame: DataFrame, key: str, by: list[str], width: int = V.ID_WIDTH) -> DataFrame:
    """Keys of the wrong width, and rows beyond the first of a key, per period.

    Keys are counted before they are compared, so a repeated key costs one row.
    """
    keys = frame.groupBy(*by, key).agg(F.count("*").alias("n"))
    return keys.groupBy(*by).agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.length(key) != width, F.col("n")).otherwise(0)).alias("wrong_width"),
        F.sum(F.col("n") - 1).alias("duplicates"))


def suspect_report(frame: DataFrame, by: list[str]) -> DataFrame:
    """Flagged rows per period and reason."""
    reasons = suspect_reasons()
    wide = frame.groupBy(*by).agg(*[count_where(c).alias(n) for n, c in reasons.items()])
    return wide.unpivot(by, list(reasons), "reason", "rows")


def percent(c: Column) -> Column:
    return F.concat(F.round(c * 100, 1).cast("string"), F.lit("%"))


def log_nulls(report: DataFrame, period: str) -> DataFrame:
    return entries(report.filter(F.col("nulls") > 0), "clean", "Q3", F.col("field"), "nulls",
                   F.concat(F.lit("null in "), percent(F.col("share")), F.lit(" of rows")), F.col(period))


def log_key_quality(report: DataFrame, period: str, target: str = "ccn") -> DataFrame:
    return entries(report, "clean", "Q1", target, "rows", F.concat_ws(
        "", F.col("wrong_width").cast("string"), F.lit(" wrong width, "),
        F.col("duplicates").cast("string"), F.lit(" duplicated")), F.col(period))


def log_date_votes(votes: DataFrame, period: str, target: str) -> DataFrame:
    return entries(votes.filter(F.col("present") > 0), "clean", "Q6", target, "unparsed", F.concat_ws(
        "", F.coalesce("date_format", F.lit("no format")), F.lit(": "),
        F.col("hits").cast("string"), F.lit(" of "), F.col("present").cast("string"),
        F.when(F.col("rivals") > 0, ", ambiguous").otherwise("")), F.col(period))


def log_unit_drift(decisions: DataFrame, counts: DataFrame, period: str, target: str) -> DataFrame:
    both = counts.join(decisions, period, "left")
    return entries(both, "clean", "Q8", target, "known", F.when(
        F.col("median").isNull(), "no value, not scaled").when(
        F.col("factor") == 100.0, "proportion, multiplied by 100").otherwise("percentage, left as is"),
        F.col(period))


def log_suspects(report: DataFrame, period: str) -> DataFrame:
    return entries(report.filter(F.col("rows") > 0), "clean", "Q4", "is_suspect", "rows",
                   F.concat(F.col("reason"), F.lit(" flagged, kept")), F.col(period))


def log_checks(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        F.lit("").alias("snapshot_date"), F.lit("load").alias("step"), "rule", "target",
        F.col("violations").alias("rows_affected"), "detail")


# --- reading the log ---------------------------------------------------------------

def quality_log(log: DataFrame, page: int | None = None) -> DataFrame:
    """Quality rules of the newest run, as they fired; all of them, or a reader's first page."""
    newest = log.agg(F.max("run_id")).scalar()
    fired = log.filter((F.col("run_id") == newest) & F.col("rule").like("Q%")).select(
        "rule", "step", "snapshot_date", "target", "rows_affected", "detail",
    ).orderBy("rule", "snapshot_date", "step", "target", "detail", "rows_affected")
    return fired if page is None else fired.limit(page)


def quality_rollup(log: DataFrame) -> DataFrame:
    """Entries and affected rows per rule and step, over all runs."""
    return log.filter(F.col("rule").like("Q%") & (F.col("rows_affected") > 0)).groupBy(
        "rule", "step").agg(
            F.count("*").alias("entries"), F.sum("rows_affected").alias("rows_affected"),
    ).orderBy(F.col("rows_affected").desc(), "rule", "step")
