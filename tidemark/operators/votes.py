"""Decisions taken once per column and period, then applied to every row.

Each decision is one aggregate, written as a table of one row per period. It is
joined back by a plain join: the size of its files is known when the plan is made,
so it is broadcast while it is small and the rows are not shuffled by period.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import fixed_values as V
from tidemark.functions.clean import col, flag_domain, strip
from tidemark.operators.lookups import join_unique
from tidemark.operators.ordering import exact_quantiles
from tidemark.session import stored

_FORMATS = V.DATE_FORMATS


def _decided(frame: DataFrame, decisions: DataFrame, by: list[str]) -> DataFrame:
    return join_unique(frame, stored(decisions, "decisions"), by, null_safe=True)


def parse_as(text: Column, index: int) -> Column:
    pattern, shape = _FORMATS[index]
    return F.when(text.rlike(shape), F.try_to_date(text, pattern))


def date_votes(frame: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Score every accepted date format against a whole column.

    Per group: values present, hits of the best format, its index (earliest wins
    ties, null when nothing parsed), values left null, and how many rival formats
    explain as many values but disagree.
    """
    text = strip(column)
    # dates repeat: each text of a group is parsed once and counts as often as it occurs
    texts = frame.select(*by, F.when(text != "", text).alias("__t")).groupBy(*by, "__t").agg(F.count("*").alias("__n"))
    parsed = texts.select(
        *by, "__t", "__n", *[parse_as(F.col("__t"), i).alias(f"__p{i}") for i in range(len(_FORMATS))])
    pairs = list(combinations(range(len(_FORMATS)), 2))
    rows = lambda holds: F.coalesce(F.sum(F.when(holds, F.col("__n"))), F.lit(0))
    scores = parsed.groupBy(*by).agg(
        rows(F.col("__t").isNotNull()).alias("present"),
        *[rows(F.col(f"__p{i}").isNotNull()).alias(f"__h{i}") for i in range(len(_FORMATS))],
        *[rows(~F.col(f"__p{i}").eqNullSafe(F.col(f"__p{j}"))).alias(f"__d{i}{j}") for i, j in pairs],
    )
    hits = [F.col(f"__h{i}") for i in range(len(_FORMATS))]
    best_hits = F.greatest(*hits)
    best = reduce(lambda later, i: F.when(hits[i] == best_hits, i).otherwise(later),
                  reversed(range(len(_FORMATS))), F.lit(None))
    scores = scores.withColumn("hits", best_hits).withColumn(
        "format_index", F.when(F.col("hits") > 0, best).cast("int"))
    rivals = F.lit(0)
    for i, j in pairs:
        rivals = rivals + F.when(
            (F.col("format_index") == i) & (hits[j] == F.col("hits")) & (F.col(f"__d{i}{j}") > 0), 1
        ).otherwise(0)
    names = F.array(*[F.lit(p) for p, _ in _FORMATS])
    return scores.select(
        *by, "present", "hits", "format_index",
        F.get(names, F.col("format_index")).alias("date_format"),
        (F.col("present") - F.col("hits")).alias("unparsed"),
        rivals.cast("int").alias("rivals"),
    )


def parse_date_vote(frame: DataFrame, column: str, into: str, by: list[str],
                    votes: DataFrame | None = None) -> DataFrame:
    """Parse a text date with the one format its whole column voted for."""
    votes = date_votes(frame, column, by) if votes is None else votes
    choice = votes.select(*by, F.col("format_index").alias("__f"))
    joined = _decided(frame, choice, by)
    text = strip(column)
    value = reduce(
        lambda later, i: F.when(F.col("__f") == i, parse_as(text, i)).otherwise(later),
        reversed(range(len(_FORMATS))), F.lit(None).cast("date"))
    return joined.withColumn(into, value).drop("__f")


def presence(frame: DataFrame, column: Column, by: list[str]) -> DataFrame:
    """Whether a period carries any value of a column."""
    return frame.groupBy(*by).agg(F.max(column.isNotNull()).alias("__present"))


def normalize_flag_domain(frame: DataFrame, column: str, into: str, by: list[str]) -> DataFrame:
    """Blank means "None" only in periods whose file carries the column."""
    joined = _decided(frame, presence(frame, col(column), by), by)
    return joined.withColumn(into, flag_domain(column, F.col("__present"))).drop("__present")


def tri_state(frame: DataFrame, name: Column, raw: str, key: Column, into: str,
              by: list[str], present: DataFrame | None = None) -> DataFrame:
    """Column absent in the period -> -1, blank -> 0, found -> its key, else -1."""
    joined = _decided(frame, presence(frame, col(raw), by) if present is None else present, by)
    value = (
        F.when(~F.col("__present"), V.UNKNOWN_KEY)
        .when(name.isNull(), V.INDEPENDENT_KEY)
        .otherwise(F.coalesce(key, F.lit(V.UNKNOWN_KEY)))
    )
    return joined.withColumn(into, value.cast("bigint")).drop("__present")


def unit_medians(frame: DataFrame, value: str, by: list[str], **options) -> DataFrame:
    """Median per period and the factor it implies; no value, no decision."""
    medians = exact_quantiles(frame, value, [0.5], by=by, **options)
    median = F.col("cuts")[0]
    return medians.select(*by, median.alias("median"), F.when(
        median < V.PROPORTION_MEDIAN, 100.0).otherwise(1.0).alias("factor"))


def fix_unit_drift(frame: DataFrame, value: str, into: str, by: list[str],
                   decisions: DataFrame | None = None, **options) -> DataFrame:
    """Scale a period to percent when its median says it was stored as a proportion."""
    decisions = unit_medians(frame, value, by, **options) if decisions is None else decisions
    joined = _decided(frame, decisions.select(*by, F.col("factor").alias("__f")), by)
    # multiply only where asked, so untouched periods keep their exact value
    return joined.withColumn(
        into, F.when(F.col("__f") == 100.0, F.col(value) * 100.0).otherwise(F.col(value))
    ).drop("__f")
