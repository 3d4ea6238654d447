"""The measures, defined once. Ratios are ratios of sums, never means of ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.functions.clean import col


def nonzero(c: Column) -> Column:
    return F.when(c != 0, c)


def divide(numerator: Column, denominator: Column) -> Column:
    """Division that gives null instead of an error when there is no base."""
    return numerator.cast("double") / nonzero(denominator.cast("double"))


def ratio_of_sums(numerator, denominator) -> Column:
    return divide(F.sum(col(numerator)), F.sum(col(denominator)))


def weighted_mean(value, weight) -> Column:
    """Mean of a rate, weighted; rows without the value carry no weight."""
    value, weight = col(value), col(weight)
    return divide(F.sum(value * weight), F.sum(F.when(value.isNotNull(), weight)))


def zero_sum(c) -> Column:
    """Sum that is 0, not null, over nothing."""
    return F.coalesce(F.sum(col(c)), F.lit(0))


def share(condition: Column, scale: float = 1.0) -> Column:
    """Share of rows where the condition holds; rows where it is null stay out."""
    return F.avg(F.when(condition.isNotNull(), condition.cast("int"))) * scale


def mean(c) -> Column:
    return F.avg(col(c).cast("double"))


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def measure_list(weight: str = "resident_days") -> list[Column]:
    """M1-M4, M7, M8 and their totals at whatever grain the caller groups by."""
    return [
        F.count("*").alias("facilities"),
        count_where(F.col("is_suspect")).alias("suspect_rows"),
        ratio_of_sums("avg_residents_per_day", "certified_beds").alias("m1_occupancy_rate"),
        F.sum("resident_days").alias("m2_resident_days"),
        weighted_mean("reported_total_nurse_hprd", weight).alias("m3_nurse_hprd"),
        weighted_mean("reported_rn_hprd", weight).alias("m3b_rn_hprd"),
        weighted_mean("total_nursing_turnover_pct", weight).alias("m4_turnover_pct"),
        mean("overall_rating").alias("m7_avg_overall_rating"),
        F.sum("cycle1_total_deficiencies").alias("m8_deficiencies"),
        F.sum("certified_beds").alias("total_certified_beds"),
        F.sum("avg_residents_per_day").alias("total_residents"),
    ]


def measures(*names: str) -> list[Column]:
    """The measures in the order asked for; all of them when none is named."""
    by_name = dict(zip(MEASURE_NAMES, measure_list()))
    return [by_name[n] for n in (names or MEASURE_NAMES)]


MEASURE_NAMES = (
    "facilities", "suspect_rows", "m1_occupancy_rate", "m2_resident_days", "m3_nurse_hprd",
    "m3b_rn_hprd", "m4_turnover_pct", "m7_avg_overall_rating", "m8_deficiencies",
    "total_certified_beds", "total_residents",
)


def penalty_split() -> list[Column]:
    """Events by type, money and days; two units are never added together."""
    from tidemark.fixed_values import DENIAL, FINE

    events = lambda kind: zero_sum(F.when(F.col("penalty_type") == kind, F.col("penalty_count")))
    return [
        F.sum("penalty_count").alias("m6_penalty_events"),
        events(FINE).alias("m6_fine_events"),
        events(DENIAL).alias("m6_denial_events"),
        zero_sum("fine_amount_usd").alias("m5_fine_usd"),
        zero_sum("payment_denial_days").alias("total_denial_days"),
    ]
