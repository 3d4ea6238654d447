"""Questions 2 and 8: do kinds of operators behave differently."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark import fixed_values as V
from tidemark.functions.bands import label_order
from tidemark.functions.measures import (
    count_where, divide, mean, ratio_of_sums, weighted_mean, zero_sum,
)
from tidemark.operators.lookups import join_unique, lookup_join
from tidemark.operators.ordering import exact_quantiles
from tidemark.plans.roster import at_period, in_window, period_end, short_names

SEGMENT_ORDER = {
    "ownership_group": V.OWNERSHIP_ORDER, "ownership_type": None,
    "chain_size_band": V.CHAIN_BAND_ORDER,
}


def segment_facilities(facility: DataFrame, segment: str, period: int | None = None,
                       exclude_suspect: bool = True) -> DataFrame:
    """Facilities of a period with their segment; unknown segments stay out."""
    rows = at_period(facility, period).filter(F.col(segment) != V.UNKNOWN_LABEL)
    if exclude_suspect:
        rows = rows.filter(~F.col("is_suspect"))
    return short_names(rows).select(
        "ccn", F.col(segment).alias("segment"), "beds", "residents", "rating", "nurse_hprd",
        "rn_hprd", F.col("turnover_pct").alias("turnover"))


def segment_compare(facility: DataFrame, penalty: DataFrame, segment: str,
                    period: int | None = None, exclude_suspect: bool = True) -> DataFrame:
    """Operations and three years of penalties per segment.

    Penalties go to the segment their facility is in at this period. They are
    reduced per facility before they meet the roster.
    """
    roster = segment_facilities(facility, segment, period, exclude_suspect)
    operations = roster.groupBy("segment").agg(
        F.count("*").alias("facilities"), F.sum("beds").alias("beds"),
        ratio_of_sums("residents", "beds").alias("occupancy"),
        mean("rating").alias("avg_rating"), F.count("rating").alias("rated_facilities"),
        weighted_mean("nurse_hprd", "residents").alias("nurse_hprd"),
        weighted_mean("rn_hprd", "residents").alias("rn_hprd"),
        weighted_mean("turnover", "residents").alias("turnover_pct"),
        mean("nurse_hprd").alias("nurse_hprd_unweighted"),
        mean("turnover").alias("turnover_pct_unweighted"))
    per_facility = in_window(penalty, period_end(facility, period)).groupBy("ccn").agg(
        F.sum("fine_amount_usd").alias("fines"),
        count_where(F.col("fine_amount_usd") > 0).alias("events"),
        F.sum("payment_denial_days").alias("days"))
    penalised = join_unique(roster.select("ccn", "segment"), per_facility, "ccn", "inner")
    penalties = penalised.groupBy("segment").agg(
        zero_sum("fines").alias("fine_total"), zero_sum("events").alias("fine_events"),
        zero_sum("days").alias("denial_days"), F.count_distinct("ccn").alias("fined_facilities"))
    joined = join_unique(operations, penalties, "segment").withColumns({
        c: F.coalesce(c, F.lit(0)).cast("bigint")
        for c in ("fine_total", "fine_events", "denial_days", "fined_facilities")})
    out = joined.withColumns({
        "rn_share": divide(F.col("rn_hprd"), F.col("nurse_hprd")),
        "fines_per_bed": divide(F.col("fine_total"), F.col("beds")),
        "share_fined": divide(F.col("fined_facilities"), F.col("facilities")),
    })
    labels = SEGMENT_ORDER.get(segment)
    if labels:
        return out.withColumn("segment_ord", label_order("segment", labels)).orderBy(
            "segment_ord", "segment")
    return out.orderBy(F.col("beds").desc(), "segment")


def segment_cross(facility: DataFrame, period: int | None = None,
                  exclude_suspect: bool = True) -> DataFrame:
    """Chain size inside each ownership group."""
    rows = at_period(facility, period).filter(
        (F.col("ownership_group") != V.UNKNOWN_LABEL) & (F.col("chain_size_band") != V.UNKNOWN_LABEL))
    if exclude_suspect:
        rows = rows.filter(~F.col("is_suspect"))
    return short_names(rows).groupBy(
        F.col("ownership_group").alias("ownership"), F.col("chain_size_band").alias("chain_size")).agg(
            F.count("*").alias("facilities"), F.sum("beds").alias("beds"),
            mean("rating").alias("avg_rating"),
            weighted_mean("nurse_hprd", "residents").alias("nurse_hprd"),
            weighted_mean("turnover_pct", "residents").alias("turnover_pct"),
    ).withColumns({
        "ownership_ord": label_order("ownership", V.OWNERSHIP_ORDER),
        "chain_ord": label_order("chain_size", V.CHAIN_BAND_ORDER),
    }).orderBy("ownership_ord", "chain_ord")


def chain_data_periods(facility: DataFrame) -> DataFrame:
    return facility.groupBy(
        F.col("snapshot_date").alias("period"), F.col("snapshot_date_key").alias("period_key")).agg(
            F.count("*").alias("facilities"),
            count_where(F.col("chain_name") != V.UNKNOWN_LABEL).alias("with_chain_data"),
    ).orderBy("period")


# --- distributions behind the figures ---------------------------------------

def rating_mix(facilities: DataFrame) -> DataFrame:
    """Share of every star level per segment, with size and median."""
    rated = facilities.filter(F.col("rating").isNotNull())
    medians = exact_quantiles(rated, "rating", [0.5], by=["segment"], bounded=True)
    level = F.round("rating").cast("int")
    mix = rated.groupBy("segment").agg(
        F.count("*").alias("n"),
        *[count_where(level == i).alias(str(i)) for i in V.RATING_LEVELS])
    long = mix.unpivot(["segment", "n"], [str(i) for i in V.RATING_LEVELS], "level", "facilities")
    return lookup_join(long, medians, "segment").select(
        "segment", F.col("level").cast("int").alias("level"), "facilities",
        divide(F.col("facilities"), F.col("n")).alias("share"), "n",
        F.col("cuts")[0].alias("median"))


def box_stats(facilities: DataFrame, column: str) -> DataFrame:
    """Quartiles and whiskers per segment; whiskers stop at data within 1.5 IQR."""
    quartiles = exact_quantiles(facilities, column, [0.25, 0.5, 0.75], by=["segment"])
    joined = lookup_join(
        facilities.select("segment", F.col(column).cast("double").alias("__v")).filter(
            F.col("__v").isNotNull()),
        quartiles.select("segment", *[F.col("cuts")[i].alias(n) for i, n in
                                      enumerate(("q1", "median", "q3"))]), "segment")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    v = F.col("__v")
    stats = joined.groupBy("segment", "q1", "median", "q3").agg(
        F.count("*").alias("n"),
        F.min(F.when(v >= F.col("q1") - reach, v)).alias("__low"),
        F.max(F.when(v <= F.col("q3") + reach, v)).alias("__high"))
    return stats.select(
        "segment", "n", F.least("__low", "q1").alias("whisker_low"), "q1", "median", "q3",
        F.greatest("__high", "q3").alias("whisker_high"))


def monotone_check(cross: DataFrame, measure: str, falling: bool) -> DataFrame:
    """Does a measure move one way along the ordered bands, inside every group?"""
    steps = W.partitionBy("ownership").orderBy("chain_ord")
    step = F.col(measure) - F.lag(measure).over(steps)
    return cross.withColumn("__step", step).groupBy("ownership").agg(
        F.count("__step").alias("steps"), F.min("__step").alias("smallest_step"),
        F.max("__step").alias("largest_step"),
    ).select(
        "ownership", F.lit(measure).alias("measure"), "steps", "smallest_step", "largest_step",
        F.coalesce((F.col("largest_step") < 0) if falling else (F.col("smallest_step") > 0),
                   F.lit(True)).alias("monotone"))


def category_churn(facility: DataFrame, first: int, last: int) -> DataFrame:
    """How many facilities changed ownership type and group between two periods."""
    pairs = _ownership_pairs(facility, first, last)
    moved = lambda a, b: count_where(F.col(a) != F.col(b))
    return pairs.agg(
        F.count("*").alias("facilities_in_both"),
        moved("type_from", "type_to").alias("type_changed"),
        moved("group_from", "group_to").alias("group_changed"))


def top_transitions(facility: DataFrame, first: int, last: int, n: int = 4) -> DataFrame:
    return _ownership_pairs(facility, first, last).filter(
        F.col("type_from") != F.col("type_to")).groupBy("type_from", "type_to").agg(
            F.count("*").alias("facilities")).orderBy(
                F.col("facilities").desc(), "type_from", "type_to").limit(n)


def _ownership_pairs(facility: DataFrame, first: int, last: int) -> DataFrame:
    """Both ends side by side from one aggregate per facility, no self-join."""
    at = F.col("snapshot_date_key")
    pick = lambda c, k: F.max(F.when(at == k, F.col(c)))
    both = facility.filter(at.isin(first, last)).groupBy("ccn").agg(
        pick("ownership_type", first).alias("type_from"), pick("ownership_type", last).alias("type_to"),
        pick("ownership_group", first).alias("group_from"), pick("ownership_group", last).alias("group_to"),
        F.count_distinct(at).alias("__ends"))
    return both.filter(F.col("__ends") == 2)


def fanout_check(facility: DataFrame, penalty: DataFrame, group: str, period: int | None = None) -> DataFrame:
    """Beds of a group, and what a row-to-row join of the two facts would claim.

    The naive total is computed from penalty counts per facility; the exploding
    join itself is never run.
    """
    rows = short_names(at_period(facility, period).filter(
        (F.col("ownership_group") == group) & ~F.col("is_suspect"))).select("ccn", "beds")
    counts = penalty.groupBy("ccn").agg(F.count("*").alias("__n"))
    return join_unique(rows, counts, "ccn").agg(
        zero_sum("beds").alias("true_beds"),
        zero_sum(F.col("beds") * F.col("__n")).alias("naive_beds"),
    ).withColumn("inflation", divide(F.col("naive_beds"), F.col("true_beds")))


def pivot_share(cross: DataFrame) -> DataFrame:
    """Facilities by chain size and ownership, with shares inside each chain size."""
    counts = cross.groupBy("chain_size", "chain_ord").pivot("ownership", V.OWNERSHIP_ORDER).agg(
        F.sum("facilities"))
    names = {g: g.lower().replace(" ", "_") for g in V.OWNERSHIP_ORDER}
    filled = counts.select("chain_size", "chain_ord", *[
        F.coalesce(F.col(f"`{g}`"), F.lit(0)).cast("bigint").alias(n) for g, n in names.items()])
    total = sum((F.col(n) for n in names.values()), F.lit(0))
    return filled.select("*", *[divide(F.col(n), total).alias(f"share_{n}") for n in names.values()]).orderBy(
        "chain_ord")
