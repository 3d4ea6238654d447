"""Filtered questions over the flat views (the view-based question set)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark import fixed_values as V
from tidemark.functions.bands import with_band
from tidemark.functions.measures import count_where, divide, mean, measures, zero_sum
from tidemark.operators.lookups import join_unique
from tidemark.plans.semantic import Filters, at_latest

ALL = Filters()


def filter_options(facility: DataFrame) -> DataFrame:
    """Every choice a reader has, one row per (option, value), in display order.

    The four columns are grouped together first, so the facts are read once.
    """
    def option(name, column, order=None):
        return F.struct(F.lit(name).alias("option"), F.col(column).cast("string").alias("value"),
                        (order if order is not None else F.lit(0)).cast("bigint").alias("key"))

    combined = facility.select(
        "snapshot_year_month", "snapshot_date_key", "state_code", "ownership_group", "chain_size_band").distinct()
    listed = combined.select(F.inline(F.array(
        option("period", "snapshot_year_month", F.col("snapshot_date_key")), option("state", "state_code"),
        option("ownership", "ownership_group"), option("chain_band", "chain_size_band"))))
    return listed.filter(F.col("value").isNotNull()).distinct().orderBy("option", "key", "value")


def kpis(facility: DataFrame, penalty: DataFrame, f: Filters = ALL) -> DataFrame:
    """Measures at the newest period inside the filter, and penalties of its dimensions.

    Empty when the filter matches nothing.
    """
    inside = at_latest(facility.filter(f.facility()))
    headline = inside.groupBy(
        F.col("snapshot_date_key").alias("latest_period_key"),
        F.col("snapshot_year_month").alias("latest_period")).agg(*measures())
    fines = penalty.filter(f.penalties()).agg(
        zero_sum("fine_amount_usd").alias("fines"), zero_sum("penalty_count").alias("events"))
    return headline.withColumns({
        "m5_fine_usd": fines.select("fines").scalar(),
        "m6_penalty_events": fines.select("events").scalar(),
    })


def trend(facility: DataFrame, f: Filters = ALL) -> DataFrame:
    return facility.filter(f.facility(with_period=False)).groupBy(
        "snapshot_date_key", "snapshot_year_month", "covid_period").agg(
            *measures()).orderBy("snapshot_date_key")


def _events(kind: str):
    return zero_sum(F.when(F.col("penalty_type") == kind, F.col("penalty_count")))


def penalties_by_year(penalty: DataFrame, f: Filters = ALL) -> DataFrame:
    return penalty.filter(f.penalties()).groupBy("penalty_year").agg(
        _events(V.FINE).alias("fine_events"), _events(V.DENIAL).alias("denial_events"),
        zero_sum("fine_amount_usd").alias("m5_fine_usd"),
        zero_sum("payment_denial_days").alias("denial_days"),
    ).orderBy("penalty_year")


def fines_per_bed_by_state(facility: DataFrame, penalty: DataFrame, f: Filters = ALL) -> DataFrame:
    """Accumulated fines over the beds of the newest period inside the filter."""
    beds = at_latest(facility.filter(f.facility())).groupBy("state_code").agg(
        F.sum("certified_beds").alias("total_beds"), F.count("*").alias("facilities"))
    fines = penalty.filter(f.penalties()).groupBy("state_code").agg(
        zero_sum("fine_amount_usd").alias("m5_fine_usd"), F.sum("penalty_count").alias("events"))
    return join_unique(beds.filter(F.col("total_beds") > 0), fines, "state_code").withColumns({
        "m5_fine_usd": F.coalesce("m5_fine_usd", F.lit(0)),
        "events": F.coalesce("events", F.lit(0)),
    }).withColumn("fine_per_bed", divide(F.col("m5_fine_usd"), F.col("total_beds")))


def penalties_by_state(facility: DataFrame, penalty: DataFrame, f: Filters = ALL,
                       top_n: int = 15) -> DataFrame:
    return fines_per_bed_by_state(facility, penalty, f).orderBy(
        F.col("fine_per_bed").desc_nulls_last(), "state_code").limit(top_n)


def compare(facility: DataFrame, penalty: DataFrame, dimension: str, f: Filters = ALL) -> DataFrame:
    """Measures and fines per group; the two facts meet only after aggregation."""
    groups = at_latest(facility.filter(f.facility())).groupBy(F.col(dimension).alias("grp")).agg(
        *measures())
    fines = penalty.filter(f.penalties()).groupBy(F.col(dimension).alias("grp")).agg(
        zero_sum("fine_amount_usd").alias("m5_fine_usd"), F.sum("penalty_count").alias("m6_events"))
    joined = join_unique(groups, fines, "grp", null_safe=True).withColumns({
        "m5_fine_usd": F.coalesce("m5_fine_usd", F.lit(0)),
        "m6_events": F.coalesce("m6_events", F.lit(0)),
    })
    return joined.withColumn(
        "fine_per_bed", divide(F.col("m5_fine_usd"), F.col("total_certified_beds"))
    ).orderBy(F.col("facilities").desc(), "grp")


def compare_ownership(facility, penalty, f: Filters = ALL) -> DataFrame:
    return compare(facility, penalty, "ownership_group", f)


def compare_chain(facility, penalty, f: Filters = ALL) -> DataFrame:
    return compare(facility, penalty, "chain_size_band", f)


def _banded(facility, f, value, bands, label, *extra) -> DataFrame:
    """Measures per fixed band, in the order of the band's smallest value."""
    banded = with_band(facility.filter(f.facility() & F.col(value).isNotNull()), value, bands, label)
    return banded.groupBy(label).agg(
        *measures(), *extra, F.min(value).alias("__lowest")).orderBy("__lowest").drop("__lowest")


def hprd_bands(facility: DataFrame, f: Filters = ALL) -> DataFrame:
    return _banded(facility, f, "reported_total_nurse_hprd", V.COMPARE_STAFFING_BANDS, "hprd_band",
                   mean("health_inspection_rating").alias("avg_health_rating"))


def turnover_bands(facility: DataFrame, f: Filters = ALL) -> DataFrame:
    return _banded(facility, f, "total_nursing_turnover_pct", V.COMPARE_TURNOVER_BANDS,
                   "turnover_band")


def market(facility: DataFrame, saturation: DataFrame, f: Filters = ALL) -> DataFrame:
    """State measures with beds per elderly attached after aggregation."""
    states = at_latest(facility.filter(f.facility())).groupBy(
        "state_code", "state_name", "census_region").agg(*measures())
    supply = saturation.select("state_code", "pop_65plus", "m10_beds_per_1000_elderly")
    return join_unique(states, supply, "state_code").orderBy(
        F.col("m1_occupancy_rate").desc_nulls_last(), "state_code")


def rating_change(facility: DataFrame, f: Filters = ALL) -> DataFrame:
    """First and last sighting of every facility that was rated at both.

    One aggregate per facility instead of two numbered copies joined.
    """
    at = "snapshot_date_key"
    shown = ["provider_name", "state_code", "ownership_group", "chain_name",
             "overall_rating", "total_nursing_turnover_pct"]
    ends = facility.filter(f.facility(with_period=False)).groupBy("ccn").agg(
        F.min(at).alias("__first_at"), F.max(at).alias("__last_at"),
        F.min_by("overall_rating", at).alias("rating_first"),
        F.max_by(F.struct(*shown), at).alias("__last"))
    return ends.filter(F.col("__first_at") != F.col("__last_at")).select(
        "ccn", "__last.provider_name", "__last.state_code", "__last.ownership_group",
        "__last.chain_name", "rating_first", F.col("__last.overall_rating").alias("rating_last"),
        F.col("__last.total_nursing_turnover_pct").alias("turnover_last"),
    ).filter(F.col("rating_first").isNotNull() & F.col("rating_last").isNotNull()).withColumn(
        "rating_delta", F.col("rating_last") - F.col("rating_first"))


def watchlist(facility: DataFrame, penalty: DataFrame, f: Filters = ALL, limit: int = 40) -> DataFrame:
    """Facilities whose rating fell, worst first, with all their fines."""
    fines = penalty.groupBy("ccn").agg(
        zero_sum("fine_amount_usd").alias("fines_usd"), F.sum("penalty_count").alias("penalty_events"))
    fell = rating_change(facility, f).filter(F.col("rating_delta") < 0)
    return join_unique(fell, fines, "ccn").withColumns({
        "fines_usd": F.coalesce("fines_usd", F.lit(0)),
        "penalty_events": F.coalesce("penalty_events", F.lit(0)),
    }).orderBy("rating_delta", F.col("fines_usd").desc(), "ccn").limit(limit)


def watchlist_summary(facility: DataFrame, f: Filters = ALL) -> DataFrame:
    delta = F.col("rating_delta")
    return rating_change(facility, f).agg(
        count_where(delta < 0).alias("declined"), count_where(delta > 0).alias("improved"),
        count_where(delta == 0).alias("unchanged"), F.count("*").alias("compared"))


def _measures_by_parts(facility: DataFrame, on: list[str]) -> DataFrame:
    """Measures as sums of numerators over sums of weights, one melted row per part."""
    days = F.col("resident_days").cast("double")

    def part(name, numerator, weight=None):
        return F.struct(F.lit(name).alias("m"), numerator.cast("double").alias("a"),
                        (F.lit(1.0) if weight is None else F.when(numerator.isNotNull(), weight.cast("double"))).alias("w"),
                        F.lit(weight is not None).alias("rate"))

    rate = {"m3_nurse_hprd": "reported_total_nurse_hprd", "m3b_rn_hprd": "reported_rn_hprd",
            "m4_turnover_pct": "total_nursing_turnover_pct"}
    plain = {"m2_resident_days": "resident_days", "m8_deficiencies": "cycle1_total_deficiencies",
             "total_certified_beds": "certified_beds", "total_residents": "avg_residents_per_day"}
    parts = [
        part("facilities", F.lit(1)), part("suspect_rows", F.coalesce(F.col("is_suspect"), F.lit(False)).cast("int")),
        F.struct(F.lit("m1_occupancy_rate").alias("m"), F.col("avg_residents_per_day").cast("double").alias("a"),
                 F.col("certified_beds").cast("double").alias("w"), F.lit(True).alias("rate")),
        *[F.struct(F.lit(m).alias("m"), (F.col(c).cast("double") * days).alias("a"), F.when(F.col(c).isNotNull(), days).alias("w"),
                   F.lit(True).alias("rate")) for m, c in rate.items()],
        part("m7_avg_overall_rating", F.col("overall_rating"), F.lit(1)),
        *[part(m, F.col(c)) for m, c in plain.items()]]
    melted = facility.select(*on, F.explode(F.array(*parts)).alias("p")).groupBy(*on, "p.m", "p.rate").agg(
        F.sum("p.a").alias("a"), F.sum("p.w").alias("w"))
    value = F.when(~F.col("rate"), F.col("a")).when(F.col("w") != 0, F.col("a") / F.col("w"))
    return melted.groupBy(*on).agg(*[F.max(F.when(F.col("m") == p, value)).alias(p) for p in [
        "facilities", "suspect_rows", "m1_occupancy_rate", *rate, "m7_avg_overall_rating", *plain]])


def measure_parity(facility: DataFrame, view: DataFrame) -> DataFrame:
    """Largest difference between a grouped view and measures built up by hand.

    The other side shares no code with the view: rows are melted to (measure,
    numerator, weight) and each measure is the quotient of two sums.
    """
    from tidemark.functions.measures import MEASURE_NAMES

    on = ["snapshot_date_key", "state_code"]
    mine = _measures_by_parts(facility, on)
    theirs = view.select(*on, *[F.col(m).alias(f"v_{m}") for m in MEASURE_NAMES])
    both = mine.join(theirs, on, "full_outer")
    gaps = []
    for m in MEASURE_NAMES:
        a, b = F.col(m).cast("double"), F.col(f"v_{m}").cast("double")
        gap = F.when(~(a.isNull() & b.isNull()), F.abs(F.coalesce(a, F.lit(0.0)) - F.coalesce(b, F.lit(0.0))))
        gaps.append(F.coalesce(F.max(gap), F.lit(0.0)).alias(m))
    wide = both.agg(*gaps, F.count("*").alias("groups"))
    return wide.unpivot("groups", list(MEASURE_NAMES), "measure", "max_difference").withColumn(
        "within_tolerance", F.col("max_difference") < 1e-9)
