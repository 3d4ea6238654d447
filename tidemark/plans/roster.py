"""One row per facility of a period, with its penalties already summed.

Most star-based questions start here. Penalties are reduced to the facility
before they meet the roster, so a facility's beds are never repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import fixed_values as V
from tidemark.functions.measures import count_where, divide, zero_sum
from tidemark.operators.lookups import join_unique
from tidemark.plans.semantic import Filters, latest_period

NO_SUSPECTS = Filters(include_suspect=False)
SHORT = {
    "certified_beds": "beds", "avg_residents_per_day": "residents",
    "reported_total_nurse_hprd": "nurse_hprd", "reported_rn_hprd": "rn_hprd",
    "total_nursing_turnover_pct": "turnover_pct", "overall_rating": "rating",
    "cycle1_total_deficiencies": "deficiencies",
}


def at_period(facility: DataFrame, period: int | None) -> DataFrame:
    """Rows of one period; the newest of the whole fact when none is named."""
    key = F.lit(period) if period is not None else latest_period(facility)
    return facility.filter(F.col("snapshot_date_key") == key)


def short_names(frame: DataFrame) -> DataFrame:
    return frame.withColumnsRenamed({k: v for k, v in SHORT.items() if k in frame.columns})


def period_end(facility: DataFrame, period: int | None) -> Column:
    return at_period(facility, period).agg(F.max("snapshot_date")).scalar()


def in_window(penalty: DataFrame, end: Column, months: int = V.FINES_WINDOW_MONTHS) -> DataFrame:
    """Penalties of the window that ends at a date, both ends included.

    The bounds on the year follow from those on the date; they prune partitions.
    """
    date, year, start = F.col("penalty_date"), F.col("penalty_year"), F.add_months(end, -months)
    return penalty.filter(
        (date >= start) & (date <= end) & (year >= F.year(start)) & (year <= F.year(end)))


def fines_by_facility(penalty: DataFrame) -> DataFrame:
    return penalty.groupBy("ccn").agg(
        F.sum("fine_amount_usd").alias("fine_total"),
        count_where(F.col("fine_amount_usd") > 0).alias("fine_events"),
        F.sum("payment_denial_days").alias("denial_days"))


def facility_roster(facility: DataFrame, penalty: DataFrame, period: int | None = None,
                    f: Filters = NO_SUSPECTS) -> DataFrame:
    rows = short_names(at_period(facility, period).filter(f.facility(with_period=False)))
    fines = fines_by_facility(in_window(penalty, period_end(facility, period)))
    zero = F.lit(0).cast("bigint")
    return join_unique(rows, fines, "ccn").withColumns({
        c: F.coalesce(c, zero) for c in ("fine_total", "fine_events", "denial_days")
    }).withColumns({
        "fines_per_bed": divide(F.col("fine_total"), F.col("beds")),
        "was_fined": F.col("fine_total") > 0,
    })


def roster_context(facility: DataFrame, penalty: DataFrame, period: int | None = None,
                   f: Filters = NO_SUSPECTS) -> DataFrame:
    """What a roster covers: period, fines window, size. One row."""
    rows = at_period(facility, period)
    inside = rows.filter(f.facility(with_period=False)).agg(
        F.count("*").alias("facilities"), zero_sum("certified_beds").alias("beds"))
    ends = rows.agg(F.max("snapshot_date_key").alias("k"), F.max("snapshot_date").alias("d"))
    end = ends.select("d").scalar()
    return inside.select(
        ends.select("k").scalar().alias("period_key"), end.alias("window_end"),
        F.add_months(end, -V.FINES_WINDOW_MONTHS).alias("window_start"), "facilities", "beds")


def drill_top_n(roster: DataFrame, state: str, n: int = 25) -> DataFrame:
    """The most fined facilities of one state."""
    return roster.filter(F.col("state_code") == state).orderBy(
        F.col("fine_total").desc(), "ccn").limit(n).select(
        "ccn", "provider_name", "ownership_group", "chain_size_band", "beds", "rating",
        "nurse_hprd", "turnover_pct", "fine_total", "fine_events", "fines_per_bed")
