"""The numbers behind each finding, one row per finding.

Columns: bq, strength, label_a, label_b, value_a, value_b, gap, n. A finding the
data cannot support is still returned, with strength ``blocked``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark import fixed_values as V
from tidemark.functions.measures import count_where, divide
from tidemark.operators.ordering import exact_quantiles, one_row
from tidemark.plans.compare import (
    compare_chain, compare_ownership, fines_per_bed_by_state, hprd_bands, market, trend,
    turnover_bands, watchlist, watchlist_summary,
)
from tidemark.plans.semantic import Filters

ALL = Filters()


def _finding(frame: DataFrame, bq: str, strength: Column, label_a, label_b, value_a, value_b, gap, n) -> DataFrame:
    blocked = strength == "blocked"
    keep = lambda c, kind: F.when(~blocked, c).cast(kind)
    return frame.select(
        F.lit(bq).alias("bq"), strength.alias("strength"),
        keep(label_a, "string").alias("label_a"), keep(label_b, "string").alias("label_b"),
        keep(value_a, "double").alias("value_a"), keep(value_b, "double").alias("value_b"),
        keep(gap, "double").alias("gap"), F.coalesce(n, F.lit(0)).cast("bigint").alias("n"))


def _solid(condition: Column) -> Column:
    return F.when(condition, "solid").otherwise("blocked")


def _extremes(groups: DataFrame, measure: str) -> DataFrame:
    """Highest and lowest group of a measure; the larger group wins a tie."""
    c = F.col
    return groups.agg(
        F.count("*").alias("groups"), F.sum("facilities").alias("n"),
        F.max_by("grp", F.struct(measure, "facilities", "grp")).alias("high"),
        F.max(measure).alias("high_value"),
        F.min_by("grp", F.struct(c(measure), -c("facilities"), c("grp"))).alias("low"),
        F.min(measure).alias("low_value"))


def finding_group_gap(facility: DataFrame, penalty: DataFrame, f: Filters = ALL) -> DataFrame:
    groups = compare_ownership(facility, penalty, f).filter(
        (F.col("grp") != V.UNKNOWN_LABEL) & F.col("m7_avg_overall_rating").isNotNull())
    x = _extremes(groups, "m7_avg_overall_rating")
    return _finding(x, "BQ2", _solid(F.col("groups") >= 2), F.col("high"), F.col("low"),
                    F.col("high_value"), F.col("low_value"),
                    F.col("high_value") - F.col("low_value"), F.col("n"))


def finding_scale(facility: DataFrame, penalty: DataFrame, f: Filters = ALL,
                  min_group: int = V.FINDING_MIN_GROUP) -> DataFrame:
    groups = compare_chain(facility, penalty, f).filter(
        F.col("m3_nurse_hprd").isNotNull() & (F.col("facilities") >= min_group))
    x = _extremes(groups, "m3_nurse_hprd")
    return _finding(x, "BQ8", _solid(F.col("groups") >= 2), F.col("low"), F.col("high"),
                    F.col("low_value"), F.col("high_value"),
                    F.col("high_value") - F.col("low_value"), F.col("n"))


def _steepest(bands: DataFrame, label: str, edges: list[tuple], bq: str, rising: bool) -> DataFrame:
    """The largest step of the mean rating between neighbouring bands."""
    from tidemark.functions.bands import label_order

    rating = F.col("m7_avg_overall_rating")
    known = bands.filter(rating.isNotNull()).withColumn(
        "__o", label_order(label, [e[2] for e in edges]))
    line = W.orderBy("__o")
    step = rating - F.lag(rating).over(line)
    stepped = known.withColumns({
        "__step": step if rising else -step,
        "__prev": F.lag(label).over(line), "__prev_value": F.lag(rating).over(line)})
    best = F.struct(F.col("__step"), -F.col("__o"))
    steps = F.when(F.col("__step").isNotNull(), best)
    x = stepped.agg(
        F.count("*").alias("bands"), F.sum("facilities").alias("n"),
        F.max_by(F.struct(F.col(label).alias("band"), rating.alias("value"), F.col("__prev").alias("prev"),
                          F.col("__prev_value").alias("prev_value")), steps).alias("b"),
        F.max("__step").alias("step"))
    return _finding(x, bq, _solid(F.col("bands") >= 3), F.col("b.prev"), F.col("b.band"),
                    F.col("b.prev_value"), F.col("b.value"), F.col("step"), F.col("n"))


def finding_marginal_gain(facility: DataFrame, f: Filters = ALL) -> DataFrame:
    return _steepest(hprd_bands(facility, f), "hprd_band", V.COMPARE_STAFFING_BANDS, "BQ3", True)


def finding_cliff(facility: DataFrame, f: Filters = ALL) -> DataFrame:
    return _steepest(turnover_bands(facility, f), "turnover_band", V.COMPARE_TURNOVER_BANDS, "BQ4", False)


def finding_concentration(facility: DataFrame, penalty: DataFrame, f: Filters = ALL) -> DataFrame:
    """Share of five states; hardest state against the softest of the larger half.

    Taken over all states that have a fine.
    """
    states = fines_per_bed_by_state(facility, penalty, f).filter(F.col("m5_fine_usd") > 0)
    median = one_row(exact_quantiles(states, "total_beds", [0.5], bounded=True), "cuts")[0]
    ranked = states.withColumns({
        "__m": F.row_number().over(W.orderBy(F.col("m5_fine_usd").desc(), "state_code")),
        "__larger": F.col("total_beds") >= median})
    rate, state = F.col("fine_per_bed"), F.col("state_code")
    x = ranked.agg(
        F.count("*").alias("states"), F.sum("m5_fine_usd").alias("total"),
        F.sum(F.when(F.col("__m") <= 5, F.col("m5_fine_usd"))).alias("top5"),
        F.min_by("state_code", F.struct(-rate, state)).alias("hard"), F.max(rate).alias("hard_rate"),
        F.min_by("state_code", F.when(F.col("__larger"), F.struct(rate, state))).alias("soft"),
        F.min(F.when(F.col("__larger"), rate)).alias("soft_rate"))
    several = F.col("states") >= 2
    strength = F.when(several, "solid").when(F.col("states") == 1, "tentative").otherwise("blocked")
    return _finding(x, "BQ7", strength, F.col("hard"), F.when(several, F.col("soft")),
                    F.col("hard_rate"), F.when(several, F.col("soft_rate")),
                    divide(F.col("top5"), F.col("total")), F.col("states"))


def finding_trend(facility: DataFrame, f: Filters = ALL) -> DataFrame:
    """Occupancy at the first and last period; the gap is in percentage points."""
    key, label, occupancy = "snapshot_date_key", "snapshot_year_month", "m1_occupancy_rate"
    x = trend(facility, f).agg(
        F.count("*").alias("periods"),
        *[pick(F.struct(label, occupancy), key).alias(n)
          for n, pick in (("a", F.min_by), ("b", F.max_by))])
    strength = F.when(F.col("periods") >= 2, "tentative").otherwise("blocked")
    return _finding(x, "BQ5", strength, F.col(f"a.{label}"), F.col(f"b.{label}"),
                    F.col(f"a.{occupancy}"), F.col(f"b.{occupancy}"),
                    (F.col(f"b.{occupancy}") - F.col(f"a.{occupancy}")) * 100, F.col("periods"))


def finding_decline(facility: DataFrame, penalty: DataFrame, f: Filters = ALL) -> DataFrame:
    """Facilities that fell, and how many of the five worst were fined."""
    fined = watchlist(facility, penalty, f, limit=5).agg(
        count_where(F.col("fines_usd") > 0).alias("fined")).scalar()
    x = watchlist_summary(facility, f).withColumn("fined", fined)
    return _finding(x, "BQ6", _solid(F.col("compared") > 0), F.lit("declined"),
                    F.lit("fined among the five worst"), F.col("declined"), F.col("fined"),
                    divide(F.col("declined"), F.col("compared")) * 100, F.col("compared"))


def finding_market(facility: DataFrame, saturation: DataFrame, f: Filters = ALL,
                   min_facilities: int = V.FINDING_MIN_MARKET) -> DataFrame:
    """Tightest and loosest three states; fewest and most beds per elderly person.

    Two rows: occupancy, and beds per 1,000 elderly (gap: the national figure).
    """
    states = market(facility, saturation, f).filter(F.col("facilities") >= min_facilities)
    return _both_ends(states, "m1_occupancy_rate", True, "BQ1 occupancy").unionByName(
        _both_ends(states.filter(F.col("m10_beds_per_1000_elderly").isNotNull()),
                   "m10_beds_per_1000_elderly", False, "BQ1 beds per 1000"))


def _both_ends(states: DataFrame, measure: str, high_first: bool, bq: str) -> DataFrame:
    m, state = F.col(measure), F.col("state_code")
    ranked = states.withColumns({
        "__up": F.row_number().over(W.orderBy(m.asc_nulls_last(), state)),
        "__down": F.row_number().over(W.orderBy(m.desc_nulls_last(), state))})
    three = lambda place: F.concat_ws(", ", F.transform(
        F.sort_array(F.collect_list(F.when(F.col(place) <= 3, F.struct(place, "state_code")))),
        lambda s: s["state_code"]))
    ends = [("__up", F.min(m)), ("__down", F.max(m))]
    if high_first:
        ends.reverse()
    x = ranked.agg(
        F.count("*").alias("n"), three(ends[0][0]).alias("a"), three(ends[1][0]).alias("b"),
        ends[0][1].alias("va"), ends[1][1].alias("vb"),
        divide(F.sum("total_certified_beds"), F.sum("pop_65plus") / 1000.0).alias("national"))
    gap = F.abs(F.col("va") - F.col("vb")) if high_first else F.col("national")
    return _finding(x, bq, _solid(F.col("n") > 0), F.col("a"), F.col("b"), F.col("va"), F.col("vb"),
                    gap, F.col("n"))


def all_findings(facility: DataFrame, penalty: DataFrame, saturation: DataFrame,
                 f: Filters = ALL) -> DataFrame:
    parts = [
        finding_group_gap(facility, penalty, f), finding_scale(facility, penalty, f),
        finding_marginal_gain(facility, f), finding_cliff(facility, f),
        finding_concentration(facility, penalty, f), finding_trend(facility, f),
        finding_decline(facility, penalty, f), finding_market(facility, saturation, f),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
