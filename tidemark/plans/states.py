"""Question 1: which state is the most attractive market."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark import fixed_values as V
from tidemark.functions.bands import band
from tidemark.functions.measures import divide, mean, ratio_of_sums, zero_sum
from tidemark.operators.lookups import join_unique
from tidemark.operators.ordering import exact_quantiles, one_row, percentile_rank
from tidemark.plans.roster import at_period


def available_periods(facility: DataFrame) -> DataFrame:
    return facility.groupBy(
        F.col("snapshot_date_key").alias("period_key"), F.col("snapshot_date").alias("period"),
        F.col("snapshot_year").alias("year")).agg(F.count("*").alias("facilities")).orderBy("period")


def nearest_year(population: DataFrame, year) -> DataFrame:
    """The population year closest to a year; the earlier one on a tie. One row."""
    distance = F.abs(F.col("year") - year)
    return population.select("year").distinct().agg(
        F.min_by("year", F.struct(distance, F.col("year"))).alias("population_year"))


def nearest_years(periods: DataFrame, population: DataFrame) -> DataFrame:
    """The nearest population year of every period year.

    Years are few: each period year looks through one sorted array of years.
    """
    years = population.select("year").distinct().agg(
        F.sort_array(F.collect_set("year")).alias("y"))
    distinct = periods.select("year").distinct().withColumn("__years", one_row(years, "y"))
    scored = F.transform("__years", lambda y: F.struct(
        F.abs(y - F.col("year")).alias("distance"), y.alias("year")))
    return distinct.withColumn("__best", F.array_min(scored)).select(
        "year", F.col("__best.year").alias("population_year"),
        (F.col("__best.distance") == 0).alias("exact"))


def state_market(facility: DataFrame, population: DataFrame, period: int | None = None,
                 exclude_suspect: bool = True, min_facilities: int = 10) -> DataFrame:
    """Supply, occupancy and competition per state, with the nearest population year.

    Small states and states without population stay, flagged.
    """
    chosen = at_period(facility, period)
    rows = chosen.filter(F.col("state_code") != V.UNKNOWN_LABEL)
    if exclude_suspect:
        rows = rows.filter(~F.col("is_suspect"))
    states = rows.groupBy("state_code").agg(
        F.max("state_name").alias("state_name"), F.max("census_region").alias("census_region"),
        F.count("*").alias("facilities"), F.sum("certified_beds").alias("beds"),
        ratio_of_sums("avg_residents_per_day", "certified_beds").alias("occupancy"),
        mean("overall_rating").alias("avg_overall_rating"),
        F.count("overall_rating").alias("rated_facilities"),
        mean("reported_total_nurse_hprd").alias("avg_nurse_hprd"))
    period_year = chosen.agg(F.max("snapshot_year")).scalar()
    wanted = nearest_year(population, period_year).scalar()
    people = population.filter(F.col("year") == wanted).select("state_code", "pop_65plus")
    out = join_unique(states, people, "state_code")
    return out.select(
        "state_code", "state_name", "census_region", "facilities", "beds", "pop_65plus",
        divide(F.col("beds"), F.col("pop_65plus") / 1000.0).alias("beds_per_1k_65plus"),
        "occupancy", "avg_overall_rating", "rated_facilities", "avg_nurse_hprd",
        (F.col("facilities") < min_facilities).alias("too_few"),
        F.col("pop_65plus").isNull().alias("no_population"))


def opportunity_score(market: DataFrame) -> DataFrame:
    """Mean of three percentile ranks among states that can be ranked."""
    eligible = ~F.col("too_few") & ~F.col("no_population")
    parts = {"pct_supply": ("beds_per_1k_65plus", False), "pct_demand": ("occupancy", True),
             "pct_contest": ("avg_overall_rating", False)}
    out = market
    for name, (measure, ascending) in parts.items():
        ranked = out.withColumn("__v", F.when(eligible, F.col(measure)))
        out = percentile_rank(ranked, "__v", name, ascending=ascending).drop("__v")
    known = reduce(add, [F.col(p).isNotNull().cast("int") for p in parts])
    total = reduce(add, [F.coalesce(p, F.lit(0.0)) for p in parts])
    out = out.withColumn("opportunity_score", F.when(eligible & (known > 0), total / known))
    score = F.col("opportunity_score")
    # 12 digits: equal scores may differ in the last bit of their sum
    place = F.rank().over(W.orderBy(F.round(score, 12).desc_nulls_last()))
    return out.withColumn("rank", F.when(score.isNotNull(), place)).orderBy(
        score.desc_nulls_last(), "state_code")


def top_opportunities(scored: DataFrame, n: int = 10) -> DataFrame:
    return scored.filter(F.col("opportunity_score").isNotNull()).orderBy(
        F.col("opportunity_score").desc(), "state_code").limit(n)


def national_baseline(market: DataFrame) -> DataFrame:
    """National figures to read a state against, weighted as their measures are."""
    reached = ~F.col("no_population")
    weighted = lambda value, weight: divide(
        F.sum(F.col(value) * F.col(weight)), F.sum(weight))
    return market.agg(
        zero_sum("facilities").alias("facilities"), zero_sum("beds").alias("beds"),
        zero_sum("pop_65plus").alias("pop_65plus"),
        divide(F.sum(F.when(reached, F.col("beds"))), F.sum("pop_65plus") / 1000.0).alias(
            "beds_per_1k_65plus"),
        weighted("occupancy", "beds").alias("occupancy"),
        weighted("avg_overall_rating", "rated_facilities").alias("avg_overall_rating"),
        F.count("*").alias("states"),
        F.count(F.when(~F.col("too_few") & reached, 1)).alias("states_ranked"))


def market_quadrant(market: DataFrame) -> DataFrame:
    """Rating bin of every state and its side of the two median lines."""
    cut = lambda c: one_row(exact_quantiles(market, c, [0.5], bounded=True), "cuts")[0]
    frame = market.withColumns({
        "median_beds_per_1k": cut("beds_per_1k_65plus"), "median_occupancy": cut("occupancy")})
    underserved = F.col("beds_per_1k_65plus") < F.col("median_beds_per_1k")
    full = F.col("occupancy") > F.col("median_occupancy")
    return frame.select(
        "state_code", "facilities", "beds_per_1k_65plus", "occupancy", "avg_overall_rating",
        band("avg_overall_rating", V.MARKET_RATING_BINS, right_closed=True).alias("rating_bin"),
        "median_beds_per_1k", "median_occupancy", (underserved & full).alias("attractive_corner"))
