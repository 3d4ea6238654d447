"""Question 7: when and where penalties concentrate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark import fixed_values as V
from tidemark.functions.measures import count_where, divide, mean, zero_sum
from tidemark.operators.lookups import join_unique
from tidemark.plans.roster import at_period, in_window, period_end


def fines_timeline(penalty: DataFrame, states: list[str] | None = None,
                   incomplete_tail: int = 2) -> DataFrame:
    """Penalties by quarter and type with their era; gaps are computed, not assumed."""
    rows = penalty.filter(F.col("state_code").isin(list(states))) if states else penalty
    cells = rows.groupBy(
        F.col("penalty_year").alias("year"), F.col("penalty_quarter").alias("quarter"),
        "penalty_type").agg(
            F.count("*").alias("events"), zero_sum("fine_amount_usd").alias("fines"),
            zero_sum("payment_denial_days").alias("denial_days"),
            F.count_distinct("ccn").alias("facilities"))
    # one pass over the events: eras are numbered on the aggregated cells
    line = W.orderBy("__i")
    run = W.partitionBy("era").orderBy(F.col("__i").desc())
    indexed = cells.withColumn("__i", F.col("year") * 4 + F.col("quarter"))
    gap = F.coalesce(F.col("__i") - F.lag("__i").over(line) > 1, F.lit(False)).cast("int")
    eras = indexed.withColumn("__gap", gap).withColumn("era", F.sum("__gap").over(
        line.rangeBetween(W.unboundedPreceding, W.currentRow)).cast("int"))
    tail = F.dense_rank().over(run) <= incomplete_tail
    return eras.withColumn("incomplete", tail).select(
        "year", "quarter", F.concat("year", F.lit("-Q"), "quarter").alias("year_quarter"),
        "penalty_type", "events", "fines", "denial_days", "facilities", "era", "incomplete",
    ).orderBy("year", "quarter", "penalty_type")


def avg_fine_by_year(penalty: DataFrame, states: list[str] | None = None) -> DataFrame:
    rows = penalty.filter(F.col("state_code").isin(list(states))) if states else penalty
    return rows.filter(F.col("penalty_type") == V.FINE).groupBy(
        F.col("penalty_year").alias("year")).agg(
            F.count("*").alias("events"), zero_sum("fine_amount_usd").alias("fines"),
    ).withColumn("avg_fine", divide(F.col("fines"), F.col("events"))).orderBy("year")


def state_enforcement(facility: DataFrame, penalty: DataFrame, period: int | None = None,
                      exclude_suspect: bool = True, min_facilities: int = 10) -> DataFrame:
    """Fines of three years per bed and state; penalties keep their own state."""
    rows = at_period(facility, period)
    if exclude_suspect:
        rows = rows.filter(~F.col("is_suspect"))
    beds = rows.groupBy("state_code", "state_name", "census_region").agg(
        F.count("*").alias("facilities"), F.sum("certified_beds").alias("beds"),
        mean("overall_rating").alias("avg_rating")).filter(F.col("facilities") >= min_facilities)
    fined = in_window(penalty, period_end(facility, period)).groupBy("state_code").agg(
        F.sum("fine_amount_usd").alias("fines"),
        count_where(F.col("fine_amount_usd") > 0).alias("fine_events"),
        F.count_distinct("ccn").alias("fined_facilities"),
        F.sum("payment_denial_days").alias("denial_days"))
    counts = ("fines", "fine_events", "fined_facilities", "denial_days")
    return join_unique(beds, fined, "state_code").withColumns({
        c: F.coalesce(c, F.lit(0)).cast("bigint") for c in counts
    }).withColumns({
        "fines_per_bed": divide(F.col("fines"), F.col("beds")),
        "pct_facilities_fined": divide(F.col("fined_facilities"), F.col("facilities")) * 100,
        "avg_fine": divide(F.col("fines"), F.col("fine_events")),
    }).orderBy(F.col("fines_per_bed").desc_nulls_last(), "state_code")


def enforcement_summary(states: DataFrame) -> DataFrame:
    """Totals, concentration in five states, and the spread between extremes."""
    by_money = W.orderBy(F.col("fines").desc(), "state_code")
    by_rate = W.orderBy(F.col("fines_per_bed").desc_nulls_last(), "state_code")
    ranked = states.withColumns({
        "__m": F.row_number().over(by_money), "__r": F.row_number().over(by_rate)})
    top = F.col("__m") <= 5
    part = lambda c: divide(F.sum(F.when(top, F.col(c))), F.sum(c)) * 100
    out = ranked.agg(
        F.count("*").alias("states"), zero_sum("fines").alias("total_fines"),
        divide(F.sum("fines"), F.sum("beds")).alias("national_fines_per_bed"),
        (divide(F.sum("fined_facilities"), F.sum("facilities")) * 100).alias("national_pct_fined"),
        part("fines").alias("top5_share_of_dollars"), part("beds").alias("top5_share_of_beds"),
        F.min_by("state_code", "__r").alias("hardest"),
        F.min_by("fines_per_bed", "__r").alias("hardest_per_bed"),
        F.max_by("state_code", "__r").alias("softest"),
        F.max_by("fines_per_bed", "__r").alias("softest_per_bed"))
    return out.withColumn("spread", F.col("hardest_per_bed") / F.greatest("softest_per_bed", F.lit(1.0)))
