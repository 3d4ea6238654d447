"""Question 6: the watchlist score, its list and its back-test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import fixed_values as V
from tidemark.functions.measures import count_where, divide, mean, share
from tidemark.operators.lookups import join_unique
from tidemark.operators.ordering import quantile_cuts
from tidemark.plans.gradients import per_base
from tidemark.plans.roster import fines_by_facility, in_window, short_names

LISTED = [
    "ccn", "provider_name", "state_code", "ownership_group", "chain_size_band", "beds", "rating",
    "rating_change", "deficiencies", "deficiency_change", "nurse_hprd", "turnover_pct",
    "fine_total", "fines_per_bed", "special_focus_status", "abuse_icon", "risk_score",
    "risk_reasons",
]


def risk_score(roster: DataFrame) -> DataFrame:
    """Five flags, their weighted sum and the reasons in words.

    Cut points are the 75th percentiles of the roster given, so a filtered view
    scores facilities against their own peers.
    """
    fines_cut = quantile_cuts(roster, "fines_per_bed", [0.75])[0]
    defic_cut = quantile_cuts(roster, "deficiencies", [0.75])[0]
    sure = lambda condition: F.coalesce(condition, F.lit(False))
    flags = {
        "flag_special_focus": sure(F.col("special_focus_status").isin(V.FOCUS_VALUES)),
        "flag_low_rating": sure(F.col("rating") <= 2),
        "flag_prior_fine": sure(F.col("fines_per_bed") >= F.col("__fines_cut")),
        "flag_deficiencies": sure(F.col("deficiencies") >= F.col("__defic_cut")),
        "flag_thin_staffing": sure(F.col("nurse_hprd") < V.STAFFING_FLOOR),
    }
    flagged = roster.withColumns({"__fines_cut": fines_cut, "__defic_cut": defic_cut}).withColumns(
        flags).drop("__fines_cut", "__defic_cut")
    score = sum((F.col(f).cast("int") * w for f, w, _ in V.RISK_FLAGS), F.lit(0))
    reasons = F.concat_ws(", ", *[F.when(F.col(f), label) for f, _, label in V.RISK_FLAGS])
    return flagged.withColumns({
        "risk_score": score.cast("int"),
        "risk_reasons": F.when(reasons == "", "-").otherwise(reasons),
    })


def with_trajectory(scored: DataFrame, facility: DataFrame, period: int | None = None) -> DataFrame:
    """Change against the first period of the same year; null at that period itself."""
    at = F.col("snapshot_date_key")
    chosen = (F.lit(period) if period is not None
              else facility.agg(F.max("snapshot_date_key")).scalar())
    year = lambda key: F.floor(key / 10000)
    start = facility.filter(year(at) == year(chosen)).agg(F.min("snapshot_date_key")).scalar()
    before = short_names(facility.filter((at == start) & (at != chosen))).select(
        "ccn", F.col("rating").alias("rating_before"),
        F.col("deficiencies").alias("deficiencies_before"))
    return join_unique(scored, before, "ccn").withColumns({
        "rating_change": F.col("rating") - F.col("rating_before"),
        "deficiency_change": F.col("deficiencies") - F.col("deficiencies_before"),
    }).withColumn("declining", F.coalesce(F.col("rating_change") < 0, F.lit(False)))


def risk_watchlist(trajectory: DataFrame, top_n: int = 50) -> DataFrame:
    return trajectory.orderBy(
        F.col("risk_score").desc(), F.col("declining").desc(),
        F.col("fines_per_bed").desc_nulls_last(), "ccn").limit(top_n).select(*LISTED)


def risk_counts(trajectory: DataFrame) -> DataFrame:
    return trajectory.agg(
        F.count("*").alias("facilities"),
        count_where(F.col("risk_score") > 0).alias("flagged_any"),
        count_where(F.col("risk_score") >= V.RISK_HIGH).alias("flagged_high"),
        count_where(F.col("declining")).alias("declining_count"),
        count_where(F.col("flag_special_focus")).alias("special_focus_count"),
        count_where(F.col("flag_thin_staffing")).alias("below_floor_count"))


def with_outcome(scored: DataFrame, facility: DataFrame, penalty: DataFrame, outcome_period: int,
                 window_end: Column, exclude_suspect: bool = True) -> DataFrame:
    """What became of every scored facility: left, fined, how rated."""
    later = facility.filter(F.col("snapshot_date_key") == outcome_period)
    if exclude_suspect:
        later = later.filter(~F.col("is_suspect"))
    later = short_names(later).select(
        "ccn", F.col("rating").alias("rating_later"), F.col("beds").alias("beds_later"))
    fines = fines_by_facility(in_window(penalty, window_end)).select(
        "ccn", F.col("fine_total").alias("fines_later"))
    joined = join_unique(join_unique(scored, later, "ccn"), fines, "ccn")
    exited = F.col("beds_later").isNull()
    return joined.withColumns({
        "exited": exited,
        "fines_later": F.when(~exited, F.coalesce("fines_later", F.lit(0))),
    }).withColumn("fined_later", F.coalesce(F.col("fines_later"), F.lit(0)) > 0)


def risk_backtest(outcome: DataFrame, thin: int = V.THIN_BUCKET) -> DataFrame:
    """Outcomes per score; scores with few facilities are marked."""
    alive = ~F.col("exited")
    return outcome.groupBy("risk_score").agg(
        F.count("*").alias("facilities"),
        (F.avg(F.when(alive, F.col("fined_later").cast("int"))) * 100).alias("pct_fined_later"),
        per_base(F.when(alive, F.col("fines_later")), F.when(alive, F.col("beds_later"))).alias(
            "fines_per_bed_later"),
        mean(F.when(alive, F.col("rating_later"))).alias("avg_rating_later"),
        share(F.col("exited"), 100.0).alias("pct_exited"),
        mean("rating").alias("avg_rating_before"),
    ).withColumn("thin", F.col("facilities") < thin).orderBy("risk_score")


def risk_lift(outcome: DataFrame) -> DataFrame:
    """The group at or above the 95th percentile of the score against everyone."""
    cut = quantile_cuts(outcome, "risk_score", [0.95], bounded=True)[0]
    alive = ~F.col("exited")
    top = F.col("risk_score") >= F.col("cut")
    fined = lambda c: F.avg(F.when(c, F.col("fined_later").cast("int"))) * 100
    money = lambda c: per_base(F.when(c, F.col("fines_later")), F.when(c, F.col("beds_later")))
    out = outcome.withColumn("cut", cut).agg(
        F.count("*").alias("population"), F.max("cut").alias("top_cut"),
        fined(alive).alias("base_pct_fined"),
        divide(F.sum(F.when(alive, F.col("fines_later"))),
               F.sum(F.when(alive, F.col("beds_later")))).alias("base_fines_per_bed"),
        count_where(top).alias("top_facilities"),
        fined(alive & top).alias("top_pct_fined"), money(alive & top).alias("top_fines_per_bed"),
        (F.avg(F.when(top, F.col("exited").cast("int"))) * 100).alias("top_pct_exited"),
        share(F.col("exited"), 100.0).alias("base_pct_exited"))
    return out.withColumns({
        "lift_incidence": divide(F.col("top_pct_fined"), F.col("base_pct_fined")),
        "lift_dollars": divide(F.col("top_fines_per_bed"), F.col("base_fines_per_bed")),
    })
