"""Questions 3 and 4: staffing hours and turnover against quality and cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark import fixed_values as V
from tidemark.functions.bands import label_order, quartile_bin, with_band
from tidemark.functions.measures import count_where, divide, mean, share, zero_sum
from tidemark.operators.ordering import quantile_cuts

STEPPED = ["avg_rating", "health_inspection_rating", "fines_per_bed", "occupancy"]


def per_base(numerator, denominator) -> Column:
    """Ratio of sums over a base of at least 1, so an empty base gives 0."""
    return zero_sum(numerator).cast("double") / F.greatest(zero_sum(denominator), F.lit(1))


def weighted_per_base(value, weight) -> Column:
    value, weight = (F.col(c) for c in (value, weight))
    return per_base(value * weight, F.when(value.isNotNull(), weight))


def band_measures() -> list[Column]:
    rating = F.col("rating")
    return [
        F.count("*").alias("facilities"), zero_sum("beds").alias("beds"),
        mean("rating").alias("avg_rating"),
        share(rating <= 2, 100.0).alias("pct_1_2_star"),
        share(rating >= 4, 100.0).alias("pct_4_5_star"),
        mean("health_inspection_rating").alias("health_inspection_rating"),
        mean("deficiencies").alias("deficiencies"),
        per_base("fine_total", "beds").alias("fines_per_bed"),
        share(F.col("was_fined"), 100.0).alias("pct_fined"),
        per_base("residents", "beds").alias("occupancy"),
        weighted_per_base("nurse_hprd", "residents").alias("nurse_hprd"),
        weighted_per_base("turnover_pct", "residents").alias("turnover_pct"),
    ]


def gradient(roster: DataFrame, value: str, bands: list[tuple]) -> DataFrame:
    """Measures per band and the change between neighbouring bands that exist.

    Facilities outside every band stay out.
    """
    banded = with_band(roster, value, bands).filter(F.col("band").isNotNull())
    levels = banded.groupBy("band", "band_ord").agg(*band_measures())
    neighbours = W.orderBy("band_ord")      # one row per band
    return levels.withColumns({
        f"d_{c}": F.col(c) - F.lag(c).over(neighbours) for c in STEPPED}).orderBy("band_ord")


def staffing_gradient(roster: DataFrame) -> DataFrame:
    return gradient(roster, "nurse_hprd", V.STAFFING_BANDS)


def staffing_floor(roster: DataFrame) -> DataFrame:
    """Facilities below and at or above the staffing floor; both rows always exist."""
    sides = [("below", F.col("nurse_hprd") < V.STAFFING_FLOOR),
             ("above", F.col("nurse_hprd") >= V.STAFFING_FLOOR)]
    names = ["facilities", "health_inspection_rating", "fines_per_bed", "pct_fined", "avg_rating",
             "deficiencies"]

    def measures_of(side):
        only = lambda c: F.when(side, F.col(c))
        return [
            count_where(side), mean(only("health_inspection_rating")),
            per_base(only("fine_total"), only("beds")),
            F.avg(F.when(side, F.col("was_fined").cast("int"))) * 100,
            mean(only("rating")), mean(only("deficiencies")),
        ]

    wide = roster.agg(
        F.count("nurse_hprd").alias("measured_facilities"),
        (F.count("*") - F.count("nurse_hprd")).alias("missing_hprd"),
        *[F.struct(*[m.alias(n) for m, n in zip(measures_of(s), names)]).alias(label)
          for label, s in sides])
    rows = F.array(*[F.struct(F.lit(label).alias("side"), *[F.col(f"{label}.{n}").alias(n) for n in names])
                     for label, _ in sides])
    return wide.select("measured_facilities", "missing_hprd", F.inline(rows)).withColumns({
        "staffing_floor": F.lit(V.STAFFING_FLOOR),
        "pct_of_measured": divide(F.col("facilities"), F.col("measured_facilities")) * 100,
    })


def with_hour_quartile(roster: DataFrame) -> DataFrame:
    """Quartile of staffing hours over the whole frame: exact cuts, right-closed."""
    cuts = quantile_cuts(roster, "nurse_hprd", [0.25, 0.5, 0.75])
    cut = roster.withColumn("__cuts", cuts)
    return cut.withColumns({
        "hprd_quartile": quartile_bin("nurse_hprd", F.col("__cuts"), V.HOUR_QUARTILES),
        "quartile_ord": quartile_bin("nurse_hprd", F.col("__cuts"), V.HOUR_QUARTILES, order=True),
    }).drop("__cuts")


def staffing_controlled(roster: DataFrame) -> DataFrame:
    """The staffing gradient inside each ownership group."""
    known = roster.filter(
        F.col("nurse_hprd").isNotNull() & (F.col("ownership_group") != V.UNKNOWN_LABEL))
    return with_hour_quartile(known).groupBy("ownership_group", "hprd_quartile", "quartile_ord").agg(
        F.count("*").alias("facilities"),
        per_base(F.col("nurse_hprd") * F.col("residents"), "residents").alias("nurse_hprd"),
        mean("health_inspection_rating").alias("health_inspection_rating"),
        mean("rating").alias("avg_rating"), per_base("fine_total", "beds").alias("fines_per_bed"),
    ).withColumn("ownership_ord", label_order("ownership_group", V.OWNERSHIP_ORDER)).orderBy(
        "ownership_ord", "quartile_ord")


def turnover_gradient(roster: DataFrame) -> DataFrame:
    """Turnover bands next to the national level, weighted and median."""
    known = roster.filter(F.col("turnover_pct").isNotNull())
    level = known.agg(
        per_base(F.col("turnover_pct") * F.col("residents"), "residents").alias("w")).scalar()
    return gradient(known, "turnover_pct", V.TURNOVER_BANDS).withColumns({
        "national_turnover_weighted": level,
        "national_turnover_median": quantile_cuts(known, "turnover_pct", [0.5])[0],
    })


def split_scan(roster: DataFrame, cuts: list[int] = V.SPLIT_CUTS,
               min_side: int = V.SPLIT_MIN_SIDE) -> DataFrame:
    """Every candidate cut with the gap between its two sides.

    The roster is reduced once to the ranges between cuts; every cut is then a
    sum over those few ranges.
    """
    known = roster.filter(F.col("turnover_pct").isNotNull())
    passed = sum((F.when(F.col("turnover_pct") >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    sums = ["n", "rated", "stars", "residents", "beds", "fines"]
    ranges = known.groupBy(passed.alias("range")).agg(
        F.count("*").alias("n"), F.count("rating").alias("rated"), zero_sum("rating").alias("stars"),
        zero_sum("residents").alias("residents"), zero_sum("beds").alias("beds"),
        zero_sum("fine_total").alias("fines"))
    each = ranges.withColumn("__cut", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(c).alias("cut")) for i, c in enumerate(cuts)])))
    low = F.col("range") <= F.col("__cut.i")
    sides = each.groupBy(F.col("__cut.cut").alias("cut")).agg(
        *[zero_sum(F.when(low, F.col(s))).alias(f"lo_{s}") for s in sums],
        *[zero_sum(F.when(~low, F.col(s))).alias(f"hi_{s}") for s in sums])
    c = F.col
    out = sides.filter((c("lo_n") >= min_side) & (c("hi_n") >= min_side)).select(
        "cut", c("lo_n").alias("facilities_below"),
        (divide(c("lo_n"), c("lo_n") + c("hi_n")) * 100).alias("pct_below"),
        divide(c("lo_stars"), c("lo_rated")).alias("rating_below"),
        divide(c("hi_stars"), c("hi_rated")).alias("rating_above"),
        divide(c("lo_residents"), c("lo_beds")).alias("occupancy_below"),
        divide(c("hi_residents"), c("hi_beds")).alias("occupancy_above"),
        divide(c("lo_fines"), c("lo_beds")).alias("fines_per_bed_below"),
        divide(c("hi_fines"), c("hi_beds")).alias("fines_per_bed_above"))
    return out.withColumns({
        "rating_gap": c("rating_below") - c("rating_above"),
        "occupancy_gap_pts": (c("occupancy_below") - c("occupancy_above")) * 100,
    }).orderBy("cut")


def turnover_controlled(roster: DataFrame) -> DataFrame:
    """Turnover bands inside each quartile of staffing hours."""
    known = roster.filter(F.col("turnover_pct").isNotNull() & F.col("nurse_hprd").isNotNull())
    binned = with_band(with_hour_quartile(known), "turnover_pct", V.TURNOVER_CONTROL_BANDS,
                       "turnover_band", "turnover_ord").filter(F.col("turnover_band").isNotNull())
    return binned.groupBy("hprd_quartile", "quartile_ord", "turnover_band", "turnover_ord").agg(
        F.count("*").alias("facilities"), mean("rating").alias("avg_rating"),
        per_base("residents", "beds").alias("occupancy"),
        per_base("fine_total", "beds").alias("fines_per_bed"),
    ).orderBy("quartile_ord", "turnover_ord")


def pivot_matrix(controlled: DataFrame, value: str) -> DataFrame:
    """Quartile by turnover band: the value and the facilities behind it."""
    labels = [b[2] for b in V.TURNOVER_CONTROL_BANDS]
    wide = controlled.groupBy("hprd_quartile", "quartile_ord").pivot("turnover_band", labels).agg(
        F.first(value).alias("value"), F.first("facilities").alias("n"))
    return wide.select("hprd_quartile", "quartile_ord", *[
        F.col(f"`{label}_{part}`").alias(f"{part}_{i}")
        for i, label in enumerate(labels) for part in ("value", "n")]).orderBy("quartile_ord")


def kpi_summary(roster: DataFrame) -> DataFrame:
    """The headline figures of a roster: ratios of sums, shares of facilities."""
    hours = F.col("nurse_hprd").isNotNull()
    weighted = lambda value, known: F.sum(F.when(known, F.col(value) * F.col("residents")))
    base = lambda known: F.sum(F.when(known, F.col("residents")))
    churn = F.col("turnover_pct").isNotNull()
    return roster.agg(
        F.count("*").alias("facilities"), zero_sum("beds").alias("beds"),
        zero_sum("residents").cast("double").alias("residents"),
        divide(F.sum("residents"), F.sum("beds")).alias("occupancy"),
        divide(weighted("nurse_hprd", hours), base(hours)).alias("nurse_hprd"),
        divide(weighted("rn_hprd", hours), weighted("nurse_hprd", hours)).alias("rn_share"),
        divide(weighted("turnover_pct", churn), base(churn)).alias("turnover_pct"),
        mean("rating").alias("avg_rating"),
        share(F.col("rating") <= 2, 100.0).alias("pct_1_2_star"),
        zero_sum("fine_total").alias("fine_total"), zero_sum("fine_events").alias("fine_events"),
        mean("deficiencies").alias("deficiencies"),
        divide(F.sum("fine_total"), F.sum("beds")).alias("fines_per_bed"),
        share(F.col("was_fined"), 100.0).alias("pct_fined"),
        share(F.col("nurse_hprd") < V.STAFFING_FLOOR, 100.0).alias("below_floor_pct"))
