"""Question 5: what changed over time, and for whom."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark.functions.measures import (
    count_where, divide, mean, ratio_of_sums, share, weighted_mean, zero_sum,
)
from tidemark.plans.roster import short_names

PAIRED = {"beds": "beds", "residents": "res", "nurse_hprd": "hprd", "rn_hprd": "rn",
          "rating": "rating", "deficiencies": "defic"}


def period_trend(facility: DataFrame, exclude_suspect: bool = True) -> DataFrame:
    rows = short_names(facility.filter(~F.col("is_suspect")) if exclude_suspect else facility)
    return rows.groupBy(
        F.col("snapshot_date").alias("period"), F.col("snapshot_date_key").alias("period_key"),
        F.col("snapshot_year").alias("year")).agg(
            F.count("*").alias("facilities"), F.sum("beds").alias("beds"),
            F.sum("residents").alias("residents"),
            ratio_of_sums("residents", "beds").alias("occupancy"),
            weighted_mean("nurse_hprd", "residents").alias("nurse_hprd"),
            weighted_mean("rn_hprd", "residents").alias("rn_hprd"),
            mean("rating").alias("avg_rating"), mean("deficiencies").alias("deficiencies"),
    ).orderBy("period")


def _newest(facility: DataFrame):
    return facility.agg(F.max("snapshot_date_key")).scalar()


def matched_cohort(facility: DataFrame, first: int, last: int | None = None,
                   exclude_suspect: bool = True) -> DataFrame:
    """Facilities present at both periods, with their figures at each end.

    One aggregate over the rows of two periods instead of a self-join. State and
    ownership are those of the later end.
    """
    at = F.col("snapshot_date_key")
    end = F.lit(last) if last is not None else _newest(facility)
    rows = short_names(facility.filter((at == first) | (at == end)))
    if exclude_suspect:
        rows = rows.filter(~F.col("is_suspect"))
    early = rows.withColumns({"__a": at == first, "__b": at == end})
    pick = lambda c, side: F.max(F.when(F.col(side), F.col(c)))
    both = early.groupBy("ccn").agg(
        F.max("__a").alias("__a"), F.max("__b").alias("__b"),
        pick("state_code", "__b").alias("state_code"),
        pick("ownership_group", "__b").alias("ownership_group"),
        *[pick(c, side).alias(f"{n}_{word}") for c, n in PAIRED.items()
          for side, word in (("__a", "from"), ("__b", "to"))])
    return both.filter(F.col("__a") & F.col("__b")).drop("__a", "__b")


def matched_summary(pairs: DataFrame) -> DataFrame:
    """The cohort in one row: both ends, the changes, and who moved which way."""
    a, b = F.col("rating_from"), F.col("rating_to")
    rated = pairs.agg(
        F.count("*").alias("matched_facilities"),
        *[zero_sum(f"{n}_{w}").alias(f"{label}_{w}") for n, label in
          (("beds", "beds"), ("res", "residents")) for w in ("from", "to")],
        *[ratio_of_sums(f"res_{w}", f"beds_{w}").alias(f"occupancy_{w}") for w in ("from", "to")],
        *[weighted_mean(f"{n}_{w}", f"res_{w}").alias(f"{label}_{w}") for n, label in
          (("hprd", "nurse_hprd"), ("rn", "rn_hprd")) for w in ("from", "to")],
        *[mean(f"{n}_{w}").alias(f"{label}_{w}") for n, label in
          (("rating", "rating"), ("defic", "deficiencies")) for w in ("from", "to")],
        share(b > a, 100.0).alias("pct_improved"), share(b == a, 100.0).alias("pct_unchanged"),
        share(b < a, 100.0).alias("pct_declined"))
    c = F.col
    return rated.withColumns({
        "occupancy_change_pts": (c("occupancy_to") - c("occupancy_from")) * 100,
        "nurse_hprd_change_pct": (divide(c("nurse_hprd_to"), c("nurse_hprd_from")) - 1) * 100,
        "rn_share_from": divide(c("rn_hprd_from"), c("nurse_hprd_from")) * 100,
        "rn_share_to": divide(c("rn_hprd_to"), c("nurse_hprd_to")) * 100,
        "rating_change": c("rating_to") - c("rating_from"),
    })


def capacity_exit(facility: DataFrame, first: int, last: int | None = None) -> DataFrame:
    """Who left and who stayed; an empty side is filled with zeros.

    Suspect rows are left out at the first period only.
    """
    at = F.col("snapshot_date_key")
    end = F.lit(last) if last is not None else _newest(facility)
    early = at == first
    shown = ["beds", "residents", "rating", "nurse_hprd"]
    rows = short_names(facility.filter(early | (at == end)))
    counted = early & ~F.col("is_suspect")
    members = rows.groupBy("ccn").agg(
        F.max(counted).alias("__a"), F.max(at == end).alias("__b"),
        *[F.max(F.when(counted, F.col(c))).alias(c) for c in shown]).filter("__a")
    zero = lambda x: F.coalesce(x.cast("double"), F.lit(0.0))

    def side(condition, label):
        only = lambda c: F.when(condition, F.col(c))
        return [
            count_where(condition).alias(f"{label}_facilities"),
            zero_sum(only("beds")).cast("bigint").alias(f"{label}_beds"),
            zero(divide(F.sum(only("residents")), F.sum(only("beds")))).alias(f"{label}_occupancy_before"),
            zero(mean(only("rating"))).alias(f"{label}_rating_before"),
            zero(mean(only("nurse_hprd"))).alias(f"{label}_hprd_before"),
        ]

    out = members.agg(*side(~F.col("__b"), "exited"), *side(F.col("__b"), "stayed"))
    everyone = F.col("exited_facilities") + F.col("stayed_facilities")
    return out.withColumn("exited_share_pct", zero(divide(F.col("exited_facilities"), everyone) * 100))


def rating_migration(pairs: DataFrame) -> DataFrame:
    """Where every starting rating ended up, as shares of its row."""
    rated = pairs.filter(F.col("rating_from").isNotNull() & F.col("rating_to").isNotNull())
    cells = rated.groupBy("rating_from", "rating_to").agg(F.count("*").alias("facilities"))
    row = W.partitionBy("rating_from")      # at most one row per rating level
    return cells.withColumn(
        "pct_of_row", divide(F.col("facilities"), F.sum("facilities").over(row)) * 100)
