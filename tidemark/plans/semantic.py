"""The semantic layer: flat views of the star and the measures over them."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.measures import (
    divide, measures, penalty_split, ratio_of_sums, zero_sum,
)
from tidemark.operators.lookups import join_unique

FACILITY_MEASURES = [
    "certified_beds", "avg_residents_per_day", "resident_days", "reported_total_nurse_hprd",
    "reported_rn_hprd", "total_nursing_turnover_pct", "overall_rating", "staffing_rating",
    "health_inspection_rating", "cycle1_total_deficiencies", "is_suspect",
]


def _star(fact: DataFrame, joins: list[tuple[DataFrame, str, dict[str, str]]]) -> DataFrame:
    """Inner equi-joins of a fact with its dimensions, each reduced to what is shown.

    Nothing runs while the view is built: file sizes and adaptive execution choose
    between broadcast and shuffle, and split a key that very many rows share.
    """
    for dim, key, shown in joins:
        side = dim.select(F.col(_key_of(dim, key)).alias(key),
                          *[F.col(c).alias(a) for c, a in shown.items()])
        fact = join_unique(fact, side, key, "inner")
    return fact


def _key_of(dim: DataFrame, key: str) -> str:
    return key if key in dim.columns else "date_key"


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def facility_view(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Snapshot fact joined with five dimensions."""
    joined = _star(fact, [
        (dims["dim_date"], "snapshot_date_key", {
            "full_date": "snapshot_date", "year": "snapshot_year", "quarter": "snapshot_quarter",
            "year_month": "snapshot_year_month", "month_name_th": "snapshot_month_th",
            "covid_period": "covid_period"}),
        (dims["dim_facility"], "facility_key", _same(
            "provider_name", "provider_type", "bed_size_band", "special_focus_status", "abuse_icon")),
        (dims["dim_geography"], "geography_key", _same(
            "state_code", "state_name", "census_region", "county_parish", "city", "zip_code",
            "urban_rural", "latitude", "longitude")),
        (dims["dim_ownership"], "ownership_key", _same(
            "ownership_type", "ownership_group", "is_for_profit")),
        (dims["dim_chain"], "chain_key", _same("chain_name", "chain_size_band", "is_independent")),
    ])
    return joined.select(
        "snapshot_date_key", "snapshot_date", "snapshot_year", "snapshot_quarter",
        "snapshot_year_month", "snapshot_month_th", "covid_period", "ccn", "provider_name",
        "provider_type", "bed_size_band", "special_focus_status", "abuse_icon", "state_code",
        "state_name", "census_region", "county_parish", "city", "zip_code", "urban_rural",
        "latitude", "longitude", "ownership_type", "ownership_group", "is_for_profit",
        "chain_name", "chain_size_band", "is_independent", *FACILITY_MEASURES)


def penalty_view(fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Penalty fact joined with six dimensions.

    The year of a published fact is its partition column, so that filters on it
    prune partitions; other facts take it from the calendar.
    """
    joined = _star(fact, [
        (dims["dim_date"], "penalty_date_key", {
            "full_date": "penalty_date", "year": "penalty_year", "quarter": "penalty_quarter",
            "year_month": "penalty_year_month", "us_fiscal_year": "us_fiscal_year",
            "covid_period": "covid_period"}),
        (dims["dim_facility"], "facility_key", _same("provider_name", "bed_size_band")),
        (dims["dim_geography"], "geography_key", _same("state_code", "state_name", "census_region")),
        (dims["dim_ownership"], "ownership_key", _same("ownership_group")),
        (dims["dim_chain"], "chain_key", _same("chain_name", "chain_size_band")),
        (dims["dim_penalty_type"], "penalty_type_key", _same("penalty_type", "is_monetary")),
    ])
    return joined.select(
        "penalty_event_key", "penalty_date", F.col("event_year" if "event_year" in fact.columns else "penalty_year").alias("penalty_year"),
        "penalty_quarter", "penalty_year_month", "us_fiscal_year", "covid_period", "ccn", "provider_name",
        "bed_size_band", "state_code", "state_name", "census_region", "ownership_group",
        "chain_name", "chain_size_band", "penalty_type", "is_monetary", "fine_id",
        "fine_id_source", "fine_amount_usd", "payment_denial_days", "penalty_count")


@dataclass(frozen=True)
class Filters:
    """What a reader selected. Order of choices does not matter."""

    periods: tuple = ()
    states: tuple = ()
    ownership: tuple = ()
    chain_bands: tuple = ()
    include_suspect: bool = True

    def __post_init__(self):
        for name in ("periods", "states", "ownership", "chain_bands"):
            object.__setattr__(self, name, tuple(sorted(getattr(self, name) or ())))

    def _shared(self) -> list[Column]:
        chosen = {"state_code": self.states, "ownership_group": self.ownership,
                  "chain_size_band": self.chain_bands}
        return [F.col(c).isin(list(v)) for c, v in chosen.items() if v]

    def facility(self, with_period: bool = True) -> Column:
        clauses = self._shared()
        if with_period and self.periods:
            clauses.append(F.col("snapshot_date_key").isin(list(self.periods)))
        if not self.include_suspect:
            clauses.append(~F.col("is_suspect"))
        return reduce(and_, clauses, F.lit(True))

    def penalties(self) -> Column:
        """Penalties know no period and no suspect flag, only shared dimensions."""
        return reduce(and_, self._shared(), F.lit(True))


def latest_period(facility: DataFrame) -> Column:
    """Newest period of a frame, as a scalar subquery (no driver round trip)."""
    return facility.agg(F.max("snapshot_date_key").alias("k")).scalar()


def at_latest(facility: DataFrame) -> DataFrame:
    return facility.filter(F.col("snapshot_date_key") == latest_period(facility))


def measure_by_state_period(facility: DataFrame) -> DataFrame:
    return facility.groupBy(
        "snapshot_date_key", "snapshot_date", "snapshot_year", "snapshot_year_month",
        "covid_period", "state_code", "state_name", "census_region").agg(*measures())


def measure_by_ownership_period(facility: DataFrame) -> DataFrame:
    return facility.groupBy(
        "snapshot_date_key", "snapshot_date", "snapshot_year_month", "ownership_group",
        "is_for_profit").agg(*measures(
            "facilities", "suspect_rows", "m1_occupancy_rate", "m2_resident_days",
            "m3_nurse_hprd", "m4_turnover_pct", "m7_avg_overall_rating", "m8_deficiencies",
            "total_certified_beds"))


def measure_by_chain_period(facility: DataFrame) -> DataFrame:
    return facility.groupBy(
        "snapshot_date_key", "snapshot_date", "snapshot_year_month", "chain_size_band",
        "is_independent").agg(
            *measures("facilities", "m1_occupancy_rate", "m2_resident_days", "m3_nurse_hprd",
                      "m4_turnover_pct", "m7_avg_overall_rating", "m8_deficiencies"),
            F.count_distinct("chain_name").alias("chains"))


def penalty_by_state_year(penalty: DataFrame) -> DataFrame:
    return penalty.groupBy("penalty_year", "state_code", "state_name", "census_region").agg(
        *penalty_split(), F.count_distinct("ccn").alias("facilities_penalised"))


def fines_per_resident_day(facility: DataFrame, penalty: DataFrame) -> DataFrame:
    """M9: each fact to (state, year) on its own, then a full join."""
    on = ["year", "state_code"]
    exposure = facility.groupBy(F.col("snapshot_year").alias("year"), "state_code").agg(
        F.count_distinct("snapshot_date_key").alias("periods_loaded"),
        F.sum("resident_days").alias("m2_resident_days"),
        F.sum("certified_beds").alias("total_certified_beds"))
    fines = penalty.groupBy(F.col("penalty_year").alias("year"), "state_code").agg(
        zero_sum("fine_amount_usd").alias("m5_fine_usd"),
        F.sum("penalty_count").alias("m6_penalty_events"))
    return exposure.join(fines, on, "full_outer").select(
        *on, "periods_loaded", "m2_resident_days", "total_certified_beds", "m5_fine_usd",
        "m6_penalty_events",
        divide(F.col("m5_fine_usd"), F.col("m2_resident_days")).alias("m9_fine_per_resident_day"),
        divide(F.col("m5_fine_usd"), F.col("total_certified_beds")).alias("fine_per_certified_bed"))


def market_saturation(facility: DataFrame, population: DataFrame) -> DataFrame:
    """M10: supply of the latest period against the newest population."""
    supply = at_latest(facility).groupBy("state_code", "state_name", "census_region").agg(
        F.sum("certified_beds").alias("total_certified_beds"),
        F.sum("avg_residents_per_day").alias("total_residents"),
        F.count("*").alias("facilities"),
        ratio_of_sums("avg_residents_per_day", "certified_beds").alias("m1_occupancy_rate"))
    newest = population.agg(F.max("year")).scalar()
    people = population.filter(F.col("year") == newest).select(
        "state_code", "pop_65plus", F.col("year").alias("population_year"))
    return join_unique(supply, people, "state_code").withColumn(
        "m10_beds_per_1000_elderly",
        divide(F.col("total_certified_beds"), F.col("pop_65plus") / 1000.0))


def check_ratio_additivity(facility: DataFrame) -> DataFrame:
    """The right occupancy next to the tempting one, per period."""
    per_row = divide(F.col("avg_residents_per_day"), F.col("certified_beds"))
    return facility.groupBy("snapshot_date_key", "snapshot_date").agg(
        ratio_of_sums("avg_residents_per_day", "certified_beds").alias("correct_sum_over_sum"),
        F.avg(per_row).alias("wrong_avg_of_ratios"),
    ).withColumn("gap_percentage_points",
                 (F.col("wrong_avg_of_ratios") - F.col("correct_sum_over_sum")) * 100)


def warehouse_coverage(facility: DataFrame, penalty: DataFrame) -> DataFrame:
    def summary(frame, name, period, date):
        return frame.agg(
            F.count_distinct(period).alias("periods"), F.min(date).alias("earliest"),
            F.max(date).alias("latest"), F.count("*").alias("rows"),
            F.count_distinct("ccn").alias("facilities"),
        ).select(F.lit(name).alias("table_name"), "*")

    return summary(facility, "fact_snapshot", "snapshot_date_key", "snapshot_date").unionByName(
        summary(penalty, "fact_penalty", "penalty_year", "penalty_date"))
