"""The periodic-snapshot fact and the penalty event fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark import fixed_values as V
from tidemark.functions import clean
from tidemark.operators.dedup import EventColumns, window_dedup
from tidemark.operators.lookups import join_unique, key_lookup
from tidemark.operators.ordering import dense_key, first_per_key
from tidemark.operators.versions import asof_lookup
from tidemark.operators.votes import fix_unit_drift, parse_date_vote, presence, tri_state, unit_medians

TIME = "processing_date"

FACILITY_FACT = [
    "snapshot_date_key", "facility_key", "geography_key", "ownership_key", "chain_key", "ccn",
    "certified_beds", "avg_residents_per_day", "resident_days", "reported_total_nurse_hprd",
    "reported_rn_hprd", "total_nursing_turnover_pct", "overall_rating", "staffing_rating",
    "health_inspection_rating", "cycle1_total_deficiencies", "is_suspect",
]
PENALTY_FACT = [
    "penalty_event_key", "penalty_date_key", "facility_key", "geography_key", "ownership_key",
    "chain_key", "penalty_type_key", "ccn", "fine_id", "fine_id_source", "fine_amount_usd",
    "payment_denial_days", "penalty_count",
]
_WHOLE = ["certified_beds", "overall_rating", "staffing_rating", "health_inspection_rating",
          "cycle1_total_deficiencies"]
_DECIMAL = ["avg_residents_per_day", "reported_total_nurse_hprd", "reported_rn_hprd",
            "total_nursing_turnover_pct"]
_LOOKED_UP = ["zip_code", "city", "state_code", "ownership_type", "chain_name"]


def with_geography_key(rows: DataFrame, dim: DataFrame) -> DataFrame:
    probe = rows.withColumns({f"__{n}": c for n, c in clean.geography_key_columns().items()})
    on = {f"__{n}": n for n in ("zip_code", "city", "state_code")}
    return key_lookup(probe, dim, on, "geography_key").drop(*on)


def with_ownership_key(rows: DataFrame, dim: DataFrame) -> DataFrame:
    probe = rows.withColumn("__type", clean.normalize_text("ownership_type"))
    return key_lookup(probe, dim, {"__type": "ownership_type"}, "ownership_key").drop("__type")


def with_chain_key(rows: DataFrame, dim: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """``source``: rows that tell whether a period has the column at all, if not ``rows``."""
    probe = rows.withColumn("__name", clean.normalize_text("chain_name", upper=True))
    names = dim.select(F.col("chain_name").alias("__name"), F.col("chain_key").alias("__found"))
    found = join_unique(probe, names, "__name")
    return tri_state(found, F.col("__name"), "chain_name", F.col("__found"), "chain_key",
                     [TIME], presence(rows if source is None else source, F.col("chain_name"), [TIME])).drop("__name", "__found")


def snapshot_keys(rows: DataFrame, dims: dict[str, DataFrame], source: DataFrame | None = None) -> DataFrame:
    """Provider rows with geography, ownership and chain keys."""
    keyed = with_geography_key(rows, dims["dim_geography"])
    keyed = with_ownership_key(keyed, dims["dim_ownership"])
    return with_chain_key(keyed, dims["dim_chain"], source)


def fact_snapshot(rows: DataFrame, dims: dict[str, DataFrame], position: list[str]) -> DataFrame:
    """One row per facility and period, 17 columns. Implausible rows are flagged."""
    # only what the fact holds or looks up is shuffled, numbers as numbers
    typed = first_per_key(rows.select(
        TIME, "ccn", *position, *_LOOKED_UP, *[clean.to_whole(c).alias(c) for c in _WHOLE],
        *[clean.to_number(c).alias(c) for c in _DECIMAL]), [TIME, "ccn"], position)
    # the medians need one column: rows are not shuffled whole a second time for them
    turnover = first_per_key(rows.select(TIME, "ccn", *position, "total_nursing_turnover_pct"), [TIME, "ccn"], position)
    units = unit_medians(turnover.select(TIME, clean.to_number("total_nursing_turnover_pct").alias("total_nursing_turnover_pct")),
                         "total_nursing_turnover_pct", [TIME])
    scaled = fix_unit_drift(typed, "total_nursing_turnover_pct", "total_nursing_turnover_pct", [TIME], units)
    keyed = snapshot_keys(scaled, dims, rows)
    keyed = asof_lookup(keyed, dims["dim_facility"], "ccn", TIME, "facility_key")
    return keyed.withColumns({
        "snapshot_date_key": clean.date_key(TIME),
        "resident_days": F.col("avg_residents_per_day") * clean.days_in_month(TIME),
        "is_suspect": clean.is_suspect(),
    }).select(*FACILITY_FACT)


def penalty_sightings(rows: DataFrame, position: list[str], votes: DataFrame | None = None) -> DataFrame:
    """Canonical penalty rows typed for the dedup; ``votes`` are the decisions on their dates, if known already."""
    dated = parse_date_vote(rows, "penalty_date", "__date", [TIME], votes)
    return dated.select(
        F.col(TIME).alias("stamp"), "ccn", F.col("__date").alias("penalty_date"),
        clean.normalize_text("penalty_type").alias("penalty_type"),
        clean.normalize_text("fine_id").alias("fine_id"),
        clean.to_whole("fine_amount_usd").alias("fine_amount_usd"),
        clean.blank_impossible(clean.to_whole("payment_denial_days")).alias("payment_denial_days"),
        *position,
    )


def attributes_at(rows: DataFrame, dims: dict[str, DataFrame], position: list[str]) -> DataFrame:
    """Keys of every (facility, period): the first row of a repeated facility."""
    first = first_per_key(rows.select(TIME, "ccn", *position, *_LOOKED_UP), [TIME, "ccn"], position)
    return snapshot_keys(first, dims, rows).select(
        "ccn", F.col(TIME).alias("stamp"), "geography_key", "ownership_key", "chain_key")


def attributes_of(snapshots: DataFrame) -> DataFrame:
    """The same from a written snapshot fact, whose keys are looked up already."""
    stamp = F.to_date(F.col("snapshot_date_key").cast("string"), "yyyyMMdd")
    return snapshots.select("ccn", stamp.alias("stamp"), "geography_key", "ownership_key", "chain_key")


def fact_penalty(
    sightings: DataFrame | None, attributes: DataFrame, dims: dict[str, DataFrame],
    columns: EventColumns = EventColumns(),
) -> DataFrame:
    """One row per penalty out of all sightings of it."""
    if sightings is None:
        return empty_penalty_fact(attributes.sparkSession)
    return penalty_fact_of(window_dedup(sightings, columns), attributes, dims, columns)


def penalty_fact_of(
    events: DataFrame, attributes: DataFrame, dims: dict[str, DataFrame],
    columns: EventColumns = EventColumns(), key: str | None = None,
) -> DataFrame:
    """Events with their dimension keys: those of the period of the kept sighting.

    ``key`` names a column of the events that holds their keys already.
    """
    events = join_unique(events, attributes, ["ccn", "stamp"], null_safe=True)
    unknown = F.lit(V.UNKNOWN_KEY).cast("bigint")
    events = events.withColumns({
        k: F.coalesce(k, unknown) for k in ("geography_key", "ownership_key", "chain_key")})
    events = asof_lookup(events, dims["dim_facility"], "ccn", "stamp", "facility_key")
    events = key_lookup(events, dims["dim_penalty_type"], "penalty_type", "penalty_type_key")
    dated = events.withColumns({
        "penalty_date_key": clean.date_key("penalty_date"),
        "penalty_count": F.lit(1).cast("bigint"),
    })
    if key:
        return dated.withColumn("penalty_event_key", F.col(key)).select(*PENALTY_FACT)
    order = ["penalty_date_key", F.col("ccn").asc_nulls_last(), "penalty_type_key", "stamp",
             *columns.position]
    # numbering writes and shuffles its rows: only what the fact holds and the order needs
    held = [c for c in PENALTY_FACT if c != "penalty_event_key"]
    narrow = dated.select(*dict.fromkeys([*held, "stamp", *columns.position]))
    return dense_key(narrow, order, "penalty_event_key").select(*PENALTY_FACT)


def empty_penalty_fact(spark) -> DataFrame:
    text = {"ccn", "fine_id", "fine_id_source"}
    schema = ", ".join(f"{c} {'string' if c in text else 'bigint'}" for c in PENALTY_FACT)
    return spark.createDataFrame([], schema)
