"""What the cleaning rules did in a build, rule by rule, as run log rows.

Q1 keys, Q2 repeats, Q3 nulls, Q4 implausible rows, Q5 unmapped categories, Q6
dates, Q7 columns that a period lacks, Q8 units. Staged rows of a kind are counted
once, in one aggregate kept as a row per period, and so is the written snapshot
fact; the rules read those. The fact holds a facility and period once, so
the rows it lacks are the repeated ones and no key is grouped again. Date formats
are those the build voted for; only the medians behind the units are taken anew.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark import fixed_values as V
from tidemark.functions import clean
from tidemark.functions.clean import suspect_reasons
from tidemark.operators.votes import date_votes, unit_medians
from tidemark.plans import runlog
from tidemark.plans.runlog import count_where, entries
from tidemark.session import stored
from tidemark.sources.text import MALFORMED

TIME = "processing_date"
TURNOVER = "total_nursing_turnover_pct"


def profile(rows: DataFrame, logical: str) -> DataFrame:
    """Per period: rows, malformed rows, keys of the wrong width, and the known values of every canonical column."""
    wanted = [*V.CANONICAL_COLUMNS[logical], *(V.NULL_REPORT_FIELDS if logical == V.REQUIRED_FILE else [])]
    fields = [c for c in dict.fromkeys(wanted) if c in rows.columns and c != TIME]
    turnover = [F.count(clean.to_number(TURNOVER)).alias("__turnover")] if TURNOVER in fields else []
    return rows.groupBy(TIME).agg(
        F.count("*").alias("__rows"), count_where(F.col(MALFORMED)).alias("__malformed"),
        count_where(F.length("ccn") != V.ID_WIDTH).alias("__wrong_width"), *turnover, *[F.count(c).alias(c) for c in fields])


def fact_profile(facts: DataFrame) -> DataFrame:
    """Per period: rows of the snapshot fact and flagged ones by reason."""
    return facts.groupBy("snapshot_date_key").agg(
        F.count("*").alias("__kept"), *[count_where(c).alias(n) for n, c in suspect_reasons().items()])


def _keys(counted: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows, keys of the wrong width and rows beyond the first of a facility, per period."""
    same = clean.date_key(TIME) == F.col("snapshot_date_key")
    return counted.join(kept.select("snapshot_date_key", "__kept"), same, "left").select(
        TIME, F.col("__rows").alias("rows"), F.col("__wrong_width").alias("wrong_width"),
        (F.col("__rows") - F.coalesce("__kept", F.lit(0))).alias("duplicates"))


def _repeats(keys: DataFrame) -> DataFrame:
    return entries(keys.filter("duplicates > 0"), "clean", "Q2", "provider_info", "duplicates", "repeated facility, first row kept", F.col(TIME))


def _nulls(counted: DataFrame) -> DataFrame:
    known = counted.unpivot([TIME, "__rows"], V.NULL_REPORT_FIELDS, "field", "known")
    return known.select(TIME, "field", (F.col("__rows") - F.col("known")).alias("nulls"),
                        ((F.col("__rows") - F.col("known")) / F.col("__rows")).alias("share"))


def _republished(survivors: DataFrame) -> DataFrame:
    several = survivors.filter((F.col("publications") > 1) | F.col("inherited"))
    return entries(several, "clean", "Q2", F.col("logical"), F.col("publications") - 1, F.when(
        F.col("inherited"), "period republished, file inherited").otherwise("period republished, later file wins"),
        F.col("processing_date"))


def _malformed(counted: DataFrame, target: str) -> DataFrame:
    return entries(counted.filter("__malformed > 0"), "read", "Q2", target, "__malformed", "fields do not match the header, kept", F.col(TIME))


def _collapsed(counted: DataFrame, events: DataFrame) -> DataFrame:
    counts = counted.agg(F.coalesce(F.sum("__rows"), F.lit(0)).alias("s"), F.lit(0).alias("e")).unionAll(
        events.agg(F.lit(0), F.count("*")))
    both = counts.agg(F.sum("s").alias("s"), F.sum("e").alias("e"))
    return entries(both, "clean", "Q2", "penalties", F.col("s") - F.col("e"), F.concat(
        F.col("s").cast("string"), F.lit(" sightings of "), F.col("e").cast("string"), F.lit(" events")))


def _unmapped(dims: dict[str, DataFrame]) -> list[DataFrame]:
    def count(dim, key, shown, target):
        found = dims[dim].filter((F.col(key) > 0) & (F.col(shown) == V.UNKNOWN_LABEL)).agg(F.count("*").alias("rows"))
        return entries(found.filter("rows > 0"), "clean", "Q5", target, "rows", "category not in the map, kept as unknown")

    return [count("dim_ownership", "ownership_key", "ownership_group", "ownership_type"),
            count("dim_geography", "geography_key", "state_name", "state_code")]


def _absent(counted: DataFrame, logical: str) -> DataFrame:
    """Canonical columns that no row of a period has: its file lacks them, or they are empty."""
    fields = [c for c in V.CANONICAL_COLUMNS[logical] if c in counted.columns and c != TIME]
    empty = counted.unpivot([TIME, "__rows"], fields, "field", "known").filter("known = 0")
    return entries(empty, "read", "Q7", F.col("field"), "__rows", "no value in the period", F.col(TIME))


def of_build(providers: DataFrame, penalties: DataFrame | None, survivors: DataFrame,
             written: dict[str, DataFrame], votes: DataFrame | None = None) -> list[DataFrame]:
    """Log rows of one build; ``written`` are the tables of the release, ``votes`` its decisions on penalty dates."""
    counted = stored(profile(providers, V.REQUIRED_FILE), "profile")
    kept = stored(fact_profile(written["fact_snapshot"]), "profile")
    keys = _keys(counted, kept)
    turnover = providers.select(TIME, clean.to_number(TURNOVER).alias(TURNOVER))
    reasons = kept.unpivot("snapshot_date_key", list(suspect_reasons()), "reason", "rows")
    parts = [
        runlog.log_key_quality(keys, TIME), _repeats(keys), _republished(survivors), _malformed(counted, "provider_info"),
        runlog.log_nulls(_nulls(counted), TIME), runlog.log_suspects(reasons, "snapshot_date_key"),
        *_unmapped(written), _absent(counted, V.REQUIRED_FILE),
        runlog.log_unit_drift(unit_medians(turnover, TURNOVER, [TIME]), counted.select(TIME, F.col("__turnover").alias("known")), TIME, TURNOVER),
    ]
    if penalties is not None:
        seen = stored(profile(penalties, "penalties"), "profile")
        votes = date_votes(penalties, "penalty_date", [TIME]) if votes is None else votes
        parts += [_malformed(seen, "penalties"), _collapsed(seen, written["fact_penalty"]), _absent(seen, "penalties"),
                  runlog.log_date_votes(votes, TIME, "penalty_date")]
    return [reduce(lambda a, b: a.unionByName(b), parts)]
