"""Merging new periods into what earlier periods left: versions, event identities, events.

Each function takes stored tables and the rows of the new periods, and gives the
tables that all periods together would give. Keys that were given out stay.
Periods are merged once and in order; ``plans.increments`` keeps account of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.dedup import EventColumns, _by_identity, key_states, natural_key, unfolded, with_natural_key
from tidemark.operators.ordering import dense_key, first_per_key
from tidemark.operators.versions import scd2_build
from tidemark.session import durable


class OutOfOrder(ValueError):
    """Rows of a period that is not newer than what was merged before."""


def largest_key(table: DataFrame, key: str) -> int:
    """The largest key given out, 0 if there is none; members like -1 do not count."""
    return max(table.agg(F.max(key)).first()[0] or 0, 0)


def scd2_merge(
    versions: DataFrame, sightings: DataFrame, key: str, time: str, tracked: list[str], surrogate: str, order: list | None = None,
    effective: str = "effective_date", expiry: str = "expiry_date", current: str = "is_current",
) -> DataFrame:
    """Versions after the sightings of newer periods.

    Closed versions are passed on as they are. An open version stands for all its
    member's sightings so far: it holds the last known value of every attribute,
    so the rule of ``scd2_build`` applied to it and the new sightings fills, closes
    and opens the same versions as it does over the whole history. Versions keep
    their surrogate keys, new ones are numbered after the largest, by member and date.

    ``sightings`` of a member that are not newer than its open version are
    refused (``OutOfOrder``); those of a period merged before, or older than the
    newest merged, must not be passed. Members with a null key are one member, as
    in ``scd2_build``. Empty versions or sightings are fine.
    """
    declared = [surrogate, key, *tracked, effective, expiry, current]
    if sorted(versions.columns) != sorted(declared):
        raise ValueError(f"versions have columns {sorted(versions.columns)}, not {sorted(declared)}")
    newer = first_per_key(sightings.select(key, time, *tracked, *order), [key, time], order) if order else sightings
    newer = durable(newer.select(key, time, *tracked))
    opened = versions.where(current)
    seeds = opened.select(key, F.col(effective).alias(time), *tracked)
    starts = opened.select(F.col(key).alias("__key"), F.col(effective).alias("__from"), F.col(surrogate).alias("__sk"))
    late = newer.join(starts, F.col(key).eqNullSafe(F.col("__key")) & (F.col(time) <= F.col("__from")), "left_semi")
    if not late.isEmpty():
        raise OutOfOrder(f"sightings are not newer than the versions they belong to, as of {late.agg(F.min(time)).first()[0]}")
    grown = scd2_build(seeds.unionByName(newer), key, time, tracked, effective=effective, expiry=expiry, current=current)
    known = durable(grown.join(starts, F.col(key).eqNullSafe(F.col("__key")) & (F.col(effective) == F.col("__from")), "left"))
    kept = known.where("__sk is not null").withColumn(surrogate, F.col("__sk"))
    added = dense_key(known.where("__sk is null").drop("__key", "__from", "__sk"), [F.col(key).asc_nulls_last(), effective], surrogate,
                      first=largest_key(versions, surrogate) + 1)
    closed = versions.where(~F.col(current))
    return closed.select(*declared).unionByName(kept.select(*declared)).unionByName(added.select(*declared)).select(*versions.columns)


def event_index(sightings: DataFrame, c: EventColumns = EventColumns(), **options) -> DataFrame:
    """The identity index of some periods: per natural key its last sighting, first official id and counts."""
    return key_states(with_natural_key(sightings, c, **options), c)


def merged_index(index: DataFrame, newer: DataFrame, c: EventColumns = EventColumns()) -> DataFrame:
    """The index of two disjoint sets of periods, in any order. One shuffle of both; hot keys do not exist, a key is one row in each."""
    return index.unionByName(newer).groupBy(*c.group[1:], "occurrence").agg(
        F.max("last").alias("last"), F.min("first_id").alias("first_id"),
        F.sum("sightings").alias("sightings"), F.sum("with_id").alias("with_id"))


def identified(index: DataFrame, c: EventColumns = EventColumns()) -> DataFrame:
    """Natural keys with the identity of their event: the official id where any sighting has one."""
    return unfolded(index, c).withColumn("identity", F.coalesce(c.official_id, "natural_key")).withColumn(
        "by_id", F.col(c.official_id).isNotNull())


def events_of(index: DataFrame, c: EventColumns = EventColumns()) -> DataFrame:
    """All events of an index: what ``window_dedup`` gives over all its sightings."""
    return _by_identity(unfolded(index, c), c)


def upserted_events(
    events: DataFrame, before: DataFrame, after: DataFrame, newer: DataFrame, key: str = "event_key", c: EventColumns = EventColumns(),
) -> DataFrame:
    """Events with stable keys after new periods.

    ``before`` and ``after`` are the index without and with ``newer``, the index of
    the new periods alone. Only events that the new periods saw are computed again.
    An official id that arrives later moves its event from the natural key to the
    id: the event keeps its key. Events that turn out to be one keep the smallest
    of their keys. New events are numbered after the largest, by identity.
    """
    touched = newer.select(natural_key(c).alias("natural_key"))
    old = identified(before, c).select("natural_key", F.col("identity").alias("was"), F.col("by_id").alias("was_by_id"))
    now = identified(after, c)
    seen = now.join(touched, "natural_key", "left_semi").select("identity", "by_id").distinct()
    # all natural keys of the events seen, also those not seen this time
    parts = durable(now.join(seen, ["identity", "by_id"], "left_semi"))
    moved = parts.select("natural_key", "identity", "by_id").join(old, "natural_key")
    keys = events.select(F.col("identity").alias("was"), (F.col("fine_id_source") == "fine_id").alias("was_by_id"), F.col(key))
    given = moved.select("identity", "by_id", "was", "was_by_id").distinct().join(keys, ["was", "was_by_id"])
    smallest = given.groupBy("identity", "by_id").agg(F.min(key).alias(key))
    again = _by_identity(parts.drop("identity", "by_id"), c).withColumn("by_id", F.col("fine_id_source") == "fine_id")
    found = durable(again.join(smallest, ["identity", "by_id"], "left").drop("by_id"))
    added = dense_key(found.where(F.col(key).isNull()).drop(key), ["identity", "fine_id_source"], key, first=largest_key(events, key) + 1)
    replaced = given.select(key).distinct()
    return events.join(replaced, key, "left_anti").unionByName(found.where(F.col(key).isNotNull()).select(*events.columns)).unionByName(
        added.select(*events.columns))
