"""One row per event out of overlapping reports of a rolling window.

Every sighting carries ``stamp`` (its period), the member id, an event date, an
event type, perhaps an official id, and its position in the file.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.operators import lookups
from tidemark.operators.ordering import number_in_group
from tidemark.session import durable

BY_ID, BY_KEY = "fine_id", "natural_key"


@dataclass(frozen=True)
class EventColumns:
    stamp: str = "stamp"
    member: str = "ccn"
    date: str = "penalty_date"
    kind: str = "penalty_type"
    official_id: str = "fine_id"
    amount: str = "fine_amount_usd"
    position: tuple[str, ...] = field(default=("source_row",))

    @property
    def group(self) -> list[str]:
        return [self.stamp, self.member, self.date, self.kind]


def natural_key(c: EventColumns, occurrence: str = "occurrence") -> Column:
    """member|date|type|occurrence; the amount is left out because it is restated."""
    text = lambda x: F.coalesce(x.cast("string"), F.lit("?"))
    return F.concat_ws(
        "|", text(F.col(c.member)), text(F.date_format(c.date, "yyyy-MM-dd")),
        text(F.col(c.kind)), F.col(occurrence).cast("string"))


def with_natural_key(sightings: DataFrame, c: EventColumns, hot_rows: int | None = None) -> DataFrame:
    """Number identical events of one file in file order and build their key.

    Rows are spread once by (member, date, type): that serves the numbering and
    the collapse after it. Where such a group is too large for one task, the
    numbering falls back to slices of the file order. Groups are counted only if
    a whole member is that large: members alone need no date or text parsed.
    """
    limit = lookups.HOT_ROWS if hot_rows is None else hot_rows
    event = c.group[1:]
    hot = lambda by: not sightings.groupBy(*by).count().filter(F.col("count") > limit).isEmpty()
    if not (hot([c.member]) and hot(event)):
        window = W.partitionBy(*event, c.stamp).orderBy(*c.position)
        numbered = sightings.repartition(*event).withColumn(
            "occurrence", (F.row_number().over(window) - 1).cast("bigint"))
    else:
        numbered = number_in_group(sightings, c.group, list(c.position), "occurrence", limit=limit)
    return numbered


def _reported_last(c: EventColumns) -> Column:
    """Order of reporting; unknown member and date come last, as in the files."""
    return F.struct(
        F.col(c.stamp), F.col(c.member).isNull(), F.col(c.member),
        F.col(c.date).isNull(), F.col(c.date), *[F.col(p) for p in c.position])


def key_states(keyed: DataFrame, c: EventColumns) -> DataFrame:
    """What is known of every natural key: last sighting, first official id reported, and counts.

    ``last``, ``first_id``, ``sightings`` and ``with_id`` of the same key over other
    periods can be merged by maximum, minimum and sums.
    """
    has_id = F.col(c.official_id).isNotNull()
    event = [*c.group[1:], "occurrence"]
    reported = [c.stamp, *c.position]          # total order inside one natural key
    rest = [x for x in keyed.columns if x not in (*event, *reported, c.official_id)]
    return keyed.groupBy(*event).agg(
        F.max(F.struct(*reported, *rest)).alias("last"),
        F.min(F.when(has_id, F.struct(*reported, c.official_id))).alias("first_id"),
        F.count("*").alias("sightings"), F.count(F.when(has_id, 1)).alias("with_id"))


def unfolded(states: DataFrame, c: EventColumns) -> DataFrame:
    """One row per natural key: its last sighting, with the first official id ever reported for it."""
    event = [*c.group[1:], "occurrence"]
    return states.select(
        *event, "last.*", F.col(f"first_id.{c.official_id}").alias(c.official_id), "sightings",
        "with_id").withColumn("natural_key", natural_key(c))


def by_natural_key(keyed: DataFrame, c: EventColumns) -> DataFrame:
    """Collapse sightings to natural keys: one row per key, its last sighting.

    The first official id ever reported replaces the row's own (so earlier
    sightings inherit a later id). Also the counts the accounting needs.
    """
    return unfolded(key_states(keyed, c), c)


def window_dedup(sightings: DataFrame, c: EventColumns = EventColumns(), **options) -> DataFrame:
    """Keep the last sighting of every event.

    Identity is the official id where any sighting of the event has one, else
    the natural key. Two aggregates replace the usual windows: each reduces a hot
    key before the shuffle.
    """
    return _by_identity(by_natural_key(with_natural_key(sightings, c, **options), c), c)


def _by_identity(keys: DataFrame, c: EventColumns) -> DataFrame:
    # the natural key follows from the columns that are kept
    payload = [x for x in keys.columns if x not in (c.official_id, "sightings", "with_id", "natural_key")]
    kept = (
        keys.withColumn("identity", F.coalesce(c.official_id, "natural_key"))
        .groupBy("identity", c.official_id)
        .agg(F.max_by(F.struct(*payload), _reported_last(c)).alias("kept"),
             F.sum("sightings").alias("sightings"))
    )
    return kept.select(
        "kept.*", c.official_id, "identity", "sightings").select(
        *payload, natural_key(c).alias("natural_key"), c.official_id,
        F.when(F.col(c.official_id).isNotNull(), BY_ID).otherwise(BY_KEY).alias("fine_id_source"),
        "identity", "sightings")


def dedup_report(sightings: DataFrame, c: EventColumns = EventColumns(), **options) -> DataFrame:
    """What the dedup did, in one row."""
    keys = by_natural_key(with_natural_key(sightings, c, **options), c)
    per_identity = (
        keys.groupBy(F.coalesce(c.official_id, "natural_key").alias("identity"),
                     F.col(c.official_id).isNotNull().alias("by_id"))
        .agg(F.count("*").alias("keys"), F.sum("sightings").alias("sightings"),
             F.sum(F.when(F.col(c.official_id).isNotNull(), F.col("sightings") - F.col("with_id"))
                   .otherwise(0)).alias("backfilled"))
    )
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("bigint")
    return per_identity.agg(
        total("sightings").alias("rows_before"),
        F.count("*").alias("events_after"),
        (total("sightings") - F.count("*")).alias("repeats"),
        total("keys").alias("natural_keys"),
        (total("keys") - F.count("*")).alias("collapsed_by_id"),
        total("backfilled").alias("backfilled_ids"),
        F.count(F.when(F.col("by_id"), 1)).alias("events_by_id"),
        F.count(F.when(~F.col("by_id"), 1)).alias("events_by_natural_key"),
    ).withColumn("repeat_share", F.when(
        F.col("rows_before") > 0, F.col("repeats") / F.col("rows_before")))


def key_audit(sightings: DataFrame, c: EventColumns = EventColumns(), **options) -> DataFrame:
    """Check natural keys against official ids, after back-fill, in one row.

    Counts keys that cover several ids, ids spread over several keys, and events
    without an id whose identical siblings (same amount) have one, with their money.
    """
    needed = sightings.select(*dict.fromkeys([*c.group, c.official_id, c.amount, *c.position]))
    # numbered once, read four times
    keyed = durable(with_natural_key(needed, c, **options))
    keys = durable(by_natural_key(keyed, c).select(*c.group[1:], "occurrence", c.official_id, "natural_key"))
    ids = keys.filter(F.col(c.official_id).isNotNull())
    per_id = ids.groupBy(c.official_id).agg(F.count("*").alias("keys"))
    # one id per key is what back-fill leaves; counted, not assumed
    per_key = ids.groupBy("natural_key").agg(F.count_distinct(c.official_id).alias("ids"))

    event = [*c.group[1:], "occurrence"]
    amounts = [*c.group[1:], c.amount]
    by_amount = keyed.groupBy(*event, c.amount).agg(F.min(_reported_last(c)).alias("__first"))
    # a group holds one row per event and amount: null-safe joins on those columns
    known = keys.select(*event, F.col(c.official_id).isNotNull().alias("__known"))
    by_amount = lookups._equi(by_amount, known, event, "inner", null_safe=True)
    sibling = by_amount.filter("__known").select(*amounts).distinct()
    orphans = lookups._equi(by_amount.filter(~F.col("__known")), sibling, amounts, "left_semi",
                            null_safe=True)
    # an event restated without an id may be an orphan under several amounts: take its first
    events = orphans.groupBy(*event).agg(F.min_by(c.amount, "__first").alias("__money"))
    counted = lambda frame, condition: frame.agg(F.count(F.when(condition, 1)).alias("n")).scalar()
    return events.agg(
        F.count("*").alias("orphan_events"),
        F.coalesce(F.sum("__money"), F.lit(0)).cast("bigint").alias("orphan_money"),
    ).select(
        counted(per_key, F.lit(True)).alias("keys_audited"),
        counted(per_id, F.lit(True)).alias("ids_audited"),
        counted(per_key, F.col("ids") > 1).alias("keys_with_many_ids"),
        counted(per_id, F.col("keys") > 1).alias("ids_with_many_keys"),
        "orphan_events", "orphan_money",
    )
