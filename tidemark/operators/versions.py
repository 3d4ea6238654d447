"""Slowly changing dimensions and the as-of lookup."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark import fixed_values as V
from tidemark.operators.lookups import join_range, lookup_join
from tidemark.operators.ordering import first_per_key


def scd2_build(
    sightings: DataFrame, key: str, time: str, tracked: list[str], order: list | None = None,
    effective: str = "effective_date", expiry: str = "expiry_date", current: str = "is_current",
) -> DataFrame:
    """Type 2 versions of a member from its periodic sightings.

    A version opens when a value that is known on both sides differs. A value
    that becomes known fills the open version; a value that becomes unknown is
    carried forward. A member that stops appearing keeps its open version.

    Repeated sightings of one (key, time) are reduced first, so a window never
    holds more rows of one member than there are periods.
    """
    rows = sightings.select(key, time, *tracked, *(order or []))
    if order:
        rows = first_per_key(rows, [key, time], order).select(key, time, *tracked)
    else:
        rows = rows.dropDuplicates([key, time])

    member = W.partitionBy(key).orderBy(time)
    before = member.rowsBetween(W.unboundedPreceding, -1)
    so_far = member.rowsBetween(W.unboundedPreceding, 0)
    known = {c: F.last(c, ignorenulls=True) for c in tracked}
    # null-safe "differs": unknown on either side is not a change
    differs = [F.coalesce(F.col(c) != known[c].over(before), F.lit(False)) for c in tracked]
    numbered = rows.withColumn("__changed", reduce(or_, differs).cast("int")).select(
        key, time, *[known[c].over(so_far).alias(c) for c in tracked],
        F.sum("__changed").over(so_far).alias("__version"))
    versions = numbered.groupBy(key, "__version").agg(
        F.min(time).alias(effective),
        F.max_by(F.struct(*tracked), time).alias("__last"),
    ).select(key, *[F.col(f"__last.{c}").alias(c) for c in tracked], effective)
    following = F.lead(effective).over(W.partitionBy(key).orderBy(effective))
    return versions.withColumn(expiry, following).withColumn(current, F.col(expiry).isNull())


def lookup_ranges(
    versions: DataFrame, key: str, surrogate: str, effective="effective_date", expiry="expiry_date",
) -> DataFrame:
    """Versions widened to ranges that cover all of time for every member.

    Time before the first version and gaps between versions belong to the first
    version and are marked ``clamped``.
    """
    member = W.partitionBy(key).orderBy(effective)
    rows = versions.select(
        key, F.col(surrogate).alias("__sk"), F.col(effective).alias("__from"),
        F.col(expiry).alias("__to"),
        F.first(surrogate).over(member.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).alias("__first"),
        F.row_number().over(member).alias("__nr"),
        F.lead(effective).over(member).alias("__next"),
    )
    none = F.lit(None).cast("date")
    span = lambda a, b, sk, clamped: F.struct(
        a.cast("date").alias("__from"), b.cast("date").alias("__to"), sk.alias("__sk"),
        F.lit(clamped).alias("__clamped"))
    c = F.col
    pieces = F.array(
        span(c("__from"), c("__to"), c("__sk"), False),
        F.when(c("__nr") == 1, span(none, c("__from"), c("__first"), True)),
        F.when(c("__to").isNotNull() & (c("__next").isNull() | (c("__next") > c("__to"))),
               span(c("__to"), c("__next"), c("__first"), True)),
    )
    return rows.select(key, F.inline(F.filter(pieces, lambda p: p.isNotNull())))


def asof_lookup(
    facts: DataFrame, versions: DataFrame, key: str, at: str, surrogate: str,
    effective="effective_date", expiry="expiry_date", into: str | None = None,
    status: str | None = None, **options,
) -> DataFrame:
    """The version valid at a fact's date: effective <= at < expiry.

    Dates no version covers get the first version, unknown members get -1. The
    join has an equality on the key and a range as residual; each fact meets
    exactly one range, and adaptive execution may split a hot member. ``status``
    names an optional match/clamped/missing column; other options (``rows``,
    ``hot_rows``) ask for a lookup that is checked and salted beforehand.
    """
    into = into or surrogate
    known = versions.filter(F.col(surrogate) != V.UNKNOWN_KEY)
    ranges = lookup_ranges(known, key, surrogate, effective, expiry)
    when = F.col(f"l.{at}").cast("date")
    inside = (F.col("r.__from").isNull() | (F.col("r.__from") <= when)) & (
        F.col("r.__to").isNull() | (when < F.col("r.__to")))
    joined = (lookup_join(facts, ranges, key, "left", residual=inside, **options) if options
              else join_range(facts, ranges, key, inside))
    out = joined.withColumn(into, F.coalesce("__sk", F.lit(V.UNKNOWN_KEY)).cast("bigint"))
    if status:
        out = out.withColumn(status, F.when(F.col("__sk").isNull(), "missing")
                             .when(F.col("__clamped"), "clamped").otherwise("match"))
    return out.drop("__sk", "__clamped", "__from", "__to")


def scd1_latest(
    rows: DataFrame, keys: list[str], order: list, latest: list[str], averaged: list[str] = (),
) -> DataFrame:
    """Type 1: the last known value of each attribute, means where asked for."""
    at = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order])
    return rows.groupBy(*keys).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), at)).alias(c) for c in latest],
        *[F.avg(c).alias(c) for c in averaged],
    )


def prepend_unknown(dim: DataFrame, key: str, **values) -> DataFrame:
    """Add the member at key -1: text says Unknown, everything else is null."""
    return add_member(dim, **{
        **{f.name: V.UNKNOWN_LABEL for f in dim.schema if f.dataType.simpleString() == "string"},
        **values, key: V.UNKNOWN_KEY})


def add_member(dim: DataFrame, **values) -> DataFrame:
    literal = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in dim.schema]
    return dim.sparkSession.range(1).select(*literal).unionByName(dim)
