"""Positions in a fixed order: dense keys, row numbers, exact quantiles.

Small inputs use an ordinary window. Past a checked size the rows are cut into
ranges of the order ("slices"), numbered inside each slice, and shifted by the
totals of the slices before. No task ever sorts more than one slice, however hot
a group is. Where a size must be known first, the rows are written once and
counted there, so the work behind them is not done twice.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.operators import lookups
from tidemark.operators.quantiles import exact_cuts
from tidemark.session import durable, stored


def _columns(order) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def sliced_total(
    frame: DataFrame, order: list, into: str, *, by: list[str] = (), weight: Column | None = None,
    slice_rows: int | None = None,
) -> DataFrame:
    """Add the sum of ``weight`` over all earlier rows of the same group.

    The slice number comes from range partitioning, so the sliced rows are
    written durably before anything is counted: all later steps and retries see
    the same slices.
    """
    slice_rows = slice_rows or lookups.HOT_ROWS
    by, order = list(by), _columns(order)
    weight = F.lit(1) if weight is None else weight
    # range partitioning samples its input first: sample the written rows
    written = durable(frame)
    slices = max(1, math.ceil(written.count() / slice_rows))
    sliced = durable(
        written.withColumn("__weight", weight.cast("bigint"))
        .repartitionByRange(slices, *[F.col(c) for c in by], *order)
        .withColumn("__slice", F.spark_partition_id())
    )
    totals = sliced.groupBy(*by, "__slice").agg(F.sum("__weight").alias("__total"))
    earlier = W.partitionBy(*by).orderBy("__slice").rowsBetween(W.unboundedPreceding, -1)
    # a group appears here once per slice it spans, so these windows stay small
    offsets = totals.withColumn("__offset", F.sum("__total").over(earlier)).filter(
        F.col("__offset").isNotNull()).drop("__total")
    inside = W.partitionBy(*by, "__slice").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    numbered = sliced.withColumn("__inside", F.sum("__weight").over(inside))
    joined = lookups._equi(numbered, offsets, by + ["__slice"], "left", null_safe=True)
    return joined.withColumn(
        into, F.coalesce("__inside", F.lit(0)) + F.coalesce("__offset", F.lit(0))
    ).drop("__inside", "__offset", "__slice", "__weight")


def dense_key(frame: DataFrame, order: list, into: str, *, first: int = 1,
              limit: int | None = None) -> DataFrame:
    """Surrogate keys first, first+1, ... in a fixed total order.

    Up to ``limit`` rows only the columns of the order are sorted in one task; the
    numbers, two longs a row, are broadcast back to the rows by their place in the checkpoint.
    """
    limit = lookups.HOT_ROWS if limit is None else limit
    frame = durable(frame)
    if frame.count() <= limit:
        placed = frame.withColumn("__place", F.monotonically_increasing_id())
        number = F.row_number().over(W.orderBy(*_columns(order))) - 1 + first
        numbers = placed.select("__place", number.cast("bigint").alias(into))
        return placed.join(F.broadcast(numbers), "__place").select(into, *frame.columns)
    numbered = sliced_total(frame, order, into, slice_rows=limit)
    return numbered.select((F.col(into) + first).cast("bigint").alias(into), *frame.columns)


def number_in_group(frame: DataFrame, by: list[str], order: list, into: str, *,
                    limit: int | None = None) -> DataFrame:
    """Zero-based position inside a group; null group values form groups."""
    limit = lookups.HOT_ROWS if limit is None else limit
    hot = frame.groupBy(*by).count().filter(F.col("count") > limit)
    if hot.isEmpty():
        window = W.partitionBy(*by).orderBy(*_columns(order))
        return frame.withColumn(into, (F.row_number().over(window) - 1).cast("bigint"))
    return sliced_total(frame, order, into, by=by, slice_rows=limit)


def first_per_key(frame: DataFrame, keys: list[str], order: list, last: bool = False) -> DataFrame:
    """One row per key: the first (or last) in order.

    An aggregate rather than a window, so a hot key is reduced before the shuffle.
    """
    rest = [c for c in frame.columns if c not in keys]
    pick = (F.max_by if last else F.min_by)(F.struct(*rest), F.struct(*_columns(order)))
    return frame.groupBy(*keys).agg(pick.alias("__row")).select(*keys, "__row.*").select(
        *frame.columns)


def exact_quantiles(
    frame: DataFrame, value: str, probs: list[float], *, by: list[str] = (), into: str = "cuts",
    bounded: bool = False, limit: int | None = None,
) -> DataFrame:
    """Exact quantiles with linear interpolation, one array per group.

    ``bounded`` says the value domain is small by construction (star ratings, one
    row per state). Otherwise equal values are merged, written and counted. Past
    ``limit`` of them refined histograms take over for a whole frame, a distributed
    selection for groups.
    """
    by = list(by)
    limit = lookups.PIN_ROWS if limit is None else limit
    counts = (
        frame.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("__v")).agg(F.count("*").alias("__n"))
    )
    if not bounded:
        counts = stored(counts, "merged-values")
    if bounded or counts.count() <= limit:
        return counts.groupBy(*by).agg(
            F.percentile("__v", F.array(*[F.lit(float(p)) for p in probs]), F.col("__n")).alias(into))
    if not by:
        return exact_cuts(frame, {value: probs}, limit=limit).withColumnRenamed(value, into)
    ranked = sliced_total(counts, ["__v"], "__before", by=by, weight=F.col("__n"), slice_rows=limit)
    sizes = counts.groupBy(*by).agg(F.sum("__n").alias("__size"))
    ranked = lookups.lookup_join(ranked, sizes, by, "inner", null_safe=True)
    picks = []
    for i, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("__size") - 1)
        covers = lambda pos: (F.col("__before") <= pos) & (pos < F.col("__before") + F.col("__n"))
        low, high = F.floor(at), F.ceil(at)
        picks += [
            F.max(F.when(covers(low), F.col("__v"))).alias(f"__lo{i}"),
            F.max(F.when(covers(high), F.col("__v"))).alias(f"__hi{i}"),
            F.max(at - low).alias(f"__at{i}"),
        ]
    found = ranked.groupBy(*by).agg(*picks)
    cut = lambda i: F.when(
        F.col(f"__lo{i}") == F.col(f"__hi{i}"), F.col(f"__lo{i}")
    ).otherwise(F.col(f"__lo{i}") * (1 - F.col(f"__at{i}")) + F.col(f"__hi{i}") * F.col(f"__at{i}"))
    return found.select(*by, F.array(*[cut(i) for i in range(len(probs))]).alias(into))


def one_row(frame: DataFrame, column: str) -> Column:
    """The single value of a one-row frame, as a scalar subquery."""
    return frame.select(column).scalar()


def quantile_cuts(frame: DataFrame, value: str, probs: list[float], **options) -> Column:
    return one_row(exact_quantiles(frame, value, probs, **options), "cuts")


def percentile_rank(frame: DataFrame, value: str, into: str, *, ascending: bool = True,
                    by: list[str] = ()) -> DataFrame:
    """Average-tie rank divided by the number of ranked rows; null stays null.

    Meant for frames of bounded size (one row per state, per segment).
    """
    c = F.col(value)
    order = c.asc_nulls_last() if ascending else c.desc_nulls_last()
    everyone = W.partitionBy(*by)
    peers = W.partitionBy(*by, value)
    rank = F.rank().over(everyone.orderBy(order))
    tied = F.count(c).over(peers)
    return frame.withColumn(into, F.when(
        c.isNotNull(), (rank + (tied - 1) / 2.0) / F.count(c).over(everyone)))
