"""Exact quantiles of several columns from one aggregate, refined where needed.

The rows are reduced to a histogram per column whose buckets keep their count,
smallest and largest value. Buckets are merged before the shuffle and their number
is bounded, whatever the number of rows or how often a value occurs. Only buckets
that hold a wanted position matter further: while they hold too many rows they are
cut again by the same step, and what is left is merged by value and picked from.
Nothing is written.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.operators import lookups

#: Buckets per unit of log(1 + |v|): a bucket is 1.6 % wide, all doubles fill at most 90,880.
LOG_STEPS = 64
#: Parts a bucket is cut into when it holds too many rows.
PARTS = 1024
_TOP = (1 << 63) - 1


def _first_bucket(v: Column) -> Column:
    """A bucket that never falls as the value rises; infinities and NaN (the largest) have their own."""
    return (F.when(F.isnan(v), F.lit(_TOP)).when(v == F.lit(math.inf), F.lit(_TOP - 1))
            .when(v == F.lit(-math.inf), F.lit(-_TOP))
            .otherwise(F.floor(F.signum(v) * F.log1p(F.abs(v)) * LOG_STEPS)))


def _histogram(rows: DataFrame, bucket: Column) -> DataFrame:
    """Buckets of every span in order, with the rows before each inside its span."""
    counted = rows.groupBy("__span", bucket.alias("__bucket")).agg(
        F.count("*").alias("n"), F.min("__v").alias("low"), F.max("__v").alias("high"))
    span = W.partitionBy("__span")                  # a bounded number of buckets
    earlier = span.orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    return counted.withColumns({
        "before": F.coalesce(F.sum("n").over(earlier), F.lit(0)), "size": F.sum("n").over(span)})


def _held(positions: Column) -> Column:
    return F.exists(positions, lambda at: (at >= F.col("before")) & (at < F.col("before") + F.col("n")))


def _positions(probs: list[float], size: int) -> list[tuple[float, int, int]]:
    """Wanted position, and the positions of the values on both sides of it."""
    return [(at, math.floor(at), math.ceil(at)) for at in (float(p) * (size - 1) for p in probs)]


def _inside(rows: DataFrame, spans: list[tuple]) -> DataFrame:
    """Rows of the spans left, numbered by them; spans of a column do not overlap."""
    number = F.coalesce(*[F.when((F.col("__c") == c) & F.col("__v").between(low, high), i)
                          for i, (c, _, _, low, high) in enumerate(spans)])
    return rows.withColumn("__span", number).filter(F.col("__span").isNotNull())


def exact_cuts(frame: DataFrame, wanted: dict[str, list[float]], *, limit: int | None = None) -> DataFrame:
    """One row with an array of quantiles, linearly interpolated, for each column of ``wanted``.

    Nulls are no values; a column without values gets null. NaN is the largest
    value. ``limit`` is the number of rows up to which the buckets left are merged
    by value; it changes the number of passes over the rows, not the result.
    """
    limit = lookups.PIN_ROWS if limit is None else limit
    columns = list(wanted)
    pairs = F.array(*[F.struct(F.lit(i).alias("__c"), F.col(c).cast("double").alias("__v")) for i, c in enumerate(columns)])
    rows = frame.select(F.inline(pairs)).filter(F.col("__v").isNotNull())

    at = lambda p: p * (F.col("size") - 1)
    probs = F.array(*[F.array(*[F.lit(float(p)) for p in wanted[c]]) for c in columns])
    both = F.transform(F.get(probs, F.col("__span")), lambda p: F.array(F.floor(at(p)), F.ceil(at(p))))
    # a row per wanted position
    found = _histogram(rows.withColumn("__span", F.col("__c")), _first_bucket(F.col("__v"))).filter(
        _held(F.flatten(both))).collect()
    sizes = {r["__span"]: r["size"] for r in found}
    spans = [(r["__span"], r["before"], r["n"], r["low"], r["high"]) for r in found]
    positions = {c: _positions(wanted[columns[c]], size) for c, size in sizes.items()}
    ranks = {c: sorted({k for _, low, high in found for k in (low, high)}) for c, found in positions.items()}

    single = lambda span: span[3] == span[4] or span[3] != span[3]
    while sum(s[2] for s in spans if not single(s)) > limit:
        open_spans = [s for s in spans if not single(s)]
        lows, widths, inside = (F.array(*x) for x in zip(*[
            (F.lit(low), F.lit(high - low), F.array(*[F.lit(k - before) for k in ranks[c] if before <= k < before + n]))
            for c, before, n, low, high in open_spans]))
        of = lambda x: F.get(x, F.col("__span"))
        part = F.floor((F.col("__v") - of(lows)) / of(widths) * PARTS)
        finer = _histogram(_inside(rows, open_spans), part).filter(_held(of(inside))).collect()
        spans = [s for s in spans if single(s)] + [
            (open_spans[r["__span"]][0], open_spans[r["__span"]][1] + r["before"], r["n"], r["low"], r["high"]) for r in finer]

    open_spans = [s for s in spans if not single(s)]
    if open_spans:
        merged = _inside(rows, open_spans).groupBy("__span", "__v").agg(F.count("*").alias("n"))
        upto = W.partitionBy("__span").orderBy("__v").rowsBetween(W.unboundedPreceding, 0)
        one = merged.withColumn("upto", F.sum("n").over(upto))
    else:
        one = frame.sparkSession.range(1)           # every bucket left holds one value: no second pass
    names = {}
    for c in sizes:
        for k in ranks[c]:
            i, before, value = next(
                (open_spans.index(s) if s in open_spans else None, s[1], s[3]) for s in spans if s[0] == c and s[1] <= k < s[1] + s[2])
            names[c, k] = F.lit(value) if i is None else F.min(
                F.when((F.col("__span") == i) & (F.col("upto") > k - before), F.col("__v")))
    picked = one.agg(F.count("*").alias("__rows"), *[x.alias(f"c{c}_{k}") for (c, k), x in names.items()])

    def cut(c, where, low, high):
        a, b = F.col(f"c{c}_{low}"), F.col(f"c{c}_{high}")
        return F.when(a == b, a).otherwise(a * (high - where) + b * (where - low)) if low != high else a

    return picked.select(*[
        (F.array(*[cut(c, *p) for p in positions[c]]) if c in sizes else F.lit(None).cast("array<double>")).alias(name)
        for c, name in enumerate(columns)])


def cuts_of(frame: DataFrame, wanted: dict[str, list[float]], **options) -> dict[str, Column]:
    """The same as one scalar subquery, an array column per name."""
    found = exact_cuts(frame, wanted, **options)
    row = found.select(F.struct(*found.columns).alias("cuts")).scalar()
    return {name: row.getField(name) for name in wanted}
