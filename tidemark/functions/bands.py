"""Labels for ranges of a value. The order number is part of the contract."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark import fixed_values as V
from tidemark.functions.clean import col


def _pick(value: Column, bands: list[tuple], result, right_closed: bool) -> Column:
    chosen = F.lit(None)
    for index, (low, high, label) in reversed(list(enumerate(bands))):
        inside = value.isNotNull()
        if low is not None:
            first = right_closed and index == 0
            inside &= (value > low) if right_closed and not first else (value >= low)
        if high is not None:
            inside &= (value <= high) if right_closed else (value < high)
        chosen = F.when(inside, F.lit(result(index, label))).otherwise(chosen)
    return chosen


def band(value: Column | str, bands: list[tuple], right_closed: bool = False) -> Column:
    """Label of the band that holds the value; null outside every band."""
    return _pick(col(value), bands, lambda i, label: label, right_closed).cast("string")


def band_order(value: Column | str, bands: list[tuple], right_closed: bool = False) -> Column:
    return _pick(col(value), bands, lambda i, label: i, right_closed).cast("int")


def with_band(df, value, bands, label="band", order="band_ord", right_closed=False):
    return df.withColumn(label, band(value, bands, right_closed)).withColumn(
        order, band_order(value, bands, right_closed))


def label_order(c: Column | str, labels: list[str]) -> Column:
    """Position of a label in a fixed list, unknown labels after all others."""
    c = col(c)
    chosen = F.lit(len(labels))
    for index, label in reversed(list(enumerate(labels))):
        chosen = F.when(c == label, index).otherwise(chosen)
    return chosen.cast("int")


def bed_band(beds: Column | str) -> Column:
    """Unknown beds stay null, so a late value is a fill and not a change."""
    return band(beds, V.BED_BANDS)


def chain_band(size: Column | str) -> Column:
    n = col(size)
    return (
        F.when(n <= 1, V.CHAIN_BAND_ORDER[0])
        .when((n >= 2) & (n <= 9), V.CHAIN_BAND_ORDER[1])
        .when((n >= 10) & (n <= 49), V.CHAIN_BAND_ORDER[2])
        .when(n >= 50, V.CHAIN_BAND_ORDER[3])
        .otherwise(V.UNKNOWN_LABEL)
    )


def quartile_bin(value: Column | str, cuts: Column, labels: list[str], order: bool = False) -> Column:
    """Right-closed bins at the given three cut points (an array Column)."""
    value = col(value)
    result = [F.lit(i if order else label) for i, label in enumerate(labels)]
    return F.when(value.isNotNull(), (
        F.when(value <= cuts[0], result[0])
        .when(value <= cuts[1], result[1])
        .when(value <= cuts[2], result[2])
        .otherwise(result[3])
    ))
