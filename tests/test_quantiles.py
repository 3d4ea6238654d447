"""Quantiles of several columns against numpy, with one pass and with many."""

import math
import uuid

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators.quantiles import cuts_of, exact_cuts

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 1.0]


def jobs(spark, action):
    """Jobs that ``action`` starts."""
    tag = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(tag, tag)
    try:
        out = action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(tag))


@pytest.mark.parametrize("limit", [100_000, 40, 0])
def test_columns_of_every_kind_together(spark, limit):
    rng = np.random.default_rng(3)
    n = 4000
    hot = np.where(rng.random(n) < 0.4, 7.25, rng.normal(0, 50, n))          # a third of the rows hold one value
    wide = np.exp(rng.normal(0, 30, n)) * rng.choice([-1, 1], n)
    close = 1e9 + rng.integers(0, 300, n) / 1024                              # all in one first bucket
    known = rng.random(n) < 0.7
    rows = [(float(a), float(b), float(c), int(d) if k else None, None) for a, b, c, d, k in zip(hot, wide, close, rng.integers(-3, 4, n), known)]
    frame = spark.createDataFrame(rows, "hot double, wide double, close double, whole int, empty double").repartition(5)
    got = exact_cuts(frame, {c: PROBS for c in frame.columns}, limit=limit).first()
    for i, c in enumerate(frame.columns[:4]):
        want = np.quantile([r[i] for r in rows if r[i] is not None], PROBS)
        assert np.allclose(got[c], want, rtol=1e-12, atol=0), c
    assert got["empty"] is None


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, min_value=-1e300, max_value=1e300), min_size=1, max_size=40), st.sampled_from([0, 3, 1000]))
def test_any_doubles(spark, values, limit):
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    ordered = sorted(values)
    # exact positions, where numpy interpolates nothing
    probs = [0.0, 1.0] + ([0.5] if len(values) % 2 else [])
    got = exact_cuts(frame, {"v": probs}, limit=limit).first().v
    assert got == [ordered[0], ordered[-1]] + ([ordered[len(values) // 2]] if len(values) % 2 else [])


def test_values_out_of_the_ordinary(spark):
    frame = spark.createDataFrame([(math.inf,), (-math.inf,), (float("nan"),), (-0.0,), (0.0,), (None,), (5e-324,)], "v double")
    for limit in (0, 100):
        got = exact_cuts(frame, {"v": [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]}, limit=limit).first().v
        assert got[:5] == [-math.inf, 0.0, 0.0, 5e-324, math.inf] and math.isnan(got[5])


def test_nothing_and_clashing_names(spark):
    empty = spark.createDataFrame([], "__v double, __c double, n int")
    assert list(exact_cuts(empty, {"__v": [0.5], "__c": [0.1], "n": [0.5]}).first()) == [None, None, None]
    frame = spark.createDataFrame([(1.0, 2.0, 3), (3.0, 4.0, 5)], "__v double, __c double, n int")
    assert list(exact_cuts(frame, {"__v": [0.5], "__c": [0.5], "n": [0.5]}).first()) == [[2.0], [3.0], [4.0]]


def test_all_cuts_of_a_frame_come_from_one_aggregate(spark, tmp_path):
    spark.range(20_000).select((F.col("id") % 97).alias("a"), (F.col("id") / 7).alias("b")).write.parquet(str(tmp_path / "t"))
    frame = spark.read.parquet(str(tmp_path / "t"))
    _, of_one = jobs(spark, lambda: cuts_of(frame, {"a": [0.5]}))
    cuts, of_both = jobs(spark, lambda: cuts_of(frame, {"a": [0.5], "b": [0.25, 0.75]}))
    assert of_both == of_one                         # one histogram, however many columns
    row = frame.select(cuts["a"].alias("a"), cuts["b"].alias("b")).first()
    assert row.a == [48.0] and np.allclose(row.b, np.quantile(np.arange(20_000) / 7, [0.25, 0.75]))
