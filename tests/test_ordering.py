import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators.ordering import (
    dense_key, exact_quantiles, first_per_key, number_in_group, percentile_rank, sliced_total,
)


@pytest.fixture(scope="module")
def sample():
    rng = random.Random(7)
    # one group holds most rows, some keys are null
    return [(rng.choice(["hot"] * 6 + ["a", "b", None]), i, rng.randint(0, 40) / 4) for i in range(3000)]


def test_dense_keys_are_the_same_by_window_and_by_slices(spark, sample):
    frame = spark.createDataFrame(sample, "g string, i int, v double").repartition(7)
    order = [F.col("v").desc(), "i"]
    expected = {i: n for n, (_, i, _) in enumerate(sorted(sample, key=lambda r: (-r[2], r[1])), 1)}
    for limit in (10_000, 100):
        got = {r.i: r.k for r in dense_key(frame, order, "k", limit=limit).collect()}
        assert got == expected


def test_positions_inside_a_hot_group(spark, sample):
    frame = spark.createDataFrame(sample, "g string, i int, v double").repartition(5)
    expected, seen = {}, {}
    for g, i, _ in sorted(sample, key=lambda r: r[1]):
        expected[i] = seen[g] = seen.get(g, -1) + 1
    for limit in (10_000, 150):
        got = {r.i: r.n for r in number_in_group(frame, ["g"], ["i"], "n", limit=limit).collect()}
        assert got == expected


def test_slices_split_a_hot_group(spark, sample):
    frame = spark.createDataFrame(sample, "g string, i int, v double")
    out = sliced_total(frame, ["i"], "before", by=["g"], weight=F.lit(2), slice_rows=100)
    last = {r.g: r.b for r in out.groupBy("g").agg(F.max("before").alias("b")).collect()}
    sizes = pd.Series([g for g, _, _ in sample]).value_counts(dropna=False)
    assert all(last[g if isinstance(g, str) else None] == 2 * (n - 1) for g, n in sizes.items())


@pytest.mark.parametrize("limit", [100_000, 5])
def test_exact_quantiles(spark, sample, limit):
    frame = spark.createDataFrame(sample, "g string, i int, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 1.0]
    whole = exact_quantiles(frame, "v", probs, limit=limit).first().cuts
    assert np.allclose(whole, np.quantile([v for _, _, v in sample], probs))
    for r in exact_quantiles(frame, "v", probs, by=["g"], limit=limit).collect():
        assert np.allclose(r.cuts, np.quantile([v for g, _, v in sample if g == r.g], probs))


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(empty, "v", [0.5]).first().cuts is None


def test_percentile_rank_matches_average_ties(spark):
    values = [3.0, 1.0, 3.0, None, 2.0, 2.0, 2.0, 9.0]
    frame = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    for ascending in (True, False):
        want = pd.Series(values).rank(pct=True, ascending=ascending)
        got = {r.i: r.p for r in percentile_rank(frame, "v", "p", ascending=ascending).collect()}
        assert got[3] is None
        assert all(abs(got[i] - want[i]) < 1e-12 for i in range(8) if i != 3)


def test_first_and_last_per_key(spark, sample):
    frame = spark.createDataFrame(sample, "g string, i int, v double")
    first = {r.g: r.i for r in first_per_key(frame, ["g"], ["i"]).collect()}
    last = {r.g: r.i for r in first_per_key(frame, ["g"], ["i"], last=True).collect()}
    for g in {r[0] for r in sample}:
        mine = [i for h, i, _ in sample if h == g]
        assert (first[g], last[g]) == (min(mine), max(mine))
    assert first_per_key(frame, ["g"], ["i"]).columns == frame.columns


def test_a_group_of_many_rows_is_numbered_in_slices(spark, monkeypatch):
    """300,000 rows of one file are more than one task sorts."""
    from tidemark.operators import ordering
    sliced = []
    monkeypatch.setattr(ordering, "sliced_total", lambda frame, *a, **k: sliced.append(k) or frame.withColumn(a[1], F.col("x")))
    ordering.number_in_group(spark.range(300_000).select(F.lit("f").alias("file"), F.col("id").alias("x")), ["file"], ["x"], "place")
    assert [k["slice_rows"] for k in sliced] == [250_000]
