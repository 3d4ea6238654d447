import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score string, id string, anchor string, x string, tops string, row string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, *["clash"] * 6) for i, v, l in rows], SCHEMA).repartition(3)


def mined(spark, rows, every=10, **settings):
    got = negatives.mined(frame(spark, rows), F.col("vec_id") % every == 0, **settings).collect()
    return sorted(tuple(r) for r in got)


def plain(rows, every=10, positives=5, wanted=10, low=30, high=90):
    sound = [(i, [int(np.floor(256 * x)) for x in v], l) for i, v, l in rows
             if i is not None and v and l is not None and all(x is not None and np.isfinite(x) for x in v)]
    sound = [r for r in sound if sum(x * x for x in r[1]) < 1 << 61]
    anchors = {}
    for i, v, l in sound:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (l, v)), (l, v))
    out = []
    for a, (label, x) in anchors.items():
        scored = [(-sum(p * q for p, q in zip(x, v)), i, l) for i, v, l in sound if len(v) == len(x)]
        for minus, p, _ in sorted(s for s in scored if s[2] == label and s[1] != a)[:positives]:
            inside = sorted((m, i) for m, i, l in scored if l != label and low * -minus <= -100 * m <= high * -minus)
            out += [(a, p, r + 1, n, -minus, -m) for r, (m, n) in enumerate(inside[:wanted])]
    return sorted(out)


def vectors(n=400, dim=12, labels=3, seed=4):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((labels, dim)) * 0.5
    return [(i, [float(np.float32(x)) for x in centre[i % labels] * rng.uniform(0, 1) + 0.3 * rng.standard_normal(dim)], i % labels)
            for i in range(n)]


def test_equals_all_pairs(spark):
    rows = vectors()
    n = len(rows)
    rows += [(n, None, 0), (n + 10, [], 0), (n + 1, [0.0] * 12, 0), (n + 2, [float("nan")] * 12, 0), (n + 3, [None] + [1.0] * 11, 0),
             (n + 4, rows[0][1], None), (None, rows[0][1], 1), (n + 5, [float("-inf")] * 12, 0), (n + 6, [1.0, 2.0], 0), (n + 7, [0.5, 2.0], 1),
             (410, [1.5, 1.5], 0), (n + 8, [1e300] * 12, 1), (420, [3e8] * 12, 1), (n + 9, [1.0] * 12, 2)]
    rows += [rows[40], rows[40], rows[41], (50, rows[51][1], 2)]                    # repeated rows and ids
    rows += [(500 + k, rows[3][1], k % 3) for k in range(60)]                       # ties
    got = mined(spark, rows)
    assert got == plain(rows) and len(got) > 500


@pytest.mark.parametrize("settings", [{"block": 3, "stretch": 37}, {"block": 1, "stretch": 1000}])
def test_blocks_and_stretches_change_nothing(spark, settings):
    rows = vectors(150)
    assert mined(spark, rows, **settings) == plain(rows)


def test_a_label_with_most_rows_and_fewer_rows_than_asked_for(spark):
    rows = [(i, v, 0 if i % 9 else 1) for i, v, _ in vectors(200, seed=6)]
    assert mined(spark, rows) == plain(rows)
    few = vectors(12, seed=7)
    assert mined(spark, few) == plain(few)


def test_all_scores_negative_give_no_window(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [-1.0, 0.0], 0), (2, [-0.5, 0.0], 1)]
    assert mined(spark, rows) == plain(rows) == []


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(i, [4e5 + v, 3e5 + w, 1e5], l) for i, (_, (v, w, *_), l) in enumerate(vectors(60, seed=8))]
    got = mined(spark, rows, low=10, high=100)
    assert got == plain(rows, low=10, high=100) and max(r[5] for r in got) > 1 << 53


def test_empty_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []


def test_other_settings(spark):
    rows = vectors(120, seed=9)
    assert mined(spark, rows, positives=2, negatives=3, low=0, high=70) == plain(rows, positives=2, wanted=3, low=0, high=70)
