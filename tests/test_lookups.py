from collections import Counter

from pyspark.sql import functions as F

from tidemark.operators.lookups import join_unique, key_lookup, lookup_join, pinned, salted_join


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def facts(spark):
    keys = ["hot"] * 500 + ["a"] * 3 + [None] * 4 + ["gone"] * 2
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, i int")


def dim(spark):
    return spark.createDataFrame([("hot", 1), ("a", 2), (None, 3)], "k string, v int")


def expected(null_value):
    return Counter({1: 500, 2: 3, null_value: 4}) + Counter({None: 2})


def test_pinned_refuses_what_is_large(spark):
    assert pinned(spark.range(11), rows=10) is None
    assert pinned(spark.range(10), rows=10).count() == 10
    assert pinned(spark.range(10), size=8) is None
    assert pinned(spark.range(0)).count() == 0


def test_small_lookup_is_broadcast_and_the_large_side_not_shuffled(spark):
    out = lookup_join(facts(spark), dim(spark), "k")
    assert "BroadcastHashJoin" in plan(out) and "Exchange hashpartitioning" not in plan(out)
    assert Counter(r.v for r in out.collect()) == Counter({1: 500, 2: 3, None: 6})


def test_large_lookup_salts_hot_keys_and_keeps_every_row(spark):
    for null_safe, want in ((True, expected(3)), (False, expected(None))):
        out = salted_join(facts(spark), dim(spark), "k", null_safe=null_safe, hot_rows=100, salts=8)
        assert Counter(r.v for r in out.collect()) == want
        assert out.columns == ["k", "i", "v"]
    semi = salted_join(facts(spark), dim(spark), "k", "left_semi", hot_rows=100)
    assert semi.count() == 503
    anti = salted_join(facts(spark), dim(spark), "k", "left_anti", hot_rows=100)
    assert anti.count() == 6


def test_without_hot_keys_nothing_is_salted(spark):
    out = lookup_join(facts(spark), dim(spark), "k", rows=1, hot_rows=10_000)
    assert Counter(r.v for r in out.collect()) == Counter({1: 500, 2: 3, None: 6})


def test_residual_condition(spark):
    ranges = spark.createDataFrame([("hot", 0, 250, "x"), ("hot", 250, 900, "y")], "k string, a int, b int, v string")
    inside = (F.col("l.i") >= F.col("r.a")) & (F.col("l.i") < F.col("r.b"))
    for options in ({}, {"rows": 1, "hot_rows": 100}):
        out = lookup_join(facts(spark), ranges, "k", residual=inside, **options)
        assert Counter(r.v for r in out.collect()) == Counter({"x": 250, "y": 250, None: 9})


def test_key_lookup_defaults_to_unknown(spark):
    keyed = spark.createDataFrame([("a", 5), ("Unknown", -1)], "name string, sk bigint")
    out = key_lookup(facts(spark), keyed, {"k": "name"}, "sk")
    assert Counter(r.sk for r in out.collect()) == Counter({5: 3, -1: 506})


def test_join_unique_null_safe(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, y int")
    assert sorted((r.x, r.y) for r in join_unique(left, right, "k", null_safe=True).collect()) == [(1, 10), (2, 20)]
    assert sorted((r.x, r.y or 0) for r in join_unique(left, right, "k").collect()) == [(1, 0), (2, 20)]
