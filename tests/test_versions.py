import datetime as dt
import random

import pytest

from tidemark.operators.versions import add_member, asof_lookup, prepend_unknown, scd1_latest, scd2_build

DAY = dt.date(2020, 1, 1)
MONTH = [DAY + dt.timedelta(days=31 * i) for i in range(14)]
SCHEMA = "ccn string, t date, a string, b string, c boolean"


def row_by_row(rows):
    """The rule stated as a walk over periods."""
    done, open_versions = [], {}
    for ccn, t, *values in sorted(rows, key=lambda r: r[1]):
        now = open_versions.get(ccn)
        if now is None:
            open_versions[ccn] = [ccn, t, None, list(values)]
            continue
        differs = any(v is not None and w is not None and v != w for v, w in zip(values, now[3]))
        merged = [w if v is None else v for v, w in zip(values, now[3])]
        if differs:
            done.append([now[0], now[1], t, now[3]])
            open_versions[ccn] = [ccn, t, None, merged]
        else:
            now[3] = merged
    return sorted((c, e, x, tuple(v)) for c, e, x, v in done + list(open_versions.values()))


def build(spark, rows, **options):
    out = scd2_build(spark.createDataFrame(rows, SCHEMA), "ccn", "t", ["a", "b", "c"], **options)
    return out, sorted((r.ccn, r.effective_date, r.expiry_date, (r.a, r.b, r.c)) for r in out.collect())


def key(v):
    return str(v)


def test_versions_equal_the_walk_on_random_data(spark):
    rng = random.Random(3)
    rows = [(f"{i:03d}", t, rng.choice(["x", "y", None]), rng.choice(["p", None, None]), rng.choice([True, False, None, None]))
            for i in range(60) for t in MONTH if rng.random() < 0.8]
    out, got = build(spark, rows)
    assert sorted(got, key=key) == sorted(row_by_row(rows), key=key)
    assert all(r.is_current == (r.expiry_date is None) for r in out.collect())


@pytest.mark.parametrize("values,versions", [
    ([None, "A", None, "B"], [("A", 0, 3), ("B", 3, None)]),      # fill in place, carry, change
    (["A", "A"], [("A", 0, None)]),
    ([None, None], [(None, 0, None)]),
    (["A", None, "A"], [("A", 0, None)]),
])
def test_unknown_is_not_a_change(spark, values, versions):
    rows = [("1", MONTH[i], v, None, None) for i, v in enumerate(values)]
    _, got = build(spark, rows)
    assert got == [("1", MONTH[a], None if b is None else MONTH[b], (v, None, None)) for v, a, b in versions]


def test_vanished_member_stays_current_and_returns_to_its_version(spark):
    rows = [("1", MONTH[0], "A", None, None), ("2", MONTH[0], "A", None, None), ("2", MONTH[1], "A", None, None),
            ("1", MONTH[5], "A", None, None)]
    out, got = build(spark, rows)
    assert len(got) == 2 and all(r.is_current for r in out.collect())


def test_repeated_sighting_keeps_the_first_row(spark):
    frame = spark.createDataFrame([("1", DAY, "late", 2), ("1", DAY, "first", 1)], "ccn string, t date, a string, pos int")
    assert [r.a for r in scd2_build(frame, "ccn", "t", ["a"], order=["pos"]).collect()] == ["first"]


def dimension(spark, with_gap=False):
    versions = [("1", MONTH[2], MONTH[4], 10), ("1", MONTH[6] if with_gap else MONTH[4], None, 11), ("2", MONTH[0], MONTH[3], 20)]
    return spark.createDataFrame(versions, "ccn string, effective_date date, expiry_date date, sk bigint")


@pytest.mark.parametrize("options", [{}, {"rows": 1, "hot_rows": 5}])
def test_asof_matches_a_scan(spark, options):
    rng = random.Random(5)
    asked = [(rng.choice(["1", "1", "1", "2", "9", None]), rng.choice(MONTH), i) for i in range(200)]
    for with_gap in (False, True):
        dim = dimension(spark, with_gap)
        known = [tuple(r) for r in dim.collect()]

        def scan(ccn, t):
            mine = sorted(v for v in known if v[0] == ccn)
            for _, a, b, sk in mine:
                if a <= t and (b is None or t < b):
                    return sk, "match"
            return (mine[0][3], "clamped") if mine else (-1, "missing")

        facts = spark.createDataFrame(asked, "ccn string, t date, i int")
        out = asof_lookup(facts, dim, "ccn", "t", "sk", status="how", **options).collect()
        assert len(out) == len(asked)
        assert all((r.sk, r.how) == scan(r.ccn, r.t) for r in out)


def test_unknown_row_and_literal_members(spark):
    dim = spark.createDataFrame([(1, "a", True)], "k bigint, name string, flag boolean")
    out = sorted(tuple(r) for r in prepend_unknown(add_member(dim, k=0, name="none"), "k").collect())
    assert out == [(-1, "Unknown", None), (0, "none", None), (1, "a", True)]


def test_latest_known_value_wins(spark):
    frame = spark.createDataFrame([("z", 1, "old", 1.0), ("z", 2, "new", 2.0), ("z", 3, None, None)], "k string, t int, x string, y double")
    assert tuple(scd1_latest(frame, ["k"], ["t"], ["x"], ["y"]).first()) == ("z", "new", 1.5)
