"""Merging period by period against the operators over all periods."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup, increments
from tidemark.operators.ordering import dense_key
from tidemark.operators.versions import scd2_build

DAY = [dt.date(2020, m, 1) for m in range(1, 9)]
TRACKED = ["a", "b"]
VERSIONS = "sk bigint, k string, a string, b boolean, effective_date date, expiry_date date, is_current boolean"


def sightings(spark, seed=1, members=40):
    rng = random.Random(seed)
    rows = [(f"m{i}" if i else None, d, rng.choice(["x", "y", None]), rng.choice([True, False, None]), rng.randrange(100))
            for i in range(members) for d in DAY if rng.random() < 0.7]
    rows += rows[:10]
    return spark.createDataFrame(rows, "k string, t date, a string, b boolean, row int").cache()


@pytest.mark.parametrize("cuts", [[1, 2, 3, 4, 5, 6, 7], [4], [0, 3]])
def test_versions_period_by_period(spark, rows, cuts):
    seen = sightings(spark)
    versions = spark.createDataFrame([], VERSIONS)
    given = {}
    for low, high in zip([0, *cuts], [*cuts, len(DAY)]):
        part = seen.where(F.col("t").isin(DAY[low:high]) if high > low else F.lit(False))
        merged = increments.scd2_merge(versions, part, "k", "t", TRACKED, "sk", order=["row"])
        versions = increments.durable(merged)
        now = {r.sk: (r.k, r.effective_date) for r in versions.collect()}
        assert all(now[k] == v for k, v in given.items())        # no key is lost or given to another version
        assert sorted(now) == list(range(1, len(now) + 1))
        given = now
    whole = scd2_build(seen, "k", "t", TRACKED, order=["row"])
    columns = [c for c in versions.columns if c != "sk"]
    assert rows(versions, *columns) == rows(whole, *columns)


def test_a_dimension_with_its_unknown_member(spark):
    start = spark.createDataFrame([(-1, "Unknown", "Unknown", None, None, None, False), (1, "m1", "x", None, DAY[0], None, True)], VERSIONS)
    new = spark.createDataFrame([("m1", DAY[1], "x", True), ("m2", DAY[1], "z", None)], "k string, t date, a string, b boolean")
    got = increments.scd2_merge(start, new, "k", "t", TRACKED, "sk").orderBy("sk").collect()
    assert [tuple(r) for r in got] == [(-1, "Unknown", "Unknown", None, None, None, False), (1, "m1", "x", True, DAY[0], None, True),
                                       (2, "m2", "z", None, DAY[1], None, True)]


def test_older_and_repeated_periods_are_refused(spark):
    start = spark.createDataFrame([(1, "m1", "x", None, DAY[2], None, True)], VERSIONS)
    for day in (DAY[1], DAY[2]):
        new = spark.createDataFrame([("m1", day, "y", None)], "k string, t date, a string, b boolean")
        with pytest.raises(increments.OutOfOrder):
            increments.scd2_merge(start, new, "k", "t", TRACKED, "sk")
    with pytest.raises(ValueError, match="columns"):
        increments.scd2_merge(start.withColumn("extra", F.lit(1)), new, "k", "t", TRACKED, "sk")


EVENT = "stamp date, ccn string, penalty_date date, penalty_type string, fine_id string, fine_amount_usd bigint, payment_denial_days bigint, source_row int"


def reported(spark, seed=3, events=60):
    rng = random.Random(seed)
    rows = []
    for e in range(events):
        member, day = f"c{e % 9}" if e % 13 else None, dt.date(2019, 1 + e % 4, 1 + e % 3) if e % 11 else None
        kind, first = rng.choice(["Fine", "Denial"]), rng.randrange(len(DAY))
        known_from = rng.choice([0, 2, 4, 6, 99])
        for p in range(first, min(len(DAY), first + 4)):
            # some events are redated later: their id joins two natural keys
            date = day + dt.timedelta(days=40) if day and e % 5 == 0 and p >= first + 2 else day
            rows.append((DAY[p], member, date, kind, f"id{e if e % 7 else e // 7}" if p >= known_from else None, rng.choice([10, 20, None]), None, rng.randrange(10 ** 6)))
    return spark.createDataFrame(rows, EVENT).cache()


@pytest.mark.parametrize("cuts", [[1, 2, 3, 4, 5, 6, 7], [5], [0, 2]])
def test_events_period_by_period(spark, rows, cuts):
    seen = reported(spark)
    index = increments.event_index(seen.limit(0))
    events = None
    keys = {}
    for low, high in zip([0, *cuts], [*cuts, len(DAY)]):
        newer = increments.durable(increments.event_index(seen.where(F.col("stamp").isin(DAY[low:high]) if high > low else F.lit(False))))
        if events is None:
            events = dense_key(increments.events_of(newer), ["identity", "fine_id_source"], "event_key")
            index = newer
        else:
            after = increments.durable(increments.merged_index(index, newer))
            events = increments.upserted_events(events, index, after, newer)
            index = after
        events = increments.durable(events)
        now = {r.event_key: r for r in events.collect()}
        assert len(now) == events.count()
        by_natural = {r.natural_key: r.event_key for r in now.values()}
        for key, nat in keys.items():            # an event keeps its key, or was joined with one of a smaller key
            if key not in now:
                assert any(k < key for k in now)
        keys = {k: r.natural_key for k, r in now.items()}
        assert len(by_natural) == len(now)
    whole = dedup.window_dedup(seen)
    assert rows(events, *whole.columns) == rows(whole)
    assert rows(increments.events_of(index), *whole.columns) == rows(whole)


def test_an_id_that_arrives_later_moves_its_event(spark):
    frame = lambda *r: spark.createDataFrame(list(r), EVENT)
    first = frame((DAY[0], "c", DAY[0], "Fine", None, 1, None, 1), (DAY[0], "c", DAY[1], "Fine", None, 2, None, 2), (DAY[0], "d", DAY[0], "Fine", "X", 3, None, 3))
    index = increments.event_index(first)
    events = dense_key(increments.events_of(index), ["identity", "fine_id_source"], "event_key")
    before = {r.identity: r.event_key for r in events.collect()}
    # both events of c turn out to be fine 7
    newer = increments.event_index(frame((DAY[1], "c", DAY[0], "Fine", "7", 5, None, 1), (DAY[1], "c", DAY[1], "Fine", "7", 6, None, 2)))
    events = increments.upserted_events(events, index, increments.merged_index(index, newer), newer)
    got = {r.identity: (r.event_key, r.fine_id_source, r.sightings, r.fine_amount_usd) for r in events.collect()}
    joined = min(key for identity, key in before.items() if identity.startswith("c|"))
    assert got == {"7": (joined, "fine_id", 4, 6), "X": (before["X"], "fine_id", 1, 3)}
