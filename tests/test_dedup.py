import datetime as dt
import random

import pytest

from tidemark.operators.dedup import EventColumns, dedup_report, key_audit, window_dedup

C = EventColumns(stamp="stamp", position=("row",))
SCHEMA = ("stamp int, row int, ccn string, penalty_date date, penalty_type string, fine_id string, fine_amount_usd bigint")
D = dt.date(2025, 5, 9)


def stepwise(rows):
    """Occurrence, key, back-fill, identity, last sighting: one step after another."""
    seen, keyed = {}, []
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        stamp, _, ccn, date, kind, *_ = r
        n = seen[(stamp, ccn, date, kind)] = seen.get((stamp, ccn, date, kind), -1) + 1
        keyed.append((r, "|".join([ccn or "?", str(date) if date else "?", kind or "?", str(n)])))
    filled = {}
    for r, nk in keyed:
        if r[5] is not None:
            filled.setdefault(nk, r[5])
    order = lambda r: (r[0], r[2] is None, r[2] or "", r[3] is None, r[3] or dt.date.min, r[1])
    kept = {}
    for r, nk in sorted(keyed, key=lambda x: order(x[0])):
        kept[filled.get(nk, nk)] = (r, nk)
    events = sorted((r[0], r[1], nk, filled.get(nk) or "") for r, nk in kept.values())
    gains = sum(1 for r, nk in keyed if r[5] is None and nk in filled)
    keys_of = {}
    for _, nk in keyed:
        if nk in filled:
            keys_of.setdefault(filled[nk], set()).add(nk)
    siblings = {(r[2], r[3], r[4], r[6]) for r, nk in keyed if nk in filled}
    orphans = {}
    for r, nk in sorted(keyed, key=lambda x: order(x[0])):
        if nk not in filled and (r[2], r[3], r[4], r[6]) in siblings:
            orphans.setdefault(nk, r[6] or 0)
    return events, gains, sum(len(k) > 1 for k in keys_of.values()), orphans


def random_rows(seed):
    """Events re-dated, restated, given ids late, repeated on one day, lacking keys."""
    rng = random.Random(seed)
    events = [(rng.choice(["015009", "015010", None]), D + dt.timedelta(days=rng.randint(0, 3)),
               rng.choice(["Fine", "Payment Denial"]), f"F{i}", rng.choice([100, 200])) for i in range(40)]
    rows = []
    for stamp in range(1, 6):
        listed = [e for e in events if rng.random() < 0.8]
        for row, (ccn, date, kind, fid, amount) in enumerate(listed):
            if rng.random() < 0.1:
                date = rng.choice([None, date + dt.timedelta(days=1)])
            has_id = kind == "Fine" and stamp >= 4 and rng.random() < 0.9
            rows.append((stamp, row, ccn, date, kind, fid if has_id else None,
                         amount + (50 if stamp == 5 and rng.random() < 0.3 else 0)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("hot_rows", [None, 4])
def test_equals_the_stepwise_statement(spark, seed, hot_rows):
    rows = random_rows(seed)
    events, gains, split, orphans = stepwise(rows)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = window_dedup(frame, C, hot_rows=hot_rows).collect()
    assert sorted((r.stamp, r.row, r.natural_key, r.fine_id or "") for r in out) == events
    assert sum(r.sightings for r in out) == len(rows)
    report = dedup_report(frame, C, hot_rows=hot_rows).first()
    assert (report.rows_before, report.events_after, report.backfilled_ids) == (len(rows), len(events), gains)
    audit = key_audit(frame, C, hot_rows=hot_rows).first()
    assert (audit.keys_with_many_ids, audit.ids_with_many_keys) == (0, split)
    assert (audit.orphan_events, audit.orphan_money) == (len(orphans), sum(orphans.values()))


def test_three_equal_fines_of_a_day_stay_three(spark):
    rows = [(s, i, "015060", D, "Fine", None, 5782) for s in (1, 2) for i in range(3)]
    out = window_dedup(spark.createDataFrame(rows, SCHEMA), C)
    assert sorted(r.natural_key for r in out.collect()) == [f"015060|2025-05-09|Fine|{i}" for i in range(3)]


def test_restated_amount_keeps_the_last_and_late_id_is_inherited(spark):
    rows = [(1, 0, "1", D, "Fine", None, 100), (2, 0, "1", D, "Fine", "F1", 120),
            (3, 0, "1", D + dt.timedelta(days=1), "Fine", "F1", 130)]
    out = window_dedup(spark.createDataFrame(rows, SCHEMA), C).collect()
    assert [(r.fine_amount_usd, r.fine_id, r.fine_id_source, r.sightings) for r in out] == [(130, "F1", "fine_id", 3)]
