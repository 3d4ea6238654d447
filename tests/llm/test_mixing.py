import re
from collections import defaultdict

import pytest

from tests.llm.frames import docs, texts
from tidemark.llm import mixing


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, left, free = {}, share * sum(sizes.values()), set(order)
    while free:
        level = left / sum(w[s] for s in free)
        full = {s for s in free if level * w[s] >= cap * sizes[s]}
        for s in full or free:
            target[s] = cap * sizes[s] if full else level * w[s]
            left -= target[s]
        free -= full or free
    return target


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_are_met(spark):
    listed = [t for seed in range(6) for t in texts(seed)]
    rows = [(i, t, None if i % 11 == 0 else f"s{i % 5}") for i, t in enumerate(listed)]
    out = mixing.mix(docs(spark, rows)).select("row.doc_id", "row.source", "size", "source_size", "target", "copies", "taken", "row.size").collect()
    sizes = defaultdict(int)
    for i, t, s in rows:
        sizes[s] += size_of(t)
    goal = plain_targets(sizes)
    taken = defaultdict(int)
    assert len(out) == len(rows)
    for r in out:
        assert r[2] == size_of(listed[r.doc_id]) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(goal[r.source])
        assert 0 <= r.copies <= 2 and r.taken == r.copies * r[2]
        taken[r.source] += r.taken
    for s in sizes:       # documents are whole: a source of few words with one very long document cannot come nearer
        largest = max(size_of(t) for _, t, x in rows if x == s)
        assert abs(taken[s] - goal[s]) <= max(0.02 * goal[s], largest / 2)
    again = mixing.mix(docs(spark, rows).repartition(5)).select("row.doc_id", "copies").collect()
    assert {(r.doc_id, r.copies) for r in again} == {(r.doc_id, r.copies) for r in out}


def test_inclusion_follows_the_propensity(spark):
    """Over many seeds, copies average to the expected ones of the size's class."""
    rows = [(i, " ".join(["w"] * (4 + i % 3 * 12)), "a") for i in range(60)] + [(100 + i, "b " * 40, "b") for i in range(30)]
    frame = docs(spark, rows).cache()
    total = defaultdict(float)
    for seed in range(8):
        for r in mixing.mix(frame, weights=(1, 3), seed=seed).select("row.doc_id", "row.source", "size", "copies").collect():
            if r.source == "a":
                total[r[2]] += r.copies / 8 / 20
    assert total[4] < total[16] < total[28]


def test_awkward_rows(spark):
    frame = docs(spark)
    out = mixing.mix(frame).select("row.*", "copies", "taken").collect()
    assert len(out) == frame.count()
    assert all(r.copies == 0 for r in out if size_of(r.text) == 0)
    assert mixing.mix(docs(spark, [])).collect() == []
    nothing = mixing.mix(docs(spark, [(1, None, "a"), (2, "", None)])).select("copies", "target").collect()
    assert [(r.copies, r.target) for r in nothing] == [(0, 0.0)] * 2
