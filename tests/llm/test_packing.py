import random
import re
from collections import defaultdict

from tests.llm.frames import docs
from tidemark.llm import packing


def check(bins, rows, capacity, per_source):
    spans = defaultdict(list)
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, _ in rows}
    for b in bins:
        assert sum(b.lengths) == b.n_words <= capacity and len(b.doc_ids) == b.n_docs
        for i, s, n in zip(b.doc_ids, b.starts, b.lengths):
            spans[i].append((s, n))
        facts = [next((t.lower(), s) for j, t, s in rows if j == i) for i in b.doc_ids]
        if len(set(b.doc_ids)) == len(b.doc_ids):
            assert len({t for t, _ in facts}) == len(facts)
        assert all(sum(s == x for _, x in facts) <= per_source for _, s in facts)
    return spans, size


def test_every_word_is_in_one_bin(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([3, 9, 20, 41, 64, 150]))), rng.choice(["a", "a", "b", None])) for i in range(200)]
    rows += [(200 + i, rows[0][1].upper(), "a") for i in range(40)]       # a large duplicate cluster
    rows += [(900, None, "a"), (901, "", "b"), (902, " \n", None)]
    bins = packing.pack(docs(spark, rows), capacity=64, per_source=3, pool_rows=50).collect()
    spans, size = check(bins, rows, 64, 3)
    for i, n in size.items():
        at = 0
        for s, length in sorted(spans.get(i, [])):
            assert s == at
            at += length
        assert at == n
    assert len({b.pool for b in bins}) >= 4
    assert {(b.pool, b.bin): b.doc_ids for b in bins} == {
        (b.pool, b.bin): b.doc_ids for b in packing.pack(docs(spark, rows).repartition(7), capacity=64, per_source=3, pool_rows=50).collect()}


def test_repeated_rows_never_share_a_bin(spark):
    rows = [(1, "one two three", "a")] * 30
    bins = packing.pack(docs(spark, rows), capacity=64, pool_rows=8).collect()
    assert len(bins) == 30 and all(b.doc_ids == [1] for b in bins)


def test_tightest_compatible_bin():
    rng = random.Random(6)
    fast = packing.Bins(50, 2)
    slow = []                                                            # (left, sources, clusters)
    for _ in range(600):
        size, source, cluster = rng.randrange(1, 51), rng.randrange(4), rng.randrange(25)
        fits = [(left, k) for k, (left, s, c) in enumerate(slow) if left >= size and s.count(source) < 2 and cluster not in c]
        best = min(fits)[1] if fits else len(slow)
        if best == len(slow):
            slow.append((50, [], set()))
        left, s, c = slow[best]
        slow[best] = (left - size, s + [source], c | {cluster})
        assert fast.place(size, source, cluster) == best


def test_awkward_rows_and_empty_table(spark):
    bins = packing.pack(docs(spark)).collect()
    assert any(None in b.doc_ids for b in bins)
    assert packing.pack(docs(spark, [])).collect() == []
