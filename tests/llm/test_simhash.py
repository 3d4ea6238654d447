import random

import numpy as np
import pytest
import xxhash

from tests.llm.frames import docs
from tidemark.llm import simhash
from tidemark.llm.components import components


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {n: top(n) for n in nodes}


def test_fingerprints_and_components_of_awkward_rows(spark):
    found = simhash.near_duplicates(docs(spark)).select("row.doc_id", "fp", "component_id", "row.row").collect()
    source = docs(spark).select("doc_id", "text").collect()
    assert len(found) == len(source)
    assert {(r.doc_id, r.fp % (1 << 64)) for r in found} == {(r.doc_id, plain_fingerprint(r.text)) for r in source}
    prints = {r.fp % (1 << 64) for r in found}
    parts = plain_components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for r in found:
        if r.doc_id is not None:
            part = parts[r.fp % (1 << 64)]
            least[part] = min(least.get(part, r.doc_id), r.doc_id)
    assert all(r.component_id == least.get(parts[r.fp % (1 << 64)]) for r in found)
    assert {r.row for r in found} == {"clash"}


def test_a_long_text_in_chunks_is_as_one(monkeypatch):
    text = " ".join(str(i % 977) for i in range(5000))
    whole = simhash.fingerprint(text.encode(), 3)
    monkeypatch.setattr(simhash, "CHUNK", 100)
    assert simhash.fingerprint(text.encode(), 3) == whole == plain_fingerprint(text)


@pytest.mark.parametrize("distance,block", [(2, 8), (3, 16), (0, 8), (2, 1024)])
def test_no_link_is_lost_in_blocks(spark, distance, block):
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(20)]
    prints = set(base)
    for b in base * 3:
        x = b
        for _ in range(rng.randrange(0, 6)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    hot = base[0]
    prints |= {hot ^ (1 << i) for i in range(40)}     # a large group of near copies
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), distance, block)
    found = {r.node: r.component for r in components(edges).collect()}
    expected = plain_components(signed, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= distance)
    assert {p: found.get(p, p) for p in signed} == expected


def test_chains_within_budget_are_exactly_the_near_ones():
    rng = np.random.default_rng(1)
    masks = simhash._masks(5)
    assert sum(int(m).bit_count() for m in masks) == 64
    x = np.array([0] + [sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in (1, 2, 2, 3, 4) * 50], np.uint64)
    passed = np.zeros(len(x), bool)
    for start in range(5):
        passed |= simhash.chain_passes(x, start, masks, 2)
    assert (passed == (np.bitwise_count(x) <= 2)).all()


def test_one_of_each_group_stays(spark):
    frame = docs(spark)
    kept = simhash.deduplicate(frame).collect()
    parts = simhash.near_duplicates(frame, groups=True).select("component").distinct().count()
    assert len(kept) == parts
    assert sorted(kept[0].asDict()) == sorted(frame.columns)
    again = simhash.deduplicate(frame).collect()
    assert sorted(map(str, kept)) == sorted(map(str, again))


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).collect() == []
    assert simhash.deduplicate(docs(spark, [])).collect() == []


def test_components_of_a_path_a_hub_and_loops(spark):
    path = [(i, i + 1) for i in range(40)]
    hub = [(100, 101 + i) for i in range(50)]
    rows = components(spark.createDataFrame(path + hub + [(7, 7), (None, 3)], "u long, v long")).collect()
    found = {r.node: r.component for r in rows}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 151)}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_deduplicate_keeps_columns_with_the_names_of_its_own(spark):
    frame = spark.createDataFrame([(2, "a b c d", "x", 1), (1, "a b c d", "y", 2), (1, "a b c d", "y", 2)], "doc_id long, text string, _key string, row int")
    got = simhash.deduplicate(frame)
    assert got.columns == frame.columns
    assert [tuple(r) for r in got.collect()] == [(1, "a b c d", "y", 2)]
