import math
import zlib
from collections import Counter, defaultdict

import xxhash

from tests.llm.frames import docs
from tidemark.llm import sharding
from pyspark.sql import functions as F


def test_columns_and_slots(spark):
    rows = docs(spark).select("doc_id", "text").collect()
    got = sharding.assign(docs(spark), slice_rows=2).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        assert 0 <= r.shard < 16 and r.grown_shard in (r.shard, 16)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    where = defaultdict(set)
    for r in got:
        where[r.doc_id].add(r.shard)
    assert all(len(s) == 1 for s in where.values())
    assert sharding.assign(docs(spark, [])).collect() == []


def moved(spark, before, after, n=4000):
    rows = spark.range(n).select(F.col("id").cast("string").alias("k"))
    both = sharding.place(sharding.place(rows, F.col("k"), before, 3, "a"), F.col("k"), after, 3, "b")
    return both.collect()


def test_shares_follow_weights(spark):
    tree = {"r0": {"k0": {0: 1.0, 1: 3.0}, "k1": {2: 2.0}}, "r1": {"k2": {3: 2.0, 4: 0.0}}}
    counts = Counter(r.a for r in moved(spark, tree, tree))
    for shard, weight in ((0, 1), (1, 3), (2, 2), (3, 2)):
        assert abs(counts[shard] / 4000 - weight / 8) < 0.03
    assert counts[4] == 0


def test_a_new_shard_takes_rows_only_into_itself(spark):
    for n in (16, 17, 20):
        rows = moved(spark, sharding.tree_of(n), sharding.tree_of(n + 1))
        went = [r for r in rows if r.a != r.b]
        assert {r.b for r in went} == {n}
        assert abs(len(went) / len(rows) - 1 / (n + 1)) < 0.02


def test_the_law_holds_for_any_number_of_shards(spark):
    for n in (1, 2, 3, 4, 5, 6, 7, 9, 13, 15, 24, 39, 40):
        got = sharding.assign(spark.range(600).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")), shards=n).collect()
        went = [r for r in got if r.shard != r.grown_shard]
        assert {r.shard for r in got} <= set(range(n)) and {r.grown_shard for r in went} == {n}, n


def test_every_shard_is_that_of_a_plain_descent(spark):
    def hashed(*parts):
        seed = 42
        for part in parts:
            seed = xxhash.xxh64_intdigest(part.encode(), seed=seed)
        return seed

    def choose(key, level, children):
        known = {n: w for n, w in children.items() if w > 0}
        draw = lambda n: -math.log(((hashed(f"3/{level}/{n}", key) >> 11) + 0.5) / 2.0 ** 53) / known[n]
        return min(known, key=lambda n: (draw(n), n))

    weight = lambda node: sum(weight(c) for c in node.values()) if isinstance(node, dict) else node
    trees = [sharding.tree_of(16), sharding.tree_of(7, base=6), {"r0": {"k0": {0: 1.0, 1: 3.0}, "k1": {2: 2.0}}, "r1": {"k2": {3: 2.0, 4: 0.0}}}]
    for tree in trees:
        rows = spark.range(300).select(F.col("id").cast("string").alias("k"))
        for r in sharding.place(rows, F.col("k"), tree, 3, "s").collect():
            region = choose(r.k, "region", {n: weight(t) for n, t in tree.items()})
            rack = choose(r.k, f"rack/{region}", {n: weight(t) for n, t in tree[region].items()})
            assert r.s == int(choose(r.k, f"shard/{rack}", {str(n): w for n, w in tree[region][rack].items()}))


def test_a_weight_moves_only_its_subtree(spark):
    tree = sharding.tree_of(16)
    heavier = {r: {k: dict(s) for k, s in racks.items()} for r, racks in tree.items()}
    heavier["r1"]["k2"][4] = 3.0
    for r in moved(spark, tree, heavier):
        if r.a != r.b:
            assert r.b in range(4, 8)       # into the region whose weight grew
