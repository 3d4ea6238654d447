import numpy as np

from tidemark.llm import pstable

SCHEMA = "vec_id long, embedding array<float>, label int, row string, x string, n_links string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, "clash", "clash", "clash") for i, v, l in rows], SCHEMA).repartition(3)


def plain(rows, least=0.93):
    def sound(v, l):
        return l is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = [set() for _ in rows]
    for i, (_, a, la) in enumerate(rows):
        for j, (_, b, lb) in enumerate(rows):
            if i < j and sound(a, la) and sound(b, lb) and la == lb and len(a) == len(b):
                x, y = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(links[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def clusters(n=12, size=9, spread=0.05):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(n):
        centre = rng.standard_normal(32)
        for k in range(size):
            rows.append((len(rows), [float(x) for x in centre + spread * (1 + k) * rng.standard_normal(32)], c % 3))
    return rows


def test_links_and_components_equal_all_pairs(spark):
    rows = clusters()
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [], 0), (n + 2, [0.0] * 32, 0), (n + 3, [float("nan")] * 32, 0), (n + 4, [None] + [1.0] * 31, 0),
             (n + 5, rows[0][1], None), (n + 6, rows[0][1], rows[0][2]), (n + 7, rows[0][1], rows[0][2]), rows[5], rows[5],
             (None, rows[0][1], rows[0][2]), (n + 8, [float("inf")] * 32, 0), (n + 9, [1.0, 2.0], 0), (n + 10, [2.0, 4.0], 0)]
    got = pstable.linked(frame(spark, rows), block=16).select("row.vec_id", "n_links", "component_id", "kept").collect()
    assert sorted([(r.vec_id, r.n_links, r.component_id) for r in got], key=str) == plain(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_a_large_group_of_near_copies_in_blocks(spark):
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(16)
    rows = [(i, [float(x) for x in centre + 0.02 * rng.standard_normal(16)], 1) for i in range(150)]
    got = pstable.linked(frame(spark, rows), block=20).select("row.vec_id", "n_links", "component_id").collect()
    assert sorted([tuple(r) for r in got], key=str) == plain(rows)


def test_empty_table(spark):
    assert pstable.linked(frame(spark, [])).collect() == []


def test_keys_hang_on_the_vector_alone():
    x = np.random.default_rng(2).standard_normal((50, 8))
    whole = pstable.keys(x, 6, 4, 2.0, 5)
    assert whole.shape == (50, 6)
    assert (pstable.keys(x[10:20], 6, 4, 2.0, 5) == whole[10:20]).all()
