import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import frames
from tests.llm.test_contamination import split
from tidemark.llm import lexical
from tidemark.llm.terms import Vocabulary, hashes, terms

ITEMS = "item_id long, text string, rank string, score string, item string, terms string"


def plain(docs, items, k=10):
    counted = [(d, Counter(split(t))) for d, t, *_ in docs]
    counted = [(d, c) for d, c in counted if c]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(split(t))
    df = Counter(w for _, c in counted for w in c)
    out = []
    for i, ws in asked.items():
        scored = []
        for d, c in counted:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10 ** 9 * c[w]) // (1000 * c[w] + 8 * m)) for w in ws if c[w])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(spark, docs, items, **settings):
    asked = spark.createDataFrame([(i, t, *["clash"] * 4) for i, t in items], ITEMS)
    return sorted((tuple(r) for r in lexical.search(frames.docs(spark, docs), asked, **settings).collect()), key=str)


def sample(n=150, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"t{k}" for k in range(300)] + ["Ünï", "straße"]
    pick = lambda: vocabulary[min(int(rng.paretovariate(0.6)), len(vocabulary)) - 1]
    docs = [(i, " ".join(pick() for _ in range(rng.randrange(1, 120))), "s") for i in range(n)]
    items = [(i, " ".join(pick() for _ in range(rng.randrange(1, 25)))) for i in range(25)]
    return docs, items


@pytest.mark.parametrize("settings", [{}, {"k": 3, "portion": 8000}, {"pairs": 0}])
def test_equals_scores_of_all_documents(spark, settings):
    docs, items = sample()
    docs += [(500, None, "s"), (501, "", "s"), (502, ", ; .", "s"), (None, docs[0][1], "s"), docs[1], docs[1], (2, "t1 t1 t7 other text of id two", "s")]
    docs += [(600 + i, docs[4][1], "s") for i in range(30)]                          # ties
    docs += [(700, " ".join(t for _, t, _ in docs[:100] if t) * 5, "s")]             # a very long text
    items += [(100, None), (101, ""), (102, "?!"), (103, "nowhere found"), (None, items[0][1]), (5, "t3 t9"), items[6], (104, items[7][1])]
    assert found(spark, docs, items, **settings) == plain(docs, items, settings.get("k", 10))


def test_documents_too_wide_for_a_signature_are_scored(spark, monkeypatch):
    docs, items = sample(60)
    monkeypatch.setattr(lexical, "WIDEST", 256)
    assert found(spark, docs, items) == plain(docs, items)


def test_terms_that_all_documents_hold_weigh_next_to_nothing(spark):
    docs = [(i, "same words here", "s") for i in range(1200)]
    assert found(spark, docs, [(1, "same words")]) == plain(docs, [(1, "same words")]) == []


def test_empty_tables(spark):
    docs, items = sample(5)
    assert found(spark, [], items) == []
    assert found(spark, docs, []) == []


def test_bounds_are_never_exceeded_and_rule_documents_out():
    docs, items = sample(300, seed=5)
    t = terms(pa.array([d[1] for d in docs]))
    n = np.diff(t.first)
    vocabulary = sorted({w for _, x in items for w in split(x)})
    df = Counter(vocabulary.index(w) for _, x, _ in docs for w in set(split(x)) if w in vocabulary)
    query = lexical.Query(vocabulary, [[vocabulary.index(w) for w in set(split(x))] for _, x in items], len(docs), int(n.sum()), df)
    exact = np.zeros((len(items), len(docs)))
    for text, item, score in query.scores(pa.array([d[1] for d in docs]), [list(range(len(items)))] * len(docs)):
        exact[item, text] = score
    blocks = lexical._Blocks()
    parts = [*blocks.add(pa.array(range(len(docs))), n, t, hashes(t)), *blocks.rest()]
    assert sorted(i for ids, *_ in parts for i in ids.to_pylist()) == list(range(len(docs)))
    loose = 0
    for ids, count, width, slices in parts:
        for item, bound in query.bounds(count, width, slices):
            mine = exact[item, ids.to_numpy()]
            assert (bound >= mine).all()
            loose += (bound > mine * 1.5 + 1e9).sum()
    assert loose < 0.2 * exact.size


def test_vocabulary_compares_bytes(monkeypatch):
    from tidemark.llm import terms as module
    monkeypatch.setattr(module, "hashes", lambda t: (t.end - t.start).astype(np.uint64) % np.uint64(3))
    known = module.Vocabulary(["abc", "xyz", "a", "abcd", "q"])
    t = terms(pa.array(["abc abd xyz", "abcd q a zzzz xyzabc"]))
    assert known.numbers(t, module.hashes(t)).tolist() == [0, -1, 1, 3, 4, 2, -1, -1]
