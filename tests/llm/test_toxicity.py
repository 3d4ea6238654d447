import random

import numpy as np

from tests.llm.frames import docs, sentence
from tidemark.llm import toxicity

SMALL = toxicity.Settings(buckets=1 << 12, sample=400, epochs=8)
BAD = ["idiot", "stupid", "worthless", "disgusting"]


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = sentence(rng, rng.randrange(10, 60)).split()
        toxic = i % 3 == 0
        for _ in range(rng.randrange(2, 5) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(toxic)))
    return rows, labels


def model(spark):
    rows, labels = corpus()
    known = spark.createDataFrame([*labels, (None, 1), (5, None), (9999, 1), (7, 9)], "doc_id long, toxic int")
    return toxicity.train(docs(spark, rows), known, settings=SMALL)


def test_held_out_accuracy_and_misspellings(spark):
    m = model(spark)
    rows, labels = corpus(seed=2)
    got = {r.doc_id: r.score for r in toxicity.score(docs(spark, rows), m).collect()}
    right = np.mean([(got[i] >= 0.5) == bool(y) for i, y in labels])
    assert right > 0.95
    rng = random.Random(5)
    clean = [sentence(rng, 20) for _ in range(40)]
    spelt = [(i, t + " idiott stuupid worthles", "s") for i, t in enumerate(clean)] + [(100 + i, t, "s") for i, t in enumerate(clean)]
    seen = {r.doc_id: r.score for r in toxicity.score(docs(spark, spelt), m).collect()}
    assert np.mean([seen[i] for i in range(40)]) > np.mean([seen[100 + i] for i in range(40)]) + 0.3


def test_score_is_the_softmax_of_the_mean(spark):
    m = model(spark)
    rows, _ = corpus(20, seed=3)
    got = {r.doc_id: r.score for r in toxicity.score(docs(spark, rows), m).collect()}
    for i, text, _ in rows:
        ids, share = toxicity.bag(text, SMALL, {})
        logit = (m.embeddings[ids] * share[:, None]).sum(axis=0) @ m.softmax.T + m.bias
        assert abs(got[i] - np.exp(logit[1]) / np.exp(logit).sum()) < 1e-4


def test_same_model_again(spark):
    assert np.array_equal(model(spark).embeddings, model(spark).embeddings)


def test_awkward_rows(spark):
    m = model(spark)
    frame = docs(spark)
    got = toxicity.score(frame, m).collect()
    assert len(got) == frame.count() and all(0 <= r.score <= 1 for r in got)
    empty = {r.score for r in got if not (r.text or "").strip()}
    assert len(empty) == 1
    assert sorted(got[0].asDict()) == sorted([*frame.columns, "score"])
    assert toxicity.score(docs(spark, []), m).collect() == []


def test_no_labels(spark):
    m = toxicity.train(docs(spark, []), spark.createDataFrame([], "doc_id long, toxic int"), settings=SMALL)
    assert toxicity.score(docs(spark, [(1, "x", "s")]), m).first().score == 0.5


def test_whole_texts_are_read():
    word = "ab" * 100
    assert sum(toxicity.tokens(word).values()) == 5
    assert toxicity.tokens("Bad, BAD! (bad)") == {"bad": 3}


def test_a_long_fitted_text_keeps_its_whole_bag(spark):
    long = " ".join(f"w{i * 7919 % 99991}x{i}" for i in range(6000))
    frame = docs(spark, [(1, long, "s"), (2, "short text", "s")])
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    s = toxicity.Settings()
    got = {r.order: r for r in toxicity.training_bags(frame, labels, "doc_id", "text", "toxic", s).collect()}
    ids, shares = toxicity.bag(long, s, {})
    assert len(ids) > 10000 and got["1"].ids == ids.tolist() and got["1"].shares == shares.tolist()
    assert abs(sum(got["1"].shares) - 1.0) < 1e-3


def test_an_id_carried_by_many_rows_stays_within_the_sample(spark):
    rows = [(1, f"text number {i} of one id", "s") for i in range(50)] + [(1, "the same text", "s")] * 50 + [(2, "another", "s"), (3, None, "s")] * 3
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    bags = lambda n: toxicity.training_bags(docs(spark, rows), labels, "doc_id", "text", "toxic", toxicity.Settings(sample=n)).collect()
    assert len(bags(10)) == 10
    every = bags(5000)
    assert sorted(r.order for r in every) == ["1"] * 51 + ["2", "3"] and {r.order: r.label for r in every} == {"1": 1, "2": 0, "3": 0}


def test_the_sample_is_bounded_by_its_n_grams_in_the_order_of_the_hash(spark):
    rows = [(i, f"word{i} other{i} third{i}", "s") for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    made = toxicity.training_bags(docs(spark, rows), labels, "doc_id", "text", "toxic", toxicity.Settings())
    hashed = {r.order: r.h for r in made.selectExpr("order", f"xxhash64(order, {toxicity.Settings().seed}) as h").collect()}
    sizes = {r.order: len(r.ids) for r in made.collect()}
    order = sorted(sizes, key=lambda i: hashed[i])
    for n in (0, 1, 7, 39, 40):
        bound = sum(sizes[i] for i in order[:n])
        got = {r.order for r in toxicity.within(made, toxicity.Settings(grams=bound)).collect()}
        assert got == set(order[:max(n, 1)])
    assert toxicity.within(made.where("false"), toxicity.Settings()).collect() == []


def test_a_users_column_with_the_name_of_the_score_is_kept(spark):
    m = toxicity.fit([], toxicity.Settings())
    frame = spark.createDataFrame([(1, "a b", "mine")], "doc_id long, text string, score string")
    assert toxicity.score(frame, m).first().asDict() == {"doc_id": 1, "text": "a b", "input_score": "mine", "score": 0.5}
    assert toxicity.score(frame, m, columns=["score"]).first().asDict() == {"input_score": "mine", "score": 0.5}
