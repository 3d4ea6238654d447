import random
import re

import pyarrow as pa
import pytest

from tests.llm import frames
from tidemark.llm import contamination
from tidemark.llm.terms import pieces, terms

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, item string, window string, length string, row string"


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, length=10):
    windows = {}
    for i, text in items:
        ws = split(text)
        for k in range(max(1, len(ws) - length + 1) if ws else 0):
            windows.setdefault(tuple(ws[k:k + length]), set()).add(i)
    out = []
    for d, text, *_ in docs:
        ws, hit, found = split(text), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(ws) - n + 1):
                owners = windows.get(tuple(ws[k:k + n]))
                if owners is not None:
                    hit.update(range(k, k + n))
                    found |= owners
        out.append((d, len(ws), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=str)


def search(spark, docs, items, **settings):
    bench = spark.createDataFrame([(i, t, *["clash"] * 4) for i, t in items], ITEMS)
    got = contamination.contaminated(frames.docs(spark, docs), bench, **settings).collect()
    for r in got:
        spans = [(s["begin"], s["end"]) for s in r.spans]
        assert all(a < b for a, b in spans) and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    return sorted(((r.row.doc_id, r.n_words, sum(s["end"] - s["begin"] for s in r.spans), list(r["items"])) for r in got), key=str)


def sample(seed=2):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(12)] + ["Ünï", "straße", "日本", "x", "longerword" * 3]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 30)))) for i in range(40)]
    docs = []
    for i in range(80):
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(0, 40)))]
        for _ in range(rng.randrange(0, 3)):
            ws = rng.choice(items)[1].split()
            cut = rng.randrange(0, max(1, len(ws) - 9))
            parts += [" - ".join(ws[cut:cut + rng.randrange(1, 15)]).upper(), rng.choice(["", "noise!", "w1"])]
        docs.append((i, "\n".join(parts), "s1"))
    return docs, items


@pytest.mark.parametrize("settings", [{}, {"length": 4}, {"portion": 16000}])
def test_equals_all_windows(spark, settings):
    docs, items = sample()
    docs += [(100, None, "s"), (101, "", "s"), (102, "... \n ,", "s"), (None, docs[0][1], "s"), docs[1], docs[1]]
    docs += [(103, " ".join(t for _, t, _ in docs[:60]) * 20, "s")]                 # a very long text
    items += [(200, None), (201, ""), (202, "!?"), (None, items[3][1] + " tail"), (5, "another text of item five"), items[6], (300, items[7][1])]
    assert search(spark, docs, items, **settings) == plain(docs, items, settings.get("length", 10))


def test_a_word_next_to_a_text_border_is_no_neighbour(spark):
    docs = [(1, "a b c d e", "s"), (2, "f g h i j", "s"), (3, "a b c d e f g h i j", "s")]
    assert search(spark, docs, [(1, "a b c d e f g h i j")]) == [(1, 5, 0, []), (2, 5, 0, []), (3, 10, 10, ["1"])]


def test_items_are_sorted_as_strings_and_one_window_may_have_many(spark):
    items = [(i, "one two three") for i in (9, 10, 100, 2)]
    assert search(spark, [(1, "zero ONE, two; three four", "s")], items) == [(1, 5, 3, ["10", "100", "2", "9"])]


def test_touching_occurrences_are_one_span(spark):
    bench = spark.createDataFrame([(1, "a b"), (2, "c d")], "item_id long, text string")
    got = contamination.contaminated(frames.docs(spark, [(1, "x a b c d y a b", "s")]), bench, portion=20).collect()
    assert [(s["begin"], s["end"]) for s in got[0].spans] == [(1, 5), (6, 8)]


def test_columns_and_empty_tables(spark):
    docs, items = sample()
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = contamination.contaminated(frames.docs(spark, docs), bench, columns=["doc_id", "row", "fp"])
    assert found.schema["row"].dataType.names == ["doc_id", "row", "fp"]
    assert contamination.contaminated(frames.docs(spark, docs).limit(0), bench).collect() == []
    assert search(spark, docs[:5], []) == plain(docs[:5], [])


def test_words_of_many_texts_at_once():
    texts = frames.texts() + ["a\x00b", "é", "Z", "9"]
    for piece in pieces(pa.record_batch([pa.array(texts, pa.string())], ["t"]).slice(3), "t", 900):
        column = piece.column("t")
        t = terms(column)
        assert [[t.word(i).decode() for i in range(a, b)] for a, b in zip(t.first[:-1], t.first[1:])] == [split(x) for x in column.to_pylist()]
