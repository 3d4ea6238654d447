import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.frames import docs
from tidemark.llm import quality


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = list(zip(w, w[1:], w[2:]))
    often = Counter(windows)
    covered = {j for i, x in enumerate(windows) if often[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def test_base_counts(spark):
    extra = ["a b c a b c", "a a a a", "x\ny\nx\n\n \nx", "é* è& #", "a b c d a b c\tz a b", "the of the of the of " * 20]
    rows = [(i, t, "s") for i, t in enumerate(extra)] + [(100 + i, r.text, "s") for i, r in enumerate(docs(spark).collect())]
    got = quality.judge(docs(spark, rows)).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    by = {i: t for i, t, _ in rows}
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:7] == plain(by[r.doc_id]), by[r.doc_id]
        assert not (r.base_failed and r.kept)


def test_distance(spark):
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    m = (np.array(p) + q) / 2
    kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m) if x)
    row = spark.range(1).select(*[quality.divergence(F.array(*map(F.lit, a)), F.array(*map(F.lit, b))).alias(n)
                                  for n, a, b in (("d", p, q), ("same", p, p), ("apart", [1.0, 0.0], [0.0, 1.0]))]).first()
    assert row.d == pytest.approx(np.sqrt((kl(p) + kl(q)) / 2)) and row.same == 0 and row.apart == pytest.approx(1)


def test_odd_texts_go_and_short_ones_are_not_judged(spark):
    prose = "The river of the town is on the map and it was for the people of that land by the sea "
    clean = [(i, " ".join(f"{w}" for w in (prose * 8).split()[i:i + 110]), "s") for i in range(30)]
    noise = (100, " ".join(f"X{i}%%%" for i in range(120)), "s")
    short = (101, " ".join(f"X{i}%%%" for i in range(20)), "s")
    frame = docs(spark, [(i, " ".join(f"{w}{k}" if k % 4 == 0 else w for k, w in enumerate(t.split())), s) for i, t, s in clean] + [noise, short])
    got = {r.doc_id: r for r in quality.judge(frame.withColumn("lang", F.lit("en")), least_words=10, most_repeated=1.0).select(
        "row.doc_id", "kept", "class_distance", "word_distance").collect()}
    assert all(got[i].kept for i in range(30)) and not got[100].kept
    assert got[101].word_distance is None and got[101].kept and got[101].class_distance is None


def test_empty_table(spark):
    assert quality.judge(docs(spark, [])).collect() == []
