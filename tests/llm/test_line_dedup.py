import random
from collections import Counter, defaultdict

from tests.llm.frames import docs, sentence
from tidemark.llm import line_dedup


def chunks_of(spark, listed):
    from pyspark.sql import functions as F
    frame = spark.createDataFrame([(t,) for t in listed], "t string")
    return {r.t: [c.body for c in r["_chunks"]] for r in line_dedup.chunked(frame, F.col("t"), 2).collect()}


def plain(spark, rows):
    """The rule over whole bodies, without hashes."""
    cut = chunks_of(spark, sorted({t for _, t, _ in rows if t is not None}))
    distinct = sorted({(i is None, i, t) for i, t, _ in rows if t is not None}, key=str)
    times, owner = Counter(), {}
    for i, t, _ in rows:
        for body in cut.get(t, []) if t is not None else []:
            if sum(bool(line.strip(" \t\n\v\f\r")) for line in body.split("\n")) >= 2:
                times[body] += 1
                if i is not None:
                    owner[body] = min(owner.get(body, i), i)
    out = {}
    for _, i, t in distinct:
        seen, left = set(), []
        for body in cut[t]:
            if times[body] > 1 and (owner.get(body) != i or body in seen):
                continue
            seen.add(body)
            left.append(body)
        out[i, t] = "\n".join(left)
    return out


def passages(n=40):
    rng = random.Random(4)
    shared = [[sentence(rng, 12) for _ in range(14)] for _ in range(3)]
    rows = []
    for i in range(n):
        own = [sentence(rng, 8) for _ in range(rng.randrange(0, 12))]
        at = rng.randrange(len(own) + 1)
        rows.append((i, "\n".join(own[:at] + (shared[i % 3] if i % 2 else []) + own[at:]), "s"))
    return rows


def test_repeated_chunks_go_but_for_the_first(spark):
    rows = passages()
    rows += [rows[1], rows[1], (200, None, "s"), (201, "", "s"), (202, "\n\n\n\n\n", "s"), (203, "\n\n\n\n\n", "s"), (204, "a", "s"), (205, "a", "s"),
             (None, rows[3][1], "s"), (3, rows[5][1], "s"), (300, "\n".join([rows[7][1]] * 2), "s")]
    got = line_dedup.remove_repeated(docs(spark, rows)).collect()
    expected = plain(spark, rows)
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, None if t is None else expected[i, t]) for i, t, _ in rows)
    assert sum(r.n_removed for r in got) > 30
    assert sorted(got[0].asDict()) == sorted([*docs(spark, []).columns, "n_chunks", "n_removed"])


def test_cuts_follow_the_content(spark):
    rng = random.Random(9)
    passage = [sentence(rng, 10) for _ in range(30)]
    one = "\n".join(passage)
    two = "\n".join([sentence(rng, 5) for _ in range(7)] + passage + [sentence(rng, 5)])
    cut = chunks_of(spark, [one, two])
    assert "\n".join(cut[one]) == one and "\n".join(cut[two]) == two
    assert all(len(c.split("\n")) >= 2 for c in cut[one])
    assert len(set(cut[one]) & set(cut[two])) >= len(cut[one]) - 2


def test_every_other_text_is_left_alone(spark):
    rows = [(i, t, "s") for i, t, _ in passages() if i % 2 == 0]
    got = {r.doc_id: r for r in line_dedup.remove_repeated(docs(spark, rows)).collect()}
    assert all(got[i].text == t and got[i].n_removed == 0 for i, t, _ in rows)


def test_awkward_rows_and_empty_table(spark):
    frame = docs(spark)
    assert line_dedup.remove_repeated(frame).count() == frame.count()
    assert line_dedup.remove_repeated(docs(spark, [])).collect() == []


def test_blank_lines_between_paragraphs_do_not_hide_a_copy(spark):
    rng = random.Random(21)
    passage = [sentence(rng, 15) for _ in range(20)]
    own = [[sentence(rng, 9) for _ in range(4)] for _ in range(2)]
    rows = [(0, "\n\n".join(passage), "s"), (1, "\n\n".join(passage), "s"), (2, "\n\n\n".join(passage), "s"),
            (3, "\n\n".join(own[0] + passage + own[1]), "s"), (4, "\n\n" + passage[0] + "\n\n", "s")]
    assert all("\n".join(c) == t for t, c in chunks_of(spark, [t for _, t, _ in rows]).items())
    got = {r.doc_id: r for r in line_dedup.remove_repeated(docs(spark, rows)).collect()}
    left = {i: [line for line in got[i].text.split("\n") if line] for i in got}
    assert got[0].text == rows[0][1] and got[4].text == rows[4][1]
    assert left[1] == [] and left[2] == []          # copies of a whole text lose every paragraph
    assert set(own[0] + own[1]) <= set(left[3]) and len(left[3]) <= 8 + 10


def plain_passages(spark, rows, least):
    """Chunks, pairs and long lines over whole texts, without hashes; ids are distinct and not null, no line is blank."""
    cut = chunks_of(spark, sorted({t for _, t, _ in rows if t}))
    pieces = {}
    for i, t, _ in rows:
        lines, at, found = t.split("\n") if t else [], 0, []
        for body in cut[t] if t else []:
            m = len(body.split("\n"))
            if m >= 2:
                found.append(("chunk", at, m, body))
            at += m
        found += [("pair", k, 2, "\n".join(lines[k:k + 2])) for k in range(len(lines) - 1)]
        found += [("line", k, 1, line) for k, line in enumerate(lines) if len(line.split()) >= least]
        pieces[i] = lines, found
    first = {}
    for i in sorted(pieces):
        for kind, k, m, body in sorted(pieces[i][1]):
            first.setdefault((kind, body), (i, k))
    out = {}
    for i, (lines, found) in pieces.items():
        again = [(kind, k, m) for kind, k, m, body in found if first[kind, body] != (i, k)]
        away = {u for kind, k, m in again if kind != "pair" for u in range(k, k + m)}
        linked = {k for kind, k, _ in again if kind == "pair"}
        u = 0
        while u < len(lines):
            end = u
            while end in linked:
                end += 1
            if end > u and sum(len(line.split()) for line in lines[u:end + 1]) >= least:
                away |= set(range(u, end + 1))
            u = end + 1
        out[i] = "\n".join(line for u, line in enumerate(lines) if u not in away)
    return out


def test_passages_of_one_to_eight_lines_inside_different_texts_go_whole(spark):
    rng = random.Random(31)
    rows, planted = [], {}
    for m in range(1, 9):
        for _ in range(6):
            passage = [sentence(rng, 60 // m + 1) for _ in range(m)]
            for _ in range(2):
                around = [[sentence(rng, 8) for _ in range(5)] for _ in range(2)]
                rows.append((len(rows), "\n".join(around[0] + passage + around[1]), "s"))
            planted[len(rows) - 1] = around
    got = {r.doc_id: r for r in line_dedup.remove_repeated(docs(spark, rows), least_words=50).collect()}
    for i, t, _ in rows:
        assert got[i].text == ("\n".join(planted[i][0] + planted[i][1]) if i in planted else t)
        assert (got[i].n_removed > 0) == (i in planted)


def test_passages_match_a_plain_statement(spark):
    rng = random.Random(32)
    for least in (4, 12, 30):
        stock = [sentence(rng, rng.choice((1, 2, 3, 8, 40))) for _ in range(25)]
        rows = [(i, "\n".join(rng.choice(stock) if rng.random() < 0.6 else sentence(rng, 5) for _ in range(rng.randrange(1, 14))), "s") for i in range(60)]
        rows += [(100 + i, t, "s") for i, t, _ in passages(12)] + [(200, "", "s"), (201, "\n".join([stock[0]] * 9), "s")]
        got = {r.doc_id: r.text for r in line_dedup.remove_repeated(docs(spark, rows), least_words=least).collect()}
        assert got == plain_passages(spark, rows, least)


def test_passages_with_blank_lines_null_ids_and_empty_tables(spark):
    rng = random.Random(33)
    passage = [sentence(rng, 20) for _ in range(3)]
    long = sentence(rng, 55)
    rows = [(0, "a b\n\n" + "\n\n".join(passage) + "\n\nc d", "s"), (1, "\n" + "\n".join(passage) + "\n\n\ne f", "s"),
            (2, long, "s"), (3, "g\n" + long + "\n\nh", "s"), (None, "i\n" + long, "s"), (None, None, "s"), (4, "\n\n", "s"), (5, "\n\n", "s")]
    got = line_dedup.remove_repeated(docs(spark, rows), least_words=50).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(
        [(0, rows[0][1]), (1, "e f"), (2, long), (3, "g\nh"), (None, "i"), (None, None), (4, "\n\n"), (5, "\n\n")])
    frame = docs(spark)
    assert line_dedup.remove_repeated(frame, least_words=50).count() == frame.count()
    assert line_dedup.remove_repeated(docs(spark, []), least_words=50).collect() == []


def test_lines_that_share_a_hash_are_judged_by_their_bytes(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(line_dedup, "_name", lambda line: F.pmod(F.xxhash64(line), F.lit(23)))
    rng = random.Random(35)
    stock = [sentence(rng, rng.choice((2, 3, 8, 40))) for _ in range(20)]
    rows = [(i, "\n".join(rng.choice(stock) if rng.random() < 0.5 else sentence(rng, 5) for _ in range(rng.randrange(1, 12))), "s") for i in range(50)]
    got = {r.doc_id: r.text for r in line_dedup.remove_repeated(docs(spark, rows), least_words=12).collect()}
    assert got == plain_passages(spark, rows, 12)


def test_a_users_column_with_the_name_of_a_count_is_kept(spark):
    frame = spark.createDataFrame([(1, "a b\nc d", "x", "y", "z")], "doc_id long, text string, n_removed string, N_Chunks string, input_n_removed string")
    row = line_dedup.remove_repeated(frame).collect()[0].asDict()
    assert row == {"doc_id": 1, "text": "a b\nc d", "input_input_n_removed": "x", "input_N_Chunks": "y", "input_n_removed": "z", "n_chunks": 1, "n_removed": 0}
