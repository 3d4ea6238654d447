import random

from tidemark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, pos string, lo string, slice string"


def turns(spark, convs):
    rows = [(c, t, r, x, "clash", "clash", "clash") for c, listed in convs.items() for t, r, x in listed]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def plain(convs):
    ordered = {c: [(r, x) for _, r, x in sorted(t, key=lambda v: (v[0] is None, v[0] or 0, v[1] is not None, v[1] or "", v[2] is not None, v[2] or ""))]
               for c, t in convs.items()}
    key = lambda c: (c is None, c or 0)
    out = {}
    for c, t in ordered.items():
        longer = sorted((o for o, u in ordered.items() if len(u) > len(t) and u[:len(t)] == t), key=key)
        equal = sorted((o for o, u in ordered.items() if u == t), key=key)
        by = longer[0] if longer else equal[0] if equal[0] != c else "kept"
        out[c] = (len(t), by == "kept", None if by == "kept" else by)
    return ordered, out


def logged():
    rng = random.Random(3)
    convs, n = {}, 0
    for _ in range(12):
        whole = [(k, "user" if k % 2 == 0 else "assistant", f"say {rng.randrange(1000)}") for k in range(rng.randrange(1, 8))]
        for cut in sorted({rng.randrange(1, len(whole) + 1) for _ in range(3)}):
            convs[n] = whole[:cut]
            n += 1
    hi = [(0, "user", "hi")]
    convs |= {100 + i: hi for i in range(5)}
    convs |= {200: hi + [(1, "assistant", None)], 201: hi + [(1, "assistant", "")], 202: hi + [(1, "assistant", None), (2, None, "x")]}
    convs |= {300: [(0, "user", "a"), (0, "user", "a"), (None, "user", "late")], 301: [(5, "user", "a"), (9, "user", "a")], None: [(0, "user", "no id")]}
    return convs


def test_snapshots_collapse(spark):
    convs = logged()
    ordered, expected = plain(convs)
    facts, parts = chat.format_chats(turns(spark, convs))
    assert {r.conv_id: (r.n_turns, r.kept, r.covered_by) for r in facts.collect()} == expected
    text = {r.conv_id: r.text for r in parts.collect()}
    assert set(text) == {c for c, (_, kept, _) in expected.items() if kept}
    for c, t in text.items():
        assert t == "".join(f"<|{r or 'unknown'}|>\n{x or ''}\n<|end|>\n" for r, x in ordered[c])


def test_a_conversation_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 4)
    whole = [(k, "user", f"t{k}") for k in range(30)]
    convs = {1: whole, 2: whole[:17], 3: whole[:16], 4: whole[:5] + [(5, "user", "else")] + whole[6:]}
    facts, parts = chat.format_chats(turns(spark, convs))
    assert {r.conv_id: (r.n_turns, r.kept, r.covered_by) for r in facts.collect()} == plain(convs)[1]
    listed = sorted((r.conv_id, r.part, r.n_turns, r.text) for r in parts.collect())
    assert [x[2] for x in listed if x[0] == 1] == [4] * 7 + [2]
    assert "".join(x[3] for x in listed if x[0] == 1) == "".join(f"<|user|>\nt{k}\n<|end|>\n" for k in range(30))


def test_empty_table(spark):
    facts, parts = chat.format_chats(turns(spark, {}))
    assert facts.collect() == [] and parts.collect() == []
