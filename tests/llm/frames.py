"""Small frames with every awkward case: nulls, empty and long texts, repeated rows, clashing columns."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, fp string, size string, source_size string, _u string, h string"
WORDS = "the of and to in alpha beta gamma delta river stone Cloud Tree window paper light sound house metal glass".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(n))


def texts(seed=1, n=60):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lines = [sentence(rng, rng.randrange(3, 14)) for _ in range(rng.randrange(1, 9))]
        out.append("\n".join(lines))
    out += [None, "", "  \t\n", "one", "two words", out[0], out[0], out[0] + " tail", out[1].replace("a", "A", 1)]
    out.append(" ".join(sentence(rng, 2000) for _ in range(3)))
    out.append("x" * 5000)
    return out


def docs(spark, rows=None):
    """``rows``: (doc_id, text, source); awkward ids, sources and repeated rows by default."""
    if rows is None:
        listed = texts()
        rows = [(i, t, None if i % 7 == 0 else f"s{i % 4}") for i, t in enumerate(listed)]
        rows += [rows[3], rows[3], (None, "no id at all", "s1"), (5, "same id, other text", "s2")]
    full = [(i, t, "en" if (i or 0) % 3 else None, s, len(t or ""), "clash", "clash", "clash", "clash", "clash", "clash") for i, t, s in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)
