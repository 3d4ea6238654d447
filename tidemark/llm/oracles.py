"""SQL for DuckDB of the queries that it can express.

Not expressible: shared keys of random projections are no rule of the result of
``op2``, so its SQL compares all pairs; ``op6``, ``op7`` and ``op10`` hang on XXH64
and CRC-32, ``op8`` on a fitted model, ``op9`` on a search that carries state.
These are tested against brute force instead.
"""

from __future__ import annotations

from tidemark.llm.quality import (CLASSES, COMMON_WORDS, LEAST_CHARS, LEAST_WORDS, MOST_CLASS_DISTANCE, MOST_WORD_DISTANCE)

GAP = r"[\x20\x09-\x0D]+"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '{GAP}'), lambda w: w <> '')"


MIX = f"""
WITH d AS (SELECT doc_id, source, len({_words('text')}) AS size,
             (('0x' || substr(md5('1|' || coalesce(CAST(doc_id AS VARCHAR), 'null') || '|' || md5(coalesce(text, ''))), 1, 13))::BIGINT + 0.5)
               / 4503599627370496.0 AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS ss FROM d GROUP BY 1),
n AS (SELECT *, ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3) + 1]::DOUBLE AS w, ss * 2.0::DOUBLE AS room FROM s),
o AS (SELECT *, row_number() OVER (ORDER BY room / w, source NULLS LAST) AS k FROM n),
v AS (SELECT *, (1.5::DOUBLE * (SELECT sum(ss) FROM s) - coalesce((SELECT sum(room) FROM o b WHERE b.k < a.k), 0.0))
             / (SELECT sum(w) FROM o b WHERE b.k >= a.k) AS level FROM o a),
f AS (SELECT arg_min(level, k) AS level FROM v WHERE room > level * w),
t AS (SELECT v.source, v.ss, CASE WHEN f.level IS NULL OR v.room <= f.level * v.w THEN v.room ELSE f.level * v.w END AS target FROM v, f),
p AS (SELECT d.*, CASE WHEN size > 0 THEN pow(2.0::DOUBLE, round(log2(size::DOUBLE) * 0.5 * 8) / 8) ELSE 0 END AS prop FROM d),
c AS (SELECT source, prop, sum(size)::DOUBLE AS m FROM p WHERE prop > 0 GROUP BY 1, 2),
r AS (SELECT c.*, t.target, (t.target - 2 * coalesce((SELECT sum(m) FROM c b WHERE b.source IS NOT DISTINCT FROM c.source AND b.prop > c.prop), 0))
             / (SELECT sum(m * prop) FROM c b WHERE b.source IS NOT DISTINCT FROM c.source AND b.prop <= c.prop) AS rate
      FROM c JOIN t ON t.source IS NOT DISTINCT FROM c.source),
g AS (SELECT source, max(prop) AS at, arg_max(rate, prop) AS rate FROM r WHERE rate * prop < 2 GROUP BY 1),
e AS (SELECT p.*, t.ss, t.target, CASE WHEN p.prop = 0 THEN 0 WHEN g.at IS NULL OR p.prop > g.at THEN 2 ELSE greatest(0, g.rate * p.prop) END AS copies
      FROM p JOIN t ON t.source IS NOT DISTINCT FROM p.source LEFT JOIN g ON g.source IS NOT DISTINCT FROM p.source),
x AS (SELECT *, floor(copies) AS whole, CASE WHEN copies > floor(copies) THEN
        (u / (1 - u)) / ((copies - floor(copies)) / (1 - (copies - floor(copies)))) END AS odds FROM e),
y AS (SELECT *, odds / (1 + odds) AS rank, target - sum(whole * size) OVER (PARTITION BY source) AS need FROM x),
z AS (SELECT *, CASE WHEN rank IS NOT NULL THEN sum(CASE WHEN rank IS NOT NULL THEN size END) OVER (PARTITION BY source ORDER BY rank NULLS LAST, size
        RANGE UNBOUNDED PRECEDING) END AS run FROM y),
q AS (SELECT *, rank IS NOT NULL AND run <= need AS fits, need - coalesce(max(CASE WHEN run <= need THEN run END) OVER (PARTITION BY source), 0) AS rest FROM z),
h AS (SELECT source, min(struct_pack(off := abs(size - rest), rank := rank, size := size)) AS best FROM q
      WHERE NOT fits AND rank IS NOT NULL AND size > 0 AND abs(size - rest) < rest GROUP BY 1)
SELECT q.doc_id, q.source, q.size, q.ss AS source_size, round(q.target, 6) AS target,
  (whole + CASE WHEN fits OR (q.rank = h.best.rank AND q.size = h.best.size) THEN 1 ELSE 0 END)::INTEGER AS copies,
  ((whole + CASE WHEN fits OR (q.rank = h.best.rank AND q.size = h.best.size) THEN 1 ELSE 0 END) * q.size)::BIGINT AS taken
FROM q LEFT JOIN h ON h.source IS NOT DISTINCT FROM q.source
"""

NEAR = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
sound AS (SELECT * FROM v WHERE label IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda e: e IS NULL OR NOT isfinite(e))) = 0
          AND len(list_filter(x, lambda e: e <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
          WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
parts AS (SELECT a, min(b) AS component_id FROM reach GROUP BY 1)
SELECT v.vec_id, (SELECT count(*) FROM links WHERE links.a = v.vec_id) AS n_links, p.component_id, v.vec_id = p.component_id AS kept
FROM v JOIN parts p ON p.a = v.vec_id
"""


def _quality() -> str:
    listed = " UNION ALL ".join(
        f"SELECT '{lang}' AS lang, {k} AS k, '{w}' AS w" for lang, ws in COMMON_WORDS.items() for k, w in enumerate(ws))
    rare = {name: f"length(rare) - length(regexp_replace(rare, '{chars}', '', 'g'))" for name, chars in CLASSES.items()}
    classes = "[length(joined) - length(rare), length(body) - length(joined), " + ", ".join(rare.values()) + \
        ", length(rare) - " + " - ".join(f"({x})" for x in rare.values()) + "]"

    def distance(p: str, q: str) -> str:
        term = "CASE WHEN a[{0}] > 0 THEN a[{0}] * log2(a[{0}] / ((a[1] + a[2]) / 2)) ELSE 0 END"
        return (f"CASE WHEN {p} IS NOT NULL AND {q} IS NOT NULL THEN sqrt(greatest(0.0, list_sum(list_transform(list_zip({p}, {q}), "
                f"lambda a: ({term.format(1)} + {term.format(2)}) / 2)))) END")

    return f"""
WITH common AS ({listed}),
d AS (SELECT row_number() OVER () AS id, doc_id, lang, coalesce(text, '') AS body, {_words('text')} AS ws FROM documents),
e AS (SELECT *, array_to_string(ws, '') AS joined, regexp_replace(array_to_string(ws, ''), '[a-z]+', '', 'g') AS rare FROM d),
win AS (SELECT id, unnest(range(1, len(ws) - 1)) AS i FROM d WHERE len(ws) >= 3),
gram AS (SELECT win.id, i, d.ws[i:i + 2] AS g FROM win JOIN d USING (id)),
often AS (SELECT id, i FROM (SELECT *, count(*) OVER (PARTITION BY id, g) AS c FROM gram) WHERE c > 1),
cover AS (SELECT id, count(DISTINCT j) AS n FROM (SELECT id, unnest([i, i + 1, i + 2]) AS j FROM often) GROUP BY 1),
lines AS (SELECT id, list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
token AS (SELECT id, lang, lower(unnest(ws)) AS w FROM d),
hit AS (SELECT token.id, c.k, count(*) AS n FROM token JOIN common c ON c.lang = token.lang AND c.w = token.w GROUP BY 1, 2),
hits AS (SELECT d.id, list(coalesce(hit.n, 0) ORDER BY c.k) AS hs FROM d JOIN common c ON c.lang = d.lang LEFT JOIN hit ON hit.id = d.id AND hit.k = c.k GROUP BY 1),
m AS (SELECT e.id, e.doc_id, e.lang, len(ws) AS n_words, length(joined) AS word_chars, {rare['symbol']} AS n_symbols,
        len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cover.n, 0) AS n_repeat_words, length(body) AS n_chars, {classes} AS cs, hs
      FROM e JOIN lines USING (id) LEFT JOIN cover USING (id) LEFT JOIN hits USING (id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        CASE WHEN n_chars >= {LEAST_CHARS} THEN list_transform(cs, lambda x: x::DOUBLE / n_chars) END AS p,
        CASE WHEN n_words >= {LEAST_WORDS} AND hs IS NOT NULL THEN list_transform(list_append(hs, n_words - list_sum(hs)), lambda x: x::DOUBLE / n_words) END AS q FROM m),
pr AS (SELECT lang, list(x ORDER BY k) AS rp FROM (SELECT lang, k, avg(p[k]) AS x FROM b, range(1, {len(CLASSES) + 4}) r(k)
       WHERE NOT base_failed AND p IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
qr AS (SELECT lang, list(x ORDER BY k) AS rq FROM (SELECT lang, k, avg(q[k]) AS x FROM b, range(1, 18) r(k)
       WHERE NOT base_failed AND q IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
f AS (SELECT b.*, {distance('p', 'rp')} AS cd, {distance('q', 'rq')} AS wd FROM b LEFT JOIN pr ON pr.lang IS NOT DISTINCT FROM b.lang
      LEFT JOIN qr ON qr.lang IS NOT DISTINCT FROM b.lang)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (coalesce(cd, 0) > {MOST_CLASS_DISTANCE} OR coalesce(wd, 0) > {MOST_WORD_DISTANCE}) AS kept,
  round(cd, 6) AS class_distance, round(wd, 6) AS word_distance FROM f
"""


WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages),
lead AS (SELECT body, max(page_id) AS first_of FROM p WHERE n >= 1000 GROUP BY 1)
SELECT p.page_id, n::BIGINT AS payload_bytes, sha1(p.body) AS payload_digest,
  CASE WHEN first_of IS NULL OR first_of = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_of <> page_id THEN first_of END AS refers_to, TRUE AS digests_hold
FROM p LEFT JOIN lead ON lead.body = p.body
"""

CHAT = """
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS pos, role, text FROM conversations),
c AS (SELECT conv_id, count(*) AS n, list(struct_pack(r := role, x := text) ORDER BY pos) AS l FROM t GROUP BY 1),
longer AS (SELECT a.conv_id, min(b.conv_id) AS by FROM c a JOIN c b ON b.n > a.n AND b.l[1:a.n] = a.l GROUP BY 1),
equal AS (SELECT a.conv_id, min(b.conv_id) AS by FROM c a JOIN c b ON b.n = a.n AND b.l = a.l GROUP BY 1),
facts AS (SELECT c.conv_id, c.n, coalesce(longer.by, CASE WHEN equal.by <> c.conv_id THEN equal.by END) AS by
          FROM c LEFT JOIN longer USING (conv_id) LEFT JOIN equal USING (conv_id)),
parts AS (SELECT t.conv_id, (pos - 1) // 256 AS part, string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '')
            || chr(10) || '<|end|>' || chr(10), '' ORDER BY pos) AS body FROM t GROUP BY 1, 2),
whole AS (SELECT conv_id, count(*) AS n_parts, sum(length(body))::BIGINT AS chars, string_agg(md5(body), ',' ORDER BY part) AS digest FROM parts GROUP BY 1)
SELECT f.conv_id, f.n::BIGINT AS n_turns, f.by IS NULL AS kept, f.by AS covered_by, CASE WHEN f.by IS NULL THEN w.n_parts END AS n_parts,
  CASE WHEN f.by IS NULL THEN w.chars END AS rendered_chars, CASE WHEN f.by IS NULL THEN w.digest END AS rendered_md5
FROM facts f JOIN whole w USING (conv_id)
"""

NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, b.label = a.label AS alike,
        CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS pos FROM s WHERE alike) WHERE pos <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.alike AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


def _terms(text: str) -> str:
    low = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"regexp_extract_all({low}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


LEAKS = f"""
WITH i AS (SELECT item_id, {_terms('text')} AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[pos:pos + 9], ' ') AS w
        FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS pos FROM i WHERE len(ws) > 0)),
d AS (SELECT row_number() OVER () AS row, doc_id, {_terms('text')} AS ws FROM documents),
place AS (SELECT row, n, pos, array_to_string(ws[pos:pos + n - 1], ' ') AS w
          FROM (SELECT row, ws, n, unnest(range(1, len(ws) - n + 2)) AS pos FROM d, (SELECT DISTINCT n FROM win) WHERE len(ws) >= n)),
hit AS (SELECT row, place.n, pos, item_id FROM place JOIN win ON win.n = place.n AND win.w = place.w),
words AS (SELECT row, count(DISTINCT w) AS n_hit FROM (SELECT row, unnest(range(pos, pos + n)) AS w FROM hit) GROUP BY 1),
owners AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
           FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (row) LEFT JOIN owners USING (row)
"""

SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_terms('text')} AS ws FROM documents),
c AS (SELECT count(*) AS n, sum(len(ws))::BIGINT AS l FROM d WHERE len(ws) > 0),
m AS (SELECT row, doc_id, 10 + (90 * len(ws)::BIGINT * c.n) // c.l AS m FROM d, c WHERE len(ws) > 0),
asked AS (SELECT DISTINCT item_id, unnest({_terms('text')}) AS t FROM benchmark),
tf AS (SELECT row, t, count(*) AS tf FROM (SELECT row, unnest(ws) AS t FROM d) WHERE t IN (SELECT t FROM asked) GROUP BY 1, 2),
w AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * c.n + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT t, count(*) AS df FROM tf GROUP BY 1), c),
s AS (SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM asked JOIN tf USING (t) JOIN w USING (t) JOIN m USING (row) GROUP BY 1, 2, 3)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10
"""

ORACLES: dict[str, str] = {
    "op1_pareto_mix": MIX, "op2_embedding_near_dups": NEAR, "op3_divergence_quality": _quality(), "op4_warc_round_trip": WARC, "op5_snapshot_collapse": CHAT,
    "op11_slot_hard_negatives": NEGATIVES, "op12_wu_manber_contamination": LEAKS, "op13_bit_sliced_search": SEARCH}
