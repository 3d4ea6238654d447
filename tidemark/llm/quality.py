"""Quality rules by distribution divergence, in DataFrame functions only.

Beside simple counts, a text's histogram of character classes and its histogram
of common words are compared with those of its language by the Jensen-Shannon
distance. The references are the means over all texts of the language that pass
the base rules, so every text weighs the same, whatever its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import packed, put, words

# Frequent function words of each language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "it", "for", "on", "with", "as", "are", "this", "by", "from", "that"],
    "fr": ["de", "la", "le", "les", "et", "des", "en", "un", "une", "que", "est", "pour", "qui", "dans", "par", "sur"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf", "ist", "im", "dem", "nicht"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con", "una", "es"],
}
#: Character classes beside small letters and spaces; what is in none of them is the last class.
CLASSES = {"upper": "[A-Z]", "digit": "[0-9]", "beyond": r"[^\x00-\x7F]", "symbol": "[#*$%&|<>]"}
#: Guards and thresholds of the verdict.
LEAST_CHARS, LEAST_WORDS = 200, 80
MOST_CLASS_DISTANCE, MOST_WORD_DISTANCE = 0.3, 0.3


def _less(text: Column, chars: str) -> Column:
    """How many characters a text loses without a class."""
    return (F.length(text) - F.length(F.regexp_replace(text, chars + "+", ""))).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """The counts of the base rules and both histograms, beside ``row``.

    Windows of three words are compared by a 64-bit hash and sorted with their
    places inside a text; equal neighbours are repeats. Only a text that has a
    repeat is sorted.
    """
    rows = docs.withColumn("_text", F.coalesce(F.col("_text"), F.lit(""))).withColumn("_words", words(F.col("_text")))
    n = F.size("_words")
    hashes = F.when(n >= 3, F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(
        F.element_at("_words", i), F.element_at("_words", i + 1), F.element_at("_words", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn("_windows", hashes)
    # half of the hash and the place in one long sort fast; runs of equal halves are the only windows that can repeat
    rows = rows.withColumn("_halves", F.sort_array(F.transform("_windows", lambda h, i: h.bitwiseAND(F.lit(-1 << 32)).bitwiseOR(i.cast("long")))))

    def half(k):
        return F.shiftright(F.element_at("_halves", k), 32)

    alike = F.filter("_halves", lambda p, k: ((k > 0) & (half(F.greatest(k, F.lit(1))) == F.shiftright(p, 32))) | (
        (k + 1 < F.size("_halves")) & (half(F.least(k + 2, F.size("_halves"))) == F.shiftright(p, 32))))
    rows = rows.withColumn("_placed", F.array_sort(F.transform(alike, lambda p: F.struct(
        F.element_at("_windows", p.bitwiseAND(F.lit((1 << 32) - 1)).cast("int") + 1).alias("h"),
        p.bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("i")))))

    def repeated(p, k):
        before = F.element_at("_placed", F.greatest(k, F.lit(1)))
        after = F.element_at("_placed", F.least(k + 2, F.size("_placed")))
        return ((k > 0) & (before["h"] == p["h"])) | ((k + 1 < F.size("_placed")) & (after["h"] == p["h"]))

    starts = F.transform(F.filter("_placed", repeated), lambda p: p["i"])
    rows = rows.withColumn("_starts", starts)
    covered = F.size(F.array_distinct(F.concat("_starts", F.transform("_starts", lambda i: i + 1), F.transform("_starts", lambda i: i + 2))))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("_lines", lines)
    rows = rows.withColumn("_joined", F.array_join("_words", ""))
    # small letters are most of a text: the other classes are counted in what is left without them
    rows = rows.withColumn("_rare", F.regexp_replace("_joined", "[a-z]+", ""))
    rows = rows.withColumns({f"_c_{name}": _less(F.col("_rare"), chars) for name, chars in CLASSES.items()} | {
        "_chars": F.length("_text").cast("long"), "_word_chars": F.length("_joined").cast("long"), "_other": F.length("_rare").cast("long")})

    common = F.create_map(*[x for lang, listed in COMMON_WORDS.items()
                            for x in (F.lit(lang), F.array(*[F.lit(w) for w in listed]))])
    every = sorted({w for listed in COMMON_WORDS.values() for w in listed})
    frequent = F.filter("_words", lambda w: F.lower(w).isin(every))
    rows = rows.withColumn("_list", F.try_element_at(common, F.col("_lang"))).withColumn(
        "_frequent", F.transform(frequent, lambda w: F.lower(w)))
    hits = F.transform("_list", lambda c: F.size(F.filter("_frequent", lambda w: w == c)).cast("double"))
    rest = F.col("_other")
    for name in CLASSES:
        rest = rest - F.col(f"_c_{name}")
    classes = [F.col("_word_chars") - F.col("_other"), F.col("_chars") - F.col("_word_chars"), *[F.col(f"_c_{name}") for name in CLASSES], rest]
    return rows.select(
        "row", F.col("_lang").alias("lang"), n.cast("long").alias("n_words"), F.col("_word_chars").alias("word_chars"),
        F.col("_c_symbol").alias("n_symbols"), (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"), F.col("_chars").alias("n_chars"),
        F.array(*[c.cast("double") for c in classes]).alias("class_hits"), hits.alias("word_hits"))


def _shares(hits: Column, total: Column) -> Column:
    return F.transform(hits, lambda h: h / total)


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two distributions given as arrays: 0 for equal ones, 1 for disjoint ones, null if one is missing."""
    def side(a, m):
        return F.when((a > 0) & (m > 0), a * F.log2(a / m)).otherwise(F.lit(0.0))

    parts = F.zip_with(p, q, lambda a, b: (side(a, (a + b) / 2) + side(b, (a + b) / 2)) / 2)
    return F.when(p.isNotNull() & q.isNotNull(), F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda s, x: s + x))))


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", least_words: int = 50, most_repeated: float = 0.5) -> DataFrame:
    """Every row as ``row`` with its counts, ``base_failed``, both distances and ``kept``.

    ``base_failed``: fewer than ``least_words`` words, or more than ``most_repeated``
    of the words lie in 3-word windows found more than once. ``kept`` is false for
    these, and for a text whose class distance exceeds ``MOST_CLASS_DISTANCE`` (if
    it has ``LEAST_CHARS`` characters) or whose word distance exceeds
    ``MOST_WORD_DISTANCE`` (if it has ``LEAST_WORDS`` words): shorter texts are not
    judged by their histograms, which say too little, and get a null distance.

    A null or empty text has no words and fails the base rules. A null or unknown
    language is a language of its own for character classes and has no word
    list, so its word distance is null. Repeated rows are judged alike; an empty
    table gives an empty one; other columns travel inside ``row``.

    Texts are read in one pass and never shuffled; the references are map-side
    means of a few numbers per language.
    """
    rows = packed(docs).select("row", F.col("row").getField(text).alias("_text"), F.col("row").getField(lang).alias("_lang"))
    base = measured(rows).withColumn("base_failed", (F.col("n_words") < least_words) | (
        100 * F.col("n_repeat_words") > 100 * F.lit(most_repeated) * F.col("n_words")))
    n_other = F.col("n_words") - F.aggregate(F.coalesce("word_hits", F.array().cast("array<double>")), F.lit(0.0), lambda s, x: s + x)
    shaped = put(base.withColumns({
        "classes": F.when(F.col("n_chars") >= LEAST_CHARS, _shares(F.col("class_hits"), F.col("n_chars"))),
        "common": F.when(F.col("n_words") >= LEAST_WORDS, _shares(F.concat("word_hits", F.array(n_other)), F.col("n_words")))}).drop(
        "class_hits", "word_hits", "n_chars"), "measures")
    k, m = len(CLASSES) + 3, len(next(iter(COMMON_WORDS.values()))) + 1
    sound = shaped.where(~F.col("base_failed"))
    reference = put(sound.groupBy("lang").agg(
        F.array(*[F.avg(F.element_at("classes", i + 1)) for i in range(k)]).alias("ref_classes"),
        F.array(*[F.avg(F.element_at("common", i + 1)) for i in range(m)]).alias("ref_common")).withColumnRenamed("lang", "_rl"), "references")
    judged = shaped.join(reference, F.col("lang").eqNullSafe(F.col("_rl")), "left").withColumns({
        "class_distance": divergence(F.col("classes"), F.col("ref_classes")),
        "word_distance": divergence(F.col("common"), F.col("ref_common"))})
    odd = (F.coalesce(F.col("class_distance"), F.lit(0.0)) > MOST_CLASS_DISTANCE) | (
        F.coalesce(F.col("word_distance"), F.lit(0.0)) > MOST_WORD_DISTANCE)
    return judged.select("row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         "class_distance", "word_distance", (~F.col("base_failed") & ~odd).alias("kept"))
