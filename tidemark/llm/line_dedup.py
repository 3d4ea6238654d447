"""Line dedup by content-defined chunks of lines, in DataFrame functions only.

Lines that hold a word are hashed (blank lines go along with the line before
them), a rolling hash runs over the hashes of neighbouring ones, and a chunk ends
where that rolling hash is a local minimum. The cut depends on a few
lines around it and on nothing before, so a passage that sits at another place in
another text is cut alike. Chunks of several lines that occur more than once in
the corpus are compared byte by byte and removed everywhere but at their first
place.

Chunks alone lose short passages and the ends of long ones. ``least_words`` adds
an exact step: pairs of neighbouring lines and single long lines are compared in
the same way, and repeated pairs that touch are one passage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import beside, packed, put

#: A line with this holds a word; the others are blank.
WORDED = r"[^\x20\x09-\x0D]"


def _rolling(hashes: Column, window: int) -> Column:
    """Cyclic polynomial over the last ``window`` line hashes, at every line."""
    def at(h, i):
        value = F.xxhash64(h)
        for back in range(1, window):
            earlier = F.when(i >= back, F.element_at(hashes, (i - back + 1).cast("int"))).otherwise(F.lit(0).cast("bigint"))
            spun = F.shiftleft(earlier, back).bitwiseOR(F.shiftrightunsigned(earlier, 64 - back))
            value = value.bitwiseXOR(F.xxhash64(spun))
        return value

    return F.transform(hashes, at)


def _name(line: Column) -> Column:
    """What stands for a line until bytes are compared."""
    return F.xxhash64(line)


def cut(docs: DataFrame, text: Column, window: int) -> DataFrame:
    """Add ``_unit``, the worded lines; ``_raw``, each with the blank lines after it (the first also with those before it);
    ``_hash`` of the units; and ``_ends``, the last unit of every chunk.

    Blank lines take no part in hashes and cuts. A text without a worded line has no unit, one raw part and one chunk.
    """
    def line(i):   # with index i from zero
        return F.element_at("_lines", (i + 1).cast("int"))

    lines = docs.withColumn("_lines", F.split(F.coalesce(text, F.lit("")), "\n"))
    n = F.size("_lines")
    placed = lines.withColumn("_at", F.filter(F.sequence(F.lit(0), n - 1), lambda i: line(i).rlike(WORDED)))
    units = F.size("_at")

    def raw(i, u):
        start = F.when(u > 0, i).otherwise(F.lit(0))
        end = F.when(u < units - 1, F.element_at("_at", F.least(u + 2, units).cast("int"))).otherwise(n)
        return F.array_join(F.slice("_lines", start + 1, end - start), "\n")

    parted = placed.withColumn("_unit", F.when(units == n, F.col("_lines")).otherwise(F.transform("_at", line))).withColumn(
        "_raw", F.when(units == n, F.col("_lines")).when(units == 0, F.array(F.array_join("_lines", "\n"))).otherwise(F.transform("_at", raw)))
    rolled = parted.withColumn("_hash", F.transform("_unit", lambda u: _name(u))).withColumn("_roll", _rolling(F.col("_hash"), window))

    def roll(i):
        return F.element_at("_roll", (i + 1).cast("int"))

    inner = F.when(units >= 4, F.sequence(F.lit(1), units - 3)).otherwise(F.array().cast("array<int>"))
    cuts = F.filter(inner, lambda i: (roll(i) < roll(i - 1)) & (roll(i) <= roll(i + 1)))
    return rolled.withColumn("_ends", F.concat(cuts, F.array(F.size("_raw") - 1))).drop("_lines", "_at", "_roll")


def _start(k: Column) -> Column:
    """First unit of the chunk with index ``k``."""
    return F.when(k > 0, F.element_at("_ends", F.greatest(k, F.lit(1)).cast("int")) + 1).otherwise(F.lit(0))


def chunked(docs: DataFrame, text: Column, window: int) -> DataFrame:
    """Add ``_chunks``: per chunk its lines joined again, and how many of them hold a word."""
    def chunk(end, k):
        start = _start(k)
        return F.struct(F.array_join(F.slice("_raw", start + 1, end - start + 1), "\n").alias("body"),
                        F.size(F.slice("_unit", start + 1, end - start + 1)).alias("worded"))

    return cut(docs, text, window).withColumn("_chunks", F.transform("_ends", chunk)).drop("_unit", "_raw", "_hash", "_ends")


def _words(line: Column) -> Column:
    return F.regexp_count(line, F.lit(f"{WORDED}+"))


def _seq(pair: bool, start: Column, m: Column) -> Column:
    """A piece as numbers: is it a pair, and the hashes of its lines."""
    return F.concat(F.array(F.lit(int(pair)).cast("long")), F.slice("_hash", start + 1, m))


def _place(pair: bool, start: Column, m: Column) -> Column:
    """A span of units in one long: first unit, number of units, is it a pair."""
    return F.shiftleft(start.cast("long"), 32) + m.cast("long") * 2 + F.lit(int(pair))


def _span(place: Column) -> tuple[Column, Column, Column]:
    """First unit, number of units and whether the piece is a pair."""
    return F.shiftright(place, 32).cast("int"), F.shiftright(place, 1).bitwiseAND(F.lit(0x7FFFFFFF).cast("long")).cast("int"), place.bitwiseAND(F.lit(1).cast("long"))


def _pieces(least_lines: int, least_words: int | None) -> Column:
    """What is looked for elsewhere: chunks, pairs of lines and long lines, as spans of units with a hash of the hashes of their lines."""
    def piece(pair, start, m):
        return F.struct(F.xxhash64(_seq(pair, start, m)).alias("h"), _place(pair, start, m).alias("place"))

    def unit(i):
        return F.element_at("_unit", (i + 1).cast("int"))

    spans = F.transform("_ends", lambda end, k: F.struct(_start(k).alias("k"), (F.least(end + 1, F.size("_unit")) - _start(k)).alias("m")))
    chunks = F.transform(F.filter(spans, lambda c: c["m"] >= least_lines), lambda c: piece(False, c["k"], c["m"]))
    if least_words is None:
        return chunks
    last = F.size("_unit") - 1
    none = F.array().cast("array<int>")
    pairs = F.transform(F.when(last >= 1, F.sequence(F.lit(0), last - 1)).otherwise(none), lambda i: piece(True, i, F.lit(2)))
    # so many words have at least so many characters; only then they are counted
    long = F.filter(F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(none), lambda i: (
        F.octet_length(unit(i)) >= 2 * least_words - 1) & (_words(unit(i)) >= least_words))
    return F.concat(chunks, pairs, F.transform(long, lambda i: piece(False, i, F.lit(1))))


def _named(held: DataFrame, text: Column, window: int) -> DataFrame:
    """Cut the texts with candidates again; ``_found``: per candidate its hash, place, numbers and whether this id holds the first one."""
    def found(f):
        place = F.shiftright(f, 1)
        start, m, pair = _span(place)
        seq = F.concat(F.array(pair), F.slice("_hash", start + 1, m))
        return F.struct(F.xxhash64(seq).alias("h"), place.alias("place"), f.bitwiseAND(F.lit(1).cast("long")).alias("home"), seq.alias("seq"))

    # the size names ``_hash`` outside the lambda too: the optimizer then leaves it a column, computed once per text
    return cut(held, text, window).withColumn("_found", F.when(F.size("_hash") > 0, F.transform("_flags", found)))


def _shared_names(named: DataFrame) -> DataFrame:
    """The byte comparison: hashes of two different lines, and hashes of two different sequences of lines.

    Every line of a candidate is sent once per task, not once per piece that holds it; pieces are sent as hashes of their lines.
    """
    def units(f):
        start, m, _ = _span(f["place"])
        return F.sequence(start, start + m - 1)

    lines = F.transform(F.array_distinct(F.flatten(F.transform("_found", units))), lambda u: F.struct(
        F.lit(True).alias("line"), F.element_at("_hash", u + 1).alias("name"), F.element_at("_unit", u + 1).alias("body"),
        F.lit(None).cast("array<bigint>").alias("seq")))
    pieces = F.transform("_found", lambda f: F.struct(F.lit(False).alias("line"), f["h"].alias("name"), F.lit(None).cast("string").alias("body"), f["seq"].alias("seq")))
    meant = named.select(F.explode(F.when(F.size("_unit") > 0, F.concat(lines, pieces))).alias("at")).select("at.*")
    return meant.groupBy("line", "name", "body", "seq").agg(F.lit(1).alias("one")).groupBy("line", "name").agg(
        F.count("one").alias("meanings")).where("meanings > 1").select("line", "name")


def _judged_by_body(named: DataFrame, shared: DataFrame) -> DataFrame:
    """New flags of the pieces that hold a name with two meanings, by their bytes: ``_places``, those pieces; ``_fixed``, those of them that go."""
    names = F.explode(F.transform("_found", lambda f: F.struct(f["place"].alias("place"), F.concat(
        F.array(F.struct(F.lit(False).alias("line"), f["h"].alias("name"))),
        F.transform(F.slice(f["seq"], 2, F.size(f["seq"]) - 1), lambda h: F.struct(F.lit(True).alias("line"), h.alias("name")))).alias("names"))))
    asked = named.select("_a", "_b", names.alias("at")).select("_a", "_b", "at.place", F.explode("at.names").alias("n")).select("_a", "_b", "place", "n.*")
    doubtful = asked.join(shared, ["line", "name"]).groupBy("_a", "_b").agg(F.collect_set("place").alias("_places"))

    def body(place):
        start, m, pair = _span(place)
        return F.struct(place.alias("place"), pair.alias("pair"), F.array_join(F.slice("_unit", start + 1, m), "\n").alias("body"))

    bodies = put(named.join(doubtful, ["_a", "_b"]).select("_a", "_b", "_id", F.explode(
        F.when(F.size("_unit") > 0, F.transform("_places", body))).alias("at")).select("_a", "_b", "_id", "at.*"), "doubtful")
    classes = bodies.groupBy("pair", "body").agg(F.min("_id").alias("owner"), F.count(F.lit(1)).alias("times"))
    firsts = bodies.groupBy("_a", "_b", "pair", "body").agg(F.min("place").alias("first"))
    judged = bodies.join(classes, ["pair", "body"]).join(firsts, ["_a", "_b", "pair", "body"])
    goes = (F.col("times") > 1) & ~(F.col("_id").eqNullSafe(F.col("owner")) & (F.col("place") == F.col("first")))
    return judged.groupBy("_a", "_b").agg(F.collect_set("place").alias("_places"), F.collect_set(F.when(goes, F.col("place"))).alias("_fixed"))


def _ordered() -> Column:
    """The candidates of a text by hash and place: the first of a run is the first place."""
    return F.array_sort(F.transform("_found", lambda f: F.struct(f["h"].alias("h"), f["place"].alias("place"), f["home"].alias("home"))))


def _goes() -> Column:
    """Places of the candidates that go: all but the first of its hash in a text under the first id."""
    def stays(f, i):
        before = F.element_at("_ordered", F.greatest(i, F.lit(1)).cast("int"))
        return (f["home"] == 1) & ((i == 0) | (before["h"] != f["h"]))

    told = F.transform("_ordered", lambda f, i: F.struct(f["place"].alias("place"), stays(f, i).alias("stays")))
    return F.transform(F.filter(told, lambda f: ~f["stays"]), lambda f: f["place"])


def _away(least_words: int | None) -> Column:
    """The units that go, each once: those of chunks and long lines, and passages of repeated pairs with enough words."""
    def units(place):
        start, m, _ = _span(place)
        return F.sequence(start, start + m - 1)

    whole = F.transform(F.filter("_gone", lambda g: _span(g)[2] == 0), units)
    if least_words is None:
        return F.array_distinct(F.flatten(whole))
    pairs = F.transform(F.filter("_gone", lambda g: _span(g)[2] == 1), lambda g: _span(g)[0])
    first = F.array_sort(F.array_except(pairs, F.transform(pairs, lambda k: k + 1)))
    last = F.array_sort(F.array_except(pairs, F.transform(pairs, lambda k: k - 1)))
    passages = F.zip_with(first, last, lambda a, b: F.struct(a.alias("a"), (b + 1).alias("b")))

    def enough(p):
        return F.aggregate(F.slice("_unit", p["a"] + 1, p["b"] - p["a"] + 1), F.lit(0), lambda n, line: n + _words(line)) >= least_words

    # the size names ``_unit`` outside the lambda too: the optimizer then leaves it a column, computed once per text
    runs = F.transform(F.when(F.size("_unit") > 0, F.filter(passages, enough)), lambda p: F.sequence(p["a"], p["b"]))
    return F.array_distinct(F.flatten(F.concat(whole, runs)))


def remove_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 2, least_lines: int = 2,
                    least_words: int | None = None) -> DataFrame:
    """Every row of ``docs`` with its text less repeated chunks; new columns ``n_chunks`` and ``n_removed`` (long).

    A chunk takes part if it has at least ``least_lines`` lines that hold a word.
    Of equal chunks that at the smallest id stays, at its first place in that text;
    all others go, with the blank lines after their lines. Equality is that of the
    bytes of the worded lines: hashes only name candidates. Names that turn out to
    have two meanings are set aside, and their pieces are judged by their bytes.
    ``n_removed`` counts chunks that lost lines.

    With ``least_words`` short passages and the ends of long ones go as well: a line
    of at least so many words that occurs before, and every run of lines of at
    least so many words in which each line and its next occur before as
    neighbours, be it in one text or in several. First places are told as for chunks.
    So whatever goes stays once, line by line, at an earlier place. Words are parted by white space.

    Null texts stay null, empty ones empty, and a text all of whose chunks go
    becomes empty; no row is dropped. Rows equal in id and text are one document
    and are treated alike (both keep the first place), as are different texts under
    one id. Rows with a null id come after all others; a chunk found only under null
    ids keeps its first place in each of their texts. An empty table gives an empty one. Other columns stay as they
    are; one named ``n_chunks`` or ``n_removed`` is returned as ``input_n_chunks`` or ``input_n_removed``.

    What is shuffled: a row of numbers per chunk, and with ``least_words`` per line (hash, document and place); every
    text once; and each line of a candidate once per task that holds it. A chunk that
    a third of all texts share is counted and compared in map-side aggregates.
    """
    body = F.col("row").getField(text)
    own_id = F.col("row").getField(doc_id)
    # a document is its id and text; two hashes stand for both
    base = packed(docs).select("row", F.xxhash64(own_id, body).alias("_a"), F.xxhash64(F.lit(1), own_id, body).alias("_b"))
    pieces = cut(base, body, window).select("_a", "_b", own_id.alias("_id"), F.explode(_pieces(least_lines, least_words)).alias("at")).select("_a", "_b", "_id", "at.*")
    repeated = put(pieces.groupBy("h").agg(F.count(F.lit(1)).alias("times"), F.min("_id").alias("owner")).where("times > 1").select("h", "owner"), "repeated-hashes")
    flags = pieces.join(repeated, "h").select(
        "_a", "_b", (F.col("place") * 2 + F.col("_id").eqNullSafe(F.col("owner")).cast("long")).alias("flag"))
    marked = put(base.join(flags.groupBy("_a", "_b").agg(F.collect_set("flag").alias("_flags")), ["_a", "_b"], "left"), "marked")

    named = _named(marked.where("_flags is not null").withColumn("_id", own_id), body, window)
    judged = named.withColumn("_ordered", _ordered()).withColumn("_gone", _goes())
    shared = put(_shared_names(named), "shared-names")
    if not shared.isEmpty():
        judged = judged.join(_judged_by_body(named, shared), ["_a", "_b"], "left").withColumn("_gone", F.when(
            F.col("_places").isNull(), F.col("_gone")).otherwise(F.concat(F.array_except("_gone", "_places"), "_fixed")))

    away = judged.withColumn("_away", F.when(F.size("_gone") > 0, _away(least_words)).otherwise(F.array().cast("array<int>")))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_raw") - 1), "_away")
    rewritten = F.array_join(F.transform(kept, lambda u: F.element_at("_raw", u + 1)), "\n")
    chunk_of = F.flatten(F.transform("_ends", lambda end, k: F.array_repeat(k, end - _start(k) + 1)))
    touched = away.withColumn("_chunk_of", chunk_of).select(
        "row", F.when(F.size("_away") > 0, rewritten).otherwise(body).alias("_new"), F.size("_ends").alias("_n"),
        F.when(F.size("_chunk_of") > 0, F.size(F.array_distinct(F.transform("_away", lambda u: F.element_at("_chunk_of", u + 1))))).alias("_m"))
    plain = cut(marked.where("_flags is null"), body, window).select(
        "row", body.alias("_new"), F.size("_ends").alias("_n"), F.lit(0).alias("_m"))
    columns = [F.col("_new").alias(c) if c == text else F.col("row").getField(c).alias(name) for c, name in beside(docs, "n_chunks", "n_removed")]
    return plain.unionAll(touched).select(
        *columns, F.when(F.col("_new").isNull(), 0).otherwise(F.col("_n")).cast("long").alias("n_chunks"), F.col("_m").cast("long").alias("n_removed"))
