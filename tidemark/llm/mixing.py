"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Targets: every source gets a share of the words asked for by its weight, at most
``cap`` times its own words; what it cannot take is shared anew among the others.

Sampling: within a source a document's expected copies are proportional to a
propensity of its size, at most ``cap``, such that the expected words meet the
target. The whole part is allocated for certain. The fraction p becomes one more
copy or none: documents are ranked by random odds over inclusion odds,
(u / (1 - u)) / (p / (1 - p)), and the lowest ranks are taken until the words that
are left are reached: a sample of fixed size, counted in words. Documents are not cut,
so the last place goes to the document that comes nearest to the words missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.llm.common import n_words, packed, put, unit

#: Classes of the propensity per doubling; copies are decided per class, so the solve runs on a small table.
CLASSES = 8
#: Rank cells per source: sums per cell find the cell in which the target is reached.
CELLS = 4096


def targets(sizes: DataFrame, weights: list[float], share: float, cap: float) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows.

    Sources are ordered by code point with null last and take the weights in
    turn. One row per source from here on: the source list is the only thing
    that a single task sees, and it is an aggregate.

    Sharing until none is above its cap is a walk over sources in the order in
    which they fill up: with the level t, a source holds min(cap * size, t * weight),
    and the order is that of cap * size / weight.
    """
    listed = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    numbered = listed.withColumn("_no", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1)
    weighed = numbered.withColumn("_w", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("_no") % len(weights) + 1).cast("int")))
    total = F.sum("source_size").over(W.partitionBy())
    room = F.col("source_size") * F.lit(float(cap))
    order = W.orderBy(room / F.col("_w"), "_no")
    done, ahead = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    asked = F.lit(float(share)) * total
    level = (asked - F.coalesce(F.sum(room).over(done), F.lit(0.0))) / F.sum("_w").over(ahead)
    stepped = weighed.withColumn("_room", room).withColumn("_level", level)
    # the first source in this order that does not fill up sets the level for itself and all behind it
    full = F.col("_room") <= F.col("_level") * F.col("_w")
    final = stepped.withColumn("_open", F.min(F.when(~full, F.struct(
        (F.col("_room") / F.col("_w")).alias("at"), "_no", "_level"))).over(W.partitionBy())["_level"])
    return final.select("source", "source_size", F.when(
        F.col("_open").isNull() | (F.col("_room") <= F.col("_open") * F.col("_w")), F.col("_room")).otherwise(
        F.col("_open") * F.col("_w")).alias("target"))


def propensity(size: Column, power: float) -> Column:
    """size ** power, rounded to one of a few classes per doubling; zero for an empty document."""
    return F.when(size > 0, F.pow(F.lit(2.0), F.round(F.log2(size.cast("double")) * power * CLASSES) / CLASSES)).otherwise(F.lit(0.0))


def expected(rows: DataFrame, goal: DataFrame, cap: float) -> DataFrame:
    """``(source, _prop, _copies)``: expected copies per propensity class, at most ``cap``, that meet the target."""
    classes = rows.groupBy("source", "_prop").agg(F.sum("size").cast("double").alias("_s")).where("_prop > 0")
    joined = classes.join(goal, classes["source"].eqNullSafe(goal["source"])).select(
        classes["source"], "_prop", "_s", "target")
    order = W.partitionBy("source").orderBy(F.desc("_prop"))
    done, ahead = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    rate = (F.col("target") - F.lit(float(cap)) * F.coalesce(F.sum("_s").over(done), F.lit(0.0))) / F.sum(F.col("_s") * F.col("_prop")).over(ahead)
    stepped = joined.withColumn("_rate", rate)
    final = stepped.withColumn("_open", F.max(F.when(F.col("_rate") * F.col("_prop") < cap, F.struct("_prop", "_rate"))).over(W.partitionBy("source")))
    return final.select("source", "_prop", F.when(F.col("_open").isNull() | (F.col("_prop") > F.col("_open._prop")), F.lit(float(cap))).otherwise(
        F.greatest(F.lit(0.0), F.col("_open._rate") * F.col("_prop"))).alias("_copies"))


def mix(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
        weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, power: float = 0.5, seed: int = 1) -> DataFrame:
    """Every row as ``row`` with ``size``, ``source_size``, ``target``, ``copies`` (0 to cap) and ``taken`` = copies * size (long).

    A null or empty text has size zero and takes no copy. A null source is a
    source like any other. The draw of a row hangs on its id, text and the seed,
    so reruns agree; equal rows share a draw and its outcome. An empty table gives an empty
    one; other columns, whatever their names, travel inside ``row``.

    No source is ever sorted whole: words are summed by rank cell, and only the
    cell in which the target falls is ordered, one of ``CELLS`` per source.
    """
    rows = packed(docs).select(
        "row", F.col("row").getField(source).alias("source"), n_words(F.col("row").getField(text)).alias("size"),
        unit(F.lit(seed), F.coalesce(F.col("row").getField(doc_id).cast("string"), F.lit("null")), F.md5(
            F.coalesce(F.col("row").getField(text), F.lit("")))).alias("_u")).withColumn("_prop", propensity(F.col("size"), power))
    # the small columns once; everything is decided on them
    small = put(rows.select("source", "size", "_u", "_prop"), "sizes")
    goal = put(targets(small, list(weights), share, cap), "targets")
    copies = put(expected(small, goal, cap), "copies")

    def ranked(frame):
        """Whole copies, fraction and rank of each row."""
        with_copies = frame.join(copies.withColumnRenamed("source", "_cs").withColumnRenamed("_prop", "_cp"),
                                 F.col("source").eqNullSafe(F.col("_cs")) & (F.col("_prop") == F.col("_cp")), "left").drop("_cs", "_cp")
        e = F.coalesce("_copies", F.lit(0.0))
        out = with_copies.withColumn("_whole", F.floor(e)).withColumn("_p", e - F.floor(e))
        odds = F.when(F.col("_p") > 0, (F.col("_u") / (1 - F.col("_u"))) / (F.col("_p") / (1 - F.col("_p"))))
        # odds to a number in (0, 1): the order is the same and cells are of even width
        return out.withColumn("_rank", odds / (1 + odds)).withColumn("_cell", F.floor(F.col("_rank") * CELLS).cast("int")).drop("_copies")

    drawn = ranked(small)
    certain = drawn.groupBy("source").agg(F.sum(F.col("_whole") * F.col("size")).cast("double").alias("_certain"))
    cells = drawn.where("_rank is not null").groupBy("source", "_cell").agg(F.sum("size").cast("double").alias("_cw"))
    ordered = W.partitionBy("source").orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)
    need = goal.join(certain.withColumnRenamed("source", "_s2"), F.col("source").eqNullSafe(F.col("_s2"))).select(
        "source", (F.col("target") - F.col("_certain")).alias("_need"))
    summed = cells.withColumn("_before", F.coalesce(F.sum("_cw").over(ordered), F.lit(0.0)))
    n = need.withColumnRenamed("source", "_s3")
    edge = put(summed.join(n, F.col("source").eqNullSafe(F.col("_s3"))).where("_before <= _need").groupBy("source").agg(
        F.max(F.struct("_cell", "_before", "_need")).alias("_e")).select(
        F.col("source").alias("_es"), F.col("_e._cell").alias("_ecell"), (F.col("_e._need") - F.col("_e._before")).alias("_left")), "edges-of-samples")

    # inside the edge cell: in rank order while a document fits
    inside = drawn.join(edge, F.col("source").eqNullSafe(F.col("_es")) & (F.col("_cell") == F.col("_ecell"))).groupBy(
        "source", "_rank", "size", "_left").agg(F.count(F.lit(1)).alias("_same"))
    w = W.partitionBy("source").orderBy("_rank", "size")
    run = F.sum(F.col("size") * F.col("_same")).over(w.rowsBetween(W.unboundedPreceding, 0))
    # sums only grow, so those that fit are the first in order
    last = inside.withColumn("_run", run).where("_run <= _left").groupBy("source").agg(
        F.max(F.struct("_rank", "size")).alias("_l"), F.max("_run").alias("_run")).select(
        F.col("source").alias("_ls"), F.col("_l._rank").alias("_lrank"), F.col("_l.size").alias("_lsize"), "_run")
    limits = put(edge.join(last, F.col("_es").eqNullSafe(F.col("_ls")), "left").select(
        "_es", "_ecell", "_lrank", "_lsize", (F.col("_left") - F.coalesce("_run", F.lit(0))).alias("_rest")), "limits")

    extra = F.coalesce((F.col("_cell") < F.col("_ecell")) | ((F.col("_cell") == F.col("_ecell")) & (
        (F.col("_rank") < F.col("_lrank")) | ((F.col("_rank") == F.col("_lrank")) & (F.col("size") <= F.col("_lsize"))))), F.lit(False))
    # the last place: of the documents left out, that whose size is nearest to the words still missing
    off = F.abs(F.col("size") - F.col("_rest"))
    nearest = drawn.join(limits, F.col("source").eqNullSafe(F.col("_es"))).where(
        ~extra & F.col("_rank").isNotNull() & (F.col("size") > 0) & (off < F.col("_rest"))).groupBy("source").agg(
        F.min(F.struct(off.alias("off"), "_rank", "size")).alias("_n")).select(
        F.col("source").alias("_ns"), F.col("_n._rank").alias("_nrank"), F.col("_n.size").alias("_nsize"))
    known = goal.withColumnRenamed("source", "_gs")
    facts = put(known.join(limits, F.col("_gs").eqNullSafe(F.col("_es")), "left").join(
        nearest, F.col("_gs").eqNullSafe(F.col("_ns")), "left").drop("_es", "_ns"), "facts")
    extra = extra | F.coalesce((F.col("_rank") == F.col("_nrank")) & (F.col("size") == F.col("_nsize")), F.lit(False))

    out = ranked(rows).join(facts, F.col("source").eqNullSafe(F.col("_gs")), "left")
    count = (F.col("_whole") + F.when(extra, 1).otherwise(0)).cast("int")
    return out.withColumn("copies", count).select(
        "row", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))
