"""Chat formatting: cumulative snapshots collapse to the longest conversations before these are rendered.

A logging client stores the whole conversation at every turn, so a conversation
is stored many times, each time as a prefix of the next. A rolling hash over its
turns gives every prefix a key; a conversation whose full key is a shorter prefix
of another is dropped by an anti-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidemark.llm.common import put

#: Turns that are numbered, hashed and rendered together: bounds a task also for a conversation of any length.
BLOCK = 256


def numbered(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns with their position (from 1) and the rolling prefix hash up to them.

    The hash of a prefix is the sum of the hashes of (position, role, text), kept
    as two sums of 32-bit halves that cannot overflow. Sums of blocks add up, so
    a very long conversation is hashed block by block in many tasks.
    """
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"),
                        F.col(text).cast("string").alias("text"), F.coalesce(F.col(conv_id).cast("string"), F.lit("\u0000")).alias("conv"))
    rows = rows.withColumn("slice", F.floor(F.coalesce("turn", F.lit((1 << 62))) / BLOCK).cast("long"))
    here = W.partitionBy("conv", "slice")
    order = here.orderBy(F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    inside = rows.withColumn("inside", F.row_number().over(order))
    before = W.partitionBy("conv").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)

    counts = rows.groupBy("conv", "slice").agg(F.count(F.lit(1)).alias("held"))
    offsets = counts.withColumn("offset", F.coalesce(F.sum("held").over(before), F.lit(0))).withColumn(
        "n_turns", F.sum("held").over(W.partitionBy("conv"))).drop("held")
    at = inside.join(offsets, ["conv", "slice"]).withColumn("pos", F.col("offset") + F.col("inside"))
    hashed = at.withColumn("h", F.xxhash64("pos", F.coalesce("role", F.lit("\u0000")), F.coalesce("text", F.lit("\u0000"))))
    halves = hashed.withColumns({"lo": F.col("h").bitwiseAND(F.lit((1 << 32) - 1)), "hi": F.shiftrightunsigned("h", 32)})
    up_to = here.orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    summed = halves.withColumns({c: F.sum(c).over(up_to) for c in ("lo", "hi")})
    totals = halves.groupBy("conv", "slice").agg(F.sum("lo").alias("lo"), F.sum("hi").alias("hi"))
    ahead = totals.select("conv", "slice", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}0") for c in ("lo", "hi")])
    return summed.join(ahead, ["conv", "slice"]).select(
        "conv_id", "conv", "pos", "n_turns", "role", "text", (F.col("lo") + F.col("lo0")).alias("lo"), (F.col("hi") + F.col("hi0")).alias("hi"))


def collapsed(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``numbered`` rows: conv_id, conv, n_turns, kept, covered_by.

    ``covered_by``: for a conversation that a longer one begins with, the
    smallest id of such a longer one; for one of several equal conversations, the
    smallest id of these; null for those that are kept. What a hash claims is
    compared turn by turn before anything is dropped.
    """
    ends = rows.where("pos = n_turns").select("conv_id", "conv", "n_turns", "lo", "hi")
    order = F.struct(F.col("conv_id").isNull().alias("last"), "conv_id", "conv")
    # distinct prefixes of longer conversations; a first turn that very many share is one row per task here
    longer = rows.where("pos < n_turns").groupBy(F.col("pos").alias("n_turns"), "lo", "hi").agg(F.min(order)["conv"].alias("longer"))
    equal = ends.groupBy("n_turns", "lo", "hi").agg(F.min(order)["conv"].alias("first"))
    claimed = ends.join(longer, ["n_turns", "lo", "hi"], "left").join(equal, ["n_turns", "lo", "hi"]).withColumn(
        "by", F.coalesce("longer", F.when(F.col("first") != F.col("conv"), F.col("first")))).select("conv_id", "conv", "n_turns", "by")
    claimed = put(claimed, "claimed")
    # proof: every turn equals the turn at the same place of the conversation said to cover it
    said = rows.select("conv", "pos", "role", "text").join(claimed.where("by is not null").select("conv", "by"), "conv")
    there = rows.select(F.col("conv").alias("by"), "pos", F.col("role").alias("role2"), F.col("text").alias("text2"))
    agreed = said.join(there, ["by", "pos"]).where(F.col("role").eqNullSafe(F.col("role2")) & F.col("text").eqNullSafe(F.col("text2")))
    proven = agreed.groupBy("conv").agg(F.count(F.lit(1)).alias("agreed"))
    names = claimed.select(F.col("conv").alias("by"), F.col("conv_id").alias("covered_by"))
    return claimed.join(proven, "conv", "left").withColumn(
        "by", F.when(F.col("agreed") == F.col("n_turns"), F.col("by"))).join(names, "by", "left").select(
        "conv_id", "conv", "n_turns", F.col("by").isNull().alias("kept"), "covered_by")


def rendered(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """The kept conversations as text, in parts of at most ``BLOCK`` turns: conv_id, conv, part, n_turns, text."""
    kept = rows.join(facts.where(~F.col("kept")).select("conv"), "conv", "left_anti")
    piece = F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("\n<|end|>\n"))
    parts = kept.groupBy("conv", F.floor((F.col("pos") - 1) / BLOCK).cast("int").alias("part")).agg(
        F.first("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("pos", piece.alias("piece")))).alias("pieces"))
    return parts.select("conv_id", "conv", "part", "n_turns", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("text"))


def format_chats(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
    """``(facts, parts)``: what became of every conversation, and the text of those kept.

    Turns are ordered by number, then role and text; repeated rows are turns of
    their own. Null turn numbers come last. Rows with a null conversation are one
    conversation. A null role is rendered as "unknown", a null text as nothing,
    though it differs from an empty one when turns are compared. An empty table
    gives empty frames; other columns are not read.
    """
    rows = put(numbered(turns, conv_id, turn, role, text), "turns")
    facts = put(collapsed(rows), "conversations")
    return facts, rendered(rows, facts)
