"""Hard negatives by slot-decomposed selection.

An anchor asks, for each of its positives, for the best rows of other labels whose
score lies in a window below the positive's score. The upper limits of an
anchor's windows cut the scores into disjoint slots. A pass over the rows keeps the
best k of every slot, first inside each task, then over all tasks; since slots
follow each other downwards, the best k below an upper limit are the first k of
the slots from there on, and one list answers all windows, however they overlap.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import put

#: Anchors that are scored together, rows of one stretch, and rows scored in one product.
ANCHORS, STRETCH, ROWS = 1024, 1 << 22, 4096
#: Scores stay below 2^62: a row whose squares sum up beyond this could break that.
MOST_SQUARES = float(1 << 61)


def first_k(groups: list[np.ndarray], score: np.ndarray, ident: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of every group, higher scores first, smaller ids next."""
    order = np.lexsort([ident, -score, *groups[::-1]])
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.logical_or.reduce([g[order][1:] != g[order][:-1] for g in groups])
    start = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - start < k]


def best_in_rows(score: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` highest allowed scores of every row; among equal ones the columns to the left."""
    rows = np.flatnonzero(ok.any(axis=1))
    score, ok = score[rows], ok[rows]
    if score.shape[1] > k:
        floor = np.iinfo(np.int64).min
        masked = np.where(ok, score, floor)
        limit = np.partition(masked, -k, axis=1)[:, -k, None]
        above, level = masked > limit, ok & (masked == limit)
        ok = above | (level & (np.cumsum(level, axis=1) <= k - above.sum(axis=1, keepdims=True)))
    at, column = np.nonzero(ok)
    return rows[at], column


class _Anchors:
    """The anchors of one stretch of the grid, as arrays."""

    def __init__(self, batch: pa.Table):
        self.ids, self.labels = batch.column("id").to_numpy(), batch.column("label").to_numpy()
        self.x = _matrix(batch.column("x"))
        self.tops = _matrix(batch.column("tops"))       # upper limits, falling, filled up with the last one
        self.floor = batch.column("floor").to_numpy()


def _matrix(column) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integers: in doubles where every sum stays below 2^53."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def _alike(anchors: _Anchors, ids: np.ndarray, labels: np.ndarray, score: np.ndarray):
    """Candidates for positives: other rows of the anchor's label, one slot."""
    yield 0, (labels[None, :] == anchors.labels[:, None]) & (ids[None, :] != anchors.ids[:, None])


def _other(anchors: _Anchors, ids: np.ndarray, labels: np.ndarray, score: np.ndarray):
    """Candidates for negatives, slot by slot downwards."""
    other = (labels[None, :] != anchors.labels[:, None]) & (score >= anchors.floor[:, None])
    for slot in range(anchors.tops.shape[1]):
        inside = other & (score <= anchors.tops[:, slot, None])
        if slot + 1 < anchors.tops.shape[1]:
            inside &= score > anchors.tops[:, slot + 1, None]
        yield slot, inside


def _best(grid: DataFrame, tasks: int, allowed: Callable, k: int) -> DataFrame:
    """``(anchor, slot, score, id)``: the best ``k`` of every anchor and slot."""
    def run(batches):
        here, anchors, waiting, state = None, None, [], []

        def flush():
            if not state:
                return None
            anchor, slot, score, ident = (np.concatenate(c) for c in zip(*state))
            keep = first_k([anchor, slot], score, ident, k)
            state[:] = [(anchor[keep], slot[keep], score[keep], ident[keep])]
            return pa.RecordBatch.from_arrays([pa.array(anchors.ids[anchor[keep]]), pa.array(slot[keep].astype(np.int32)),
                                               pa.array(score[keep]), pa.array(ident[keep])], ["anchor", "slot", "score", "id"])

        for batch in batches:
            cell = batch.column("cell").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]]) if len(cell) else [0]
            for a, b in zip(cuts[:-1], cuts[1:]):
                part = batch.slice(a, b - a)
                if cell[a] != here:
                    if found := flush():
                        yield found
                    here, anchors, waiting, state[:] = cell[a], None, [], []
                is_anchor = part.column("is_anchor").to_numpy(zero_copy_only=False)
                n_anchors = int(is_anchor.sum())      # they come first in their cell
                if n_anchors:
                    waiting.append(part.slice(0, n_anchors))
                rows = part.slice(n_anchors)
                if not rows.num_rows or not waiting and anchors is None:
                    continue
                if waiting:
                    anchors, waiting = _Anchors(pa.Table.from_batches(waiting)), []
                for at in range(0, rows.num_rows, ROWS):
                    some = rows.slice(at, ROWS)
                    order = np.argsort(some.column("id").to_numpy(), kind="stable")
                    ids, labels = some.column("id").to_numpy()[order], some.column("label").to_numpy()[order]
                    score = _products(anchors.x, _matrix(some.column("x"))[order])
                    for slot, ok in allowed(anchors, ids, labels, score):
                        i, j = best_in_rows(score, ok, k)
                        state.append((i, np.full(len(i), slot), score[i, j], ids[j]))
                    if len(state) > 64:
                        flush()
        if found := flush():
            yield found

    parts = grid.repartition(tasks, "cell").sortWithinPartitions("cell", F.col("is_anchor").desc())
    found = parts.mapInArrow(run, "anchor bigint, slot int, score bigint, id bigint")
    # a rank limit, which Spark also applies before the shuffle
    place = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def _grid(rows: DataFrame, anchors: DataFrame, blocks: int, stretches: int) -> DataFrame:
    """Every block of anchors beside every stretch of rows of the same length, once each."""
    cell = F.col("dim").cast("bigint") * F.lit(blocks * stretches) + F.col("block") * F.lit(stretches) + F.col("stretch")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(n)).cast("int")
    a = anchors.withColumn("block", deal(1, blocks)).withColumn("stretch", spread(stretches)).select(
        cell.cast("bigint").alias("cell"), F.lit(True).alias("is_anchor"), "id", "label", "x", "tops", "floor")
    b = rows.withColumn("stretch", deal(2, stretches)).withColumn("block", spread(blocks)).select(
        cell.cast("bigint").alias("cell"), F.lit(False).alias("is_anchor"), "id", "label", "x",
        F.lit(None).cast("array<bigint>").alias("tops"), F.lit(None).cast("bigint").alias("floor"))
    return a.unionByName(b)


def mined(vectors: DataFrame, anchors: Column, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
          scale: float = 256.0, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, block: int = ANCHORS,
          stretch: int = STRETCH) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    A component x becomes ``floor(scale * x)``; a score is the integer inner
    product with the anchor. Higher scores come first, then smaller ids. The
    positives of an anchor (a row where the condition ``anchors`` holds) are its first
    ``positives`` rows of equal label and another id; for each, the first
    ``negatives`` rows of another label are returned whose score lies between
    ``low`` and ``high`` per cent of the positive's, both included (for a negative
    score this window is empty).

    Rows with a null id, label or vector, or a null or non-finite component take no
    part, nor do empty vectors and rows whose scaled components are so large that a score might not
    fit a long (the sum of squares from 2^61). Vectors of different length do not
    meet. Anchor rows that repeat an id are one anchor, the smallest by label and
    vector; other rows count one by one. An empty table gives no rows; other
    columns, whatever their names, are not read.

    Anchors are a stated set, compared with all rows: blocks of about ``block``
    anchors meet stretches of at most about ``stretch`` rows, each pair in one
    task that streams its rows, so nothing hangs on how many rows share a label.
    What leaves a task is at most ``negatives`` rows per anchor and slot.
    """
    wanted = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
                            F.col(f"`{embedding}`").alias("raw"), anchors.alias("asks")).where("id is not null and label is not null and raw is not null")
    finite = F.coalesce(F.forall("raw", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
    fits = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v) < MOST_SQUARES
    rounded = wanted.where(finite).withColumn("raw", F.transform("raw", lambda v: F.lit(scale) * v.cast("double"))).withColumn(
        "x", F.transform("raw", lambda v: F.when(F.abs(v) < 4e9, F.floor(v).cast("double")).otherwise(v)))
    rows = put(rounded.where(fits).select("id", "label", F.col("asks").eqNullSafe(True).alias("asks"),
                                          F.transform("x", lambda v: v.cast("long")).alias("x"), F.size("x").alias("dim")), "rounded")
    asking = put(rows.where("asks and dim > 0").groupBy("id").agg(F.min(F.struct("label", "x", "dim")).alias("a")).select("id", "a.*"), "anchors")
    n_rows, n_asking, cores = rows.count(), asking.count(), rows.sparkSession.sparkContext.defaultParallelism
    blocks = max(1, math.ceil(n_asking / block))
    stretches = max(1, math.ceil(n_rows / stretch), math.ceil(2 * cores / blocks))
    grid = lambda a: _grid(rows, a, blocks, stretches)
    tasks = blocks * stretches

    none = asking.select("*", F.array(F.lit(0).cast("bigint")).alias("tops"), F.lit(0).cast("bigint").alias("floor"))
    alike = put(_best(grid(none), tasks, _alike, positives), "positives")
    windows = alike.where("score >= 0").select(
        "anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"),
        # floor and ceiling of the shares of the score, without a product that could leave the longs
        F.expr(f"(score div 100) * {high} + ((score % 100) * {high}) div 100").alias("top"),
        F.expr(f"(score div 100) * {low} + ((score % 100) * {low} + 99) div 100").alias("least"))
    # at most ``positives`` windows per anchor; repeated upper limits are one slot
    limits = windows.groupBy(F.col("anchor").alias("id")).agg(
        F.sort_array(F.collect_set("top"), False).alias("found"), F.min("least").alias("floor"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(positives - 1)), lambda i: F.get("found", F.least(i, F.size("found") - 1)))
    ready = asking.join(limits, "id").select("*", filled.alias("tops"))
    best = _best(grid(ready), tasks, _other, negatives)

    # the slots of an anchor, one after the other downwards: a window is a run of this list
    lists = best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct(
        "slot", (-F.col("score")).alias("below"), F.col("id").alias("negative_id")))).alias("list"))
    slot = F.array_position("found", F.col("top")).cast("int") - 1
    asked = windows.join(limits.select(F.col("id").alias("anchor"), "found"), "anchor").join(lists, "anchor")
    first = F.slice(F.filter("list", lambda c: c["slot"] >= slot), 1, negatives)
    chosen = asked.select("anchor", "positive_id", "positive_score", F.posexplode(
        F.filter(first, lambda c: -c["below"] >= F.col("least"))).alias("at", "c"))
    return chosen.select(F.col("anchor").alias("anchor_id"), "positive_id", (F.col("at") + 1).cast("int").alias("rank"),
                         F.col("c.negative_id").alias("negative_id"), "positive_score", (-F.col("c.below")).alias("negative_score"))
