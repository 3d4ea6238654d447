"""Near-duplicate embeddings by Euclidean p-stable hashing, with exact cosine checks.

Vectors are normalised. A table's key is the tuple of k quantised Gaussian
projections, floor((a . x + b) / w): on the unit sphere the Euclidean distance is
a function of the cosine, and near vectors share a key with a probability that
falls with their distance. L tables make up for each other's misses.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import bucket_blocks, packed, per_group, put, roots
from tidemark.llm.components import components

#: Two vectors at cosine 0.93 share a key of 16 projections of width 2 with probability 0.076,
#: unrelated ones with 0.00001; 64 tables find the former with probability 0.993 and those at
#: cosine 0.98 all but surely.
TABLES, PROJECTIONS, WIDTH = 64, 16, 2.0


def _draws(dim: int, tables: int, projections: int, seed: int):
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, tables * projections)), rng.uniform(0.0, 1.0, tables * projections)


def keys(x: np.ndarray, tables: int, projections: int, width: float, seed: int) -> np.ndarray:
    """One 64-bit key per table of every normalised row of ``x``."""
    a, b = _draws(x.shape[1], tables, projections, seed)
    cells = np.floor(x @ a / width + b).astype(np.int64).reshape(len(x), tables, projections)
    mixed = np.zeros((len(x), tables), np.uint64)
    for j in range(projections):
        mixed = (mixed ^ cells[:, :, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed.view(np.int64)


def linked(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", least: float = 0.93,
           tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH, seed: int = 5, block: int = 512) -> DataFrame:
    """Every row as ``row`` with ``n_links``, ``component_id`` and ``kept``.

    Links join rows of equal, known labels whose vectors have a cosine, in double
    precision, of ``least`` or more. ``n_links`` counts the other rows linked
    directly, ``component_id`` is the smallest id reachable, ``kept`` says that
    this is the row's own id.

    A vector that is null, empty, all zero, or holds a null or non-finite number
    links with nothing, nor does one with a null label, nor vectors of different
    length. Every row is a vector of its own, also one that repeats another. An
    empty table gives an empty one; other columns travel inside ``row``.

    Equal vectors are one node with a count. Buckets are cut into blocks (see
    ``bucket_blocks``); a pair is counted in the first table in which it meets,
    checked exactly, and a block emits sums and a spanning forest: at most one
    row per vector, never the pairs, also in a group of very many near copies.
    """
    flat = packed(vectors).select("row", F.col("row").getField(vec_id).cast("long").alias("id"),
                                  F.col("row").getField(label).alias("label"), F.col("row").getField(embedding).alias("x"))
    x = F.transform("x", lambda v: v.cast("double"))
    sound = (F.col("label").isNotNull() & F.col("x").isNotNull()
             & F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))
             & F.coalesce(F.exists(x, lambda v: v != 0), F.lit(False)))
    rows = flat.withColumn("x", F.when(sound, x))
    nodes = put(rows.where("x is not null").groupBy("label", "x").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("times")).select(
        "label", "x", "least", "times", F.size("x").alias("dim"), F.xxhash64("label", "x").alias("node")), "vectors")

    def hashed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = batch.column("dim").to_numpy()
            out = np.empty((len(dims), tables), np.int64)
            lists = batch.column("x")
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                out[at] = keys(_unit(np.stack([lists[int(i)].values.to_numpy() for i in at])), tables, projections, width, seed)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(
                np.arange(0, out.size + 1, tables, dtype=np.int32), pa.array(out.ravel()))], [*batch.schema.names, "keys"])

    with_keys = put(nodes.mapInArrow(hashed, T.StructType([*nodes.schema.fields, T.StructField("keys", T.ArrayType(T.LongType()))])), "keys")
    at = with_keys.select("node", "label", "dim", F.posexplode("keys").alias("t", "key"))
    dealt = bucket_blocks(at, ["label", "dim", "t", "key"], "node", block)
    # vectors join their places only once these are known to hold more than one node
    placed = dealt.join(with_keys.select("node", "x", "times", "keys"), "node")

    def work(group: pa.Table):
        n = group.num_rows
        node, times, blk = (group.column(c).to_numpy() for c in ("node", "times", "blk"))
        t, bi, bj = (group.column(c)[0].as_py() for c in ("t", "bi", "bj"))
        unit = _unit(_matrix(group.column("x"), n))
        all_keys = _matrix(group.column("keys"), n)
        met = np.zeros((n, n), bool)
        for earlier in range(t):
            met |= all_keys[:, earlier, None] == all_keys[None, :, earlier]
        close = (unit @ unit.T >= least - 1e-9) & ~met
        if bi != bj:
            close &= blk[:, None] != blk[None, :]
        np.fill_diagonal(close, False)
        if not close.any():
            return None
        # the last digits of a matrix product may hang on its shape: pairs at the border are summed alike everywhere
        i, j = np.nonzero(close)
        for s in range(0, len(i), 1 << 15):
            a, b = i[s:s + (1 << 15)], j[s:s + (1 << 15)]
            border = np.einsum("ij,ij->i", unit[a], unit[b]) < least
            close[a[border], b[border]] = False
        close &= close.T
        label = roots(close)
        count = close @ times
        some = np.flatnonzero(count)
        return pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(node[label[some]]), pa.array(count[some].astype(np.int64))],
                                          ["u", "v", "links"])

    found = put(per_group(placed, ["label", "dim", "t", "key", "bi", "bj"], work, "u bigint, v bigint, links bigint"), "links")
    parts = components(found.select("u", "v"))
    sums = found.groupBy("u").agg(F.sum("links").alias("links")).withColumnRenamed("u", "node")
    known = nodes.join(sums, "node", "left").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = known.join(smallest, "component").select(
        F.col("label").alias("_label"), F.col("x").alias("_x"), (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id")
    joined = rows.join(facts, (rows["label"] == facts["_label"]) & (rows["x"] == facts["_x"]), "left")
    own = F.coalesce(F.col("component_id"), F.col("id"))
    return joined.select("row", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"),
                         F.col("id").eqNullSafe(own).alias("kept"))


def _matrix(column, n: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def _unit(x: np.ndarray) -> np.ndarray:
    # by the largest entry first, so that the squares of huge or tiny entries stay finite
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
