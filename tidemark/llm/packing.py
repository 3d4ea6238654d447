"""Conflict-constrained best-fit packing of documents into sequences of a fixed number of words.

Documents are dealt by hash into pools of bounded size, and every pool is packed
on its own, longest first. The open bins of a pool are ordered by residual. Each
carries a bitmap of the sources that have used up their places in it and a bitmap
of the duplicate clusters it holds. The search begins at the smallest residual
that a document fits in and goes on to the successors until a bin's bitmaps admit
it: that is the tightest compatible bin. If there is none a bin is opened.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import n_words, put, sorted_groups


class Bins:
    """Open and full bins of one pool; ``place`` puts an item in and says where."""

    def __init__(self, capacity: int, per_source: int):
        self.capacity, self.per_source = capacity, per_source
        self.order: list[tuple[int, int]] = []      # (residual, bin), ascending
        self.full_sources: list[int] = []           # bitmap per bin
        self.clusters: list[int] = []
        self.held: list[dict[int, int]] = []        # source -> documents, per bin

    def place(self, size: int, source: int, cluster: int) -> int:
        s, c = 1 << source, 1 << cluster
        at = bisect_left(self.order, (size, -1))
        while at < len(self.order):
            residual, number = self.order[at]
            if not (self.full_sources[number] & s or self.clusters[number] & c):
                self.order.pop(at)
                break
            at += 1
        else:
            number, residual = len(self.held), self.capacity
            self.full_sources.append(0)
            self.clusters.append(0)
            self.held.append({})
        held = self.held[number]
        held[source] = held.get(source, 0) + 1
        if held[source] >= self.per_source:
            self.full_sources[number] |= s
        self.clusters[number] |= c
        if residual > size:
            insort(self.order, (residual - size, number))
        return number


def items_of(docs: DataFrame, doc_id: str, source: str, text: str) -> DataFrame:
    """Size, source, duplicate cluster and draw of every row that has a word."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(body).alias("n_words"),
        F.xxhash64(F.lower(body)).alias("cluster"), F.xxhash64(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), body).alias("draw"))
    return put(rows.where("n_words > 0"), "items")


def pack(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text",
         capacity: int = 2048, per_source: int = 4, pool_rows: int = 4096) -> DataFrame:
    """One row per bin: pool, bin, doc_ids, starts and lengths (word spans), n_words, n_docs, n_sources.

    A bin holds at most ``capacity`` words, at most ``per_source`` documents of a
    source, and never two documents of a duplicate cluster (equal lower-cased
    texts; copies of a row are such). A document longer than a bin is cut: its
    full pieces are bins of their own, its rest is packed like any other item, so
    every word of every document is in exactly one bin.

    Documents without a word (null, empty, blank) fill nothing and are in no bin.
    A null source is a source like any other; a null id stays null in the lists.
    Equal sizes are ordered by hash, then id, so reruns agree. An empty table
    gives no bins. Other columns are not read.

    A pool holds about ``pool_rows`` documents whatever the input, dealt by a hash
    of id and text, with a running number where equal rows repeat, so neither a
    hot source nor a hot cluster meets in one task; only sizes and hashes are
    shuffled, never texts.
    """
    items = items_of(docs, doc_id, source, text)
    count = items.count()
    pools = max(1, -(-count // pool_rows))
    # rows equal in id and text get a running number, so that many of them are dealt over many pools
    salted = items.groupBy("doc_id", "source", "n_words", "cluster", "draw").agg(F.count(F.lit(1)).alias("times")).select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)).alias("copy"))
    dealt = salted.withColumn("pool", F.pmod(F.xxhash64("draw", "copy"), F.lit(pools)).cast("int")).select(
        "pool", F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")).alias("source"), "n_words", "cluster",
        (F.col("n_words") % capacity).alias("rest"), "draw", "copy")
    order = ["pool", F.desc("rest"), "draw", F.col("doc_id").asc_nulls_last(), "copy"]
    parts = dealt.repartition("pool").sortWithinPartitions(*order)

    def run(batches):
        for group in sorted_groups(batches, ["pool"]):
            yield _pack_pool(group, capacity, per_source)

    return parts.mapInArrow(run, "pool int, bin int, doc_ids array<bigint>, starts array<bigint>, lengths array<bigint>, "
                                 "n_words bigint, n_docs int, n_sources int")


def _pack_pool(group: pa.Table, capacity: int, per_source: int) -> pa.RecordBatch:
    pool = group.column("pool")[0].as_py()
    ids, names, sizes, marks = (group.column(c).to_pylist() for c in ("doc_id", "source", "n_words", "cluster"))
    source_bit = {n: i for i, n in enumerate(dict.fromkeys(names))}
    cluster_bit = {c: i for i, c in enumerate(dict.fromkeys(marks))}
    open_bins = Bins(capacity, per_source)
    held: list[list[tuple]] = []
    whole: list[list[tuple]] = []
    for doc, name, size, mark in zip(ids, names, sizes, marks):
        full = size // capacity
        whole += [[(doc, k * capacity, capacity, name)] for k in range(full)]
        rest = size - full * capacity
        if rest:
            number = open_bins.place(rest, source_bit[name], cluster_bit[mark])
            if number == len(held):
                held.append([])
            held[number].append((doc, full * capacity, rest, name))
    bins = held + whole
    return pa.RecordBatch.from_arrays([
        pa.array([pool] * len(bins), pa.int32()), pa.array(range(len(bins)), pa.int32()),
        pa.array([[x[0] for x in b] for b in bins], pa.list_(pa.int64())), pa.array([[x[1] for x in b] for b in bins], pa.list_(pa.int64())),
        pa.array([[x[2] for x in b] for b in bins], pa.list_(pa.int64())), pa.array([sum(x[2] for x in b) for b in bins], pa.int64()),
        pa.array([len(b) for b in bins], pa.int32()), pa.array([len({x[3] for x in b}) for b in bins], pa.int32())],
        ["pool", "bin", "doc_ids", "starts", "lengths", "n_words", "n_docs", "n_sources"])
