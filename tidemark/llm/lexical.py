"""Ranked lexical search over bit-sliced Bloom signatures.

The index holds documents in blocks of similar size. A document's signature says
which terms it may hold, and how often (a level per count of ``LEVELS``); a block stores its signatures by bit, so the documents that may hold a
term are an AND of a few rows. For every item, the rows' weights summed over terms
and counts give each document a score it cannot exceed. Documents whose bound
reaches the k-th best score known are scored exactly from their texts; all others
are provably not among the first k.

Score of a document with n terms: the sum over the item's terms it holds of
``w * ((10^9 * tf) div (1000 * tf + 8 * m))`` with ``m = 10 + (90 * n * N) div L``
and ``w = floor(1000 * ln((2 N + 2) / (2 df + 1)))``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.llm.common import put
from tidemark.llm.terms import Terms, Vocabulary, hashes, mixed, pieces, portions, runs, terms, words

#: Counts that have an entry of their own in a signature, bits per entry, rows that a term sets.
LEVELS, BITS, PROBES = (1, 2, 3, 4, 6, 8, *(1 << b for b in range(4, 16))), 10, 4
#: An item's known score comes from so many times k documents, those of highest bound.
SEEDS = 4
#: Documents and entries of a block; bits of the widest signature. A wider document has none: it is always scored.
BLOCK_DOCS, BLOCK_ENTRIES, WIDEST = 4096, 1 << 20, 1 << 22
#: Bytes of items searched for at once; (document, item) pairs that are sent to all tasks at most.
PORTION, PAIRS = 1 << 20, 1 << 20


def _probes(h: np.ndarray, level: int, width: int) -> np.ndarray:
    """Bits of a signature of ``width`` that a term sets for a level, one row per term."""
    h = mixed(h + np.uint64(level * 0x632BE59BD9B4E019 % (1 << 64)))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) & np.uint64(width - 1)).astype(np.int64)


def _entries(t: Terms, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, hash and count of the distinct terms of every text. Terms that share 48 bits count together: never too few."""
    text = runs(t).astype(np.uint64)
    short = hashed >> np.uint64(16)
    out = []
    for at in range(0, len(t.first) - 1, 1 << 16):
        a, b = t.first[at], t.first[min(at + (1 << 16), len(t.first) - 1)]
        key = np.sort(((text[a:b] - np.uint64(at)) << np.uint64(48)) | short[a:b])
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
        out.append(((key[begin] >> np.uint64(48)).astype(np.int64) + at, key[begin] & np.uint64((1 << 48) - 1),
                    np.diff(np.concatenate([begin, [len(key)]]))))
    return tuple(np.concatenate([o[i] for o in out]) for i in range(3)) if out else (np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64))


def _widths(entries: np.ndarray) -> np.ndarray:
    """A power of two of at least BITS bits per entry; 0 beyond the widest."""
    width = 1 << np.ceil(np.log2(np.maximum(entries * BITS, 64))).astype(np.int64)
    return np.where(width > WIDEST, 0, width)


class _Blocks:
    """Collects the signatures of a task's documents by width and gives them out block by block."""

    def __init__(self):
        self.open: dict[int, list] = {}

    def add(self, ids: pa.Array, n: np.ndarray, t: Terms, hashed: np.ndarray) -> Iterator[tuple]:
        text, h, count = _entries(t, hashed)
        size = np.zeros(len(n), np.int64)
        for level in LEVELS:
            size += np.bincount(text[count >= level], minlength=len(n))
        widths = _widths(size)
        for width in np.unique(widths[n > 0]).tolist():
            docs = np.flatnonzero((widths == width) & (n > 0))
            place = np.full(len(n), -1, np.int64)
            place[docs] = np.arange(len(docs))
            own = place[text] >= 0
            part = (ids.take(pa.array(docs)), n[docs], place[text[own]], h[own], count[own])
            self.open.setdefault(width, []).append(part)
            if sum(len(p[1]) for p in self.open[width]) >= BLOCK_DOCS or sum(len(p[2]) for p in self.open[width]) >= BLOCK_ENTRIES:
                yield self._closed(width)

    def rest(self) -> Iterator[tuple]:
        for width in list(self.open):
            yield self._closed(width)

    def _closed(self, width: int) -> tuple:
        parts = self.open.pop(width)
        ids, n = pa.concat_arrays([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        if not width:
            return ids, n, 0, b""
        shift = np.cumsum([0] + [len(p[1]) for p in parts[:-1]])
        doc = np.concatenate([p[2] + s for p, s in zip(parts, shift)])
        h, count = np.concatenate([p[3] for p in parts]), np.concatenate([p[4] for p in parts])
        slices = np.zeros((width, -(-len(n) // 8)), np.uint8)
        step = max(8, (1 << 24) // width // 8 * 8)      # documents whose bits are spread out at a time
        order = np.argsort(doc, kind="stable")
        doc, h, count = doc[order], h[order], count[order]
        for at in range(0, len(n), step):
            a, b = np.searchsorted(doc, [at, at + step])
            bits = np.zeros((width, min(step, len(n) - at)), np.bool_)
            for level in LEVELS:
                often = np.flatnonzero(count[a:b] >= level) + a
                bits[_probes(h[often], level, width), (doc[often] - at)[:, None]] = True
            packed = np.packbits(bits, axis=1)
            slices[:, at // 8:at // 8 + packed.shape[1]] = packed
        return ids, n, width, slices.tobytes()


def indexed(docs: DataFrame, vocabulary: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index of all documents, and what the scores need to know of the corpus, as one written table.

    Rows with ``slices`` are blocks: ``ids``, ``n`` (terms of each document),
    ``width`` (bits of a signature; 0: none) and the block's bits, row by row.
    Rows without hold, of a piece of documents, how many have a term, how many
    terms they have, and in how many each word of the vocabulary occurs. Every
    document with a term is in one block.
    """
    told = docs.sparkSession.sparkContext.broadcast(Vocabulary(vocabulary))
    kind = docs.schema[doc_id].dataType
    schema = T.StructType([T.StructField("ids", T.ArrayType(kind)), T.StructField("n", T.ArrayType(T.LongType())), T.StructField("width", T.LongType()),
                           T.StructField("slices", T.BinaryType()), T.StructField("docs", T.LongType()), T.StructField("total", T.LongType()),
                           T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("holding", T.ArrayType(T.LongType()))])

    def run(batches):
        blocks, known = _Blocks(), told.value
        held, n_docs, total, ids_type = np.zeros(known.size, np.int64), 0, 0, None

        def block(ids, n, width, slices):
            return pa.RecordBatch.from_arrays([
                pa.ListArray.from_arrays([0, len(ids)], ids), pa.ListArray.from_arrays([0, len(n)], pa.array(n, pa.int64())),
                pa.array([width], pa.int64()), pa.array([slices], pa.binary()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()),
                pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int64()))], schema.fieldNames())

        for batch in batches:
            ids_type = batch.column("id").type
            for piece in pieces(batch, "text"):
                t = terms(piece.column("text"))
                hashed, n = hashes(t), np.diff(t.first)
                # a word is held once by a document, however often it occurs
                number, text_of = known.numbers(t, hashed), runs(t)
                some = number >= 0
                pairs = np.unique(text_of[some] * max(known.size, 1) + number[some])
                held += np.bincount(pairs % max(known.size, 1), minlength=known.size)[:known.size]
                n_docs, total = n_docs + int((n > 0).sum()), total + int(n.sum())
                for found in blocks.add(piece.column("id"), n, t, hashed):
                    yield block(*found)
        for found in blocks.rest():
            yield block(*found)
        if ids_type is not None:
            at = np.flatnonzero(held)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(1, pa.list_(ids_type)), pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                pa.array([n_docs], pa.int64()), pa.array([total], pa.int64()), pa.ListArray.from_arrays([0, len(at)], pa.array(at, pa.int32())),
                pa.ListArray.from_arrays([0, len(at)], pa.array(held[at], pa.int64()))], schema.fieldNames())

    flat = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    return put(flat.mapInArrow(run, schema), "lexical-index")


class Query:
    """A bounded portion of the items, with the weights of their terms."""

    def __init__(self, vocabulary: list[str], items: list[list[int]], n_docs: int, total: int, holding: dict[int, int]):
        self.vocabulary = Vocabulary(vocabulary)
        self.items = [np.array(i, np.int64) for i in items]
        self.n_docs, self.total = n_docs, total
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding.get(v, 0) + 1)))
                                for v in range(len(vocabulary))], np.int64)

    def lengths(self, n: np.ndarray) -> np.ndarray:
        """m of documents with n terms; whole numbers of any size in between."""
        return np.array([10 + (90 * int(v) * self.n_docs) // self.total for v in n], np.int64)

    def gain(self, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)

    def bounds(self, n: np.ndarray, width: int, slices: bytes) -> Iterator[tuple[int, np.ndarray]]:
        """For every item, the score that each document of a block cannot exceed."""
        m = self.lengths(n)
        # the highest count that a document of each level may have: up to the next level, at last all its terms
        most = [np.minimum(n, nxt - 1) for nxt in LEVELS[1:]] + [n]
        gains = [self.gain(c, m).astype(np.float64) for c in most]
        steps = np.diff(np.stack([np.zeros(len(n)), *gains]), axis=0)
        if not width:
            for i, used in enumerate(self.items):
                yield i, self.weight[used].sum() * gains[-1]
            return
        rows = np.frombuffer(slices, np.uint8).reshape(width, -1)
        short = self.vocabulary.hash >> np.uint64(16)
        present, before = [], None
        for level in LEVELS:
            if level > n.max():
                break
            at = _probes(short, level, width)
            here = rows[at[:, 0]]
            for j in range(1, PROBES):
                here = here & rows[at[:, j]]
            before = here if before is None else before & here
            present.append(before)
        weight = self.weight.astype(np.float64)
        for i, used in enumerate(self.items):
            bound = np.zeros(len(n))
            for step, bits in zip(steps, present):
                held = used[bits[used].any(axis=1)]
                if not len(held):
                    break       # a count includes the smaller ones
                for at in range(0, len(held), 2048):
                    few = held[at:at + 2048]
                    bound += step * (weight[few] @ np.unpackbits(bits[few], axis=1, count=len(n)))
            yield i, bound

    def scores(self, texts: pa.Array, asked: list[list[int]]) -> Iterator[tuple[int, int, int]]:
        """``(text, item, score)`` of the asked items, exactly, from the texts."""
        t = terms(texts)
        number, text_of, n = self.vocabulary.numbers(t, hashes(t)), runs(t), np.diff(t.first)
        some = number >= 0
        key, count = np.unique(text_of[some] * max(len(self.weight), 1) + number[some], return_counts=True)
        cut = np.searchsorted(key, np.arange(len(n) + 1) * max(len(self.weight), 1))
        tf = np.zeros(len(self.weight), np.int64)
        m = self.lengths(n)
        for text, items in enumerate(asked):
            mine = slice(cut[text], cut[text + 1])
            at = key[mine] - text * max(len(self.weight), 1)
            tf[at] = count[mine]
            for item in items:
                used = self.items[item]
                yield text, item, int((self.weight[used] * self.gain(tf[used], m[text])).sum())
            tf[at] = 0


def search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", portion: int = PORTION, pairs: int = PAIRS) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's ``k`` documents of highest score above 0, ties by ascending id.

    Terms are runs of digits, letters and characters beyond ASCII, lowered from A
    to Z; a null or empty text has none. Rows of one item id are one item that asks
    for the terms of them all; items without terms have no rows. Every row of the
    documents is a document of its own, also one that repeats another or another's
    id; documents without an id come last among ties. Texts are read whole. Empty
    tables give no rows; other columns, whatever their names, are not read.

    The documents are read three times and never shuffled: for the index, for the
    scores of each item's ``SEEDS * k`` documents of highest bound, whose k-th best exact
    score is then known to be reached, and for the scores of every document whose
    bound reaches that. The documents to score are sent to all tasks if they are at
    most ``pairs`` pairs with an item, else joined by a shuffle. Items beyond
    ``portion`` bytes of terms are searched for portion by portion.
    """
    names = {"item_id": items.schema[item_id].dataType, "doc_id": docs.schema[doc_id].dataType}
    asked = items.select(F.col(f"`{item_id}`").alias("item_id"), F.explode(words(F.col(f"`{item_text}`"))).alias("term")).distinct()
    asked = put(asked.groupBy("item_id").agg(F.sort_array(F.collect_list("term")).alias("terms"))
                .withColumn("key", F.coalesce(F.col("item_id").cast("string"), F.lit(""))), "items")
    size = F.aggregate("terms", F.lit(16).cast("long"), lambda a, t: a + F.octet_length(t) + 24)
    flat = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"))
    found = []
    for rows, last in portions(asked, size, ["key"], portion):
        ranked = _searched(flat, rows, k, names, pairs)
        found.append(ranked if last and not found else put(ranked, "ranked"))
    result = found[0]
    for other in found[1:]:
        result = result.unionByName(other)
    return result


def _searched(flat: DataFrame, rows: pa.Table, k: int, names: dict, pairs: int) -> DataFrame:
    spark = flat.sparkSession
    listed = rows.column("terms").to_pylist()
    vocabulary = sorted({t for ts in listed for t in ts})
    place = {t: i for i, t in enumerate(vocabulary)}
    index = indexed(flat, vocabulary, "id", "text")
    blocks, sums = index.where("slices is not null").select("ids", "n", "width", "slices"), index.where("slices is null")
    corpus = sums.agg(F.sum("docs").alias("n"), F.sum("total").alias("l")).first()
    # one number per word of the portion
    holding = dict(sums.select(F.explode(F.arrays_zip("terms", "holding")).alias("z")).groupBy("z.terms").agg(
        F.sum("z.holding")).toArrow().to_pandas().itertuples(index=False, name=None))
    query = spark.sparkContext.broadcast(Query(vocabulary, [[place[t] for t in ts] for ts in listed], corpus.n or 0, corpus.l or 1, holding))
    kind = names["doc_id"]
    pair = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("id", kind), T.StructField("bound", T.DoubleType())])

    few = SEEDS * k

    def candidates(reached: np.ndarray | None):
        """Pairs whose bound reaches the item's known score, or, with none known, a task's few pairs of highest bound per item."""
        def run(batches):
            best: dict[int, tuple] = {}
            for batch in batches:
                for r in range(batch.num_rows):
                    ids, n = batch.column("ids")[r].values, batch.column("n")[r].values.to_numpy()
                    out = []
                    for item, bound in query.value.bounds(n, batch.column("width")[r].as_py(), batch.column("slices")[r].as_py()):
                        if reached is not None:
                            at = np.flatnonzero(bound >= max(reached[item], 1))
                            if len(at):
                                out.append((item, at, bound[at]))
                            continue
                        at = np.flatnonzero(bound > 0)
                        if len(at) > few:
                            at = at[np.argpartition(bound[at], -few)[-few:]]
                        if len(at):
                            had = best.get(item)
                            bound, mine = bound[at], ids.take(pa.array(at))
                            if had:
                                bound, mine = np.concatenate([had[0], bound]), pa.concat_arrays([had[1], mine])
                            top = np.argsort(-bound, kind="stable")[:few]
                            best[item] = bound[top], mine.take(pa.array(top))
                    if out:
                        yield _pairs([(i, ids.take(pa.array(at)), b) for i, at, b in out])
            if best:
                yield _pairs([(i, ids, b) for i, (b, ids) in best.items()])
        return blocks.mapInArrow(run, pair)

    first = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), F.col("id").asc_nulls_last()))
    seeds = candidates(None).withColumn("at", first).where(F.col("at") <= few).drop("at")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.col("id").asc_nulls_last()))
    at_kth = _scored(flat, seeds, query, pairs).withColumn("rank", rank).where(F.col("rank") == k)
    reached = np.zeros(len(listed), np.int64)
    for item, score in at_kth.select("item", "score").collect():     # a number per item of the portion
        reached[item] = score
    # the same documents reach their own bounds, so none of the first k is left out
    exact = _scored(flat, candidates(reached), query, pairs)
    named = spark.createDataFrame(pa.table({"item": pa.array(range(len(listed)), pa.int32()), "item_id": rows.column("item_id")}),
                                  T.StructType([T.StructField("item", T.IntegerType()), T.StructField("item_id", names["item_id"])]))
    top = exact.withColumn("rank", rank).where(F.col("rank") <= k)
    # the portion of items is bounded by the caller
    return top.join(F.broadcast(named), "item").select("item_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("doc_id"), "score")


def _pairs(parts: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([np.full(len(b), i, np.int32) for i, _, b in parts])), pa.concat_arrays([ids for _, ids, _ in parts]),
        pa.array(np.concatenate([b for _, _, b in parts]))], ["item", "id", "bound"])


def _scored(flat: DataFrame, chosen: DataFrame, query, pairs: int) -> DataFrame:
    """``(item, id, score)`` of chosen pairs with a score above 0; an id's items meet each of its documents."""
    distinct = put(chosen.select("item", "id").distinct(), "pairs")
    # at most one entry per item of the portion
    asked = distinct.groupBy("id").agg(F.collect_list("item").alias("items")).withColumnRenamed("id", "of")
    if distinct.count() <= pairs:
        asked = F.broadcast(asked)
    joined = flat.join(asked, F.col("id").eqNullSafe(F.col("of"))).select("id", "text", "items")
    schema = T.StructType([T.StructField("item", T.IntegerType()), flat.schema["id"], T.StructField("score", T.LongType())])

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                got = [g for g in query.value.scores(piece.column("text"), piece.column("items").to_pylist()) if g[2] > 0]
                text, item, score = (np.array(c, np.int64) for c in zip(*got)) if got else [np.empty(0, np.int64)] * 3
                yield pa.RecordBatch.from_arrays([pa.array(item.astype(np.int32)), piece.column("id").take(pa.array(text)), pa.array(score)],
                                                 ["item", "id", "score"])

    return joined.mapInArrow(run, schema)
