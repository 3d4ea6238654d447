"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with boundary marks) and itself; a
text is the average of the embeddings of all n-grams of all its words; a softmax
over two classes sits on that average. Embeddings and softmax are learnt
together, so a misspelling never seen shares most of its n-grams, and so its
score, with the words it comes from.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.llm.common import beside, put


@dataclass(frozen=True)
class Settings:
    """Everything that decides a model; a model is the same for the same rows and settings."""

    buckets: int = 1 << 17
    dim: int = 8
    shortest: int = 3
    longest: int = 5
    epochs: int = 6
    rate: float = 0.5
    batch: int = 32
    #: at most this many labelled texts are fitted, the smallest by hash of their id, equal rows once
    sample: int = 5000
    #: and at most so many distinct n-grams, counted text by text in that order: what the driver holds, 8 bytes each
    grams: int = 30_000_000
    seed: int = 11


def subwords(word: str, s: Settings) -> list[int]:
    """Bucket ids of a word: the marked word itself and its character n-grams."""
    marked = f"<{word}>".encode()
    ids = [zlib.crc32(marked) % s.buckets]
    text = f"<{word}>"
    for n in range(s.shortest, s.longest + 1):
        for i in range(len(text) - n + 1):
            ids.append(zlib.crc32(text[i:i + n].encode(), n) % s.buckets)
    return ids


#: A longer run without a space is cut into pieces of this many characters, all of them used.
PIECE = 40


def tokens(text: str | None) -> Counter:
    """Words of the whole text, lowered, without the punctuation around them, with their counts."""
    found: Counter = Counter()
    for word, times in Counter((text or "").lower().split()).items():
        word = word.strip(".,;:!?\"'()[]{}<>*%$&#|-_")
        for i in range(0, len(word), PIECE):
            found[word[i:i + PIECE]] += times
    return found


def bag(text: str | None, s: Settings, cache: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct bucket ids of a text and their shares; the shares add up to one."""
    counts: Counter = Counter()
    for word, times in tokens(text).items():
        ids = cache.get(word)
        if ids is None:
            ids = cache[word] = subwords(word, s)
        for i in ids:
            counts[i] += times
    if len(cache) > 200_000:
        cache.clear()
    if not counts:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    total = sum(counts.values())
    ids = np.fromiter(counts.keys(), np.int32, len(counts))
    share = np.fromiter(counts.values(), np.float32, len(counts)) / total
    order = np.argsort(ids)
    return ids[order], share[order]


def training_bags(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, s: Settings) -> DataFrame:
    """``(order, a, b, label, ids, shares)`` of the fitted sample; texts become bags on the executors.

    Bags are whole: every n-gram of a fitted text counts, and their distinct
    ids are at most ``buckets``. Rows equal in id and text are one text; an id with
    several texts has one bag for each, and all together are at most ``sample``.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(doc_id).isNotNull()).groupBy(doc_id).agg(
        F.max(label).cast("int").alias("_label"))
    chosen = known.orderBy(F.xxhash64(F.col(doc_id).cast("string"), F.lit(s.seed)), doc_id).limit(s.sample)
    # at most ``sample`` rows of two numbers: small enough to broadcast by the bound
    texts = docs.select(F.col(doc_id), F.col(text).alias("_text")).join(F.broadcast(chosen), doc_id).withColumns(
        {"_a": F.xxhash64("_text"), "_b": F.xxhash64(F.lit(1), "_text")})
    keys = [doc_id, "_a", "_b"]
    # an id may be carried by many rows: the bound is applied again to distinct texts
    bounded = texts.select(*keys).distinct().orderBy(F.xxhash64(F.col(doc_id).cast("string"), F.lit(s.seed)), *keys).limit(s.sample)
    texts = texts.join(F.broadcast(bounded), keys).dropDuplicates(keys)

    def run(batches):
        cache: dict = {}
        for batch in batches:
            found = [bag(t.as_py(), s, cache) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays([
                batch.column(doc_id).cast(pa.string()), batch.column("_a"), batch.column("_b"), batch.column("_label"),
                pa.array([i for i, _ in found], pa.list_(pa.int32())), pa.array([v for _, v in found], pa.list_(pa.float32()))],
                ["order", "a", "b", "label", "ids", "shares"])

    return texts.mapInArrow(run, "order string, a bigint, b bigint, label int, ids array<int>, shares array<float>")


@dataclass
class Model:
    embeddings: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray
    settings: Settings

    def pulls(self) -> np.ndarray:
        """How far one n-gram pulls a text's logit towards toxic: the softmax is linear, so averages commute with it."""
        return self.embeddings.astype(np.float64) @ (self.softmax[1] - self.softmax[0]).astype(np.float64)


def fit(bags: list[tuple[int, np.ndarray, np.ndarray]], s: Settings) -> Model:
    """Stochastic gradient steps with per-parameter rates on embeddings and softmax together."""
    rng = np.random.default_rng(s.seed)
    emb = rng.uniform(-1.0 / s.dim, 1.0 / s.dim, (s.buckets, s.dim)).astype(np.float32)
    soft = rng.normal(0.0, 0.3, (2, s.dim)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen_e = np.full((s.buckets, 1), 1e-8, np.float32)
    seen_s, seen_b = np.full_like(soft, 1e-8), np.full_like(bias, 1e-8)
    # averaging shrinks every gradient by the length of a text: shares are scaled up to a common size
    scale = np.float32(50.0)
    bags = [b for b in bags if len(b[1])]
    for epoch in range(s.epochs if bags else 0):
        rate = s.rate * (1.0 - epoch / s.epochs)
        order = rng.permutation(len(bags))
        for at in range(0, len(order), s.batch):
            part = [bags[i] for i in order[at:at + s.batch]]
            lengths = [len(b[1]) for b in part]
            ids = np.concatenate([b[1] for b in part])
            share = np.concatenate([b[2] for b in part])[:, None] * scale
            y = np.array([b[0] for b in part])
            edges = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            mean = np.add.reduceat(emb[ids] * share, edges, axis=0)
            logit = mean @ soft.T + bias
            logit -= logit.max(axis=1, keepdims=True)
            p = np.exp(logit)
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1.0
            p /= len(y)
            g_soft, g_bias, g_mean = p.T @ mean, p.sum(axis=0), p @ soft
            g_emb = np.repeat(g_mean, lengths, axis=0) * share
            unique, where = np.unique(ids, return_inverse=True)
            g = np.zeros((len(unique), s.dim), np.float32)
            for d in range(s.dim):
                g[:, d] = np.bincount(where, g_emb[:, d], len(unique))
            seen_e[unique] += (g * g).mean(axis=1, keepdims=True)
            emb[unique] -= rate * g / np.sqrt(seen_e[unique])
            seen_s += g_soft ** 2
            soft -= rate * 0.2 * g_soft / np.sqrt(seen_s)
            seen_b += g_bias ** 2
            bias -= rate * 0.2 * g_bias / np.sqrt(seen_b)
    emb[seen_e[:, 0] <= 1e-8] = 0.0          # what was never seen pulls nowhere
    return Model(emb * scale, soft, bias, s)


def within(bags: DataFrame, s: Settings) -> DataFrame:
    """The bags, in the order of their hashes, as long as their distinct n-grams add up to at most ``s.grams``.

    This bounds what the driver holds, 8 bytes for each. Bags are made once, as a table; only their sizes, at most
    ``s.sample`` rows, are summed in one task. Bags are taken whole, and the first in any case.
    """
    placed = F.struct(F.xxhash64("order", F.lit(s.seed)).alias("h"), "order", "a", "b")
    made = put(bags, "training-bags").withColumn("_place", placed)
    running = made.select("_place", F.sum(F.size("ids").cast("long")).over(Window.orderBy("_place")).alias("n"), F.row_number().over(Window.orderBy("_place")).alias("i"))
    last = running.where((F.col("n") <= s.grams) | (F.col("i") == 1)).agg(F.max("_place").alias("last")).first().last
    if last is not None:
        made = made.where(F.col("_place") <= F.struct(*[F.lit(v) for v in last]))
    return made.select(*bags.columns)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          settings: Settings = Settings()) -> Model:
    """Fit a model on at most ``settings.sample`` labelled texts, chosen by hash, with at most ``settings.grams`` distinct n-grams counted text by text.

    Rows with a null id or a label other than 0 and 1 teach nothing; an id with
    several labels counts as toxic if one of them says so; no rows at all give
    the model that answers 0.5 everywhere.
    """
    got = within(training_bags(docs, labels, doc_id, text, label, settings), settings).toArrow()
    rows = []
    for order, y, ids, shares in zip(got.column("order").to_pylist(), got.column("label").to_pylist(),
                                     got.column("ids"), got.column("shares")):
        rows.append((order, y, ids.values.to_numpy(zero_copy_only=False), shares.values.to_numpy(zero_copy_only=False)))
    rows.sort(key=lambda r: (r[0], r[1], len(r[2])))
    return fit([(y, i, v) for _, y, i, v in rows], settings)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score", columns: list[str] | None = None) -> DataFrame:
    """Every row with a double ``name`` in [0, 1]: the softmax's share of the toxic class over the whole text.

    A null or empty text, or one of punctuation only, has an empty bag and gets
    the share that the bias alone gives. Rows, repeated or not, are scored one by
    one. ``columns`` names those to return beside the score, all by default: texts
    that nobody reads stay behind. They stay as they are; one with the score's own name
    is returned with the prefix ``input_``. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    # settings.buckets doubles: a bound that does not depend on the data
    told = spark.sparkContext.broadcast((model.pulls(), float(model.bias[1]) - float(model.bias[0])))
    s, schema = model.settings, docs.schema
    kept = docs.columns if columns is None else columns
    names = dict(beside(docs, name))
    told_columns = [*[names[c] for c in kept], name]

    def run(batches):
        pull, bias = told.value
        cache: dict = {}
        for batch in batches:
            out = []
            for t in batch.column(text):
                total, n = 0.0, 0
                for word, times in tokens(t.as_py()).items():
                    known = cache.get(word)
                    if known is None:
                        ids = subwords(word, s)
                        known = cache[word] = (float(pull[ids].sum()), len(ids))
                    total += known[0] * times
                    n += known[1] * times
                if len(cache) > 300_000:
                    cache.clear()
                logit = bias + (total / n if n else 0.0)
                out.append(1.0 / (1.0 + float(np.exp(-np.clip(logit, -500, 500)))))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(out, pa.float64())], told_columns)

    return docs.mapInArrow(run, T.StructType([*[T.StructField(names[c], schema[c].dataType) for c in kept], T.StructField(name, T.DoubleType())]))
