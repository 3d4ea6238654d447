"""SimHash near-duplicates: pigeonring filtering over cyclic segments of the fingerprint."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import bucket_blocks, packed, per_group, put, roots
from tidemark.llm.components import components

BITS = 64
#: Shingles hashed and counted at once: bounds the memory of a very long text.
CHUNK = 1 << 15


def fingerprint(text: bytes | None, shingle: int) -> int:
    """64 bits of a text's UTF-8 bytes; zero for null and for a text without a word.

    A-Z are lowered, words are split at the ASCII spaces (``bytes.lower`` and
    ``bytes.split`` do just that), and a bit is set if over half of the shingles'
    hashes have it. A text of fewer words than a shingle is one shingle.
    """
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    width = min(shingle, len(tokens))
    total = len(tokens) - width + 1
    digest, join = xxhash.xxh64_intdigest, b" ".join
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, total, CHUNK):
        hashes = np.array([digest(join(tokens[i:i + width]), 42) for i in range(start, min(start + CHUNK, total))], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = 3) -> DataFrame:
    """The rows with a long column ``fp`` beside ``row``; ``row`` has every column but the text."""
    kept = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias("row"),
        F.col(text).cast("binary").alias("body"))

    def run(batches):
        for batch in batches:
            found = np.array([fingerprint(b.as_py(), shingle) for b in batch.column("body")], dtype="<u8").view("<i8")
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found)], ["row", "fp"])

    schema = kept.schema["row"].dataType.simpleString()
    return kept.mapInArrow(run, f"row {schema}, fp bigint")


def segments(distance: int) -> int:
    """Segments of the ring: with 2d + 1 of them two consecutive ones must be equal."""
    return 2 * distance + 1


def _edges_of_ring(count: int) -> list[tuple[int, int]]:
    cuts = [BITS * i // count for i in range(count + 1)]
    return list(zip(cuts, cuts[1:]))


def _masks(count: int) -> np.ndarray:
    return np.array([((1 << b) - (1 << a)) for a, b in _edges_of_ring(count)], dtype=np.uint64)


def chain_passes(x: np.ndarray, start: int, masks: np.ndarray, distance: int) -> np.ndarray:
    """Which of the XORs keep, from segment ``start`` on, within the budget of every chain length.

    The budget of the first l segments is l * distance / count. The last length
    is the whole ring, that is the full Hamming distance.
    """
    count = len(masks)
    alive = np.arange(x.size)
    spent = np.zeros(x.size, dtype=np.int16)
    flat = x.ravel()
    for length in range(1, count + 1):
        spent = spent + np.bitwise_count(flat[alive] & masks[(start + length - 1) % count])
        fits = spent * count <= length * distance
        alive, spent = alive[fits], spent[fits]
    out = np.zeros(x.size, dtype=bool)
    out[alive] = True
    return out.reshape(x.shape)


def links(distinct: DataFrame, distance: int = 2, block: int = 1024) -> DataFrame:
    """Edges ``(u, v)`` that connect fingerprints ``fp`` (each once) at ``distance`` bits or fewer, as far as reachability goes.

    If two fingerprints differ in at most d bits, some chain of consecutive
    segments of the ring stays within its proportional budget at every length.
    With 2d + 1 segments that chain starts with two equal ones, and these are
    the bucket key. Pairs meet block by block in numpy, are pruned by the longer
    chains and checked in full by the last; a block emits a spanning forest of
    its links, at most one row per fingerprint, never the pairs. Exact: no link
    is lost.
    """
    count = segments(distance)
    ring = _edges_of_ring(count)
    masks = _masks(count)
    equal = next(l for l in range(count, 0, -1) if l * distance < count) if distance else count

    def signed(mask: int) -> int:
        return mask - (1 << 64) if mask >= 1 << 63 else mask

    def key(start):
        mask = sum(((1 << ring[(start + k) % count][1]) - (1 << ring[(start + k) % count][0])) for k in range(equal))
        return F.struct(F.lit(start).alias("start"), F.col("fp").bitwiseAND(F.lit(signed(mask))).alias("key"))

    rows = distinct.select("fp", F.explode(F.array(*[key(s) for s in range(count)])).alias("at")).select("fp", "at.start", "at.key")
    dealt = bucket_blocks(rows, ["start", "key"], "fp", block)

    def work(group: pa.Table):
        fp = group.column("fp").to_numpy().view(np.uint64)
        blk = group.column("blk").to_numpy()
        start, bi, bj = (group.column(c)[0].as_py() for c in ("start", "bi", "bj"))
        near = chain_passes(fp[:, None] ^ fp[None, :], start, masks, distance)
        if bi != bj:
            near &= blk[:, None] != blk[None, :]
        np.fill_diagonal(near, False)
        if not near.any():
            return None
        label = roots(near)
        moved = np.flatnonzero(label != np.arange(len(fp)))
        signed_fp = fp.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed_fp[moved]), pa.array(signed_fp[label[moved]])], ["u", "v"])

    return per_group(dealt, ["start", "key", "bi", "bj"], work, "u bigint, v bigint")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2,
                    groups: bool = False) -> DataFrame:
    """``row`` (all columns but the text), ``fp`` and ``component_id`` for every row of ``docs``.

    ``component_id`` is the smallest id among the rows whose fingerprints are
    linked, directly or through others, at ``distance`` bits or fewer; with
    ``groups`` also ``component``, a key of the group that is never null. Equal
    fingerprints are one node, so copies cost nothing beyond a count.

    Null and empty texts have fingerprint zero and are linked like any other.
    Repeated rows each stay. Rows with a null id are grouped by their text; the
    id of a component without any id is null. An empty table gives an empty one.
    Other columns, whatever their names, travel inside ``row``.
    """
    rows = put(fingerprints(docs, text, shingle), "fingerprints")
    distinct = rows.groupBy("fp").agg(F.min(F.col("row").getField(doc_id)).alias("least"))
    found = components(links(distinct.select("fp"), distance))
    least = (distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("component", F.coalesce("component", "fp")))
    smallest = least.groupBy("component").agg(F.min("least").alias("component_id"))
    # one row per fingerprint against all rows: a hot fingerprint is split by adaptive execution
    return rows.join(least.join(smallest, "component").select("fp", "component", "component_id"), "fp").select(
        "row", "fp", *(["component"] if groups else []), "component_id")


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """The rows of ``docs``, one of each group of near-duplicates: that with the smallest id.

    Null ids come last; under equal ids the row with the smaller hash of the text
    stays, and of rows equal in id and text one. Null and empty texts have fingerprint
    zero and are linked like any other. An empty table gives an empty one; all columns,
    whatever their names, stay as they are. Texts are shuffled once at most, against
    the keys of the rows that go.
    """
    def key(i, t):
        return F.struct(F.coalesce(i.cast("string"), F.lit("\u0000")).alias("i"), F.xxhash64(t).alias("a"), F.xxhash64(F.lit(1), t).alias("b"))

    small = docs.select(F.col(doc_id).alias("doc_id"), key(F.col(doc_id), F.col(text)).alias("key"), F.col(text).alias("text"))
    rows = near_duplicates(small, "doc_id", "text", shingle, distance, groups=True)
    keys = put(rows.groupBy(F.col("row.key").alias("key"), F.col("row.doc_id").alias("doc_id"), "component").agg(
        F.count(F.lit(1)).alias("times")), "row-keys")
    stays = keys.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "key")).alias("m")).select(
        F.col("m.key").alias("key"))
    gone = put(keys.join(stays, "key", "left_anti").select(F.col("key").alias("_key")), "gone")
    repeated = put(keys.where("times > 1").join(stays, "key").select(F.col("key").alias("_key")), "repeated")
    row = F.col("row")
    keyed = packed(docs).withColumn("_key", key(row.getField(doc_id), row.getField(text))).join(gone, "_key", "left_anti")
    once = keyed.join(repeated, "_key", "left_anti")
    several = keyed.join(repeated, "_key", "left_semi").dropDuplicates(["_key"])
    return once.unionByName(several).select(*[row.getField(c).alias(c) for c in docs.columns])
