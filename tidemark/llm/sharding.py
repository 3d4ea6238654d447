"""Hierarchical weighted hash tree: documents descend by region, rack and shard.

At every level each child draws a number from the document's key and its own
name, and the smallest draw divided by weight, -ln(u) / w, wins. A child's draw
hangs on no other child, so a change of weights moves documents only into or out
of the subtrees whose weights change.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark.llm.common import put

Tree = dict[str, dict[str, dict[int, float]]]

#: Shards per rack and racks per region of the trees that ``tree_of`` builds.
RACK, REGION = 2, 2


def tree_of(shards: int, base: int = 16) -> Tree:
    """A tree of equal shards: the first ``base`` in full racks and regions, each later one in a region of its own.

    A new shard in its own region takes documents from all others and gives
    itself all that it takes; in a shared region it would also move documents
    between its neighbours. Rebuild with a larger ``base`` to fold them in.
    """
    tree: Tree = {}
    for s in range(shards):
        region, rack = (f"r{s // (RACK * REGION)}", f"k{s // RACK}") if s < base else (f"r+{s}", f"k+{s}")
        tree.setdefault(region, {}).setdefault(rack, {})[s] = 1.0
    return tree


def _draw(key: Column, level: str, name: str, weight: float, seed: int) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(f"{seed}/{level}/{name}"), key), 11).cast("double")
    return -F.log((bits + 0.5) / F.lit(float(1 << 53))) / F.lit(float(weight))


def _choice(key: Column, level: str, children: dict[str, float], seed: int) -> Column:
    """Name of the child with the smallest draw; equal draws go to the smaller name."""
    known = {n: w for n, w in children.items() if w > 0}
    if len(known) == 1:
        return F.lit(next(iter(known)))
    return F.least(*[F.struct(_draw(key, level, n, w, seed).alias("d"), F.lit(n).alias("n")) for n, w in known.items()])["n"]


def _weight(node) -> float:
    return sum(_weight(c) for c in node.values()) if isinstance(node, dict) else float(node)


def place(rows: DataFrame, key: Column, tree: Tree, seed: int, name: str) -> DataFrame:
    """Add the shard as column ``name``; no shuffle."""
    def among(column: str, options: dict[str, Column]) -> Column:
        return reduce(lambda c, kv: c.when(F.col(column) == kv[0], kv[1]), list(options.items())[1:],
                      F.when(F.col(column) == next(iter(options)), next(iter(options.values()))))

    rows = rows.withColumn("_region", _choice(key, "region", {r: _weight(t) for r, t in tree.items()}, seed))
    rows = rows.withColumn("_rack", among("_region", {
        r: _choice(key, f"rack/{r}", {k: _weight(t) for k, t in racks.items()}, seed) for r, racks in tree.items()}))
    rows = rows.withColumn(name, among("_rack", {
        k: _choice(key, f"shard/{k}", {str(s): w for s, w in shards.items()}, seed).cast("int")
        for racks in tree.values() for k, shards in racks.items()}))
    return rows.drop("_region", "_rack")


def assign(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shards: int = 16, seed: int = 3, tree: Tree | None = None,
           grown: Tree | None = None, slice_rows: int = 50_000) -> DataFrame:
    """Every row's id, size, text_crc32, shard, slot and the shard in the grown tree, without its text.

    The shard hangs on the id and the tree alone; rows with a null id share one.
    ``size`` is the text's UTF-8 bytes plus one; a null text has none, and the
    CRC of nothing, 0. ``slot`` numbers the rows of a shard from 0 without gaps,
    ordered inside slices of the id's hash, so no shard is ever sorted in one
    task; equal rows get consecutive slots. An empty table gives an empty one;
    other columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_b")).select(
        "doc_id", (F.octet_length("_b") + 1).cast("long").alias("size"), F.crc32("_b").cast("long").alias("text_crc32"),
        F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("_key"))
    # one more shard than there are full racks for is a region of its own, whatever the number of shards
    for name, t in (("shard", tree or tree_of(shards, base=shards)), ("grown_shard", grown or tree_of(shards + 1, base=shards))):
        rows = place(rows, F.col("_key"), t, seed, name)
    placed = put(rows.drop("_key"), "placed")
    slices = max(1, -(-placed.count() // (shards * slice_rows)))
    cut = placed.withColumn("_slice", F.pmod(F.xxhash64(F.lit("slice"), "doc_id", "size", "text_crc32"), F.lit(slices)).cast("int"))
    counts = cut.groupBy("shard", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(
        W.partitionBy("shard").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    inside = F.row_number().over(W.partitionBy("shard", "_slice").orderBy(F.col("doc_id").asc_nulls_last(), "size", "text_crc32")) - 1
    return cut.withColumn("_inside", inside).join(before, ["shard", "_slice"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("_before") + F.col("_inside")).cast("long").alias("slot"), "grown_shard")
