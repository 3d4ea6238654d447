"""Pieces that several operators share: words, shared tables, sorted groups."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; an empty array for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def n_words(text: Column) -> Column:
    parts = F.split(F.coalesce(text, F.lit("")), GAP)
    edges = (F.element_at(parts, 1) == "").cast("int") + (
        (F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")
    return (F.size(parts) - edges).cast("long")


def unit(*parts: Column) -> Column:
    """A number in (0, 1) from the MD5 of the parts' text: the same on every run and in every engine."""
    digits = F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def put(frame: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder once and read it back; cuts the lineage."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def forget(frame: DataFrame) -> None:
    """Delete the files of a table made by ``put`` that nothing reads any more."""
    spark = frame.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in frame.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def packed(frame: DataFrame) -> DataFrame:
    """The whole row in one column, so that working columns cannot clash with the user's."""
    return frame.select(F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias("row"))


def beside(frame: DataFrame, *added: str) -> list[tuple[str, str]]:
    """The columns of ``frame`` and the names they get beside ``added`` ones: a clashing name is prefixed ``input_``, as often as it takes."""
    taken = {c.lower() for c in (*frame.columns, *added)}
    names = []
    for column in frame.columns:
        name = column
        if column.lower() in {a.lower() for a in added}:
            while name.lower() in taken:
                name = f"input_{name}"
            taken.add(name.lower())
        names.append((column, name))
    return names


def sorted_groups(batches: Iterable[pa.RecordBatch], key: list[str]) -> Iterator[dict[str, pa.Array]]:
    """Runs of equal keys in a partition that is sorted by ``key``; a run may span batches."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = pa.Table.from_batches([batch])
        if rest is not None:
            whole = pa.concat_tables([rest, whole]).combine_chunks()
        cut = _changes(whole, key)
        for a, b in zip(cut[:-2], cut[1:-1]):
            yield whole.slice(a, b - a)
        rest = whole.slice(cut[-2])
    if rest is not None:
        yield rest


def _changes(whole: pa.Table, key: list[str]) -> np.ndarray:
    differs = np.zeros(max(whole.num_rows - 1, 0), dtype=bool)
    for name in key:
        column = whole.column(name).to_numpy()
        differs |= column[1:] != column[:-1]
    return np.concatenate([[0], np.flatnonzero(differs) + 1, [whole.num_rows]])


def bucket_blocks(rows: DataFrame, key: list[str], member: str, size: int) -> DataFrame:
    """Deal the members of every bucket into pairs of blocks.

    A bucket of at most ``size`` members is one block. A larger one is cut into
    blocks by a hash of the member, and every pair of its blocks becomes a group
    ``(key, bi, bj)`` of its own, so no task ever holds a whole hot bucket and
    every pair of members meets exactly once (pairs inside a block meet in
    ``bi = bj``). Buckets of a single member are left out: they make no pair.
    The counts are aggregated map-side; the join back is on the bucket, which
    adaptive execution splits where a bucket is hot.
    """
    counts = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(
        *key, F.ceil(F.col("_n") / F.lit(size)).cast("int").alias("_blocks"))
    dealt = rows.join(counts, key).withColumn(
        "blk", F.when(F.col("_blocks") == 1, 0).otherwise(F.pmod(F.xxhash64(F.lit(7), member), "_blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return (dealt.withColumn("_other", other)
            .withColumn("bi", F.least("blk", "_other")).withColumn("bj", F.greatest("blk", "_other"))
            .drop("_other", "_blocks"))


def per_group(frame: DataFrame, key: list[str], work: Callable[[pa.Table], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Run ``work`` over each group of ``key``; groups must be bounded by the caller.

    One Arrow pass per partition instead of one Python call per group: the rows
    of a partition are sorted by key and cut into runs.
    """
    def run(batches):
        for group in sorted_groups(batches, key):
            found = work(group)
            if found is not None and found.num_rows:
                yield found

    parts = frame.repartition(*key).sortWithinPartitions(*key)
    return parts.mapInArrow(run, schema)


def roots(adjacent: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each index of a dense symmetric matrix."""
    n = len(adjacent)
    label = np.arange(n, dtype=np.int32)
    reach = adjacent | np.eye(n, dtype=bool)
    while True:
        new = np.where(reach, label[None, :], n).min(axis=1).astype(np.int32)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new
