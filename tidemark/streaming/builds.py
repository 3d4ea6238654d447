"""A warehouse fed by a stream of snapshot files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.plans import publish
from tidemark.plans.increments import extend_warehouse
from tidemark.sources import catalog
from tidemark.streaming.incremental import FILE_SCHEMA


def publish_batch(spark: SparkSession, source: str, root: str, batch: int, logged_at: str) -> str | None:
    """Merge the periods that have arrived; a batch that was published before does nothing.

    The manifest holds the number of the batch it came from, so a batch that is
    replayed after its release was published, but before the stream noted it, is
    recognised. One that failed before publishing left nothing that readers see,
    and is built again into a release of its own.
    """
    found = publish.manifest(spark, root)
    if found is not None and found.get("batch", -1) >= batch:
        return None
    run_id, attempt = f"batch-{batch}", 0
    while publish.exists(spark, f"{root}/releases/{run_id}"):
        attempt += 1
        run_id = f"batch-{batch}-{attempt}"
    return extend_warehouse(spark, source, root, run_id, logged_at, batch=batch)


def stream_builds(spark: SparkSession, source: str, root: str, checkpoint: str, logged_at: str) -> None:
    """Publish a release for every batch of files that arrived since the last run.

    The stream lists files, without reading them, and says when there is something
    new; which periods are merged follows from the warehouse's own account.
    """
    listed = (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true").load(source)
        .select(catalog.period_of("path").alias("snapshot_date"), "path", "length", catalog.classify("path").alias("logical"))
        .filter(F.col("snapshot_date").isNotNull() & F.col("logical").isNotNull()))

    def publish_new(files: DataFrame, batch: int) -> None:
        if not files.isEmpty():
            publish_batch(spark, source, root, batch, logged_at)

    listed.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(publish_new).start().awaitTermination()
