"""Incremental pick-up of new snapshot files as a bounded streaming job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.sources import catalog

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def record_new_files(spark: SparkSession, root: str, ledger: str, checkpoint: str) -> DataFrame:
    """Append files no earlier run has seen to a ledger table, and return the ledger.

    The file source remembers in ``checkpoint`` what it has listed; the parquet
    sink makes each batch appear once, also after a lost run. Only paths and sizes
    flow through the stream: contents are pruned from the scan, and rows are read
    in batch, where their position in the file is known.
    """
    listed = (
        spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true").load(root)
        .select(catalog.period_of("path").alias("snapshot_date"), "path", "length",
                catalog.classify("path").alias("logical"))
        .filter(F.col("snapshot_date").isNotNull() & F.col("logical").isNotNull())
    )
    query = (
        listed.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
        .format("parquet").option("path", ledger).outputMode("append").start()
    )
    query.awaitTermination()
    return spark.read.parquet(ledger)
