"""Session settings and durable intermediate results."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even if that costs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows of snapshots compress about tenfold: the default 64 MB of a shuffle are up to 600 MB in each sort of a
    # task, and several million rows of two narrow columns; tasks stay small, their number grows with the input
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "512",
    "spark.sql.files.maxPartitionBytes": "16m",
}

#: Of tables written to be read again.
COMPRESSION = "zstd"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every plan in this package assumes."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str = "tidemark", cores: int | str = "*", **settings) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        # recording the call site of every column expression costs more than planning
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, named by ``spark.checkpoint.dir``."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing else ever writes there."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


#: Scratch paths of this application, for ``clean``.
_MADE: list[str] = []


def clean(spark: SparkSession) -> int:
    """Delete the scratch tables of this application; call it when no result is read any more."""
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    deleted = 0
    while _MADE:
        path = paths(_MADE.pop())
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        deleted += bool(system.delete(path, True))
    return deleted


def stored(frame: DataFrame, name: str, partition: str | None = None, *, spread: bool = True) -> DataFrame:
    """Write a table to the shared folder once and read it back.

    Readers get column and partition pruning and exact sizes. Rebalancing splits
    a hot partition over several writers and merges small ones. Without ``spread``
    rows are written where they are, without that shuffle.
    """
    path = scratch_path(frame.sparkSession, name)
    rows = frame.hint("rebalance", *([partition] if partition else [])) if spread else frame
    writer = rows.write.partitionBy(partition) if partition else rows.write
    writer.option("compression", COMPRESSION).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def durable(frame: DataFrame) -> DataFrame:
    """Write a frame to the shared checkpoint folder and cut its lineage.

    Needed where a value must not be computed twice with different outcomes
    (slice numbers after range partitioning): a lost executor re-reads the file
    instead of re-planning the slices.
    """
    spark = frame.sparkSession
    shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return frame.checkpoint(eager=True)
