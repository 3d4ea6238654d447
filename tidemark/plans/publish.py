"""Publishing a set of tables: build beside, check, then switch.

A release is a folder of tables written once and never changed. Generation n is a
manifest file that names the tables of all readers: their folders, schemas, and
the key version, the run that numbered the dimension keys they hold. Manifests are
created exclusively: a build that started from generation n can only publish n + 1,
so of two builds at once one is refused and nothing is lost silently. A failed
build leaves what readers see untouched.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.plans import checks, runlog
from tidemark.plans.facts import FACILITY_FACT, PENALTY_FACT
from tidemark.session import COMPRESSION

DECLARED = {"fact_snapshot": FACILITY_FACT, "fact_penalty": PENALTY_FACT}
PARTITIONS = {"fact_snapshot": "snapshot_date_key", "fact_penalty": "event_year"}


def event_year():
    """Partition column of the penalty fact beside the declared ones; unknown dates have no year."""
    return F.when(F.col("penalty_date_key") > 0, F.floor(F.col("penalty_date_key") / 10000).cast("int"))


class StaleRelease(RuntimeError):
    """Another build published since this one started."""


class StaleKeys(ValueError):
    """A fact holds keys of another numbering of the dimensions than the published one."""


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: str, run_id: str,
            logged_at: str, extra_log: list[DataFrame] = (), base: int | None = None, inherit: bool = False) -> str:
    """Write, validate what was written, log, and switch readers to it.

    Checks read the written tables, so each table is computed once. The run log
    is appended whether or not the gate opens. ``base`` is the generation the build
    started from, the present one by default. With ``inherit`` readers keep the
    tables of that generation that are not given here.
    """
    base = generation(spark, root) if base is None else base
    written = {name: write_table(frame, root, run_id, name) for name, frame in tables.items()}
    return switch(spark, written, root, run_id, logged_at, extra_log, base, inherit=inherit)


def write_table(frame: DataFrame, root: str, run_id: str, name: str) -> DataFrame:
    """Write one table of a release that no reader follows yet, and read it back."""
    release = f"{root}/releases/{run_id}"
    rows = checks.conform(frame, DECLARED[name], name) if name in DECLARED else frame
    by = [PARTITIONS[name]] if name in PARTITIONS else []
    if name == "fact_penalty":
        rows = rows.withColumn("event_year", event_year())
    # rebalancing splits a hot period over several writers and merges small ones
    writer = rows.hint("rebalance", *by).write.mode("errorifexists").option("compression", COMPRESSION)
    (writer.partitionBy(*by) if by else writer).parquet(f"{release}/{name}")
    return frame.sparkSession.read.schema(rows.schema).parquet(f"{release}/{name}")


def switch(spark: SparkSession, written: dict[str, DataFrame], root: str, run_id: str, logged_at: str,
           extra_log: list[DataFrame] = (), base: int | None = None, *, inherit: bool = False, key_version: str | None = None,
           segments: dict[str, list[str]] | None = None, **facts) -> str:
    """Validate the written tables of a release, log, and publish them as the generation after ``base``.

    ``key_version`` is the run that numbered the keys, this one by default.
    ``segments`` names earlier folders that a table goes on from; ``facts`` are
    further entries of the manifest.
    """
    base = generation(spark, root) if base is None else base
    release = f"{root}/releases/{run_id}"
    # a metric row per rule: small, and needed twice
    metrics = checks.validate(written).collect()
    frame = spark.createDataFrame(
        metrics, "rule string, target string, rows_checked bigint, violations bigint, detail string")
    append_log(runlog.run_log([*extra_log, runlog.log_checks(frame)], run_id, logged_at), root)
    checks.gate(frame)
    kept = (manifest(spark, root, base) or {}).get("tables", {}) if inherit else {}
    tables = {name: {"folders": [*(segments or {}).get(name, []), f"{release}/{name}"], "schema": table.schema.jsonValue(),
                     "key_version": key_version or run_id} for name, table in written.items()}
    claim(spark, root, {"generation": base + 1, "run_id": run_id, "published_at": logged_at, "release": release,
                        "tables": {**kept, **tables}, **facts})
    return release


def _path(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def generation(spark: SparkSession, root: str) -> int:
    """The number of the newest manifest; 0 before anything is published."""
    folder, system = _path(spark, f"{root}/generations")
    if not system.exists(folder):
        return 0
    names = [f.getPath().getName() for f in system.listStatus(folder)]
    return max([int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")], default=0)


def manifest(spark: SparkSession, root: str, number: int | None = None) -> dict | None:
    """What a generation, the newest by default, consists of."""
    number = generation(spark, root) if number is None else number
    if not number:
        return None
    file, system = _path(spark, f"{root}/generations/{number:010d}.json")
    stream = system.open(file)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def claim(spark: SparkSession, root: str, content: dict) -> None:
    """Create the manifest of a generation, whole or not at all, or raise if the generation exists.

    The file is written beside and then named: by a hard link on a local file
    system, elsewhere by a rename that does not replace. Both fail if the name is
    taken, whoever took it and whenever.
    """
    jvm = spark.sparkContext._jvm
    name = f"{root}/generations/{content['generation']:010d}.json"
    draft, system = _path(spark, f"{root}/generations/.{uuid.uuid4().hex}")
    final = jvm.org.apache.hadoop.fs.Path(name)
    stream = system.create(draft, False)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    try:
        if system.getUri().getScheme() == "file":
            nio = lambda path: jvm.java.nio.file.Paths.get(path.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0))
            jvm.java.nio.file.Files.createLink(nio(final), nio(draft))
        else:
            system = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            system.rename(draft, final, spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except Py4JJavaError as failed:
        if "FileAlreadyExists" not in failed.java_exception.getClass().getName():
            raise
        raise StaleRelease(f"generation {content['generation']} was published by another build") from None
    finally:
        delete(spark, f"{root}/generations/{draft.getName()}")


def append_log(log: DataFrame, root: str) -> None:
    log.write.mode("append").parquet(f"{root}/run_log")


def copy_log(spark: SparkSession, root: str, run_id: str, target: str) -> None:
    """A delimited copy of one run's log, readable without Spark."""
    log = spark.read.parquet(f"{root}/run_log").filter(F.col("run_id") == run_id)
    log.orderBy("step", "rule", "snapshot_date", "target").write.option("header", True).csv(target)


def current_release(spark: SparkSession, root: str) -> str | None:
    found = manifest(spark, root)
    return found and found["release"]


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the generation readers are switched to; facts join these stored keys.

    A fact whose key version is not that of every published dimension is refused:
    its keys mean other members.
    """
    found = manifest(spark, root)
    if found is None:
        raise ValueError(f"nothing is published below {root}")
    if name not in found["tables"]:
        raise ValueError(f"{found['release']} has no table {name}")
    versions = {n: t["key_version"] for n, t in found["tables"].items()}
    stale = sorted(n for n, v in versions.items() if n.startswith("dim_") and v != versions[name])
    if name.startswith("fact_") and stale:
        raise StaleKeys(f"{name} holds keys of {versions[name]}, but {', '.join(stale)} were numbered again; rebuild it")
    return table_of(spark, found, name)


def table_of(spark: SparkSession, found: dict, name: str) -> DataFrame:
    """A table of a manifest, whatever its key version; its schema is known, so no file is opened to plan it."""
    entry = found["tables"][name]
    schema = T.StructType.fromJson(entry["schema"])
    return reduce(lambda a, b: a.unionByName(b), [spark.read.schema(schema).parquet(f) for f in entry["folders"]])


def key_versions(spark: SparkSession, root: str) -> DataFrame:
    """Every published fact with its rows, its key version, and whether dimensions were numbered again since."""
    found = manifest(spark, root)
    dims = {n: t["key_version"] for n, t in found["tables"].items() if n.startswith("dim_")}
    newest = spark.createDataFrame(sorted(dims.items()), "dim string, key_version string")
    parts = [checks.key_version_check(
        table_of(spark, found, n).withColumn("key_version", F.lit(t["key_version"])), newest).withColumn("target", F.lit(n))
        for n, t in sorted(found["tables"].items()) if n.startswith("fact_")]
    return checks.union_all(parts)


def build_warehouse(spark: SparkSession, source: str, root: str, run_id: str, logged_at: str,
                    population: DataFrame | None = None, periods: list | None = None) -> str:
    """Text snapshots to a published star.

    The text is parsed once into staged rows; tables are written straight into
    the release, which readers see only after the checks. Facts start from the
    written dimensions, so they use exactly the stored surrogate keys, and the
    penalty fact takes its keys from the written snapshot fact. What the cleaning
    rules did is logged with the checks. Staged rows are deleted at the end.
    """
    from tidemark.operators.votes import date_votes
    from tidemark.plans import cleaning_log, dimensions, facts
    from tidemark.session import stored
    from tidemark.sources.text import POSITION, load_snapshots

    position, base = list(POSITION), generation(spark, root)
    staging = f"{root}/staged/{run_id}"
    providers, penalties, survivors = load_snapshots(spark, source, periods, staging)
    written = {name: write_table(frame, root, run_id, name) for name, frame in
               dimensions.build_dimensions(providers, penalties, position).items()}
    dims = dict(written)
    written["fact_snapshot"] = write_table(facts.fact_snapshot(providers, dims, position), root, run_id, "fact_snapshot")
    attributes = facts.attributes_of(written["fact_snapshot"])
    votes = None if penalties is None else stored(date_votes(penalties, "penalty_date", ["processing_date"]), "votes")
    sightings = None if penalties is None else facts.penalty_sightings(penalties, position, votes)
    columns = facts.EventColumns(position=tuple(position))
    written["fact_penalty"] = write_table(
        facts.fact_penalty(sightings, attributes, dims, columns), root, run_id, "fact_penalty")
    if population is not None:
        written["ref_state_population"] = write_table(population, root, run_id, "ref_state_population")
    log = cleaning_log.of_build(providers, penalties, survivors, written, votes)
    release = switch(spark, written, root, run_id, logged_at, log, base)
    delete(spark, staging)
    return release


def exists(spark: SparkSession, path: str) -> bool:
    folder, system = _path(spark, path)
    return system.exists(folder)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package on whatever file system it lies."""
    folder, system = _path(spark, path)
    system.delete(folder, True)
