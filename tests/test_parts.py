"""Files in parts, and how little of the text goes over the network on its way to staged rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests import snapshots
from tidemark.fixed_values import PROVIDER_COLUMNS
from tidemark.operators.dedup import EventColumns
from tidemark.plans import dimensions, facts
from tidemark.session import stored
from tidemark.sources import catalog, records, text
from workload import frames

POSITION = list(text.POSITION)


def in_parts(folder, names):
    """The only file of a folder as a folder of parts: a record, perhaps of two lines, for each name; the header in each."""
    (file,) = folder.iterdir()
    header, *lines = file.read_text(encoding="latin-1").split('"\n"')
    assert len(lines) == len(names)
    file.unlink()
    file.mkdir()
    for name, line in reversed(list(zip(names, lines))):
        (file / name).write_text(f'{header}"\n"{line.rstrip().rstrip(chr(34))}"\n', encoding="latin-1")


@pytest.mark.parametrize("broken", [False, True])
def test_parts_are_read_as_the_file_they_make_up(spark, tmp_path, broken):
    names = ["part-00002-a.c000.csv", "part-00009-a.c000.csv", "part-00009-a.c001.csv", "part-00010-a.c000.csv", "part-100000-a.c000.csv"]
    rows = [snapshots.provider(ccn, city=f"{'Two' + chr(10) if broken else ''}Place {i}") for i, ccn in enumerate(["015009", "015010", "015009", "015009", "015010"])]
    for at in ("whole", "parts"):
        snapshots.write(tmp_path / at, "2026-07-29", "NH_ProviderInfo_Jun2026.csv", "2026", rows, PROVIDER_COLUMNS, "2026-07-01")
    in_parts(tmp_path / "parts" / "2026-07-29", names)
    files = catalog.list_files(spark, str(tmp_path / "parts")).collect()
    assert [(f.snapshot_date, f.path.rsplit("/", 1)[1]) for f in files] == [(dt.date(2026, 7, 29), "NH_ProviderInfo_Jun2026.csv")]
    read = {at: text.load_snapshots(spark, str(tmp_path / at), staging=str(tmp_path / f"{at}-staged"))[0] for at in ("whole", "parts")}
    shown = lambda frame: [r[:] for r in frame.orderBy(*POSITION).drop(*POSITION, "file_path").collect()]
    assert shown(read["parts"]) == shown(read["whole"]) and len(shown(read["whole"])) == 5
    assert [r.city for r in read["parts"].orderBy(*POSITION).collect()] == [r["city"] for r in rows]


def test_other_files_below_a_period_are_no_parts(spark):
    paths = ["/a/2026-07-29/x.csv", "/a/2026-07-29/x.csv/part-00001.csv", "/a/2026-07-29/y/x.csv", "/a/z/x.csv/part-00001.csv", "/a/2026-07-29/part-00003.csv"]
    found = spark.createDataFrame([(p,) for p in paths], "path string").select(
        catalog.period_of("path").isNotNull().alias("known"), catalog.file_name("path").alias("name")).collect()
    assert [tuple(r) for r in found] == [(True, "x.csv"), (True, "x.csv"), (False, "x.csv"), (False, "part-00001.csv"), (True, "part-00003.csv")]


@pytest.fixture
def no_small_side(spark):
    """Without it Spark would guess, from the size of small files, what larger ones do not allow."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "-1")
    yield
    spark.conf.unset(key)


def plans(monkeypatch, frame, method):
    """Plans of all frames that a method gives from now on."""
    kind, made = type(frame), []
    plain = getattr(kind, method)
    monkeypatch.setattr(kind, method, lambda self, *a, **b: made.append(plain(self, *a, **b)) or made[-1])
    return lambda: [f._jdf.queryExecution().executedPlan().toString() for f in made]


def test_headers_are_found_without_a_shuffle_of_lines(spark, tmp_path, no_small_side, monkeypatch):
    folder = snapshots.build(tmp_path)
    joins = plans(monkeypatch, spark.range(1), "join")
    found = text.layouts_of(spark, catalog.classify_files(catalog.list_files(spark, folder)), "penalties")
    assert len(found) == 4 and joins() and not any("SortMergeJoin" in p for p in joins())


def test_records_are_shuffled_once_and_before_they_are_parsed(spark, tmp_path, no_small_side):
    (tmp_path / "f.csv").write_text('a,b\n1,"x\ny"\n2,z\n')
    found = records.ingest_quoted_scan(spark, [str(tmp_path / "f.csv")], ["a", "b"], "bad", by_file=True)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert 0 <= plan.index("from_csv") < plan.index("RebalancePartitions")
    assert sorted((r.a, r.b) for r in found.collect()) == [("1", "x\ny"), ("2", "z")]


def test_facts_shuffle_what_they_hold(spark, tmp_path, monkeypatch):
    providers, penalties, _ = text.load_snapshots(spark, snapshots.build(tmp_path))
    dims = {n: stored(d, n) for n, d in dimensions.build_dimensions(providers, penalties, POSITION).items()}
    seen = {}
    for name in ("first_per_key", "dense_key"):
        plain = getattr(facts, name)
        monkeypatch.setattr(facts, name, lambda frame, *a, _of=name, _plain=plain, **b: seen.setdefault(_of, []).append(set(frame.columns)) or _plain(frame, *a, **b))
    snapshot = facts.fact_snapshot(providers, dims, POSITION)
    events = facts.fact_penalty(facts.penalty_sightings(penalties, POSITION), facts.attributes_of(snapshot), dims, EventColumns(position=tuple(POSITION)))
    assert events.columns == facts.PENALTY_FACT and snapshot.columns == facts.FACILITY_FACT
    assert seen["first_per_key"] and not any({"provider_name", "file_path"} & c for c in seen["first_per_key"])
    assert seen["dense_key"] and not any({"natural_key", "identity", "penalty_type"} & c for c in seen["dense_key"])


def test_sightings_are_written_in_slices_of_their_events(spark, tmp_path, monkeypatch):
    day = lambda n: dt.datetime(1998, 1, 1) + dt.timedelta(days=45 * n)
    lines = [(k * 7 % 40, k % 5, k % 3, 1 + k % 7, 1.0 + k, 100.0 + k, 0.08, 0.02, "R" if k % 4 else "N", day(k % 26)) for k in range(80)]
    tables = {
        "lineitem": (lines + lines[:3], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                     "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp"),
        "supplier": ([(s, 1) for s in range(3)], "s_suppkey long, s_nationkey int"), "nation": ([(1, "N", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(1, "R")], "r_regionkey int, r_name string")}
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    read, sources = {}, {}
    for events in (1 << 17, 9):
        monkeypatch.setattr(frames, "SLICE_EVENTS", events)
        f = frames.Frames(spark, str(tmp_path))
        sources[events] = f.snapshots
        read[events] = text.load_snapshots(spark, f.snapshots)[1].orderBy("snapshot_date", *POSITION).drop(*POSITION, "file_path").collect()
        assert len(read[events]) == f.sighting.count() > 300
    parts = lambda source: spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source).filter(F.col("path").contains("/part-")).count()
    assert read[9] == read[1 << 17] and parts(sources[9]) > 0 == parts(sources[1 << 17])
    ids = [(r.snapshot_date, *map(int, r.fine_id.split("-"))) for r in read[9] if r.fine_id]
    assert len(ids) > 50 and ids == sorted(ids)
