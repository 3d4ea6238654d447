"""Generations, races, key versions, and a star that grows period by period."""

import shutil

import pytest
from pyspark.sql import functions as F

from tests import snapshots
from tests.test_warehouse import rows_of_star
from tidemark.plans import publish
from tidemark.plans.increments import extend_warehouse
from tidemark.streaming import builds

OWNERSHIP = "ownership_key bigint, ownership_type string, ownership_group string, is_for_profit boolean"


def ownership(spark, *types):
    return spark.createDataFrame([(i + 1, t, "Unknown", False) for i, t in enumerate(types)], OWNERSHIP)


def test_the_loser_of_a_race_is_refused(spark, tmp_path):
    root = str(tmp_path)
    base = publish.generation(spark, root)
    publish.publish(spark, {"dim_ownership": ownership(spark, "a")}, root, "first", "t", base=base)
    with pytest.raises(publish.StaleRelease, match="generation 1"):
        publish.publish(spark, {"dim_ownership": ownership(spark, "b")}, root, "second", "t", base=base)
    assert publish.read_table(spark, root, "dim_ownership").first().ownership_type == "a"
    publish.publish(spark, {"dim_ownership": ownership(spark, "b")}, root, "third", "t")
    assert publish.generation(spark, root) == 2 and publish.manifest(spark, root)["run_id"] == "third"
    assert publish.manifest(spark, root, 1)["run_id"] == "first"
    assert sorted(p.name for p in (tmp_path / "generations").iterdir()) == ["0000000001.json", "0000000002.json"]


def test_a_claimed_name_is_never_replaced(spark, tmp_path):
    root = str(tmp_path)
    for run in "ab":
        try:
            publish.claim(spark, root, {"generation": 1, "run_id": run, "tables": {}})
        except publish.StaleRelease:
            assert run == "b"
    assert publish.manifest(spark, root)["run_id"] == "a"


def test_facts_of_another_numbering_are_refused(spark, tmp_path):
    root, source = str(tmp_path / "warehouse"), snapshots.build(tmp_path / "source")
    publish.build_warehouse(spark, source, root, "one", "t")
    again = publish.read_table(spark, root, "dim_ownership").where("ownership_key <> 1")
    publish.publish(spark, {"dim_ownership": again}, root, "two", "t", inherit=True)
    with pytest.raises(publish.StaleKeys, match="dim_ownership were numbered again"):
        publish.read_table(spark, root, "fact_snapshot")
    assert publish.read_table(spark, root, "dim_chain").count() > 0
    assert publish.read_table(spark, root, "dim_ownership").where("ownership_key = 1").count() == 0
    got = {r.target: (r.key_version, r.fact_rows, r.stale) for r in publish.key_versions(spark, root).collect()}
    assert got == {"fact_snapshot": ("one", 6, True), "fact_penalty": ("one", 5, True)}
    with pytest.raises(ValueError, match="no table"):
        publish.read_table(spark, root, "ref_state_population")


@pytest.fixture(scope="module")
def once(spark, tmp_path_factory):
    """All snapshots in one build."""
    source, root = snapshots.build(tmp_path_factory.mktemp("whole")), str(tmp_path_factory.mktemp("once"))
    publish.build_warehouse(spark, source, root, "once", "t")
    return source, rows_of_star(spark, root)


def copied(source, target, *periods):
    for period in periods:
        shutil.copytree(f"{source}/{period}", f"{target}/{period}")


def test_a_star_grown_by_stream_equals_one_build(spark, tmp_path, once):
    whole, source = once[0], tmp_path / "source"
    root, state = str(tmp_path / "grown"), str(tmp_path / "state")
    source.mkdir()
    run = lambda: builds.stream_builds(spark, str(source), root, state, "t")
    copied(whole, source, "2019-01-17")
    run()
    first = {(r.ccn, r.effective_date): r.facility_key for r in publish.read_table(spark, root, "dim_facility").collect()}
    copied(whole, source, "2020-10-09")
    run()
    assert publish.generation(spark, root) == 2
    # a batch that was published is replayed, and one finds nothing new
    assert publish.manifest(spark, root)["batch"] == 1
    assert builds.publish_batch(spark, str(source), root, 1, "t") is None
    run()
    assert publish.generation(spark, root) == 2
    copied(whole, source, "2026-07-29", "2026-08-06")
    run()
    found = publish.manifest(spark, root)
    assert found["generation"] == 3 and len(found["tables"]["fact_snapshot"]["folders"]) == 3
    assert {t["key_version"] for t in found["tables"].values()} == {"batch-0"}
    keys = {(r.ccn, r.effective_date): r.facility_key for r in publish.read_table(spark, root, "dim_facility").collect()}
    assert {k: keys[k] for k in first} == first

    assert rows_of_star(spark, root) == once[1]
    # the same periods again change nothing
    assert extend_warehouse(spark, str(source), root, "again", "t") is None


def test_periods_out_of_order_build_everything_again(spark, tmp_path, once):
    whole, source, root = once[0], tmp_path / "source", str(tmp_path / "grown")
    source.mkdir()
    copied(whole, source, "2019-01-17", "2026-07-29")
    extend_warehouse(spark, str(source), root, "r1", "t")
    copied(whole, source, "2026-08-06", "2020-10-09")        # republished, and older
    extend_warehouse(spark, str(source), root, "r2", "t")
    assert rows_of_star(spark, root) == once[1]
    assert {t["key_version"] for t in publish.manifest(spark, root)["tables"].values()} == {"r2"}
