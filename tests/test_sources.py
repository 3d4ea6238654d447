import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests import snapshots
from tidemark.fixed_values import POPULATION_VARIABLES
from tidemark.sources import catalog, population, text


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return snapshots.build(tmp_path_factory.mktemp("snapshots"))


@pytest.mark.parametrize("path,logical", [
    ("/a/2019-01-17/ProviderInfo_Download.csv", "provider_info"), ("/a/2026-06-24/NH_ProviderInfo_Jun2026.csv", "provider_info"),
    ("/a/2026-07-29/4pq5-n9py_2026-07-29_NH_ProviderInfo_Jul2026.csv", "provider_info"),
    ("/a/2026-07-29/._4pq5_NH_ProviderInfo_Jul2026.csv", None), ("__MACOSX/x/NH_Penalties_Jun2026.csv", None),
    ("/a/x/nh_penalties_jun2026.CSV", "penalties"), ("/a/x/StateAverages_Download.csv", "state_averages"),
    ("/a/x/SNF VBP Facility Performance.csv", "vbp"), ("/a/x/FY_2026_SNF_VBP_Aggregate_Performance.csv", None)])
def test_file_names(spark, path, logical):
    assert spark.range(1).select(catalog.classify(F.lit(path)).alias("l")).first().l == logical


def test_catalogue_of_a_folder(spark, folder, rows):
    files = catalog.list_files(spark, folder)
    assert catalog.period_catalog(files).count() == 5
    usable = {str(r.snapshot_date): r.status for r in catalog.usable_periods(catalog.classify_files(files)).collect()}
    assert usable == {"2019-01-17": "complete", "2020-10-09": "complete", "2026-07-29": "complete",
                      "2026-08-06": "no penalties", "2026-09-01": "skipped"}


def test_eras(spark):
    def era(logical, name):
        return text.detect_era(logical, [f" {c.upper()} " for c in text.era_columns(logical, name).values()])[0]
    for name in ("2026", "2020", "2019"):
        assert era("provider_info", name) == name and era("penalties", name) == name
    with pytest.raises(ValueError, match="no known layout"):
        text.detect_era("penalties", ["unnamed: 0"])
    with pytest.raises(ValueError, match="required"):
        text.canonicalize(spark.createDataFrame([("1",)], "PROVNUM string"), "provider_info")
    report = text.layout_report(list(text.era_columns("provider_info", "2019").values()), "provider_info")
    assert report["era"] == "2019" and report["mapped"] == 27 and "chain_name" in report["absent"]


def test_loading_collapses_republished_files(spark, folder):
    providers, penalties, survivors = text.load_snapshots(spark, folder)
    got = {(str(r.snapshot_date), str(r.processing_date), r.n) for r in providers.groupBy(
        "snapshot_date", "processing_date").agg(F.count("*").alias("n")).collect()}
    assert got == {("2019-01-17", "2019-01-01", 3), ("2020-10-09", "2020-10-01", 2), ("2026-08-06", "2026-07-01", 2)}
    got = {(str(r.snapshot_date), r.n) for r in penalties.groupBy("snapshot_date").agg(F.count("*").alias("n")).collect()}
    assert got == {("2019-01-17", 3), ("2020-10-09", 2), ("2026-08-06", 2)}       # inherited, not lost
    first = providers.filter("snapshot_date = '2019-01-17'").orderBy("file_block", "row_in_block").collect()
    assert [(r.ccn, r.overall_rating, r.chain_name, r.special_focus_status) for r in first] == [
        ("015009", "3", None, "Y"), ("015010", "3", None, None), ("015010", "3", None, None)]
    assert survivors.filter("inherited").count() == 1
    assert text.load_snapshots(spark, folder, ["2020-10-09"])[0].count() == 2


def test_quoted_line_breaks_and_encoding(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n"one\ntwo",NA\n"caf\xe9","x ""y"""\n', encoding="latin-1")
    out = text.ingest_text_scan(spark, str(tmp_path / "x.csv"), multiline=True).orderBy("row_in_block").collect()
    assert [(r.a, r.b) for r in out] == [("one\ntwo", None), ("caf\xe9", 'x "y"')]


def test_processing_date_falls_back_to_the_label(spark):
    frame = spark.createDataFrame([("2020-01-05", 1, None), ("2020-02-05", 1, "bad"), ("2020-02-05", 2, "2020-02-01"),
                                   ("2020-02-05", 3, "2020-03-01")], "snapshot_date string, row int, processing_date string")
    out = {r.snapshot_date: (str(r.processing_date), r.distinct_dates, r.label_differs)
           for r in text.processing_dates(frame, ["row"]).collect()}
    assert out == {"2020-01-05": ("2020-01-05", 0, False), "2020-02-05": ("2020-02-01", 2, True)}


def test_pending_files(spark):
    day = dt.date(2020, 1, 1)
    sizes = spark.createDataFrame([(day, 5), (day.replace(month=2), 5), (day.replace(month=3), 0), (day.replace(month=4), 9)], "snapshot_date date, length bigint")
    ledger = spark.createDataFrame([(day, 5), (day.replace(month=2), 4), (day.replace(month=3), 7)], "snapshot_date date, length bigint")
    out = {r.snapshot_date.month: r.reason for r in catalog.incremental_pending(sizes, ledger).collect()}
    assert out == {2: "size mismatch", 4: "new"}
    assert catalog.incremental_pending(sizes, ledger, force=True).count() == 4


def test_coverage_counts_every_file(spark):
    day = lambda m, d=1: dt.date(2020, m, d)
    files = spark.createDataFrame([
        (day(1), day(1), "penalties", 10), (day(1, 9), day(1), "penalties", 12), (day(2), None, "penalties", 5),
        (day(1, 9), day(1), "provider_info", 3)], "snapshot_date date, processing_date date, logical string, row_count bigint")
    survivors = catalog.collapse_republished(files.filter("processing_date is not null"))
    out = {r.logical: (r.files, r.carried, r.superseded, r.unread, r.rows_carried) for r in catalog.source_coverage(files, survivors).collect()}
    assert out == {"penalties": (3, 1, 1, 1, 12), "provider_info": (1, 1, 0, 0, 3)}


def test_population_from_both_shapes(spark, rows):
    wide = spark.createDataFrame([
        ("1", "Alabama", "0", "65", "10", "11"), ("1", "Alabama", "0", "85", "5", None), ("1", "Alabama", "1", "70", "99", "99"),
        ("1", "Alabama", "0", "999", "500", "500"), ("1", "Alabama", "0", "64", "7", "7"), ("0", "United States", "0", "70", "9", "9"),
        ("60", "Nowhere", "0", "70", "9", "9")], "STATE string, NAME string, SEX string, AGE string, POPEST2020_CIV string, POPEST2021_CIV string")
    long = population.unpivot_population(wide)
    out = population.state_population(long, "s")
    assert rows(out) == [("AL", "Alabama", 2020, 15, "s"), ("AL", "Alabama", 2021, 11, "s")]
    assert [r.state_name for r in population.unmapped_states(long).collect()] == ["Nowhere"]
    head = '["state","NAME",' + ",".join(f'"{v}"' for v in POPULATION_VARIABLES) + "]"
    body = '["05","Arkansas",' + ",".join(['"2"'] * 11 + ['"x"']) + "]"
    payload = spark.createDataFrame([(f"[{head},{body}]",), ("[]",), (None,), (f"[{head}]",)], "p string")
    summed = population.json_rows_sum(payload, "p", 2023)
    assert rows(population.state_population(summed, "api")) == [("AR", "Arkansas", 2023, 22, "api")]
