"""Work is done once per text, however many rows repeat it, and files are staged as they are read."""

import pytest
from pyspark.sql import functions as F

from tests import snapshots
from tidemark.functions import clean
from tidemark.operators import votes
from tidemark.plans import dimensions
from tidemark.sources import catalog, text


@pytest.fixture
def counted(spark):
    """A text function that counts the rows it is applied to."""
    calls = spark.sparkContext.accumulator(0)

    def one(value):
        calls.add(1)
        return value

    return calls, F.udf(one, "string").asNondeterministic()


def test_a_repeated_date_is_parsed_once_and_counts_as_often_as_it_occurs(spark, counted, monkeypatch):
    calls, seen = counted
    frame = spark.createDataFrame([("p", "13/02/2024")] * 300 + [("p", "soon")] * 20 + [("p", " ")] * 5 + [("q", None)], "period string, t string").repartition(1)
    expected = {("p", 320, 300, "d/M/yyyy", 20, 0), ("q", 0, 0, None, 0, 0)}
    picked = ["period", "present", "hits", "date_format", "unparsed", "rivals"]
    assert {tuple(r) for r in votes.date_votes(frame, "t", ["period"]).select(*picked).collect()} == expected
    parse = votes.parse_as
    monkeypatch.setattr(votes, "parse_as", lambda c, i: parse(seen(c), i))
    assert {tuple(r) for r in votes.date_votes(frame, "t", ["period"]).select(*picked).collect()} == expected
    assert 0 < calls.value <= 4 * 3 * len(votes._FORMATS)


def test_votes_of_an_empty_frame(spark):
    empty = spark.createDataFrame([], "t string")
    assert [tuple(r)[:3] for r in votes.date_votes(empty, "t", []).collect()] == [(0, 0, None)]


def test_a_repeated_category_is_normalised_once(spark, counted, monkeypatch):
    calls, seen = counted
    normal = clean.normalize_text
    monkeypatch.setattr(clean, "normalize_text", lambda c, **o: normal(seen(F.col(c)), **o))
    rows = spark.createDataFrame([(" Tribal",)] * 200 + [("Tribal  ",)] * 200 + [(None,)] * 9, "ownership_type string").repartition(1)
    assert [r.ownership_type for r in dimensions.dim_ownership(rows).orderBy("ownership_key").collect()] == ["Unknown", "Tribal"]
    assert 0 < calls.value <= 50


def test_text_is_replaced_once_a_row(spark):
    frame = spark.createDataFrame([("\x1f a \xa0\x85 b\x0b",), (" \t",), (None,)], "t string")
    plan = lambda c: frame.select(c.alias("n"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan(clean.normalize_text("t")).count("regexp_replace") == 1
    assert "regexp_replace" not in plan(clean.to_number("t"))
    numbers = [f"{c}1{c},2{c}" for c in "$%\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0 "] + ["1 ", "NaN"]
    typed = spark.createDataFrame([(i, n) for i, n in enumerate(numbers)], "i int, t string").select(clean.to_number("t").alias("n"), "i").orderBy("i")
    assert [r.n for r in typed.collect()] == [12.0] * 14 + [None] * 2


def test_files_read_line_by_line_are_staged_without_a_shuffle(spark, tmp_path, monkeypatch):
    folder = snapshots.build(tmp_path / "in")
    chosen = catalog.classify_files(catalog.list_files(spark, folder))
    quoted = [any(l.quoted_breaks for l in text.layouts_of(spark, chosen, kind)) for kind in ("provider_info", "penalties")]
    assert not all(quoted)
    kind, shuffled = type(spark.range(1)), []
    hint = kind.hint
    monkeypatch.setattr(kind, "hint", lambda self, name, *by: shuffled.append(by) or hint(self, name, *by))
    plain = text.load_snapshots(spark, folder)[1]
    staged = text.load_snapshots(spark, folder, staging=str(tmp_path / "staged"))[1]
    assert [by for by in shuffled if by == ("snapshot_date",)] == [("snapshot_date",)] * sum(quoted)
    assert sorted(map(str, plain.select(*sorted(plain.columns)).collect())) == sorted(map(str, staged.select(*sorted(plain.columns)).collect()))
