import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import votes


def dates(spark, values):
    return spark.createDataFrame([("p", i, v) for i, v in enumerate(values)], "period string, row int, t string")


def vote(spark, values):
    return votes.date_votes(dates(spark, values), "t", ["period"]).first()


def test_one_format_for_the_whole_column(spark):
    frame = dates(spark, ["01/02/2024", "13/02/2024", "x", None])
    parsed = votes.parse_date_vote(frame, "t", "d", ["period"]).orderBy("row").collect()
    assert [r.d for r in parsed] == [dt.date(2024, 2, 1), dt.date(2024, 2, 13), None, None]
    chosen = vote(spark, ["01/02/2024", "13/02/2024", "x", None])
    assert (chosen.present, chosen.hits, chosen.date_format, chosen.unparsed, chosen.rivals) == (3, 2, "d/M/yyyy", 1, 0)


def test_ties_go_to_the_earlier_format_and_are_reported(spark):
    chosen = vote(spark, ["01/02/2024", "03/04/2024"])
    assert (chosen.date_format, chosen.rivals) == ("M/d/yyyy", 1)
    agreeing = vote(spark, ["02/02/2024"])
    assert (agreeing.date_format, agreeing.rivals) == ("M/d/yyyy", 0)


def test_nothing_parseable_leaves_nulls(spark):
    chosen = vote(spark, ["soon", "later"])
    assert (chosen.hits, chosen.format_index, chosen.unparsed) == (0, None, 2)
    assert votes.parse_date_vote(dates(spark, ["soon"]), "t", "d", ["period"]).first().d is None


def test_other_formats(spark):
    assert vote(spark, ["2024-01-31"]).date_format == "yyyy-M-d"
    assert vote(spark, ["2024/01/31"]).date_format == "yyyy/M/d"
    assert vote(spark, ["01-31-2024"]).date_format == "M-d-yyyy"
    assert vote(spark, ["2024-02-30"]).hits == 0


def test_blank_flag_means_none_only_where_the_column_exists(spark):
    frame = spark.createDataFrame(
        [("a", 1, "Y"), ("a", 2, None), ("a", 3, "N"), ("a", 4, "SFF Candidate"), ("a", 5, " "), ("b", 1, None)],
        "p string, i int, s string")
    out = votes.normalize_flag_domain(frame, "s", "o", ["p"]).orderBy("p", "i").collect()
    assert [r.o for r in out] == ["SFF", "None", "None", "SFF Candidate", "None", None]


def test_three_states_of_a_lookup(spark):
    frame = spark.createDataFrame(
        [("a", "X", 7), ("a", None, None), ("a", "Z", None), ("b", None, None)], "p string, s string, k bigint")
    out = votes.tri_state(frame, F.col("s"), "s", F.col("k"), "key", ["p"]).orderBy("p", "s").collect()
    assert sorted((r.p, r.s or "", r.key) for r in out) == [("a", "", 0), ("a", "X", 7), ("a", "Z", -1), ("b", "", -1)]


def test_unit_drift_is_decided_per_period(spark):
    frame = spark.createDataFrame(
        [("a", 0.52), ("a", 0.4), ("a", None), ("b", 52.0), ("b", 1.0), ("b", 40.0), ("c", None)], "p string, v double")
    out = votes.fix_unit_drift(frame, "v", "o", ["p"]).collect()
    got = sorted(((r.p, r.o) for r in out), key=str)
    assert got == sorted([("a", 52.0), ("a", 40.0), ("a", None), ("b", 52.0), ("b", 1.0), ("b", 40.0), ("c", None)], key=str)


def test_decisions_beyond_the_pin_limit_join_by_shuffle(spark, monkeypatch):
    from tidemark.operators import lookups
    monkeypatch.setattr(lookups, "PIN_ROWS", 1)
    frame = spark.createDataFrame([(f"p{i % 5}", "Y" if i % 5 else None) for i in range(50)], "p string, s string")
    out = votes.normalize_flag_domain(frame, "s", "o", ["p"])
    assert {(r.p, r.o) for r in out.collect()} == {("p0", None)} | {(f"p{i}", "SFF") for i in range(1, 5)}
