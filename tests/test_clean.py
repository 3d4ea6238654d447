import pytest
from pyspark.sql import functions as F

from tidemark.functions import bands, clean
from tidemark import fixed_values as V


def apply(spark, expression, values, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in frame.withColumn("y", expression(F.col("x"))).orderBy("i").collect()]


def test_ids_keep_zeros_and_are_never_cut(spark):
    assert apply(spark, clean.normalize_id, ["15009", " 015009 ", "1234567", "", "-5", None]) == [
        "015009", "015009", "1234567", "000000", "-00005", None]


def test_zip_takes_five_characters(spark):
    assert apply(spark, clean.normalize_zip, ["1234", "01234-5678", " 99501 "]) == ["01234", "01234", "99501"]


def test_text_collapses_every_kind_of_space(spark):
    assert apply(spark, clean.normalize_text, ["  a \t b\xa0c ", "   ", None]) == ["a b c", None, None]
    assert apply(spark, lambda c: clean.normalize_text(c, upper=True), ["Searcy "]) == ["SEARCY"]


def test_numbers_are_null_when_unparseable(spark):
    values = ["$1,234", "12%", "abc", " 5 ", "1e3", "", "nan", "1d", "-.5", None]
    assert apply(spark, clean.to_number, values) == [1234.0, 12.0, None, 5.0, 1000.0, None, None, None, -0.5, None]


def test_yes_no(spark):
    assert apply(spark, clean.normalize_yes_no, ["y", " YES", "0", "False", "maybe", None]) == [
        True, True, False, False, None, None]


def test_categories_fall_back_to_unknown(spark):
    assert apply(spark, clean.ownership_group, ["For profit - Individual", "Tribal"]) == ["For profit", "Unknown"]
    assert apply(spark, clean.census_region, ["PR", "VT", "XX"]) == ["Territory", "Northeast", "Unknown"]
    assert len(V.STATES) == 56 and len(V.OWNERSHIP_GROUPS) == 13


def test_negative_duration_is_blanked(spark):
    assert apply(spark, clean.blank_impossible, [-526, 0, 3, None], "bigint") == [None, 0, 3, None]


def test_date_key(spark):
    import datetime as dt
    assert apply(spark, clean.date_key, [dt.date(2026, 6, 1), None], "date") == [20260601, -1]


@pytest.mark.parametrize("beds,residents,turnover,flag", [
    (0, 5.0, None, True), (100, 105.0, 40.0, False), (100, 150.0, 40.0, True), (100, 50.0, 0.0, True),
    (100, 50.0, 200.0, False), (100, 50.0, 201.0, True), (None, 50.0, None, False), (100, -1.0, None, True)])
def test_suspect_flag(spark, beds, residents, turnover, flag):
    frame = spark.createDataFrame([(beds, residents, turnover)],
                                  "certified_beds bigint, avg_residents_per_day double, total_nursing_turnover_pct double")
    assert frame.select(clean.is_suspect().alias("s")).first().s is flag


def test_bands_at_their_edges(spark):
    assert apply(spark, bands.bed_band, [49.0, 50.0, 199.0, 200.0, None], "double") == [
        "Small (<50 beds)", "Medium (50-99 beds)", "Large (100-199 beds)", "Very large (200+ beds)", None]
    assert apply(spark, bands.chain_band, [0, 1, 2, 9, 10, 50, None], "int") == [
        "Independent (1)", "Independent (1)", "Small chain (2-9)", "Small chain (2-9)",
        "Medium chain (10-49)", "Large chain (50+)", "Unknown"]
    hours = lambda c: bands.band(c, V.STAFFING_BANDS)
    assert apply(spark, hours, [2.74, 3.48, 98.9, 99.0, -0.1, None], "double") == [
        "< 2.75", "3.48-3.75", "5.00+", None, None, None]
    closed = lambda c: bands.band(c, V.MARKET_RATING_BINS, right_closed=True)
    assert apply(spark, closed, [1.0, 2.75, 2.76, 5.0, 5.1], "double") == [
        "< 2.75", "< 2.75", "2.75–3.00", "> 3.30", None]


def test_days_in_month(spark):
    import datetime as dt
    assert apply(spark, clean.days_in_month, [dt.date(2024, 2, 9), dt.date(2023, 2, 1)], "date") == [29, 28]
