"""Hot groups are looked for among whole members first."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup


@pytest.fixture
def counted(spark):
    """A text function that counts the rows it is applied to."""
    calls = spark.sparkContext.accumulator(0)

    def one(value):
        calls.add(1)
        return value

    return calls, F.udf(one, "string").asNondeterministic()


def test_groups_are_counted_only_if_a_member_is_that_large(spark, counted):
    calls, seen = counted
    c = dedup.EventColumns(position=("row",))
    day = dt.date(2025, 5, 9)
    rows = [(s, 10 * s + i, "a", day, kind, None, 5) for s in (1, 2) for i, kind in enumerate("Fine Fine Denial".split())]
    plain = spark.createDataFrame(rows, "stamp int, row int, ccn string, penalty_date date, penalty_type string, fine_id string, fine_amount_usd bigint")
    sightings = plain.withColumn("penalty_type", seen(F.col("penalty_type")))
    numbered = dedup.with_natural_key(sightings, c, hot_rows=6)
    assert calls.value == 0 and numbered.count() == 6
    shown = lambda limit: sorted((r.natural_key, r.row) for r in dedup.window_dedup(plain, c, hot_rows=limit).collect())
    # no large member; a large member without a large group; a large group
    assert shown(6) == shown(5) == shown(3) == [
        ("a|2025-05-09|Denial|0", 22), ("a|2025-05-09|Fine|0", 20), ("a|2025-05-09|Fine|1", 21)]
