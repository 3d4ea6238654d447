"""Population aged 65 and over by state and year, from either source shape."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, functions as F, types as T

from tidemark import fixed_values as V
from tidemark.functions.clean import map_category, strip, to_number, zero_pad

ROWS = T.ArrayType(T.ArrayType(T.StringType()))


def fips(column: str = "state_fips"):
    return zero_pad(strip(F.col(column).cast("string")), 2)


def unpivot_population(wide: DataFrame, years: list[int] = V.POPULATION_YEARS) -> DataFrame:
    """Wide estimates to one row per (state, year), both sexes, 65 and over.

    The all-ages total and the national row are left out. The sum comes before
    the unpivot, so one row per state is turned, not every source row.
    """
    columns = {y: f"POPEST{y}_CIV" for y in years if f"POPEST{y}_CIV" in wide.columns}
    sex, age = to_number(F.col("SEX").cast("string")), to_number(F.col("AGE").cast("string"))
    elderly = wide.filter(
        (sex == V.BOTH_SEXES) & (age >= V.ELDERLY_FROM) & (age != V.ALL_AGES)
        & (fips("STATE") != V.NATIONAL_FIPS))
    sums = elderly.groupBy("STATE", "NAME").agg(*[
        F.coalesce(F.sum(to_number(F.col(c).cast("string"))), F.lit(0.0)).alias(str(y))
        for y, c in columns.items()])
    return sums.unpivot(["STATE", "NAME"], [str(y) for y in columns], "year", "pop_65plus").select(
        F.col("STATE").alias("state_fips"), F.col("NAME").alias("state_name"),
        F.col("year").cast("int").alias("year"), F.col("pop_65plus").cast("bigint").alias("pop_65plus"))


def json_rows_sum(payloads: DataFrame, payload: str, year: int,
                  variables: list[str] = V.POPULATION_VARIABLES) -> DataFrame:
    """Rows of JSON arrays under a header row, twelve columns summed per row.

    A payload is an array of arrays whose first row names the columns.
    """
    parsed = payloads.select(F.from_json(payload, ROWS).alias("__rows")).filter(
        F.size("__rows") > 1)
    lines = parsed.select(F.col("__rows")[0].alias("__head"),
                          F.explode(F.slice("__rows", 2, F.size("__rows") - 1)).alias("__line"))
    at = lambda name: F.try_element_at(
        F.col("__line"), F.nullif(F.array_position("__head", name), F.lit(0)).cast("int"))
    total = reduce(add, [F.coalesce(to_number(at(v)), F.lit(0.0)) for v in variables])
    return lines.select(
        at("state").alias("state_fips"), at("NAME").alias("state_name"),
        F.lit(year).cast("int").alias("year"), total.cast("bigint").alias("pop_65plus"))


def state_population(long: DataFrame, source: str) -> DataFrame:
    """Attach state codes; rows whose FIPS code is no state are left out."""
    codes = {s[1]: s[0] for s in V.STATES if s[1]}
    return long.select(
        map_category(fips(), codes).alias("state_code"), "state_name",
        F.col("year").cast("int").alias("year"),
        F.col("pop_65plus").cast("bigint").alias("pop_65plus"),
        F.lit(source).alias("source"),
    ).filter(F.col("state_code").isNotNull())


def unmapped_states(long: DataFrame) -> DataFrame:
    """What ``state_population`` leaves out, for the run log."""
    codes = [s[1] for s in V.STATES if s[1]]
    return long.filter(~F.coalesce(fips().isin(codes), F.lit(False))).groupBy(
        "state_name").agg(F.count("*").alias("rows"))
