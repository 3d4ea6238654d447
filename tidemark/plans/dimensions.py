"""The six dimensions and the population reference.

``rows`` are canonical provider rows (text) with ``processing_date`` as the time
axis and position columns that give the order inside a period.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import fixed_values as V
from tidemark.functions import bands, clean
from tidemark.operators.lookups import lookup_join
from tidemark.operators.ordering import dense_key
from tidemark.operators.versions import add_member, prepend_unknown, scd1_latest, scd2_build
from tidemark.operators.votes import normalize_flag_domain

TIME = "processing_date"


def dim_date(spark: SparkSession, start: str = V.CALENDAR_START, end: str = V.CALENDAR_END) -> DataFrame:
    days = spark.range(1).select(F.explode(F.sequence(
        F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))).alias("full_date"))
    month = F.month("full_date")
    names = F.array(*[F.lit(m) for m in V.MONTH_NAMES_TH])
    calendar = days.select(
        clean.date_key("full_date").alias("date_key"), "full_date",
        F.year("full_date").alias("year"), F.quarter("full_date").alias("quarter"),
        month.alias("month"), names[month - 1].alias("month_name_th"),
        F.date_format("full_date", "yyyy-MM").alias("year_month"),
        (F.year("full_date") + (month >= 10).cast("int")).alias("us_fiscal_year"),
        covid_period(F.col("full_date")).alias("covid_period"),
    )
    return prepend_unknown(calendar, "date_key")


def covid_period(date):
    return (
        F.when(date <= F.lit(V.COVID_FIRST_DAY_AFTER).cast("date"), "Pre-COVID")
        .when(date <= F.lit(V.COVID_LAST_DAY).cast("date"), "COVID")
        .when(date.isNotNull(), "Post-COVID")
    )


PLACE = ["zip_code", "city", "state_code"]


def dim_geography(rows: DataFrame, position: list[str]) -> DataFrame:
    """One row per place: last known text, mean coordinates, state lookups."""
    keyed = located(rows, position)
    places = scd1_latest(keyed, PLACE, [TIME, *position],
                         ["county_parish", "urban_flag"], ["latitude", "longitude"])
    keyed = dense_key(described(places), place_order(), "geography_key")
    return prepend_unknown(keyed, "geography_key")


def place_order() -> list:
    return [F.col("state_code"), F.col("zip_code"), F.col("city").asc_nulls_last()]


def located(rows: DataFrame, position: list[str]) -> DataFrame:
    """Provider rows with a usable place."""
    return rows.select(
        *[c.alias(n) for n, c in clean.geography_key_columns().items()],
        clean.normalize_text("county_parish").alias("county_parish"), "urban_flag",
        clean.to_number("latitude").alias("latitude"),
        clean.to_number("longitude").alias("longitude"), TIME, *position,
    ).filter(F.col("zip_code").isNotNull() & F.col("state_code").isNotNull())


def described(places: DataFrame, *more: str) -> DataFrame:
    """Places with the names and regions of their states; ``more`` columns stay."""
    urban = clean.normalize_yes_no("urban_flag")
    return places.select(
        *more,
        "zip_code", "city", "county_parish", "state_code",
        clean.state_name(F.col("state_code")).alias("state_name"),
        clean.census_region(F.col("state_code")).alias("census_region"),
        F.when(urban, "Urban").when(~urban, "Rural").otherwise(V.UNKNOWN_LABEL).alias("urban_rural"),
        "latitude", "longitude",
    )


def unmapped_state_codes(geography: DataFrame) -> DataFrame:
    return geography.filter(
        (F.col("geography_key") != V.UNKNOWN_KEY) & (F.col("state_name") == V.UNKNOWN_LABEL)
    ).select("state_code").distinct()


def distinct_values(rows: DataFrame, column: str, key: str) -> DataFrame:
    """Sorted distinct known values of a text column, normalised, with a dense key; each spelling is normalised once."""
    spelled = rows.select(column).distinct()
    values = spelled.select(clean.normalize_text(column).alias(column)).filter(F.col(column).isNotNull()).distinct()
    return dense_key(values, [column], key)


def dim_ownership(rows: DataFrame) -> DataFrame:
    types = distinct_values(rows, "ownership_type", "ownership_key")
    grouped = types.withColumn("ownership_group", clean.ownership_group(F.col("ownership_type")))
    return prepend_unknown(
        grouped.withColumn("is_for_profit", F.col("ownership_group") == V.FOR_PROFIT),
        "ownership_key", is_for_profit=False)


def chains_seen(rows: DataFrame, position: list[str]) -> DataFrame:
    """Last known id and size of every chain named in the rows."""
    named = rows.select(
        clean.normalize_text("chain_name", upper=True).alias("chain_name"),
        clean.normalize_text("chain_id").alias("chain_id"),
        clean.to_whole("num_facilities_in_chain").alias("num_facilities_in_chain"),
        TIME, *position,
    ).filter(F.col("chain_name").isNotNull())
    return scd1_latest(named, ["chain_name"], [TIME, *position],
                       ["chain_id", "num_facilities_in_chain"])


def dim_chain(rows: DataFrame, position: list[str]) -> DataFrame:
    """One row per chain, key 0 for "in no chain", key -1 for "not known"."""
    keyed = banded(dense_key(chains_seen(rows, position), ["chain_name"], "chain_key"))
    with_independent = add_member(
        keyed, chain_key=V.INDEPENDENT_KEY, chain_name=V.INDEPENDENT_NAME,
        num_facilities_in_chain=1, chain_size_band=V.INDEPENDENT_BAND, is_independent=True)
    return prepend_unknown(with_independent, "chain_key", chain_id=None, is_independent=False)


def banded(chains: DataFrame) -> DataFrame:
    return chains.select(
        "chain_key", "chain_id", "chain_name",
        F.col("num_facilities_in_chain").cast("int").alias("num_facilities_in_chain"),
        bands.chain_band("num_facilities_in_chain").alias("chain_size_band"),
        F.lit(False).alias("is_independent"))


def dim_penalty_type(penalties: DataFrame | None, spark: SparkSession | None = None) -> DataFrame:
    """Penalty types seen; the two known ones where no period has the file."""
    if penalties is None:
        known = spark.createDataFrame([(V.FINE,), (V.DENIAL,)], "penalty_type string")
        penalties = known
    types = distinct_values(penalties, "penalty_type", "penalty_type_key")
    flagged = types.withColumn(
        "is_monetary", F.lower(F.trim("penalty_type")) == V.FINE.lower())
    return prepend_unknown(flagged, "penalty_type_key", is_monetary=False)


def facility_attributes(rows: DataFrame, position: list[str]) -> DataFrame:
    """The tracked attributes of every provider row, normalised."""
    focused = normalize_flag_domain(rows, "special_focus_status", "special_focus_status", [TIME])
    return focused.select(
        "ccn", TIME,
        clean.normalize_text("provider_name", upper=True).alias("provider_name"),
        clean.normalize_text("legal_business_name", upper=True).alias("legal_business_name"),
        clean.normalize_text("provider_type").alias("provider_type"),
        clean.normalize_yes_no("resides_in_hospital").alias("resides_in_hospital"),
        clean.normalize_yes_no("ccrc_flag").alias("ccrc_flag"),
        "special_focus_status",
        clean.normalize_yes_no("abuse_icon").alias("abuse_icon"),
        bands.bed_band(clean.to_number("certified_beds")).alias("bed_size_band"),
        *position,
    )


def dim_facility(rows: DataFrame, position: list[str]) -> DataFrame:
    versions = scd2_build(facility_attributes(rows, position), "ccn", TIME,
                          V.TRACKED_ATTRIBUTES, order=position)
    keyed = dense_key(versions, [F.col("ccn").asc_nulls_last(), "effective_date"], "facility_key")
    return prepend_unknown(keyed, "facility_key", is_current=False)


def build_dimensions(rows: DataFrame, penalties: DataFrame | None, position: list[str]) -> dict[str, DataFrame]:
    """All six dimensions. They are independent, so their jobs may overlap."""
    spark = rows.sparkSession
    builders = {
        "dim_date": lambda: dim_date(spark),
        "dim_facility": lambda: dim_facility(rows, position),
        "dim_geography": lambda: dim_geography(rows, position),
        "dim_ownership": lambda: dim_ownership(rows),
        "dim_chain": lambda: dim_chain(rows, position),
        "dim_penalty_type": lambda: dim_penalty_type(penalties, spark),
    }
    with ThreadPoolExecutor(len(builders)) as pool:
        return dict(zip(builders, pool.map(lambda build: build(), builders.values())))


def calendar_of(frame: DataFrame, date: str, calendar: DataFrame) -> DataFrame:
    """Attach calendar attributes by date key; unparsed dates get the -1 row."""
    keyed = frame.withColumn("date_key", clean.date_key(date))
    return lookup_join(keyed, calendar, "date_key", "inner")
