"""Domain frames derived from the driver's tables, with the DataFrame API.

supplier = facility, ship quarter = period, nation = state, returned and
discounted line items = penalties seen through a three-year rolling window.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark import fixed_values as V
from tidemark.functions import clean
from tidemark.operators.dedup import EventColumns, window_dedup
from tidemark.operators.lookups import lookup_join
from tidemark.plans import dimensions, facts, publish, semantic
from tidemark.plans.dimensions import covid_period
from tidemark.plans.increments import extend_warehouse
from tidemark.plans.roster import facility_roster
from tidemark.session import scratch_path, stored, tune
from tidemark.sources.text import era_columns

SIGHTING_POSITION = ("l_orderkey", "l_linenumber", "l_partkey", "cents")
SIGHTING = EventColumns(position=SIGHTING_POSITION)
SLICE_EVENTS = 1 << 17      # events whose sightings, up to twelve each, a task sorts and writes as text


def text(c):
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def padded(c, width):
    return F.lpad(text(c), width, "0")


class Frames:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tune(spark), folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- facilities and periods --------------------------------------------------

    @cached_property
    def panel(self) -> DataFrame:
        """One row per supplier and ship quarter, from integer sums."""
        cents = lambda c: F.round(F.col(c) * 100).cast("bigint")
        returned = F.col("l_returnflag") == "R"
        quantity = F.col("l_quantity").cast("bigint")
        lines = self.table("lineitem")
        grouped = lines.groupBy(
            "l_suppkey", F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("period")).agg(
                F.count("*").alias("n"), F.sum(quantity).alias("beds"),
                F.sum(F.when(~returned, quantity)).alias("residents"),
                F.sum(cents("l_discount")).alias("d"), F.sum(cents("l_tax")).alias("t"),
                F.sum(F.when(returned, 1).otherwise(0)).alias("deficiencies"))
        supplier = self.table("supplier").select("s_suppkey", "s_nationkey")
        nation = self.table("nation").select("n_nationkey", "n_name", "n_regionkey")
        region = self.table("region")
        joined = (
            grouped.join(supplier, F.col("s_suppkey") == F.col("l_suppkey"))
            .join(nation, F.col("n_nationkey") == F.col("s_nationkey"))
            .join(region, F.col("r_regionkey") == F.col("n_regionkey")))
        n, d, t = F.col("n"), F.col("d").cast("double"), F.col("t").cast("double")
        period, sk = F.col("period"), F.col("l_suppkey")
        date = lambda s: F.lit(s).cast("date")
        return joined.select(
            padded("l_suppkey", 6).alias("ccn"), "period",
            clean.date_key("period").alias("snapshot_date_key"), "beds", "residents",
            F.when(n % 7 != 0, d * 0.8 / n).alias("nurse_hprd"),
            F.when(n % 7 != 0, d * 0.2 / n).alias("rn_hprd"),
            F.when((period >= date("1997-01-01")) & (n % 9 != 0), t * 11.5 / n).alias("turnover_pct"),
            F.when(n % 11 != 0, 1 + n % 5).alias("overall_rating"),
            F.when(n % 13 != 0, 1 + F.col("d") % 5).alias("health_inspection_rating"),
            "deficiencies",
            (F.col("residents") * 1.0 > F.lit(0.85) * F.col("beds")).alias("is_suspect"),
            F.col("n_name").alias("state_code"), F.col("r_name").alias("census_region"),
            F.when(sk % 3 == 0, "For profit").when(sk % 3 == 1, "Non profit")
            .otherwise("Government").alias("ownership_group"),
            F.when(period >= date("1999-01-01"), F.when(sk % 4 == 0, "Independent (1)")
                   .when(sk % 4 == 1, "Small chain (2-9)").when(sk % 4 == 2, "Medium chain (10-49)")
                   .otherwise("Large chain (50+)")).alias("chain_size_band"),
        )

    @cached_property
    def facility(self) -> DataFrame:
        """The flat facility view as a stored table by period, as questions read it."""
        return stored(self.facility_rows, "facility", "snapshot_date_key")

    @cached_property
    def facility_rows(self) -> DataFrame:
        """The flat facility view over the panel."""
        sk, period, defic = F.col("ccn").cast("bigint"), F.col("period"), F.col("deficiencies")
        group = F.when((period >= F.lit("2000-01-01").cast("date")) & (sk % 10 == 7), "Government").otherwise(
            F.col("ownership_group"))
        kind = (
            F.when(group == "For profit", F.when(defic % 2 == 0, "For profit - Corporation")
                   .otherwise("For profit - Partnership"))
            .when(group == "Non profit", F.lit("Non profit - Corporation"))
            .otherwise(F.when(defic % 3 == 0, "Government - City").otherwise("Government - County")))
        band = F.coalesce("chain_size_band", F.lit("Unknown"))
        chain = (
            F.when(band == "Unknown", "Unknown")
            .when(band == "Independent (1)", "Independent (no chain)")
            .otherwise(F.concat(F.lit("CHAIN "), text(sk % 12))))
        return self.panel.select(
            "snapshot_date_key", period.alias("snapshot_date"), F.year(period).alias("snapshot_year"),
            F.date_format(period, "yyyy-MM").alias("snapshot_year_month"),
            covid_period(period).alias("covid_period"), "ccn",
            F.concat(F.lit("FACILITY "), F.col("ccn")).alias("provider_name"),
            F.when(defic > 10, "SFF").when(defic == 10, "SFF Candidate").otherwise("None").alias("special_focus_status"),
            (defic % 2 == 0).alias("abuse_icon"), "state_code",
            F.concat(F.lit("State of "), F.col("state_code")).alias("state_name"), "census_region",
            kind.alias("ownership_type"), group.alias("ownership_group"),
            (group == "For profit").alias("is_for_profit"), chain.alias("chain_name"),
            band.alias("chain_size_band"), (band == "Independent (1)").alias("is_independent"),
            F.col("beds").alias("certified_beds"),
            F.col("residents").cast("double").alias("avg_residents_per_day"),
            (F.col("residents") * clean.days_in_month(period)).cast("double").alias("resident_days"),
            F.col("nurse_hprd").alias("reported_total_nurse_hprd"),
            F.col("rn_hprd").alias("reported_rn_hprd"),
            F.col("turnover_pct").alias("total_nursing_turnover_pct"), "overall_rating",
            (1 + F.col("beds") % 5).alias("staffing_rating"), "health_inspection_rating",
            defic.alias("cycle1_total_deficiencies"),
            F.coalesce("is_suspect", F.lit(False)).alias("is_suspect"),
        )

    @cached_property
    def attrs(self) -> DataFrame:
        beds, defic, period = F.col("beds"), F.col("deficiencies"), F.col("period")
        return self.panel.select(
            "ccn", "period",
            F.when(beds < 450, "small").when(beds < 600, "medium").otherwise("large").alias("size_band"),
            F.when(defic % 4 == 0, None).when(defic > 8, "SFF").otherwise("None").alias("focus"),
            F.when(period >= F.lit("1997-01-01").cast("date"), defic % 2 == 0).alias("icon"))

    @cached_property
    def provider(self) -> DataFrame:
        """Canonical provider rows as text, with repeated facilities."""
        sk, beds, defic, period = (F.col("ccn").cast("bigint"), F.col("beds"), F.col("deficiencies"),
                                   F.col("period"))
        day = lambda s: F.lit(s).cast("date")
        no_column_before = lambda s, c: F.when(period >= day(s), c)
        turnover = 30 + beds % 50
        rows = self.panel.select(
            period.alias("processing_date"), sk.alias("source_row"), "ccn",
            F.concat(F.lit(" Facility  "), "ccn", F.when(beds % 7 == 0, " Home").otherwise(" home")).alias("provider_name"),
            F.when(beds % 4 != 0, F.concat(F.lit("Owner "), text(
                sk % 5 + F.when(period >= day("1999-01-01"), 1).otherwise(0)))).alias("legal_business_name"),
            F.when(sk % 5 == 0, "Medicare").otherwise("Medicare and Medicaid").alias("provider_type"),
            F.when(sk % 7 == 0, "Y").otherwise("N").alias("resides_in_hospital"),
            F.when(defic % 5 == 0, "maybe").when(sk % 3 == 0, " yes").otherwise("0").alias("ccrc_flag"),
            no_column_before("1997-01-01", F.when(defic > 10, "SFF").when(defic == 10, "Y")
                             .when(defic % 2 == 0, F.lit(None)).otherwise("N")).alias("special_focus_status"),
            no_column_before("1997-01-01", F.when(defic % 3 == 0, "Y").when(defic % 3 == 1, "N")).alias("abuse_icon"),
            text(F.floor(beds / 5)).alias("certified_beds"),
            F.concat(text(F.floor(F.col("residents") / 5)), F.lit(".5")).alias("avg_residents_per_day"),
            F.concat(text(2 + beds % 4), F.lit("."), padded(defic * 7 % 100, 2)).alias("reported_total_nurse_hprd"),
            F.concat(F.lit("0."), padded(beds % 100, 2)).alias("reported_rn_hprd"),
            no_column_before("1997-01-01", F.when(beds % 31 == 0, "250")
                             .when(F.year(period) % 3 == 0, F.concat(F.lit("0."), text(turnover)))
                             .otherwise(F.concat(text(turnover), F.lit(" %")))).alias("total_nursing_turnover_pct"),
            text("overall_rating").alias("overall_rating"),
            text(1 + beds % 5).alias("staffing_rating"),
            text("health_inspection_rating").alias("health_inspection_rating"),
            text(defic).alias("cycle1_total_deficiencies"),
            F.when(sk % 2 == 0, text(1000 + sk % 40)).otherwise(
                F.concat(text(20000 + sk % 40), F.lit("-1234"))).alias("zip_code"),
            F.when(F.month(period) == 1, F.concat(F.lit(" springfield  "), text(sk % 4)))
            .otherwise(F.concat(F.lit("Springfield "), text(sk % 4))).alias("city"),
            F.when(sk % 6 == 0, "AL").when(sk % 6 == 1, "ca ").when(sk % 6 == 2, " NY")
            .when(sk % 6 == 3, "TX").when(sk % 6 == 4, "PR").otherwise("ZZ").alias("state_code"),
            F.when(beds % 3 != 0, F.concat(F.lit("County "), text(beds % 5))).alias("county_parish"),
            no_column_before("1998-01-01", F.when(sk % 3 == 0, "Y").when(sk % 3 == 1, "n").otherwise("?")).alias("urban_flag"),
            F.concat(text(30 + sk % 20), F.lit("."), text(beds % 10)).alias("latitude"),
            F.concat(F.lit("-"), text(80 + sk % 20), F.lit("."), text(beds % 10)).alias("longitude"),
            F.when((period >= day("2000-01-01")) & (sk % 4 == 1), "Government - State")
            .when(sk % 5 == 0, "For profit -  Corporation").when(sk % 5 == 1, "Non profit - Other")
            .when(sk % 5 == 2, "Government - City/county").when(sk % 5 == 3, "For profit - Individual")
            .otherwise("Tribal").alias("ownership_type"),
            no_column_before("1999-01-01", F.when(sk % 4 != 0, F.concat(
                F.when(beds % 2 == 0, " chain ").otherwise("CHAIN  "), text(sk % 9)))).alias("chain_name"),
            no_column_before("1999-01-01", F.when(beds % 3 != 0, text(100 + sk % 9))).alias("chain_id"),
            no_column_before("1999-01-01", text((sk % 9) * 8 + F.when(
                period >= day("2000-01-01"), 1).otherwise(0))).alias("num_facilities_in_chain"),
        )
        again = rows.filter((F.col("source_row") % 23 == 5)).withColumns({
            "source_row": F.col("source_row") + 1_000_000_000, "certified_beds": F.lit("1"),
            "provider_name": F.lit("Repeated")})
        return rows.unionByName(again)

    # --- penalties ----------------------------------------------------------------

    @cached_property
    def sighting(self) -> DataFrame:
        """Every event in each of the twelve quarters whose window covers it."""
        return self._sightings_of(self._penalized)

    @property
    def _penalized(self) -> DataFrame:
        return self.table("lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_discount") >= 0.07))

    def _sightings_of(self, events: DataFrame) -> DataFrame:
        """The quarters follow from the ship date by arithmetic; only those that are periods of the panel are kept."""
        shipped = F.col("l_shipdate").cast("date")
        quarter = F.to_date(F.date_trunc("quarter", "l_shipdate"))
        periods = self.table("lineitem").select(quarter.alias("period")).distinct()
        seen = events.select(
            "*", F.explode(F.sequence(F.add_months(quarter, 3), F.add_months(quarter, 36),
                                      F.expr("interval 3 months"))).alias("period"))
        seen = lookup_join(seen, periods, "period", "left_semi")
        denial = F.col("l_linenumber") % 4 == 0
        order, period = F.col("l_orderkey"), F.col("period")
        day = lambda s: F.lit(s).cast("date")
        price = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        return seen.select(
            "period", padded("l_suppkey", 6).alias("ccn"),
            F.date_add(shipped, F.when((order % 17 == 0) & (period >= day("2000-07-01")), 1).otherwise(0)).alias("penalty_date"),
            F.when(denial, "Payment Denial").otherwise("Fine").alias("penalty_type"),
            F.when(~denial & (period >= day("2000-01-01")), F.concat_ws(
                "-", text(order), text("l_linenumber"), text("l_partkey"), text(price))).alias("fine_id"),
            F.when(~denial, F.round("l_extendedprice").cast("bigint") + F.when(
                order % 5 == 0, F.year(period).cast("bigint") - 1995).otherwise(0)).alias("fine_amount_usd"),
            F.when(denial, F.col("l_quantity").cast("bigint")).alias("payment_denial_days"),
            "l_orderkey", "l_linenumber", "l_partkey", price.alias("cents"),
        ).withColumnRenamed("period", "stamp")

    @cached_property
    def staged_sighting(self) -> DataFrame:
        """Sightings as a stored staging table, as rows parsed from files would be."""
        return stored(self.sighting, "sighting", spread=False)

    @cached_property
    def events(self) -> DataFrame:
        """Events after dedup, stored: the flat view and the fact both start here."""
        return stored(window_dedup(self.staged_sighting, SIGHTING), "events")

    @cached_property
    def penalty(self) -> DataFrame:
        """The flat penalty view as a stored table by penalty year."""
        return stored(self.penalty_rows, "penalty", "penalty_year")

    @cached_property
    def penalty_rows(self) -> DataFrame:
        """The flat penalty view: events after dedup, attributes of the kept period."""
        at = self.facility_rows.select(
            "ccn", F.col("snapshot_date").alias("stamp"), "provider_name", "state_code", "state_name",
            "census_region", "ownership_group", "chain_name", "chain_size_band")
        unknown = F.lit("Unknown")
        labels = [c for c in at.columns if c not in ("ccn", "stamp")]
        date = F.col("penalty_date")
        return self.events.join(at, ["ccn", "stamp"], "left").select(
            date, F.year(date).alias("penalty_year"), F.quarter(date).alias("penalty_quarter"),
            "stamp", "ccn", *[F.coalesce(c, unknown).alias(c) for c in labels], "penalty_type",
            (F.col("penalty_type") == "Fine").alias("is_monetary"), "fine_id", "fine_id_source",
            "fine_amount_usd", "payment_denial_days", F.lit(1).cast("bigint").alias("penalty_count"))

    @cached_property
    def population(self) -> DataFrame:
        people = self.table("customer").join(
            self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        counts = people.groupBy(F.col("n_name").alias("state_code")).agg(
            (F.count("*") * 1000).alias("pop_65plus"))
        return counts.select(
            "state_code", F.explode(F.array(*[F.lit(y) for y in (1998, 1999, 2000)])).alias("year"),
            "pop_65plus")

    # --- dirty text ---------------------------------------------------------------

    @cached_property
    def raw(self) -> DataFrame:
        key, cust, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
        whole = text(F.round("o_totalprice").cast("bigint"))
        month, dom, year = text(F.month(day)), text(F.dayofmonth(day)), text(F.year(day))
        return self.table("orders").select(
            F.year(day).cast("bigint").alias("batch"), key.alias("source_row"),
            F.when(cust % 3 == 0, text(cust)).when(cust % 3 == 1, F.concat(F.lit(" "), padded(cust, 6), F.lit(" ")))
            .otherwise(F.concat(F.lit("12345"), text(cust))).alias("id_text"),
            F.when(key % 9 == 0, "").when(key % 9 == 1, "n/a").when(key % 9 == 2, F.concat(whole, F.lit(" %")))
            .otherwise(F.concat(F.lit("$"), whole)).alias("number_text"),
            F.when(key % 50 == 0, "unknown").when(F.year(day) % 2 == 0, F.concat_ws("/", month, dom, year))
            .otherwise(F.concat_ws("/", dom, month, year)).alias("date_text"),
            F.when(F.year(day) >= 1997, F.when(F.col("o_orderstatus") == "F", "Y")
                   .when(F.col("o_orderstatus") == "O", " n ").otherwise("")).alias("flag_text"),
            F.concat(F.lit("  "), "o_orderpriority", F.when(key % 2 == 0, "   x").otherwise(" X")).alias("label_text"),
            F.when(F.year(day) % 3 == 0, (key % 97).cast("double") / 100.0)
            .otherwise((key % 97).cast("double")).alias("drifting_pct"))

    # --- the star -------------------------------------------------------------------

    @cached_property
    def staged_provider(self) -> DataFrame:
        """Provider rows as a stored staging table: read by many rules below."""
        return stored(self.provider, "provider", spread=False)

    @cached_property
    def dims(self) -> dict[str, DataFrame]:
        """Dimensions stored before any fact refers to their keys."""
        built = dimensions.build_dimensions(self.staged_provider, self.staged_sighting, ["source_row"])
        with ThreadPoolExecutor(len(built)) as pool:
            return dict(zip(built, pool.map(stored, built.values(), built)))

    @cached_property
    def fact_snapshot(self) -> DataFrame:
        return stored(self.fact_snapshot_rows, "fact_snapshot", "snapshot_date_key")

    @cached_property
    def fact_penalty(self) -> DataFrame:
        return stored(self.fact_penalty_rows, "fact_penalty")

    @property
    def fact_snapshot_rows(self) -> DataFrame:
        return facts.fact_snapshot(self.staged_provider, self.dims, ["source_row"])

    @property
    def fact_penalty_rows(self) -> DataFrame:
        attributes = facts.attributes_at(self.staged_provider, self.dims, ["source_row"])
        return facts.penalty_fact_of(self.events, attributes, self.dims, SIGHTING)

    @property
    def star_facility(self) -> DataFrame:
        """The facility view of the star: the snapshot fact joined with its dimensions."""
        return semantic.facility_view(self.fact_snapshot, self.dims)

    @property
    def star_penalty(self) -> DataFrame:
        return semantic.penalty_view(self.fact_penalty, self.dims)

    @cached_property
    def snapshots(self) -> str:
        """Text snapshots of the provider and sighting rows.

        One folder per period, one file per kind, in the newest layout. The names
        of a fifth of the facilities hold a quoted line break. The impossible
        turnover of the fixture is 0 here, flagged but let through by the checks.

        An event is in twelve files, so events are dealt out by their place in the
        files, and their sightings are written by the tasks that hold them: a file of
        many events has a part per slice of places.
        """
        source = scratch_path(self.spark, "snapshots")
        broken = F.when(F.col("source_row") % 5 == 0, F.regexp_replace("provider_name", "  ", "\n")).otherwise(F.col("provider_name"))
        rows = self.staged_provider.withColumns({"provider_name": broken, "__period": F.col("processing_date"), "total_nursing_turnover_pct": F.when(
            F.col("total_nursing_turnover_pct") == "250", "0").otherwise(F.col("total_nursing_turnover_pct"))})
        self._write_text(rows.repartition("__period"), "provider_info", ["source_row"], source, "NH_ProviderInfo_Jun2026.csv")
        events = stored(self._penalized, "penalized", spread=False)
        slices = max(1, -(-events.count() // SLICE_EVENTS))
        price = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        seen = self._sightings_of(events.repartitionByRange(slices, "l_orderkey", "l_linenumber", "l_partkey", price))
        seen = seen.withColumn("__period", F.col("stamp")).withColumn("processing_date", F.col("stamp"))
        self._write_text(seen, "penalties", list(SIGHTING_POSITION), source, "NH_Penalties_Jun2026.csv")
        return source

    @cached_property
    def published(self) -> str:
        """Root of a warehouse built from all text snapshots at once."""
        root = scratch_path(self.spark, "warehouse")
        publish.build_warehouse(self.spark, self.snapshots, root, "run-1", "2026-01-01T00:00:00")
        return root

    @cached_property
    def grown(self) -> str:
        """Root of a warehouse that the same snapshots were merged into in three goes."""
        root = scratch_path(self.spark, "grown")
        for go, until in enumerate(("1994-12-31", "1998-06-30", None)):
            extend_warehouse(self.spark, self.snapshots, root, f"go-{go}", "2026-01-01T00:00:00", until=until)
        return root

    def _write_text(self, rows: DataFrame, logical: str, order: list[str], root: str, name: str) -> None:
        """``root/<period>/<name>`` for every period, in row order, under the newest headers.

        A task's rows become one part of each file; all tasks with rows of a period hold
        them in the order of the tasks. A file with a single part is that part.
        """
        header = era_columns(logical, V.ERA_NAMES[0])
        folder = scratch_path(self.spark, "text")
        shown = [(F.col(c) if c in rows.columns else F.lit(None)).cast("string").alias(h) for c, h in header.items()]
        # the writer keeps the order of rows that are sorted by its partition column as it is written
        named = rows.withColumn("__period", F.col("__period").cast("string"))
        named.sortWithinPartitions("__period", *order).select("__period", *shown).write.partitionBy("__period").option("header", True).option(
            "encoding", V.TEXT_ENCODING).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False).csv(folder)
        # one small catalogue step per period: give the files the names a publisher gives them
        paths = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        system = paths(folder).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for file in system.globStatus(paths(f"{folder}/__period=*")):
            period = file.getPath().getName().split("=", 1)[1]
            parts = system.globStatus(paths(f"{folder}/__period={period}/part-*"))
            system.mkdirs(paths(f"{root}/{period}"))
            system.rename(parts[0].getPath() if len(parts) == 1 else file.getPath(), paths(f"{root}/{period}/{name}"))

    @lru_cache(maxsize=8)
    def roster(self, period: int | None = None) -> DataFrame:
        """One row per facility of a period, stored: questions pass over it often."""
        return stored(facility_roster(self.facility, self.penalty, period), "roster")


@lru_cache(maxsize=4)
def _frames(spark: SparkSession, folder: str, application: str) -> Frames:
    return Frames(spark, folder)


def frames(spark: SparkSession, folder: str) -> Frames:
    """Frames of a folder; stored tables are built once per application."""
    return _frames(spark, folder, spark.sparkContext.applicationId)
