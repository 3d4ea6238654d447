"""Data-quality checks. Every check is a metrics frame:

rule, target, rows_checked, violations, detail. A gate collects the few metric
rows and refuses to publish when any violation is left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidemark import fixed_values as V
from tidemark.functions.measures import count_where, divide, zero_sum
from tidemark.operators.lookups import join_unique

PRIMARY_KEYS = {
    "dim_date": ["date_key"], "dim_facility": ["facility_key"], "dim_geography": ["geography_key"],
    "dim_ownership": ["ownership_key"], "dim_chain": ["chain_key"],
    "dim_penalty_type": ["penalty_type_key"], "fact_snapshot": ["snapshot_date_key", "ccn"],
    "fact_penalty": ["penalty_event_key"], "ref_state_population": ["state_code", "year"],
}
NATURAL_KEYS = {
    "dim_date": ["full_date"], "dim_facility": ["ccn", "effective_date"],
    "dim_geography": ["zip_code", "city", "state_code"], "dim_ownership": ["ownership_type"],
    "dim_chain": ["chain_name"], "dim_penalty_type": ["penalty_type"],
}
FOREIGN_KEYS = {
    "fact_snapshot": {
        "snapshot_date_key": ("dim_date", "date_key"), "facility_key": ("dim_facility", "facility_key"),
        "geography_key": ("dim_geography", "geography_key"),
        "ownership_key": ("dim_ownership", "ownership_key"), "chain_key": ("dim_chain", "chain_key")},
    "fact_penalty": {
        "penalty_date_key": ("dim_date", "date_key"), "facility_key": ("dim_facility", "facility_key"),
        "geography_key": ("dim_geography", "geography_key"),
        "ownership_key": ("dim_ownership", "ownership_key"), "chain_key": ("dim_chain", "chain_key"),
        "penalty_type_key": ("dim_penalty_type", "penalty_type_key")},
}


def metric(frame: DataFrame, rule: str, target: str, rows: Column, violations: Column,
           detail: Column | None = None) -> DataFrame:
    """One metric row from a global aggregate."""
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return frame.agg(
        zero(rows).alias("rows_checked"), zero(violations).alias("violations"),
        (detail if detail is not None else F.lit("")).cast("string").alias("detail"),
    ).select(F.lit(rule).alias("rule"), F.lit(target).alias("target"),
             "rows_checked", "violations", "detail")


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


# --- keys ---------------------------------------------------------------------

def check_unique(frame: DataFrame, keys: list[str], target: str, rule: str = "unique") -> DataFrame:
    """Rows beyond the first of every key; null key values compare equal."""
    groups = frame.groupBy(*keys).agg(F.count("*").alias("n"))
    return metric(groups, rule, f"{target}({','.join(keys)})", F.sum("n"), F.sum(F.col("n") - 1))


def check_not_null(frame: DataFrame, keys: list[str], target: str) -> DataFrame:
    some_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return metric(frame, "not_null", f"{target}({','.join(keys)})", F.count("*"),
                  count_where(some_null))


def set_counts(frame: DataFrame, sets: list[list[str]]) -> tuple[DataFrame, list[int]]:
    """Rows of every value of several sets of columns, from one scan of the frame, and the number that names each set.

    Rows have ``__set``, ``n`` and all columns, those outside the set null.
    """
    columns = list(dict.fromkeys(c for one in sets for c in one))
    named = [sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in one) for one in sets]
    chosen = [list(one) for one in dict.fromkeys(tuple(one) for one in sets)]
    return frame.select(*columns).groupingSets(chosen, *columns).agg(
        F.grouping_id(*columns).cast("int").alias("__set"), F.count("*").alias("n")), named


def _rule_rows(frame: DataFrame, rules: list[tuple], counted: DataFrame) -> DataFrame:
    """A metric row per rule ``(rule, target, set, figure)``; a table without rows has zeros."""
    listed = frame.sparkSession.createDataFrame(rules, "rule string, target string, __set int, figure string")
    figures = [c for c in counted.columns if c not in ("__set", "rows", "detail")]
    picked = F.coalesce(*[F.when(F.col("figure") == c, F.col(c)) for c in figures], F.lit(0)).cast("bigint")
    detail = F.col("detail") if "detail" in counted.columns else F.lit("")
    # a row per set of columns
    return listed.join(F.broadcast(counted), "__set", "left").select(
        "rule", "target", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows_checked"), picked.alias("violations"), detail.alias("detail"))


def check_table_keys(frame: DataFrame, name: str) -> DataFrame:
    """Primary key unique and known, natural key unique: all from one scan of the table."""
    keys = {rule: of[name] for rule, of in (("primary_key", PRIMARY_KEYS), ("natural_key", NATURAL_KEYS)) if name in of}
    grouped, named = set_counts(frame, list(keys.values()))
    lacking = F.lit(False)
    for number, columns in zip(named, keys.values()):
        lacking = F.when(F.col("__set") == number, reduce(lambda a, b: a | b, [F.col(k).isNull() for k in columns])).otherwise(lacking)
    counted = grouped.groupBy("__set").agg(F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("surplus"), F.sum(F.when(lacking, F.col("n"))).alias("lacking"))
    rules = []
    for number, (rule, columns) in zip(named, keys.items()):
        target = f"{name}({','.join(columns)})"
        rules.append((rule, target, number, "surplus"))
        if rule == "primary_key":
            rules.append(("not_null", target, number, "lacking"))
    return _rule_rows(frame, rules, counted)


def check_keys(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([check_table_keys(frame, name) for name, frame in tables.items() if name in PRIMARY_KEYS or name in NATURAL_KEYS])


def fk_orphans(fact: DataFrame, dim: DataFrame, column: str, key: str, target: str) -> DataFrame:
    """Fact rows without a member, and rows at Unknown."""
    return _orphans(fact, {column: (dim, key)}, lambda _: target)


def _orphans(fact: DataFrame, keys: dict[str, tuple[DataFrame, str]], target) -> DataFrame:
    """The same for all foreign keys of a fact from one scan.

    The fact is reduced to the distinct values of every key first, so a hot key is one row.
    """
    grouped, named = set_counts(fact, [[c] for c in keys])
    value = F.coalesce(*[F.when(F.col("__set") == n, F.col(c)) for n, c in zip(named, keys)])
    used = grouped.select("__set", value.alias("__k"), "n")
    members = union_all([dim.select(F.lit(n).alias("__set"), F.col(key).alias("__k"), F.lit(True).alias("__member"))
                         for n, (dim, key) in zip(named, keys.values())])
    joined = join_unique(used, members, ["__set", "__k"])
    counted = joined.groupBy("__set").agg(
        F.sum("n").alias("rows"), F.sum(F.when(F.col("__member").isNull(), F.col("n"))).alias("orphans"),
        F.concat(zero_sum(F.when(F.col("__k") == V.UNKNOWN_KEY, F.col("n"))).cast("string"), F.lit(" at Unknown")).alias("detail"))
    rows = _rule_rows(fact, [("fk", target(c), n, "orphans") for n, c in zip(named, keys)], counted)
    return rows.withColumn("detail", F.coalesce("detail", F.lit("0 at Unknown")))


def check_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    return union_all([
        _orphans(tables[fact], {c: (tables[dim], key) for c, (dim, key) in keys.items()}, lambda c, fact=fact: f"{fact}.{c}")
        for fact, keys in FOREIGN_KEYS.items() if fact in tables])


# --- versions -------------------------------------------------------------------

def scd2_check(versions: DataFrame, key: str = "ccn", effective: str = "effective_date",
               expiry: str = "expiry_date", current: str = "is_current",
               target: str = "dim_facility") -> DataFrame:
    """At most one current version per member, closed versions end, no overlap."""
    line = W.partitionBy(key).orderBy(effective)
    overlaps = F.coalesce(F.col(effective) < F.lag(expiry).over(line), F.lit(False))
    members = versions.withColumn("__overlap", overlaps).groupBy(key).agg(
        F.count("*").alias("n"), count_where(F.col(current)).alias("__current"),
        count_where(~F.col(current) & F.col(expiry).isNull()).alias("__open"),
        count_where(F.col("__overlap")).alias("__overlaps"))
    problems = {
        "scd2_one_current": F.sum(F.when(F.col("__current") > 1, 1)),
        "scd2_closed_has_expiry": F.sum("__open"),
        "scd2_no_overlap": F.sum("__overlaps"),
    }
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    wide = members.agg(zero(F.sum("n")).alias("rows_checked"), F.count("*").cast("string").alias("m"),
                       *[zero(c).alias(r) for r, c in problems.items()])
    return wide.unpivot(["rows_checked", "m"], list(problems), "rule", "violations").select(
        "rule", F.lit(target).alias("target"), "rows_checked", "violations",
        F.concat("m", F.lit(" members")).alias("detail"))


# --- CHECK constraints -----------------------------------------------------------

def _between(column, low, high):
    return F.col(column).between(low, high)


def rules_of(table: str) -> dict[str, Column]:
    """Predicates a table must satisfy; a null predicate passes."""
    c = F.col
    return {
        "dim_date": {
            "quarter_range": _between("quarter", 1, 4), "month_range": _between("month", 1, 12)},
        "dim_facility": {"range_forward": c("expiry_date") > c("effective_date")},
        "dim_geography": {
            "zip_width": (c("geography_key") == V.UNKNOWN_KEY) | (F.length("zip_code") == V.ZIP_WIDTH),
            "latitude": _between("latitude", -90, 90), "longitude": _between("longitude", -180, 180)},
        "dim_ownership": {
            "known_group": c("ownership_group").isin(V.OWNERSHIP_ORDER + [V.UNKNOWN_LABEL])},
        "dim_chain": {"size_nonneg": c("num_facilities_in_chain") >= 0},
        "ref_state_population": {"positive": c("pop_65plus") > 0},
        "fact_snapshot": {
            "overall_rating_range": _between("overall_rating", 1, 5),
            "staffing_rating_range": _between("staffing_rating", 1, 5),
            "health_rating_range": _between("health_inspection_rating", 1, 5),
            "beds_nonneg": c("certified_beds") >= 0,
            "residents_nonneg": c("avg_residents_per_day") >= 0,
            "turnover_is_percent": _between("total_nursing_turnover_pct", 0, 200)},
        "fact_penalty": {
            "count_is_one": c("penalty_count") == 1, "fine_nonneg": c("fine_amount_usd") >= 0,
            "denial_days_nonneg": c("payment_denial_days") >= 0,
            "fine_id_source_known": c("fine_id_source").isin("fine_id", "natural_key")},
    }[table]


def check_rules(frame: DataFrame, table: str, rules: dict[str, Column] | None = None) -> DataFrame:
    """All rules of a table in one pass."""
    rules = rules_of(table) if rules is None else rules
    wide = frame.agg(F.count("*").alias("rows_checked"),
                     *[count_where(~predicate).alias(name) for name, predicate in rules.items()])
    return wide.unpivot("rows_checked", list(rules), "rule", "violations").select(
        "rule", F.lit(table).alias("target"), "rows_checked", "violations", F.lit("").alias("detail"))


# --- whole-table invariants --------------------------------------------------------

def check_population(population: DataFrame) -> DataFrame:
    """(state, year) unique, enough states, and a plausible national total."""
    latest = population.filter(F.col("year") == population.agg(F.max("year")).scalar())
    counted = latest.filter(F.col("state_code") != V.POPULATION_OUTSIDE_TOTAL)
    low, high = V.POPULATION_TOTAL_RANGE
    total = F.coalesce(F.sum("pop_65plus"), F.lit(0))
    states = F.count_distinct("state_code")
    return union_all([
        check_unique(population, ["state_code", "year"], "ref_state_population"),
        metric(latest, "enough_states", "ref_state_population", F.count("*"),
               (states < V.POPULATION_MIN_STATES).cast("int"),
               F.concat(states.cast("string"), F.lit(" states"))),
        metric(counted, "plausible_total", "ref_state_population", F.count("*"),
               (~((total > low) & (total < high))).cast("int"), total.cast("string")),
    ])


def key_version_check(facts: DataFrame, dims: DataFrame, version: str = "key_version") -> DataFrame:
    """Facts built on another numbering of the dimensions than the published one."""
    current = dims.agg(F.max(version)).scalar()
    return facts.groupBy(version).agg(F.count("*").alias("fact_rows")).withColumn(
        "stale", ~F.col(version).eqNullSafe(current))


def refuse_stale(facts: DataFrame, dims: DataFrame, version: str = "key_version") -> DataFrame:
    """The facts, or an error when any row refers to other surrogate keys."""
    if not key_version_check(facts, dims, version).filter("stale").isEmpty():
        raise ValueError("facts were built on other surrogate keys; rebuild them first")
    return facts


def unexpected_columns(frame: DataFrame, names: list[str]) -> list[str]:
    return sorted(set(frame.columns) - set(names))


def conform(frame: DataFrame, names: list[str], table: str) -> DataFrame:
    """Exactly the declared columns, in order; a surprise fails by name."""
    extra, absent = unexpected_columns(frame, names), sorted(set(names) - set(frame.columns))
    if extra or absent:
        raise ValueError(f"{table}: unexpected columns {extra}, absent columns {absent}")
    return frame.select(*names)


def canary(facility: DataFrame, ccn: str, period: int, expected: dict[str, float],
           tolerance: float = 5e-4) -> DataFrame:
    """A named facility and period must show known values; absence is a violation."""
    row = facility.filter((F.col("ccn") == ccn) & (F.col("snapshot_date_key") == period))
    wide = row.agg(
        F.count("*").alias("rows_checked"),
        F.max("certified_beds").cast("double").alias("beds"),
        F.max("avg_residents_per_day").cast("double").alias("residents"),
        F.max(divide(F.col("avg_residents_per_day"), F.col("certified_beds"))).alias("occupancy"),
        F.max("resident_days").cast("double").alias("resident_days"),
        F.max(F.col("is_suspect").cast("double")).alias("suspect"))
    long = wide.unpivot("rows_checked", list(expected), "measure", "actual")
    want = F.lit(None).cast("double")
    for name, value in expected.items():
        want = F.when(F.col("measure") == name, F.lit(float(value))).otherwise(want)
    return long.withColumn("expected", want).withColumn(
        "passed", F.coalesce(F.abs(F.col("actual") - F.col("expected")) < tolerance, F.lit(False)))


def reconcile(detail: DataFrame, published: DataFrame, key: str, amount: str, total: str,
              tolerance: float = 1.0) -> DataFrame:
    """Sums of a detail table against a total published elsewhere, per key.

    Only keys with a published amount are compared; one row of results.
    """
    sums = detail.groupBy(key).agg(zero_sum(amount).alias("__sum"))
    joined = join_unique(published.select(key, F.col(total).alias("__total")).filter(
        F.col("__total") > 0), sums, key)
    drift = F.coalesce("__sum", F.lit(0)) - F.col("__total")
    return joined.withColumn("__drift", drift).agg(
        F.count("*").alias("compared"),
        count_where(F.abs("__drift") < tolerance).alias("agreeing"),
        count_where(F.abs("__drift") >= tolerance).alias("drifting"),
        zero_sum("__drift").alias("net_drift"), zero_sum("__total").alias("published_total"))


def dedup_upper_bound(sightings: DataFrame, events: DataFrame, file: str, group: list[str]) -> DataFrame:
    """Stored events per group can not exceed what some single file reported.

    One row: groups compared, groups over the bound, surplus rows.
    """
    in_file = sightings.groupBy(file, *group).agg(F.count("*").alias("n"))
    bound = in_file.groupBy(*group).agg(F.max("n").alias("__bound"))
    stored = events.groupBy(*group).agg(F.count("*").alias("stored"))
    joined = join_unique(stored, bound, group, null_safe=True)
    surplus = F.greatest(F.col("stored") - F.coalesce("__bound", F.lit(0)), F.lit(0))
    return joined.agg(
        F.count("*").alias("groups"), count_where(surplus > 0).alias("groups_over"),
        zero_sum(surplus).alias("surplus_rows"))


def all_or_nothing_unknown(fact: DataFrame, column: str, period: str = "snapshot_date_key") -> DataFrame:
    """Unknown members may only sit in periods where every row is Unknown."""
    periods = fact.groupBy(period).agg(
        F.count("*").alias("n"), count_where(F.col(column) == V.UNKNOWN_KEY).alias("unknown"))
    whole = F.col("unknown") == F.col("n")
    return periods.agg(
        zero_sum("unknown").alias("unknown_rows"),
        zero_sum(F.when(whole, F.col("unknown"))).alias("in_blank_periods"),
        count_where(whole).alias("blank_periods"),
        zero_sum(F.when(~whole, F.col("unknown"))).alias("violations"))


def calendar_check(calendar: DataFrame) -> DataFrame:
    """Span, leap days and gaps of the calendar."""
    days = calendar.filter(F.col("date_key") != V.UNKNOWN_KEY)
    return days.agg(
        F.min("full_date").alias("first_day"), F.max("full_date").alias("last_day"),
        F.count("*").alias("days"),
        (F.datediff(F.max("full_date"), F.min("full_date")) + 1 - F.count("*")).cast("bigint").alias("missing_days"),
        count_where((F.col("month") == 2) & (F.dayofmonth("full_date") == 29)).alias("leap_days"))


def validate(tables: dict[str, DataFrame]) -> DataFrame:
    """Everything that must hold before a set of tables is published."""
    parts = [check_keys(tables)]
    if "dim_facility" in tables:
        parts.append(scd2_check(tables["dim_facility"].filter(
            F.col("facility_key") != V.UNKNOWN_KEY)))
    if any(f in tables for f in FOREIGN_KEYS):
        parts.append(check_foreign_keys(tables))
    if "ref_state_population" in tables:
        parts.append(check_population(tables["ref_state_population"]))
    for name, frame in tables.items():
        try:
            rules = rules_of(name)
        except KeyError:
            continue
        parts.append(check_rules(frame, name, rules))
    return union_all(parts)


class GateClosed(Exception):
    """Raised instead of publishing; carries the violated rules."""

    def __init__(self, problems):
        super().__init__("; ".join(f"{p.target}: {p.rule} violated {p.violations} times" for p in problems))
        self.problems = problems


def gate(metrics: DataFrame) -> None:
    """One metric row per rule is all that reaches the driver."""
    problems = metrics.filter(F.col("violations") > 0).orderBy("target", "rule").collect()
    if problems:
        raise GateClosed(problems)
