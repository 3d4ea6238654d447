"""A warehouse that grows period by period.

Beside its star, every generation keeps what later periods are merged into: the
periods merged, the identity index and events of the rolling window, and sums
behind the means of places. Only files of new periods are parsed. Keys that were
given out stay, so rows of earlier periods in the snapshot fact are never written
again: the table goes on in a folder per release.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark import fixed_values as V
from tidemark.functions import clean
from tidemark.operators import increments
from tidemark.operators.increments import largest_key
from tidemark.operators.ordering import dense_key
from tidemark.operators.versions import prepend_unknown, scd1_latest
from tidemark.operators.votes import date_votes
from tidemark.plans import cleaning_log, dimensions, facts, publish
from tidemark.session import durable, stored
from tidemark.sources import catalog
from tidemark.sources.text import POSITION, load_snapshots

TIME = "processing_date"


def _later(old: DataFrame, new: DataFrame, on: list[str], columns: dict[str, Column]) -> DataFrame:
    """Full join on keys that may be null; each side holds a key once. ``columns`` may use ``o`` and ``n``."""
    o, n = old.alias("o"), new.alias("n")
    same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in on]
    either = [F.when(F.col("n.__in"), F.col(f"n.{k}")).otherwise(F.col(f"o.{k}")).alias(k) for k in on]
    return o.join(n.withColumn("__in", F.lit(True)).alias("n"), same, "full").select(*either, *[c.alias(k) for k, c in columns.items()])


def _numbered(rows: DataFrame, order: list, key: str) -> DataFrame:
    """Rows with a key keep it, the others are numbered after the largest."""
    rows = durable(rows)
    added = dense_key(rows.where(F.col(key).isNull()).drop(key), order, key, first=largest_key(rows, key) + 1)
    return rows.where(F.col(key).isNotNull()).unionByName(added)


def merged_places(state: DataFrame | None, rows: DataFrame, position: list[str]) -> DataFrame:
    """Places with keys, last known text, and sums of coordinates."""
    keyed = dimensions.located(rows, position)
    text = scd1_latest(keyed, dimensions.PLACE, [TIME, *position], ["county_parish", "urban_flag"])
    sums = keyed.groupBy(*dimensions.PLACE).agg(*[
        f(c).alias(f"{c}_{n}") for c in ("latitude", "longitude") for f, n in ((F.sum, "sum"), (F.count, "n"))])
    same = [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in dimensions.PLACE]
    new = text.alias("t").join(sums.alias("s"), same).select("t.*", *[f"s.{c}" for c in sums.columns if c not in dimensions.PLACE])
    if state is None:
        return dense_key(new, dimensions.place_order(), "geography_key")
    last = {c: F.coalesce(f"n.{c}", f"o.{c}") for c in ("county_parish", "urban_flag")}
    total = {c: F.when(F.col(f"n.{c}").isNull(), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}") + F.coalesce(f"o.{c}", F.lit(0)))
             for c in sums.columns if c not in dimensions.PLACE}
    return _numbered(_later(state, new, dimensions.PLACE, {**last, **total, "geography_key": F.col("o.geography_key")}),
                     dimensions.place_order(), "geography_key").select(*state.columns)


def geography_of(places: DataFrame) -> DataFrame:
    mean = lambda c: F.when(F.col(f"{c}_n") > 0, F.col(f"{c}_sum") / F.col(f"{c}_n"))
    shown = dimensions.described(places.withColumns({c: mean(c) for c in ("latitude", "longitude")}), "geography_key")
    return prepend_unknown(shown, "geography_key")


def _grown(old: DataFrame, new: DataFrame, name: str, key: str) -> DataFrame:
    """Members of a category dimension, old ones as they are, new ones numbered after them."""
    fresh = new.where(F.col(key) > 0).join(old.select(name), name, "left_anti").drop(key)
    return old.unionByName(dense_key(fresh, [name], key, first=largest_key(old, key) + 1).select(*old.columns))


def merged_chains(old: DataFrame, rows: DataFrame, position: list[str]) -> DataFrame:
    special, known = old.where("chain_key <= 0"), old.where("chain_key > 0")
    last = {c: F.coalesce(f"n.{c}", f"o.{c}") for c in ("chain_id", "num_facilities_in_chain")}
    both = _later(known, dimensions.chains_seen(rows, position), ["chain_name"], {**last, "chain_key": F.col("o.chain_key")})
    return special.unionByName(dimensions.banded(_numbered(both, ["chain_name"], "chain_key")).select(*old.columns))


def merged_dimensions(old: dict[str, DataFrame] | None, places: DataFrame, rows: DataFrame, penalties: DataFrame | None,
                      position: list[str]) -> dict[str, DataFrame]:
    """The six dimensions after newer periods; ``old`` are the published ones."""
    if old is None:
        built = dimensions.build_dimensions(rows, penalties, position)
        return {**built, "dim_geography": geography_of(places)}
    return {
        "dim_date": dimensions.dim_date(rows.sparkSession),
        "dim_facility": increments.scd2_merge(old["dim_facility"], dimensions.facility_attributes(rows, position), "ccn", TIME,
                                              V.TRACKED_ATTRIBUTES, "facility_key", order=position),
        "dim_geography": geography_of(places),
        "dim_ownership": _grown(old["dim_ownership"], dimensions.dim_ownership(rows), "ownership_type", "ownership_key"),
        "dim_chain": merged_chains(old["dim_chain"], rows, position),
        "dim_penalty_type": old["dim_penalty_type"] if penalties is None else _grown(
            old["dim_penalty_type"], dimensions.dim_penalty_type(penalties), "penalty_type", "penalty_type_key"),
    }


def pending_periods(spark: SparkSession, source: str, merged: DataFrame | None, until: str | None = None) -> list:
    """Labels of usable periods below a folder, up to ``until``, whose files are not in the account of merged ones."""
    chosen = catalog.classify_files(catalog.list_files(spark, source))
    if until is not None:
        chosen = chosen.where(F.col("snapshot_date") <= until)
    usable = catalog.usable_periods(chosen).filter("has_provider").select("snapshot_date")
    files = chosen.join(usable, "snapshot_date", "left_semi").select("snapshot_date", "logical").filter(
        F.col("logical").isin(V.REQUIRED_FILE, "penalties"))
    if merged is not None:
        files = files.join(merged.select("snapshot_date", "logical"), ["snapshot_date", "logical"], "left_anti")
    # a row per period of the catalogue
    return [r.snapshot_date for r in files.select("snapshot_date").distinct().orderBy("snapshot_date").collect()]


def extend_warehouse(spark: SparkSession, source: str, root: str, run_id: str, logged_at: str, *, rebuild: bool = False,
                     until: str | None = None, **noted) -> str | None:
    """Merge the periods below ``source``, up to ``until``, that are not in the warehouse yet and publish the next generation.

    Nothing is published if there are none. Periods that do not come after all
    merged ones (an older one, one republished, or a file added to one) change
    rows of earlier periods; then, and with ``rebuild``, everything is built again
    under a new key version. ``noted`` are entries for the manifest.
    """
    base = publish.generation(spark, root)
    found = publish.manifest(spark, root, base)
    grown = found is not None and "state_periods" in found["tables"] and not rebuild
    old = {n: publish.table_of(spark, found, n) for n in found["tables"]} if grown else {}
    pending = pending_periods(spark, source, old.get("state_periods"), until)
    if not pending:
        return None
    position = list(POSITION)
    staging = f"{root}/staged/{run_id}"
    providers, penalties, survivors = load_snapshots(spark, source, pending, staging)
    carried = durable(survivors)
    if grown:
        newest = old["state_periods"].agg(F.max(TIME)).first()[0]
        if carried.agg(F.min(TIME)).first()[0] <= newest:
            publish.delete(spark, staging)
            return extend_warehouse(spark, source, root, run_id, logged_at, rebuild=True, until=until, **noted)

    # every file of the new periods is accounted for, also one that a later publication replaced
    chosen = catalog.classify_files(catalog.list_files(spark, source)).where(F.col("snapshot_date").isin(pending)).select("snapshot_date", "logical")
    axis = providers.select("snapshot_date", TIME).distinct()
    periods = chosen.join(axis, "snapshot_date", "left").withColumn(TIME, F.coalesce(TIME, F.lit(carried.agg(F.max(TIME)).first()[0])))
    write = lambda frame, name: publish.write_table(frame, root, run_id, name)
    state = {"state_periods": write(periods if not grown else old["state_periods"].unionByName(periods), "state_periods"),
             "state_places": write(merged_places(old.get("state_places"), providers, position), "state_places")}
    dims = merged_dimensions(old if grown else None, state["state_places"], providers, penalties, position)
    written = {name: write(frame, name) for name, frame in dims.items()}
    dims = dict(written)

    segments = found["tables"]["fact_snapshot"]["folders"] if grown else []
    added = write(facts.fact_snapshot(providers, dims, position), "fact_snapshot")
    written["fact_snapshot"] = old["fact_snapshot"].unionByName(added) if grown else added

    columns = facts.EventColumns(position=tuple(position))
    votes = None
    if penalties is not None:
        votes = stored(date_votes(penalties, "penalty_date", [TIME]), "votes")
        newer = durable(increments.event_index(facts.penalty_sightings(penalties, position, votes), columns))
        if "state_events" in old:
            state["state_index"] = write(increments.merged_index(old["state_index"], newer, columns), "state_index")
            events = increments.upserted_events(old["state_events"], old["state_index"], state["state_index"], newer, c=columns)
        else:
            state["state_index"] = write(newer, "state_index")
            events = dense_key(increments.events_of(state["state_index"], columns), ["identity", "fine_id_source"], "event_key")
        state["state_events"] = write(events, "state_events")
    elif "state_events" in old:
        state |= {n: write(old[n], n) for n in ("state_index", "state_events")}
    if "state_events" in state:
        attributes = facts.attributes_of(written["fact_snapshot"])
        penalty = facts.penalty_fact_of(state["state_events"], attributes, dims, columns, key="event_key")
    else:
        penalty = facts.empty_penalty_fact(spark)
    written["fact_penalty"] = write(penalty, "fact_penalty")

    log = cleaning_log.of_build(providers, penalties, carried, {**written, "fact_snapshot": added}, votes)
    release = publish.switch(spark, {**written, **state}, root, run_id, logged_at, log, base, segments={"fact_snapshot": segments},
                             key_version=found["tables"]["dim_facility"]["key_version"] if grown else run_id, **noted)
    publish.delete(spark, staging)
    return release
