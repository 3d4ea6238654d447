"""The medians behind the units of the snapshot fact."""

from pyspark.sql import functions as F

from tidemark.operators import ordering
from tidemark.plans import dimensions, facts


def test_medians_of_the_snapshot_fact_shuffle_only_what_they_need(spark, monkeypatch):
    plans = []
    stored = ordering.stored
    monkeypatch.setattr(ordering, "stored", lambda frame, *a, **o: plans.extend(
        frame._jdf.queryExecution().optimizedPlan().toString().splitlines()) or stored(frame, *a, **o))
    names = ["ccn", "provider_name", "city", "state_code", "zip_code", "ownership_type", "chain_name", *facts._WHOLE, *facts._DECIMAL]
    rows = spark.createDataFrame([(k, *["1"] * (len(names) - 2), t) for k, t in (("a", "0.4"), ("a", "70"), ("b", "0.5"))],
                                 ", ".join(f"{n} string" for n in [*(n for n in names if n != "total_nursing_turnover_pct"), "total_nursing_turnover_pct"]))
    rows = rows.withColumns({"processing_date": F.lit("2026-07-01").cast("date"), "source_row": F.monotonically_increasing_id()})
    dims = dimensions.build_dimensions(rows.withColumns({n: F.lit(None).cast("string") for n in (
        "legal_business_name", "provider_type", "resides_in_hospital", "ccrc_flag", "special_focus_status", "abuse_icon", "county_parish",
        "urban_flag", "latitude", "longitude", "chain_id", "num_facilities_in_chain")}), None, ["source_row"])
    plans.clear()
    fact = facts.fact_snapshot(rows, dims, ["source_row"])
    above = [line for line in plans if "RDD" not in line and "Relation" not in line]
    assert above and not any("provider_name" in line or "certified_beds" in line for line in above)
    # the repeated row of a does not count for the median, so the period is one of proportions
    assert sorted((r.ccn, r.total_nursing_turnover_pct) for r in fact.collect()) == [("a", 40.0), ("b", 50.0)]
