"""Small text snapshots in three header layouts, written below a folder."""

from pathlib import Path

from tidemark.fixed_values import PENALTY_COLUMNS, PROVIDER_COLUMNS

ERA = {"2026": 0, "2020": 1, "2019": 2}


def provider(ccn, **values):
    return {"ccn": ccn, "provider_name": f"Home {ccn}", "city": "Searcy", "state_code": "AR", "zip_code": "72143",
            "county_parish": "White", "ownership_type": "For profit - Corporation", "certified_beds": "60",
            "avg_residents_per_day": "48", "provider_type": "Medicare", "resides_in_hospital": "N",
            "legal_business_name": "Owner LLC", "ccrc_flag": "N", "special_focus_status": "", "overall_rating": "3",
            "health_inspection_rating": "3", "staffing_rating": "2", "reported_total_nurse_hprd": "3.5",
            "reported_rn_hprd": "0.5", "cycle1_total_deficiencies": "4", **values}


def write(root, snapshot, name, era, rows, columns, processing_date, change=None):
    folder = Path(root) / snapshot
    folder.mkdir(parents=True, exist_ok=True)
    index = ERA[era]
    names = [(c, e[index]) for c, e in columns.items() if e[index]]
    lines = [",".join(f'"{(change or str)(n)}"' for _, n in names)]
    for row in rows:
        full = {"processing_date": processing_date, **row}
        lines.append(",".join(f'"{full.get(c, "")}"' for c, _ in names))
    (folder / name).write_text("\n".join(lines) + "\n", encoding="latin-1")


def providers(root, snapshot, era, rows, processing_date, name="NH_ProviderInfo_Jun2026.csv", change=None):
    write(root, snapshot, name, era, rows, PROVIDER_COLUMNS, processing_date, change)


def penalties(root, snapshot, era, rows, processing_date, name="NH_Penalties_Jun2026.csv"):
    write(root, snapshot, name, era, rows, PENALTY_COLUMNS, processing_date)


def fine(ccn, date, amount, fine_id=""):
    return {"ccn": ccn, "penalty_date": date, "penalty_type": "Fine", "fine_id": fine_id, "fine_amount_usd": amount}


def build(root):
    """Four publications: 2019, 2020, two of one 2026 period (the later without penalties)."""
    providers(root, "2019-01-17", "2019", [
        provider("15009", special_focus_status="Y", city="SEARCY"), provider("015010", certified_beds="0"),
        provider("015010", certified_beds="99")], "2019-01-01", "ProviderInfo_Download.csv",
        change=lambda n: n.replace("OVERALL_RATING", "Overall_Rating"))
    penalties(root, "2019-01-17", "2019", [fine("15009", "2018-05-09", "$5,782"), fine("15009", "2018-05-09", "$5,782"),
                                           {"ccn": "015010", "penalty_date": "2018-06-01", "penalty_type": "Payment Denial",
                                            "payment_denial_days": "-526"}], "2019-01-01", "Penalties_Download.csv")
    providers(root, "2020-10-09", "2020", [
        provider("015009", total_nursing_turnover_pct="0.52", special_focus_status="N", abuse_icon="Y"),
        provider("015011", total_nursing_turnover_pct="0.40", ownership_type="Tribal")], "10/01/2020")
    penalties(root, "2020-10-09", "2020", [fine("015009", "05/09/2018", "5800"), fine("015009", "12/25/2019", "100")], "10/01/2020")
    chained = {"chain_name": "", "total_nursing_turnover_pct": "52"}
    providers(root, "2026-07-29", "2026", [
        provider("015009", **{**chained, "chain_name": "Big  Chain", "chain_id": "7", "num_facilities_in_chain": "60"}),
        provider("015011", **chained, provider_name="Caf\xe9 Home")], "2026-07-01")
    penalties(root, "2026-07-29", "2026", [fine("015009", "2019-12-25", "150", "F1"), fine("015011", "2026-01-05", "900", "F2")], "2026-07-01")
    providers(root, "2026-08-06", "2026", [
        provider("015009", **{**chained, "chain_name": "Big Chain", "chain_id": "7", "num_facilities_in_chain": "60"}, certified_beds="61"),
        provider("015011", **chained)], "2026-07-01")
    (Path(root) / "2026-08-06" / "._NH_ProviderInfo_Jun2026.csv").write_bytes(b"\x00\x05\x16")
    penalties(root, "2026-09-01", "2026", [fine("015009", "2026-08-05", "1", "F9")], "2026-09-01")
    return str(root)
