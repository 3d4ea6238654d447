from tests import snapshots
from tidemark.sources import text
from tidemark.streaming.incremental import record_new_files


def test_each_file_is_recorded_once(spark, tmp_path):
    root, ledger, state = (str(tmp_path / n) for n in ("in", "ledger", "state"))
    snapshots.providers(root, "2026-06-24", "2026", [snapshots.provider("1"), snapshots.provider("2")], "2026-06-01")
    snapshots.penalties(root, "2026-06-24", "2026", [snapshots.fine("1", "2026-01-01", "5")], "2026-06-01")
    (tmp_path / "in" / "2026-06-24" / "readme.txt").write_text("x")
    seen = record_new_files(spark, root, ledger, state)
    assert sorted(r.logical for r in seen.collect()) == ["penalties", "provider_info"]
    snapshots.providers(root, "2026-07-29", "2026", [snapshots.provider("3")], "2026-07-01")
    record_new_files(spark, root, ledger, state)
    seen = record_new_files(spark, root, ledger, state)
    assert sorted((str(r.snapshot_date), r.logical) for r in seen.collect()) == [
        ("2026-06-24", "penalties"), ("2026-06-24", "provider_info"), ("2026-07-29", "provider_info")]
    new = text.read_logical(spark, seen.filter("snapshot_date = '2026-07-29'"), "provider_info")
    assert [r.ccn for r in new.collect()] == ["000003"]
