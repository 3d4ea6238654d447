import gzip
import hashlib
import zlib

import pytest

from tidemark.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, sha1 string, last string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", "clash") for r in rows], SCHEMA).repartition(3)


def rows_of():
    big = "<p>" + "ä" * 1500
    rows = [(i, f"http://e.example/{i}?q=ü\r\nX: y", f"<html>{i} " + "text " * i) for i in range(40)]
    rows += [(50, None, big), (51, "", big), (52, "http://x", big), (52, "http://x", big), (None, "http://n", big)]
    rows += [(60, "http://x", None), (61, "http://x", ""), (62, "http://x", "short"), (63, "http://x", "short"), (64, "http://z", "line\r\n\r\nWARC/1.1\r\n" * 200),
             (65, "http://z", "x" * (1 << 21))]
    return rows


def test_round_trip(spark):
    rows = rows_of()
    got = warc.archived(pages(spark, rows), records_per_file=7).collect()
    assert len(got) == len(rows)
    assert all(r.block_ok and r.payload_ok is not False for r in got)
    html = {None if i is None else str(i): (h or "").encode() for i, _, h in rows}
    for r in got:
        body = html[r.page]
        assert r.payload_digest == hashlib.sha1(body).hexdigest() and r.declared_bytes == len(body)
        assert r.record_type == ("revisit" if r.refers_to else "response")
        assert r.payload == (None if r.refers_to else body)
    refers = {r.page: r.refers_to for r in got}
    assert refers["50"] == refers["51"] == refers[None] == "52"
    assert all(v is None for k, v in refers.items() if k not in ("50", "51", None))
    assert len({r.archive for r in got}) >= 6


def test_archives_are_plain_gzip(spark, tmp_path):
    rows = rows_of()
    path = str(tmp_path / "w")
    warc.write_warc(pages(spark, rows), path)
    whole = b"".join(gzip.decompress(f.read_bytes()) for f in sorted((tmp_path / "w").glob("part-*")))
    assert whole.count(b"WARC-Type: ") >= len(rows) and b"X: y\r\n" not in whole.replace(b"WARC/1.1\r\n", b"")
    for f in (tmp_path / "w").glob("part-*"):
        for _, member in warc.members(memoryview(f.read_bytes())):
            assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n")


def test_a_record_of_many_megabytes(spark, tmp_path):
    rows = [(1, "http://a", "ab" * (9 << 20)), (2, "http://b", "small"), (3, "http://c", "z" * ((1 << 24) - 500))]
    warc.write_warc(pages(spark, rows), str(tmp_path / "w"))
    got = {r.page: r for r in warc.read_warc(spark, str(tmp_path / "w")).collect()}
    assert {p: r.declared_bytes for p, r in got.items()} == {"1": 18 << 20, "2": 5, "3": (1 << 24) - 500}
    assert all(r.payload_ok and r.block_ok for r in got.values())


def test_damage_is_found():
    good = warc.record("1", "http://a", b"hello", hashlib.sha1(b"hello").hexdigest(), None)
    assert len(list(warc.framed(memoryview(good * 3)))) == 3
    with pytest.raises(warc.Damaged):
        list(warc.framed(memoryview(good + good[:-9])))
    with pytest.raises(warc.Damaged):
        list(warc.framed(memoryview(good[:40] + bytes([good[40] ^ 255]) + good[41:])))
    raw = zlib.decompress(good, 31)
    with pytest.raises(warc.Damaged):
        list(warc.framed(memoryview(gzip.compress(raw.replace(b"hello", b"hell")))))
    changed = warc._row(next(iter(warc.framed(memoryview(gzip.compress(raw.replace(b"hello", b"jello")))))), "a")
    assert changed["block_ok"] is False and changed["payload_ok"] is False


def test_empty_table(spark):
    assert warc.archived(pages(spark, [])).collect() == []
