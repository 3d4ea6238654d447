"""Splittable reading of quoted line breaks against Spark's multi-line reader."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark import fixed_values as V
from tidemark.sources import records
from tidemark.sources.text import MALFORMED, ingest_text_scan

COLUMNS = ["a", "b", "c"]


def value(rng):
    plain = rng.choice(["", "x", "word and word", "5 foot", "caf\xe9", "long " * rng.randrange(1, 60)])
    kind = rng.randrange(9)
    if kind == 0:
        return f'"{plain}\nsecond line"'
    if kind == 1:
        return f'"{plain}, with ""quotes""\n\n and, two breaks"'
    if kind == 2:
        return '"\n"'
    if kind == 3:
        return '""'
    if kind == 4:
        return '"""start\nand end"""'
    if kind == 5:
        return f'"{plain}"'
    if kind == 6:
        return '"one ""\n"" pair"'
    if kind == 7 and plain:
        return f'{plain}" inch'          # a quote inside a plain value is a character
    return plain


def write(path, seed, rows, end="\n"):
    rng = random.Random(seed)
    lines = [",".join(["a", "b", "c"])]
    for i in range(rows):
        if rng.random() < 0.03:
            lines.append("")
        fields = [f"r{i}", value(rng), value(rng)]
        if rng.random() < 0.02:
            fields = fields[:rng.randrange(1, 3)]
        lines.append(",".join(fields))
    path.write_bytes((end.join(lines) + (end if seed % 2 else "")).encode("latin-1"))
    return str(path)


@pytest.fixture
def small_blocks(spark):
    """Files are cut every 700 bytes."""
    settings = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def in_order(frame):
    rows = frame.orderBy("file_path", "file_block", "row_in_block").collect()
    return [(r.file_path, r.a, r.b, r.c, r[MALFORMED]) for r in rows]


def test_rows_and_order_are_those_of_the_multi_line_reader(spark, tmp_path, small_blocks):
    paths = [write(tmp_path / f"f{s}.csv", s, 90) for s in range(4)]
    (tmp_path / "header.csv").write_text("a,b,c\n")
    (tmp_path / "one.csv").write_text('a,b,c\n1,"x\ny",3')
    (tmp_path / "inside.csv").write_text('a,b,c\n1,"' + "block after block\n" * 300 + '",3\n2,,"z\n"\n')
    paths += [str(tmp_path / n) for n in ("header.csv", "one.csv", "inside.csv")]
    found = records.ingest_quoted_scan(spark, paths, COLUMNS, MALFORMED)
    split = found.select(*[F.when(~F.trim(c).isin(*[""]), F.col(c)).alias(c) for c in COLUMNS], "file_path", "file_block", "row_in_block", MALFORMED)
    known = ingest_text_scan(spark, paths, COLUMNS, multiline=True, malformed=True)
    blank = known.select(*[F.when(~F.trim(c).isin(*[""]), F.col(c)).alias(c) for c in COLUMNS], "file_path", "file_block", "row_in_block", MALFORMED)
    assert in_order(split) == in_order(blank)
    # many tasks read one file
    blocks = {r.file_path.rsplit("/", 1)[1]: r.n for r in found.groupBy("file_path").agg(F.count_distinct("file_block").alias("n")).collect()}
    assert blocks["f0.csv"] > 5 and blocks["f3.csv"] > 5


def test_breaks_of_two_characters(spark, tmp_path, small_blocks):
    path = tmp_path / "crlf.csv"
    path.write_bytes(b'a,b,c\r\n1,"x\r\ny",z\r\n\r\n2,,"q\r\n"\r\n' + b"".join(b'%d,"m\r\nn",o\r\n' % i for i in range(3, 90)))
    found = records.ingest_quoted_scan(spark, [str(path)], COLUMNS, MALFORMED).orderBy("file_block", "row_in_block").collect()
    assert [(r.a, r.b, r.c) for r in found] == [("1", "x\r\ny", "z"), ("2", None, "q\r\n")] + [(str(i), "m\r\nn", "o") for i in range(3, 90)]


@pytest.mark.parametrize("line, outside, inside", [
    ("", False, True), ("a,b", False, True), ('"a', True, False), ('a,"b', True, False), ('a"b', False, False), ('"a""', True, False),
    ('"a"",b"', False, False), ('b"",c', False, True), ('x",y', False, False), ('","', False, True), ('"x"y,"z', True, True)])
def test_where_a_line_ends(spark, line, outside, inside):
    row = spark.createDataFrame([(line,)], "v string").select(
        records.ends_inside(F.col("v"), False), records.ends_inside(F.col("v"), True)).first()
    assert tuple(row) == (outside, inside)


def test_the_exchange_of_whole_records_is_the_one_of_blocks(spark, tmp_path, small_blocks):
    path = write(tmp_path / "f.csv", 1, 60)
    plan = records.quoted_records(spark, [path])._jdf.queryExecution().toString()
    assert "mapInArrow" not in plan and "PythonUDF" not in plan and "CartesianProduct" not in plan


def test_a_file_of_one_block_is_cut_into_stretches_of_lines(spark, tmp_path, monkeypatch):
    """Records that go over the end of one stretch, or of many, keep their text and place."""
    monkeypatch.setattr(records, "CHUNK_LINES", 7)
    paths = [write(tmp_path / f"f{s}.csv", s, 60) for s in (5, 6)]
    (tmp_path / "inside.csv").write_text('a,b,c\n1,"' + "line after line\n" * 50 + '",3\n\n\n2,,"z\n"\n')
    paths.append(str(tmp_path / "inside.csv"))
    shown = lambda frame: frame.select(*[F.when(~F.trim(c).isin(""), F.col(c)).alias(c) for c in COLUMNS], "file_path", "file_block", "row_in_block", MALFORMED)
    found = records.ingest_quoted_scan(spark, paths, COLUMNS, MALFORMED)
    assert in_order(shown(found)) == in_order(shown(ingest_text_scan(spark, paths, COLUMNS, multiline=True, malformed=True)))
