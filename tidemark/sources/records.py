"""Splittable reading of delimited text whose values hold line breaks.

Whether a line starts a record hangs on everything before it in the file. Each
line is a small function instead: where it ends, outside or inside quotes, if it
starts outside, and if it starts inside. Such functions are put together first
inside a stretch of lines, then over the stretches of a file (one row each), so every
line knows its state while no task holds more than a few stretches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from tidemark import fixed_values as V
from tidemark.session import COMPRESSION, scratch_path

# states inside a line: at the start of a value, in a plain value, in quotes, after a quote in quotes
_START, _PLAIN, _QUOTED, _CLOSED = range(4)
CHUNK_LINES = 1 << 15       # lines of a block that are sorted and joined as one


def _after(state: Column, part: Column) -> Column:
    """State after text without quotes; a value that goes on after its closing quote is plain up to the next comma."""
    return F.when((part == "") | (state == _QUOTED), state).when(part.endswith(","), _START).otherwise(_PLAIN)


def ends_inside(line: Column, inside: bool) -> Column:
    """Whether a line that starts inside or outside quotes ends inside them; a doubled quote is a quote in the value."""
    parts = F.split(line, '"')
    quote = lambda state: (F.when(state == _START, _QUOTED).when(state == _QUOTED, _CLOSED)
                           .when(state == _CLOSED, _QUOTED).otherwise(_PLAIN))
    first = _after(F.lit(_QUOTED if inside else _START), parts[0])
    end = F.aggregate(F.slice(parts, 2, F.size(parts)), first, lambda state, part: _after(quote(state), part))
    return F.when(F.instr(line, '"') == 0, inside).otherwise(end == _QUOTED)


def _with_state(frame: DataFrame, by: list[str], order: list[str], outside: str, inside: str) -> DataFrame:
    """What the functions before a row make of the state at the start of its group, and with the row itself (``_after``).

    A function keeps the state, turns it, or ends in one state whatever it was.
    The last of the third kind (``settled``, null if there is none) and whether the
    state was ``turned`` an odd number of times since then say everything.
    """
    ordered = W.partitionBy(*by).orderBy(*order)
    upto, before = ordered.rowsBetween(W.unboundedPreceding, 0), ordered.rowsBetween(W.unboundedPreceding, -1)
    same = F.col(outside) == F.col(inside)
    turns = frame.withColumn("__turns", F.sum((~same & F.col(outside)).cast("int")).over(upto)).withColumn(
        "__settled", F.when(same, F.struct(F.col(outside).alias("state"), F.col("__turns").alias("turns"))))
    last = lambda window: F.last("__settled", ignorenulls=True).over(window)
    count = lambda turned, settled: (F.coalesce(turned, F.lit(0)) - F.coalesce(settled["turns"], F.lit(0))) % 2 == 1
    return turns.withColumns({"__before": last(before), "__upto": last(upto), "__turned": F.lag("__turns").over(ordered)}).withColumns({
        "settled": F.col("__before.state"), "turned": count(F.col("__turned"), F.col("__before")),
        "settled_after": F.col("__upto.state"), "turned_after": count(F.col("__turns"), F.col("__upto")),
    }).drop("__turns", "__settled", "__before", "__upto", "__turned")


def quoted_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(file_path, file_block, row_in_block, record)`` of text files with quoted line breaks.

    Position columns are those of a record's first line. Records end with ``\\n`` or
    ``\\r\\n``; breaks inside quotes stay as they are, empty lines between records are
    left out.

    Lines are written once, so that every step sees the same blocks. A block is cut
    into stretches of ``CHUNK_LINES`` lines, which are its unit of work: a task holds
    a few of them, however large files and blocks are. Inside a stretch the lines of a
    record are put together to a piece, without another shuffle, and pieces are
    written; only those of records that go over the end of a stretch meet in one.
    """
    chunk_lines = CHUNK_LINES
    read = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("file_block"),
        F.monotonically_increasing_id().alias("row"), F.decode(F.col("value").cast("binary"), V.TEXT_ENCODING).alias("value"))
    # numbers of rows are consecutive inside a block, so stretches of numbers follow each other
    lines = read.select(
        "*", (F.col("row") - F.col("row") % chunk_lines).alias("chunk"),
        ends_inside(F.col("value"), False).alias("outside"), ends_inside(F.col("value"), True).alias("inside"))
    written = _written(lines, "lines")

    block, at = ["file_path", "file_block", "chunk"], ["file_block", "chunk"]
    tasks = max(spark.sparkContext.defaultParallelism, -(-written.count() // (8 * chunk_lines)))
    relative = _with_state(written.repartition(tasks, *block), block, ["row"], "outside", "inside")
    # a row per stretch of a file
    blocks = relative.groupBy(*block).agg(F.max_by(F.struct("settled_after", "turned_after"), "row").alias("end")).select(
        *block, (F.coalesce("end.settled_after", F.lit(False)) != F.col("end.turned_after")).alias("outside"),
        (F.coalesce("end.settled_after", F.lit(True)) != F.col("end.turned_after")).alias("inside"))
    entered = _with_state(_written(blocks, "blocks"), ["file_path"], at, "outside", "inside").select(
        *block, (F.coalesce("settled", F.lit(False)) != F.col("turned")).alias("entry"))
    started = relative.join(entered, block).withColumn("open", F.coalesce("settled", "entry") != F.col("turned"))
    kept = started.where(F.col("open") | ~F.col("value").isin("", "\r"))
    so_far = W.partitionBy(*block).orderBy("row").rowsBetween(W.unboundedPreceding, 0)
    numbered = kept.withColumn("nr", F.sum((~F.col("open")).cast("int")).over(so_far))

    def joined(frame: DataFrame, by: list[str], order: list[str], text: str) -> DataFrame:
        parts = F.array_sort(F.collect_list(F.struct(*order, text)))
        return frame.groupBy(*by).agg(parts.alias("parts")).select(
            *by, F.col("parts")[0].alias("first"), F.array_join(F.transform("parts", lambda p: p[text]), "\n").alias("text"))

    pieces = _written(joined(numbered, [*block, "nr"], ["row"], "value").select(
        *block, "nr", F.col("first.row").alias("row"), "text"), "pieces")
    # lines before the first record of a stretch belong to the last record of a stretch before
    per_block = pieces.groupBy(*block).agg(F.max("nr").alias("last"), F.min("nr").alias("first"))
    later = W.partitionBy("file_path").orderBy(*at)
    owners = per_block.select(
        *block, "last", (F.lead("first").over(later) == 0).alias("goes_on"),
        F.last(F.when(F.col("last") > 0, F.struct(*at, "last")), ignorenulls=True).over(
            later.rowsBetween(W.unboundedPreceding, -1)).alias("owner"))
    # a row per stretch, sent to the pieces
    placed = pieces.join(F.broadcast(owners), block)
    edge = (F.col("nr") == 0) | (F.coalesce("goes_on", F.lit(False)) & (F.col("nr") == F.col("last")))
    own = F.when(F.col("nr") > 0, F.struct(*at, F.col("nr").alias("last"))).otherwise(F.col("owner"))
    over = joined(placed.where(edge).withColumn("of", own), ["file_path", "of"], ["file_block", "row"], "text")
    shown = lambda block, row: ["file_path", block.alias("file_block"), row.alias("row_in_block"),
                                F.regexp_replace("text", "\r$", "").alias("record")]
    return placed.where(~edge).select(*shown(F.col("file_block"), F.col("row"))).unionByName(
        over.select(*shown(F.col("first.file_block"), F.col("first.row"))))


def _written(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    frame.write.option("compression", COMPRESSION).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def ingest_quoted_scan(spark: SparkSession, paths: list[str], columns: list[str], malformed: str, broken: str = "__broken", *,
                       by_file: bool = False) -> DataFrame:
    """Values of ``columns`` as text, by record, with position columns and a flag for records of another number of fields.

    The first record of every file is its header and left out. With ``by_file`` records
    go to the tasks of their files as they are, which is less to shuffle than their values.
    """
    records = quoted_records(spark, paths)
    header = records.groupBy("file_path").agg(F.min(F.struct("file_block", "row_in_block")).alias("header"))
    # a row per file, sent to the records
    body = records.join(F.broadcast(header), "file_path").where(
        F.struct("file_block", "row_in_block") != F.col("header")).drop("header")
    body = body.hint("rebalance", "file_path") if by_file else body
    schema = ", ".join(f"`{c}` string" for c in [*columns, broken])
    options = {"quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken,
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    parsed = body.withColumn("r", F.from_csv("record", schema, options))
    return parsed.select(*[F.col("r").getField(c).alias(c) for c in columns], "file_path", "file_block", "row_in_block",
                         F.col("r").getField(broken).isNotNull().alias(malformed))
