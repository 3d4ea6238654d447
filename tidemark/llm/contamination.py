"""Benchmark decontamination by Wu-Manber search over words.

The strings searched for are windows of ten consecutive words of the benchmark's
items (a shorter item is one window). All windows of one length are searched
together: a table over blocks of two words says how far the search may move on
when such a block ends the current position; where it may not move, the bucket of
that last block holds the windows that end so, and a direct comparison of all
their bytes decides. A block is known by the lengths and last bytes of its two
words, so most of a text's words are never looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import put
from tidemark.llm.terms import Terms, mixed, pieces, portions, runs, terms, words

BLOCK, TAIL, CELLS = 2, 5, 1 << 20
#: Positions that one lane of the search walks over; long texts are many lanes.
LANE = 512
#: Bytes of windows and item ids that are searched for at once; more take further passes.
PORTION = 32 << 20


def _word_marks(t: Terms, at: np.ndarray) -> np.ndarray:
    """Length and last bytes of words."""
    end, length = t.end[at], t.end[at] - t.start[at]
    mark = length.astype(np.uint64)
    for j in range(1, TAIL + 1):
        byte = t.data[np.maximum(end - j, 0)].astype(np.uint64)
        mark = mark * np.uint64(257) + np.where(length >= j, byte, np.uint64(256))
    return mark


def _blocks(t: Terms, last: np.ndarray, size: int) -> np.ndarray:
    """The cell of the block of ``size`` words that ends with word ``last``."""
    mark = _word_marks(t, last)
    for back in range(1, size):
        mark = mixed(mark) + _word_marks(t, last - back)
    return (mixed(mark) & np.uint64(CELLS - 1)).astype(np.int64)


class Search:
    """Shift table and buckets of all windows of ``length`` words; ``owners[w]`` are the items of window ``w``."""

    def __init__(self, length: int, windows: list[bytes]):
        self.length, self.block = length, min(BLOCK, length)
        t = terms(pa.array([w.decode() for w in windows], pa.string()))
        first = t.first[:-1]
        self.shift = np.full(CELLS, length - self.block + 1, np.int32)
        for q in range(self.block - 1, length):
            np.minimum.at(self.shift, _blocks(t, first + q, self.block), length - 1 - q)
        ends = _blocks(t, first + length - 1, self.block)
        self.buckets: dict[int, dict[bytes, int]] = {}
        for number, (cell, window) in enumerate(zip(ends.tolist(), windows)):
            self.buckets.setdefault(cell, {})[window] = number
        # windows of a bucket by their first block as well: spares most comparisons
        self.fronts = np.zeros(CELLS, bool)
        self.fronts[self._front(t, first, ends)] = True

    def _front(self, t: Terms, first: np.ndarray, cell: np.ndarray) -> np.ndarray:
        both = _blocks(t, first + self.block - 1, self.block).astype(np.uint64) * np.uint64(CELLS) + cell.astype(np.uint64)
        return (mixed(both) & np.uint64(CELLS - 1)).astype(np.int64)

    def occurrences(self, t: Terms) -> tuple[np.ndarray, np.ndarray]:
        """First words and window numbers of all occurrences in the texts of ``t``."""
        pos, stop = _lanes(t.first, self.length)
        at, where = [], []
        while len(pos):
            cell = _blocks(t, pos, self.block)
            shift = self.shift[cell]
            here = shift == 0
            if here.any():
                at.append(pos[here])
                where.append(cell[here])
            pos = pos + np.maximum(shift, 1)
            on = pos < stop
            pos, stop = pos[on], stop[on]
        if not at:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        last, cell = np.concatenate(at), np.concatenate(where)
        likely = self.fronts[self._front(t, last - self.length + 1, cell)]
        found, numbers = [], []
        for end, c in zip(last[likely].tolist(), cell[likely].tolist()):
            begin = end - self.length + 1
            number = self.buckets[c].get(b" ".join([t.word(i) for i in range(begin, end + 1)]))
            if number is not None:
                found.append(begin)
                numbers.append(number)
        return np.array(found, np.int64), np.array(numbers, np.int64)


def _lanes(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of last words, from and to, that texts are walked over by; at most LANE in one lane."""
    low, high = first[:-1] + length - 1, first[1:]
    count = np.maximum(0, -(-(high - low) // LANE))
    text = np.repeat(np.arange(len(low)), count)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = low[text] + nth * LANE
    return begin, np.minimum(begin + LANE, high[text])


class Searches:
    """One search per window length, over a bounded portion of all windows."""

    def __init__(self, rows: pa.Table):
        self.searches: list[tuple[Search, list[list[str]]]] = []
        owners: dict[int, dict[bytes, list]] = {}
        for window, length, item in zip(*(rows.column(c).to_pylist() for c in ("window", "length", "item"))):
            owners.setdefault(length, {}).setdefault(window.encode(), []).append(item)
        for length, known in sorted(owners.items()):
            self.searches.append((Search(length, list(known)), [sorted(i for i in v if i is not None) for v in known.values()]))

    def scan(self, texts: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
        """Number of words, spans of words inside occurrences, and items, of every text."""
        t = terms(texts)
        n = len(t.first) - 1
        begins, ends, items = [], [], [set() for _ in range(n)]
        text_of = runs(t)
        for search, owners in self.searches:
            begin, number = search.occurrences(t)
            begins.append(begin)
            ends.append(begin + search.length)
            for text, w in set(zip(text_of[begin].tolist(), number.tolist())):
                items[text].update(owners[w])
        none = np.empty(0, np.int64)
        return np.diff(t.first), _spans(t.first, text_of, np.concatenate([none, *begins]), np.concatenate([none, *ends])), items


def _spans(first: np.ndarray, text_of: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> list[list[tuple[int, int]]]:
    """Longest runs of covered words of every text, counted from its first word, the end left out."""
    n = len(text_of)
    step = np.bincount(begins, minlength=n + 1)[:n + 1] - np.bincount(ends, minlength=n + 1)[:n + 1]
    hit = np.cumsum(step)[:n] > 0
    new_text = np.ones(n, bool)
    new_text[1:] = text_of[1:] != text_of[:-1]
    before = np.concatenate([[False], hit[:-1]])[:n]
    after = np.concatenate([hit[1:], [False]])[:n]
    opens = np.flatnonzero(hit & (~before | new_text))
    closes = np.flatnonzero(hit & (~after | np.concatenate([new_text[1:], [True]])[:n])) + 1
    out: list[list[tuple[int, int]]] = [[] for _ in range(len(first) - 1)]
    for text, a, b in zip(text_of[opens].tolist(), opens.tolist(), closes.tolist()):
        out[text].append((a - int(first[text]), b - int(first[text])))
    return out


def _joined(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Two lists of spans as one; spans that touch are one."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(a + b):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((begin, end))
    return out


def windows_of(benchmark: DataFrame, item_id: str, text: str, length: int) -> DataFrame:
    """Distinct ``(window, length, item)``: consecutive words, joined by a space, and the item's id as text."""
    ws = benchmark.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("ws")).where("size(ws) > 0")
    at = F.sequence(F.lit(1), F.greatest(F.size("ws") - (length - 1), F.lit(1)))
    cut = F.transform(at, lambda i: F.array_join(F.slice("ws", i, length), " "))
    return ws.select(F.explode(cut).alias("window"), F.least(F.size("ws"), F.lit(length)).alias("length"), "item").distinct()


SPANS = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
                 length: int = 10, columns: list[str] | None = None, portion: int = PORTION) -> DataFrame:
    """Every row as ``row`` with ``n_words``, ``spans`` (of words inside windows of the benchmark) and ``items`` (sorted as strings).

    ``columns`` names the columns that ``row`` has, all by default. Words are
    compared lower-cased from A to Z. A null or empty text has no words, a
    null or empty item no window; an item of fewer than ``length`` words is one
    window. Rows of one item id are one item; the windows of items without an id
    count as hits, their missing id is not listed. Every row of the documents is
    judged by itself, repeated or not, and texts of any length are searched
    whole. Empty tables give no rows, or rows without hits. Other columns travel
    inside ``row``.

    Documents are read once and never shuffled. The windows are sent to the tasks
    in portions of at most ``portion`` bytes; a benchmark beyond that takes a pass
    per portion, with the results so far written in between.
    """
    kept = docs.columns if columns is None else columns
    flat = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), F.col(f"`{text}`").alias("text"))
    listed = put(windows_of(benchmark, item_id, item_text, length), "windows")
    size = F.octet_length("window") + F.coalesce(F.octet_length("item"), F.lit(0)) + 16
    result = flat
    for rows, last in portions(listed, size, ["window", "item"], portion):
        result = _passed(result, Searches(rows), carry=["row"] if last else ["row", "text"])
        if not last:   # one portion at a time is sent to the tasks
            result = put(result, "searched")
    return result


def _passed(frame: DataFrame, searches: Searches, carry: list[str]) -> DataFrame:
    """One pass over the texts; adds to what earlier portions have found."""
    told = frame.sparkSession.sparkContext.broadcast(searches)
    again = "spans" in frame.columns
    fields = [*[frame.schema[c] for c in carry], T.StructField("n_words", T.LongType()),
              T.StructField("spans", T.ArrayType(T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
              T.StructField("items", T.ArrayType(T.StringType()))]

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "text"):
                n, spans, items = told.value.scan(piece.column("text"))
                if again:
                    earlier = [[(s["begin"], s["end"]) for s in v] for v in piece.column("spans").to_pylist()]
                    spans = [_joined(a, b) for a, b in zip(earlier, spans)]
                    items = [set(a) | b for a, b in zip(piece.column("items").to_pylist(), items)]
                yield pa.RecordBatch.from_arrays(
                    [*[piece.column(c) for c in carry], pa.array(n, pa.int64()),
                     pa.array([[{"begin": a, "end": b} for a, b in v] for v in spans], SPANS),
                     pa.array([sorted(v) for v in items], pa.list_(pa.string()))], [*carry, "n_words", "spans", "items"])

    return frame.mapInArrow(run, T.StructType(fields))
