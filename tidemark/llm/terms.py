"""Words of many texts at once: positions in one array of lower-cased bytes.

A word is a longest run of digits, letters a to z (A to Z lowered) and
characters beyond ASCII. In UTF-8 these are the bytes 0x30 to 0x39, 0x61 to 0x7A
and 0x80 upwards, so words are found on bytes, a whole batch of texts at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Texts are worked on in pieces of about this many bytes; a longer text is a piece of its own.
PIECE_BYTES = 1 << 22

_LOWERED = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_IN_WORD = np.array([0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


def words(text: Column) -> Column:
    """The same words as a column, for small tables; null has none."""
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP), lambda w: w != "")


@dataclass
class Terms:
    """Words ``i`` are ``raw[start[i]:end[i]]``; text ``t`` has the words ``first[t]`` to ``first[t + 1]``."""

    raw: bytes
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.end[i]]


def terms(texts: pa.Array) -> Terms:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, places, content = texts.buffers()
    edge = np.frombuffer(places, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = (content.slice(edge[0], edge[-1] - edge[0]).to_pybytes() if content else b"").translate(_LOWERED)
    edge = edge - edge[0]
    data = np.frombuffer(raw, np.uint8)
    inside = _IN_WORD[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    # texts lie side by side without a gap: a word neither starts before its text nor goes on into the next
    first, last = edge[:-1][edge[:-1] < len(data)], edge[1:][edge[1:] > 0] - 1
    begins[first], ends[last] = inside[first], inside[last]
    start = np.flatnonzero(begins)
    return Terms(raw, data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, edge))


def pieces(batch: pa.RecordBatch, text: str, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with about ``most`` bytes of text."""
    if not batch.num_rows:
        return
    total = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(total):
        before = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, before + most, "right")))
        yield batch.slice(at, to - at)
        at = to


_POWERS: list[np.ndarray] = []
_ODD = 0x9E3779B97F4A7C15


def hashes(t: Terms) -> np.ndarray:
    """A 64-bit hash of every word's bytes, from running sums over the whole piece."""
    n = len(t.data) + 1
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, PIECE_BYTES + 1)
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, p, np.uint64)]))
                      for p in (_ODD, pow(_ODD, -1, 1 << 64))]
    power, inverse = (p[:n] for p in _POWERS)
    sums = np.zeros(n, np.uint64)
    np.cumsum((t.data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
    return mixed((sums[t.end] - sums[t.start]) * inverse[t.start])


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result hangs on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs(t: Terms) -> np.ndarray:
    """The text of every word."""
    return np.repeat(np.arange(len(t.first) - 1), np.diff(t.first))


class Vocabulary:
    """Finds the words of a bounded list in texts: by hash, then byte by byte."""

    def __init__(self, listed: list[str]):
        known = terms(pa.array(listed, pa.string()))
        if not np.array_equal(np.diff(known.first), np.ones(len(listed), np.int64)):
            raise ValueError("every entry has to be one word")
        self.size, self.known, self.hash = len(listed), known, hashes(known)
        self.order = np.argsort(self.hash, kind="stable")
        self.sorted = self.hash[self.order]

    def numbers(self, t: Terms, hashed: np.ndarray) -> np.ndarray:
        """The place of every word of ``t`` in the list, -1 for words that are not in it."""
        out = np.full(len(hashed), -1, np.int64)
        if not self.size or not len(hashed):
            return out
        low = np.searchsorted(self.sorted, hashed)
        open_ = np.flatnonzero(low < self.size)
        open_ = open_[self.sorted[low[open_]] == hashed[open_]]
        step = 0
        while len(open_):     # more than one step only where listed words share a hash
            entry = self.order[low[open_] + step]
            same = self._equal(t, open_, entry)
            out[open_[same]] = entry[same]
            open_, step = open_[~same], step + 1
            open_ = open_[low[open_] + step < self.size]
            open_ = open_[self.sorted[low[open_] + step] == hashed[open_]]
        return out

    def _equal(self, t: Terms, at: np.ndarray, entry: np.ndarray) -> np.ndarray:
        a, b = t.start[at], self.known.start[entry]
        length = t.end[at] - a
        same = length == self.known.end[entry] - b
        left = np.flatnonzero(same)
        step = 0
        while len(left):
            left = left[length[left] > step]
            wrong = t.data[a[left] + step] != self.known.data[b[left] + step]
            same[left[wrong]] = False
            left, step = left[~wrong], step + 1
        return same


def portions(rows: DataFrame, size: Column, key: list[str], most: int) -> Iterator[tuple[pa.Table, bool]]:
    """A written table in portions of at most ``most`` (by ``size``), dealt by a hash of the key; the last one is told.

    Each portion is one collect of bounded size; a portion exceeds the bound only
    where a single key does. An empty table is one empty portion.
    """
    count = max(1, math.ceil((rows.agg(F.sum(size)).first()[0] or 0) / most))
    while True:
        part = F.pmod(F.xxhash64(F.lit(3), *key), F.lit(count))
        # a row of two numbers per portion
        sums = rows.groupBy(part.alias("p")).agg(F.sum(size).alias("s"), F.count_distinct(F.xxhash64(*key)).alias("n"))
        if count == 1 or sums.where((F.col("s") > most) & (F.col("n") > 1)).isEmpty():
            break
        count *= 2
    for p in range(count):
        yield (rows if count == 1 else rows.where(part == p)).toArrow(), p == count - 1
