"""Joins that stay safe when a key is hot and when a lookup side grows.

A lookup side is broadcast only after its size was checked. Beyond the check the
join is an ordinary shuffle join, with the hot keys of the large side salted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import fixed_values as V

PIN_ROWS = 100_000          # most rows a pinned lookup may have
PIN_BYTES = 64 << 20        # and most bytes
HOT_ROWS = 250_000          # rows of one key that a single task may handle: up to 1 kB each in its sort and window
SALTS = 64


def pinned(frame: DataFrame, rows: int = PIN_ROWS, size: int = PIN_BYTES) -> DataFrame | None:
    """A small result as a local table of known size, or None if it is not small."""
    table = frame.limit(rows + 1).toArrow()
    if table.num_rows > rows or table.nbytes > size:
        return None
    return frame.sparkSession.createDataFrame(table, schema=frame.schema)


def _condition(on: list[str], extra: list[Column] | None = None) -> Column:
    matched = F.lit(True)
    for name in on:
        matched &= F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}"))
    for clause in extra or []:
        matched &= clause
    return matched


def _equi(left: DataFrame, right: DataFrame, on: list[str], how: str, null_safe: bool,
          residual: Column | None = None) -> DataFrame:
    """Join on equal names and keep one copy of them (the left one)."""
    extra = [residual] if residual is not None else []
    if null_safe:
        matched = _condition(on, extra)
    else:
        matched = F.lit(True)
        for name in on:
            matched &= F.col(f"l.{name}") == F.col(f"r.{name}")
        for clause in extra:
            matched &= clause
    joined = left.alias("l").join(right.alias("r"), matched, how)
    if how in ("left_semi", "left_anti"):
        return joined.select("l.*")
    return joined.select("l.*", *[F.col(f"r.{c}") for c in right.columns if c not in on])


def join_unique(left: DataFrame, right: DataFrame, on: list[str] | str, how: str = "left", *,
                null_safe: bool = False) -> DataFrame:
    """Join two sides that hold every key at most once.

    No key can be hot, so the physical join is left to the optimizer and to
    runtime statistics: broadcast when a side turns out small, else by shuffle.
    """
    return _equi(left, right, [on] if isinstance(on, str) else list(on), how, null_safe)


def join_range(left: DataFrame, right: DataFrame, on: str, inside: Column) -> DataFrame:
    """Left join on a key and a range, of which every left row meets at most one.

    Nothing runs beforehand: file sizes and runtime statistics choose the strategy.
    """
    return _equi(left, right, [on], "left", False, inside)


def lookup_join(
    large: DataFrame, small: DataFrame, on: list[str] | str, how: str = "left", *,
    null_safe: bool = False, residual: Column | None = None, rows: int | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Join a large frame with a lookup side.

    ``residual`` is an extra condition over ``l.`` and ``r.`` columns. A lookup
    within the size check is broadcast, so the large side is not shuffled at all.
    """
    on = [on] if isinstance(on, str) else list(on)
    local = pinned(small, PIN_ROWS if rows is None else rows)
    if local is not None:
        return _equi(large, F.broadcast(local), on, how, null_safe, residual)
    return salted_join(large, small, on, how, null_safe=null_safe, residual=residual,
                       hot_rows=hot_rows)


def salted_join(
    large: DataFrame, small: DataFrame, on: list[str] | str, how: str = "left", *,
    null_safe: bool = False, residual: Column | None = None, hot_rows: int | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Shuffle join in which only the hot keys of the large side are salted.

    The salt is a hash of the row itself, so a retried task puts every row where
    it was before. Lookup rows of hot keys are repeated once per salt.
    """
    on = [on] if isinstance(on, str) else list(on)
    limit = HOT_ROWS if hot_rows is None else hot_rows
    hot = large.groupBy(*on).count().filter(F.col("count") > limit).select(*on)
    hot_keys = pinned(hot)
    if hot_keys is not None and hot_keys.isEmpty():
        return _equi(large, small, on, how, null_safe, residual)
    flags = (F.broadcast(hot_keys) if hot_keys is not None else hot).withColumn("__hot", F.lit(True))
    left = _equi(large, flags, on, "left", True).withColumn(
        "__salt", F.when(F.col("__hot"), F.pmod(F.xxhash64(*large.columns), F.lit(salts)))
        .otherwise(F.lit(0)).cast("int")).drop("__hot")
    right = _equi(small, flags, on, "left", True).withColumn(
        "__salt", F.explode(F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                            .otherwise(F.array(F.lit(0))))).drop("__hot")
    return _equi(left, right, on + ["__salt"], how, null_safe, residual).drop("__salt")


def key_lookup(
    facts: DataFrame, dim: DataFrame, on: dict[str, str] | list[str] | str, key: str,
    into: str | None = None, default: int = V.UNKNOWN_KEY,
) -> DataFrame:
    """Attach a dimension key by its natural key, null-safe; absent becomes -1.

    ``on`` maps fact column -> dimension column (or lists equal names). A
    dimension holds a natural key once, so nothing runs beforehand: the size of its
    files decides between broadcast and shuffle, and adaptive execution splits a
    key that very many facts share.
    """
    if isinstance(on, str):
        on = {on: on}
    elif not isinstance(on, dict):
        on = {c: c for c in on}
    into = into or key
    side = dim.filter(F.col(key) != V.UNKNOWN_KEY).select(
        *[F.col(d).alias(f) for f, d in on.items()], F.col(key).alias("__key"))
    joined = _equi(facts, side, list(on), "left", True)
    return joined.withColumn(into, F.coalesce("__key", F.lit(default)).cast("bigint")).drop("__key")
