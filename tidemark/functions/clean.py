"""Cleaning rules as Column functions. Every one is a native expression."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from tidemark import fixed_values as V

_NUMBER = r"^[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?$"
# characters one by one, no ranges or classes: such a set is a bit table to the regular expressions of the JVM
_SPACE = r"[ \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0]"
_SIGNS = "$,% \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.trim(col(c), F.lit(V.WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def null_tokens_to_null(c: Column | str) -> Column:
    c = col(c)
    return F.when(~c.isin(V.NULL_TOKENS), c)


def zero_pad(c: Column, width: int) -> Column:
    """Pad with zeros on the left; never truncate, keep a sign in front."""
    sign = F.substring(c, 1, 1)
    signed = F.concat(sign, F.lpad(F.substring(c, 2, width), width - 1, "0"))
    return (
        F.when(F.length(c) >= width, c)
        .when(sign.isin("+", "-"), signed)
        .otherwise(F.lpad(c, width, "0"))
    )


def normalize_id(c: Column | str, width: int = V.ID_WIDTH) -> Column:
    return zero_pad(strip(c), width)


def normalize_zip(c: Column | str) -> Column:
    return zero_pad(F.substring(strip(c), 1, V.ZIP_WIDTH), V.ZIP_WIDTH)


def normalize_text(c: Column | str, upper: bool = False) -> Column:
    # blank before the replacement is blank after it: asked there, the replacement runs once
    text = F.regexp_replace(strip(c), f"{_SPACE}+", " ")
    return F.when(strip(c) != "", F.upper(text) if upper else text)


def to_number(c: Column | str) -> Column:
    """Money, percent and grouped digits to a double; anything else is null."""
    text = F.translate(col(c), _SIGNS, "")
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_whole(c: Column | str) -> Column:
    return F.round(to_number(c)).try_cast("bigint")


def normalize_yes_no(c: Column | str) -> Column:
    word = F.upper(strip(c))
    return F.when(word.isin(V.TRUE_WORDS), True).when(word.isin(V.FALSE_WORDS), False)


def flag_domain(c: Column | str, column_present: Column) -> Column:
    """One domain across eras; a blank means "None" only where the column exists."""
    text = strip(c)
    mapped = F.when(text != "", text)
    for source, target in V.FLAG_DOMAIN.items():
        mapped = F.when(text == source, target).otherwise(mapped)
    return F.when(column_present, F.coalesce(mapped, F.lit(V.FLAG_ABSENT))).otherwise(mapped)


def map_category(c: Column, mapping: dict[str, str], default: str | None = None) -> Column:
    """Explicit lookup of a small fixed vocabulary, folded into the expression."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    value = F.when(c.isin(list(mapping)), table[c])
    return value if default is None else F.coalesce(value, F.lit(default))


def ownership_group(ownership_type: Column) -> Column:
    return map_category(ownership_type, V.OWNERSHIP_GROUPS, V.UNKNOWN_LABEL)


def state_name(code: Column) -> Column:
    return map_category(code, {s[0]: s[2] for s in V.STATES}, V.UNKNOWN_LABEL)


def census_region(code: Column) -> Column:
    return map_category(code, {s[0]: s[3] for s in V.STATES}, V.UNKNOWN_LABEL)


def geography_key_columns(zip_code="zip_code", city="city", state="state_code") -> dict[str, Column]:
    """The natural key of a place; the builder and the lookup both use this."""
    return {
        "zip_code": normalize_zip(zip_code),
        "city": normalize_text(city, upper=True),
        "state_code": normalize_text(state, upper=True),
    }


def blank_impossible(c: Column | str) -> Column:
    """A negative duration is not a duration: null it, keep the row."""
    c = col(c)
    return F.when(c >= 0, c)


def date_key(d: Column | str) -> Column:
    d = col(d)
    return F.coalesce(
        F.year(d).cast("bigint") * 10000 + F.month(d) * 100 + F.dayofmonth(d),
        F.lit(V.UNKNOWN_KEY).cast("bigint"),
    )


def suspect_reasons(
    beds="certified_beds", residents="avg_residents_per_day", turnover="total_nursing_turnover_pct"
) -> dict[str, Column]:
    """Why a row is implausible, one three-valued Column per reason."""
    beds, residents, turnover = col(beds), col(residents), col(turnover)
    low, high = V.OCCUPANCY_RANGE
    occupancy = residents / F.when(beds > 0, beds)
    floor, ceiling = V.TURNOVER_RANGE
    return {
        "occupancy": (occupancy < low) | (occupancy > high),
        "beds": beds <= 0,
        "turnover": (turnover <= floor) | (turnover > ceiling),
    }


def is_suspect(**columns) -> Column:
    reasons = suspect_reasons(**columns).values()
    return reduce(or_, [F.coalesce(r, F.lit(False)) for r in reasons])


def days_in_month(d: Column | str) -> Column:
    return F.dayofmonth(F.last_day(col(d)))
