"""String expressions: fixed-width fields, key packing, defaults."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed(c: Column | str, start: int, length: int | None = None, drop: int = 0) -> Column:
    """Characters from 1-based ``start``: ``length`` of them, or the field's own
    length less ``drop`` when ``length`` is None."""
    c = as_col(c)
    if length is not None:
        return F.substring(c, start, length)
    return F.substr(c, F.lit(start), F.length(c) - F.lit(drop))


def last(c: Column | str, n: int) -> Column:
    return F.substring(as_col(c), -n, n)


def strip_one_zero(c: Column | str) -> Column:
    return F.regexp_replace(as_col(c), "^0", "")


def strip_zeros(c: Column | str) -> Column:
    return F.regexp_replace(as_col(c), "^0+", "")


def swap(c: Column | str, old: str, new: str) -> Column:
    """Replace every occurrence of a literal."""
    return F.replace(as_col(c), F.lit(old), F.lit(new))


def pack(sep: str, *parts: Column | str) -> Column:
    """Join parts with a separator; null if any part is null."""
    woven: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            woven.append(F.lit(sep))
        woven.append(as_col(part))
    return F.concat(*woven)


def part(c: Column | str, sep: str, i: int) -> Column:
    """0-based piece of a packed value; null past the end."""
    return F.get(F.split(as_col(c), sep), F.lit(i))


def before(c: Column | str, marker: str) -> Column:
    """Text ahead of the first ``marker``; empty when it is absent."""
    c = as_col(c)
    return F.when(F.instr(c, marker) > 0, F.substring_index(c, marker, 1)).when(
        c.isNotNull(), F.lit("")
    )


def suffix_key(c: Column | str, n: int = 4) -> Column:
    """``key_last4``: a function of the key, so joins may use the key itself."""
    return pack("_", c, last(c, n))


def is_blank(c: Column | str) -> Column:
    c = as_col(c)
    return c.isNull() | (F.trim(c) == "")


def null_to(c: Column | str, default: str | Column) -> Column:
    return F.coalesce(as_col(c), default if isinstance(default, Column) else F.lit(default))


def blank_to(c: Column | str, default: str) -> Column:
    """``default`` for null or the empty string (not for blanks only)."""
    c = as_col(c)
    return F.when(c.isNull() | (c == ""), F.lit(default)).otherwise(c)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def mcc(c: Column | str) -> Column:
    return fixed(c, 1, 3)


def mnc(c: Column | str) -> Column:
    """From character 4, for the field's length less five."""
    return fixed(c, 4, drop=5)


def activity_id(timestamp: Column | str, event_id: Column | str, delta: Column | str) -> Column:
    return F.concat(as_col(timestamp), as_col(event_id), as_col(delta))
