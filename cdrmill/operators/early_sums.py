"""Sums over a lookup, added up before it.

Where records would be shuffled to meet a dimension, sums by join key and own
group keys go ahead of the lookup and are merged behind it: rows of a popular
key are added up where they are read, and what is shuffled is one row for each
key and group. A dimension small enough to broadcast moves no records, so there
the lookup goes first and one round of sums does. Groups that ask nothing of the
dimension skip the lookup, or take from it only how often it would multiply
their records.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lookup import lookup
from .salted import KeyCounts, is_small
from .skew import HOT_ROWS


def sum_by(df: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def sum_through_lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    derived: Mapping[str, Column],
    keys: Sequence[str],
    sums: Sequence[str],
    *,
    hit: str | None = None,
    unique: bool = True,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """``sums`` by ``keys`` of the records looked up in ``dim``.

    ``on``, ``take``, ``hit`` and ``unique`` are those of ``lookup``; ``derived``
    are the group keys made of what it takes, all others are columns of ``df``.
    Sums of no values are null, as ever.
    """
    join_keys, own = list(on), [k for k in keys if k not in derived]
    if len(own) == len(keys):
        if unique:
            return sum_by(df, keys, sums)
        matched = dim.select(*[F.col(c).alias(k) for k, c in on.items()]).na.drop()
        times = matched.groupBy(*join_keys).agg(F.count(F.lit(1)).alias("_times"))
        early = sum_by(df, [*dict.fromkeys([*join_keys, *own])], sums)
        counts = KeyCounts(early, join_keys, hot_rows)
        found = lookup(early, times, {k: k for k in on}, {"_times": "_times"}, unique=False, counts=counts)
        often = F.coalesce(F.col("_times"), F.lit(1))
        return sum_by(found.withColumns({c: F.col(c) * often for c in sums}), keys, sums)
    if not is_small(dim):
        df = sum_by(df, [*dict.fromkeys([*join_keys, *own])], sums)
    counts = KeyCounts(df, join_keys, hot_rows)
    found = lookup(df, dim, on, take, hit=hit, unique=unique, counts=counts)
    return sum_by(found.withColumns(dict(derived)), keys, sums)
