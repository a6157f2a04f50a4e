"""Left lookups into a dimension.

A dimension that Spark measures below its threshold is broadcast. Otherwise
records and dimension are shuffled by key, and by a salt where a key is hot or
missing (``salted``). AQE cannot do this here: it splits a join only when both
inputs come straight from a shuffle, and chained lookups share one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import all_of, as_col
from .salted import NO_KEY, KeyCounts, add_salt, is_small, replicate
from .skew import keep_one


def spread_key(
    key: Column | str, by: Sequence[str], missing: Column | None = None, mark: str = NO_KEY
) -> Column:
    """``key``, or where it is missing a key of the row's own that matches nothing.

    Keeps the key-less records of an outer join from meeting in one task. The
    key is a function of the row (give ``by`` what tells rows apart), so a
    retried task chooses the same.
    """
    key = as_col(key)
    missing = key.isNull() if missing is None else missing
    return F.when(missing, F.concat(F.lit(mark), F.xxhash64(*by).cast("string"))).otherwise(key)


def is_spread(key: Column | str) -> Column:
    return as_col(key).startswith(NO_KEY)


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    *,
    hit: str | None = None,
    unique: bool = True,
    prefer: Sequence[str] = (),
    spread_by: Sequence[str] = (),
    counts: KeyCounts | None = None,
) -> DataFrame:
    """Left join ``dim`` and take some of its columns.

    ``on`` maps record column to dimension column, ``take`` output name to
    dimension column (an output name may replace a record column). ``hit``
    names a boolean "found" column. With ``unique`` one dimension row per key
    is kept, the smallest by ``prefer``; without it duplicates multiply the
    records. Keys are counted in ``df`` unless ``counts`` (of some of the ``on``
    columns) says where. ``spread_by`` names the columns that tell records apart.
    """
    key_of = {right: f"_d{i}" for i, right in enumerate(dict.fromkeys(on.values()))}
    keys = list(key_of.values())
    side = dim.select(
        *[F.col(right).alias(name) for right, name in key_of.items()],
        *[F.col(source).alias(f"_t_{name}") for name, source in take.items()],
        *[F.col(c).alias(f"_p_{c}") for c in prefer],
    ).filter(all_of([F.col(name).isNotNull() for name in keys]))
    if unique:
        side = keep_one(side, keys, [f"_p_{c}" for c in prefer])
    side = side.drop(*[f"_p_{c}" for c in prefer])

    counts = KeyCounts(df, list(on)) if counts is None else counts
    given = counts.salt in df.columns
    same = {left: F.col(left) == F.col(key_of[right]) for left, right in on.items()}
    if given or not is_small(side):
        last = list(counts.columns)[-1]
        kind = side.schema[key_of[on[last]]].dataType.simpleString()
        if not given:
            df = add_salt(df, counts, spread_by, None if dict(df.dtypes)[last] == kind else kind)
        side = replicate(side, counts, {c: key_of[on[c]] for c in counts.columns}, "_d_salted")
        same[last] = F.col(counts.salt) == F.col("_d_salted")
        keys = [*keys, "_d_salted"]
    joined = df.join(side, all_of(list(same.values())), "left")
    taken = {name: F.col(f"_t_{name}") for name in take}
    if hit:
        taken[hit] = F.col(keys[0]).isNotNull()
    spent = [*keys, *[f"_t_{name}" for name in take]]
    return joined.withColumns(taken).drop(*spent, *([] if given else [counts.salt]))
