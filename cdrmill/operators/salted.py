"""Joins on keys of very uneven frequency, salted by counted shares.

A shuffled join puts all records of a key into one task. Here a key's records
are counted first (over a sample, see ``KeyCounts``) and get as many salts as
their share of the rows asks for; its dimension rows are replicated just as
often, every other dimension row stays single. Records without a key match
nothing, each gets a salt of its own. Both sides then join on key and salt, so
one pass of shuffles serves any number of hot keys, and a key with many
dimension rows as well as one with a single row.

Nothing is counted for a dimension that Spark measures small enough to
broadcast: such a join moves no records.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .skew import HOT_ROWS, key_shares, row_code


class KeyCounts:
    """How often the values of some record columns occur: counted when a lookup
    asks for it, once.

    ``columns`` are record columns or, where ``rows`` is a frame the records are
    derived from, a mapping of record columns to expressions over ``rows``.
    None for ``hot_rows`` counts nothing.
    """

    def __init__(
        self,
        rows: DataFrame,
        columns: Sequence[str] | Mapping[str, Column],
        hot_rows: int | None = HOT_ROWS,
    ):
        if not isinstance(columns, Mapping):
            columns = {c: F.col(c) for c in columns}
        self.rows, self.columns, self.hot_rows = rows, dict(columns), hot_rows

    @property
    def salt(self) -> str:
        """Column that holds a record's salted key."""
        return "_salted_" + "_".join(self.columns)

    @cached_property
    def salts(self) -> DataFrame | None:
        """The hot keys and ``_salts`` for each, a local frame of at most
        skew.SPLIT_KEYS rows; None where there are none."""
        if self.hot_rows is None:
            return None
        known = self.rows.select(*[e.alias(c) for c, e in self.columns.items()]).na.drop()
        shares = key_shares(known, list(self.columns), self.hot_rows)
        return None if shares is None else shares.withColumnRenamed("_shares", "_salts")


def is_small(side: DataFrame) -> bool:
    """Whether Spark would broadcast it, by its own measure of the plan."""
    most = side.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= most


def _join_salts(df: DataFrame, salts: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """``_salts`` of each row's key (record columns -> columns of ``df``); null
    for keys that are not hot."""
    known = salts.withColumnsRenamed({c: f"_hot_{c}" for c in keys})
    same = [F.col(own) == F.col(f"_hot_{c}") for c, own in keys.items()]
    joined = df.join(F.broadcast(known), _all(same), "left")
    return joined.drop(*[f"_hot_{c}" for c in keys])


def _all(tests: Sequence[Column]) -> Column:
    found = tests[0]
    for test in tests[1:]:
        found = found & test
    return found


# Starts a key that no dimension holds.
NO_KEY = "\u0001"


def _salted(key: Column, salt: Column) -> Column:
    return F.concat(F.lit(NO_KEY), salt.cast("string"), F.lit(NO_KEY), key)


def add_salt(
    df: DataFrame, counts: KeyCounts, spread_by: Sequence[str] = (), kind: str | None = None
) -> DataFrame:
    """Add the salted key (``counts.salt``): the last counted column as text,
    with a salt where the key is hot, and one of the row's own where it is
    missing. Done once ahead of a chain of lookups by the same key, it lets them
    share one shuffle. ``kind`` is the dimension's type of the key, if another."""
    code, keys = row_code(df, spread_by), list(counts.columns)
    last = F.col(keys[-1])
    text = (last if kind is None else last.try_cast(kind)).cast("string")
    missing = text.isNull()
    for c in keys[:-1]:
        missing = missing | F.col(c).isNull()
    salted = F.when(missing, F.concat(F.lit(NO_KEY), code.cast("string")))
    if counts.salts is None:
        return df.withColumn(counts.salt, salted.otherwise(text))
    known = _join_salts(df, counts.salts, {c: c for c in keys})
    hot = F.col("_salts").isNotNull()
    salted = salted.when(hot, _salted(text, F.pmod(code, F.col("_salts"))))
    return known.withColumn(counts.salt, salted.otherwise(text)).drop("_salts")


def replicate(side: DataFrame, counts: KeyCounts, keys: Mapping[str, str], out: str) -> DataFrame:
    """The dimension's rows with their salted key, those of hot keys once for
    each salt. ``keys`` maps the counted record columns to columns of ``side``."""
    text = F.col(list(keys.values())[-1]).cast("string")
    if counts.salts is None:
        return side.withColumn(out, text)
    known = _join_salts(side, counts.salts, keys)
    numbers = F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1)
    salted = F.transform(numbers, lambda salt: _salted(text, salt))
    salted = F.when(F.col("_salts").isNotNull(), salted).otherwise(F.array(text))
    return known.withColumn(out, F.explode(salted)).drop("_salts")
