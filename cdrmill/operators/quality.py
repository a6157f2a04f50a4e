"""Routing of records: quarantine, completeness, totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import total
from ..functions.text import all_of, any_of, fixed, is_blank
from ..functions.times import compact_date
from ..sentinels import MISSING_ID, NOT_QUALIFIED

GOOD, REJECT, BAD = "GOOD", "REJECT", "BAD"


def quarantine_bad(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(good, bad): bad records have all of ``columns`` null. Blank is not null."""
    empty = all_of([F.col(c).isNull() for c in columns])
    return df.filter(~empty), df.filter(empty)


def any_missing(sentinels: Mapping[str, str]) -> Column:
    """True when any column is null, blank or its own sentinel."""
    return any_of([is_blank(c) | (F.col(c) == s) for c, s in sentinels.items()])


def reject_if_any_missing(
    df: DataFrame, sentinels: Mapping[str, str], out: str = "status_data"
) -> DataFrame:
    return df.withColumn(out, F.when(any_missing(sentinels), F.lit(REJECT)).otherwise(F.lit(GOOD)))


def reject_if_first_missing(
    df: DataFrame,
    columns: Sequence[str],
    out: str = "status_reject",
    sentinels: Sequence[str] = (NOT_QUALIFIED, MISSING_ID),
) -> DataFrame:
    """"YES" when the first non-null of ``columns`` is a sentinel or all are
    null, else "NO"."""
    first = F.coalesce(*columns)
    return df.withColumn(
        out, F.when(first.isNull() | first.isin(*sentinels), F.lit("YES")).otherwise(F.lit("NO"))
    )


def good_if_all_present(df: DataFrame, columns: Sequence[str], out: str = "status_reject") -> DataFrame:
    present = all_of([F.col(c).isNotNull() for c in columns])
    return df.withColumn(out, F.when(present, F.lit(GOOD)).otherwise(F.lit(REJECT)))


def split_by(
    df: DataFrame, column: str, routes: Sequence[str], rest: str | None = None
) -> dict[str, DataFrame]:
    """A DataFrame per route. ``rest`` names the route of all other records,
    those without a value among them; without it the caller knows there are none."""
    parts = {route: df.filter(F.col(column) == route) for route in routes}
    if rest is not None:
        listed = F.col(column).isin(*routes) if routes else F.lit(False)
        parts[rest] = df.filter(~F.coalesce(listed, F.lit(False)))
    return parts


def route_counts(df: DataFrame, route: str, amount: str | None = None) -> DataFrame:
    """Records (and their amount) per route."""
    aggregates = [F.count(F.lit(1)).alias("records")]
    if amount:
        aggregates.append(total(amount).alias("amount"))
    return df.groupBy(route).agg(*aggregates)


def control_totals(
    df: DataFrame,
    *,
    amount: str,
    job_id: str,
    group_process: str,
    filetype: str,
    date: str = "event_date",
    keep_dashes: bool = False,
) -> DataFrame:
    """Count and amount per period, file and status.

    The period is the day as ``yyyyMMdd``; ``keep_dashes`` takes the date
    column's text as it is.
    """
    period = F.col(date).cast("string")
    return (
        df.select(
            (period if keep_dashes else compact_date(fixed(period, 1, 10))).alias("periode"),
            "filename",
            F.lit(job_id).alias("job_id"),
            F.lit(group_process).alias("group_process"),
            "status_data",
            "status",
            F.lit(filetype).alias("filetype"),
            F.col(amount).alias("_amount"),
        )
        .groupBy("periode", "filename", "job_id", "group_process", "status_data", "status", "filetype")
        .agg(F.count(F.lit(1)).alias("qty"), total("_amount").alias("rev"))
        .select(
            "periode", "filename", "job_id", "group_process", "status_data", "status", "qty", "rev", "filetype"
        )
    )
